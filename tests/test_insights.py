import json

from leadlens.dictionary import CONTACTS
from leadlens.operators import insights
from leadlens.sources import sinks


def test_nine_rows(few):
    stats = insights.shared_stats(few, CONTACTS)
    assert tuple(insights.insight_overall(stats).first()) == (9, 4, 0.4444)
    assert tuple(insights.insight_unknown(stats, CONTACTS).first()) == ("default", 2 / 9, "warn")
    assert tuple(insights.insight_sentinel(stats).first()) == (5, 5 / 9)
    means = insights.insight_leakage(stats).first()
    assert (round(means[0], 2), means[1]) == (442.5, 113.0)
    assert insights.insight_correlation(stats, CONTACTS).collect() == []
    assert tuple(insights.insight_contact(stats).first()) == (2, 0.0, 4 / 7, "lower")
    assert insights.segment_lift(few, CONTACTS).collect() == []


def test_report(few, tmp_path):
    report = insights.insight_report(few, CONTACTS)
    row = report.first()
    assert (row["dataset"], row["n_rows"], row["positive_rate"]) == ("train", 9, 0.4444)
    assert [(i["category"], i["level"]) for i in row["items"]] == [
        ("business", "info"), ("quality", "warn"), ("quality", "suggest"), ("modeling", "warn"), ("business", "suggest"),
    ]
    sinks.write_insight_report(report, str(tmp_path / "report"))
    [part] = (tmp_path / "report").glob("part-*.json")
    written = json.loads(part.read_text(encoding="utf-8"))
    assert written["n_rows"] == 9 and written["items"][0]["metrics"]["rate"] == "44.44%"


def test_without_labels_only_quality(few):
    row = insights.insight_report(few.drop("subscribe"), CONTACTS, "test").first()
    assert (row["n_rows"], row["positive_rate"]) == (9, None)
    assert {i["category"] for i in row["items"]} == {"quality"}


def test_empty_table_warns(few):
    row = insights.insight_report(few.limit(0), CONTACTS).first()
    assert (row["n_rows"], row["positive_rate"]) == (0, None)
    assert [i["level"] for i in row["items"]] == ["warn"]


def test_planted_signal_is_found(leaning):
    lift = {r["column"]: r for r in insights.segment_lift(leaning, CONTACTS).collect()}
    assert lift["poutcome"]["best_value"] == "success" and lift["poutcome"]["lift"] > 2
    top = insights.insight_correlation(insights.shared_stats(leaning, CONTACTS), CONTACTS).collect()
    assert [r["rank"] for r in top] == [1, 2, 3]
    pdf = leaning.toPandas()
    coded = (pdf.subscribe == "yes").astype(float)
    want = {c: pdf[c].corr(coded) for c in CONTACTS.numerics}
    best = sorted(want, key=lambda c: -abs(want[c]))[:3]
    assert [r["column"] for r in top] == best
    assert all(abs(r["r"] - want[r["column"]]) < 1e-9 for r in top)


def test_lift_over_a_zero_rate(spark):
    rows = [("a", "no")] * 30 + [("b", "yes")] * 30 + [("c", "yes")] * 29
    df = spark.createDataFrame(rows, "job string, subscribe string")
    [row] = insights.segment_lift(df, CONTACTS).collect()
    assert (row["best_value"], row["worst_value"], row["lift"], row["worst_rate_is_zero"]) == ("b", "a", None, True)


def test_unlabelled_rows_leave_the_denominators(spark, few):
    from pyspark.sql import functions as F

    mixed = few.union(few.withColumn("subscribe", F.lit(None).cast("string")))
    stats = insights.shared_stats(mixed, CONTACTS)
    assert tuple(insights.insight_overall(stats).first()) == (18, 4, 0.4444)
    assert tuple(insights.insight_contact(stats).first())[1:] == (0.0, 4 / 7, "lower")
