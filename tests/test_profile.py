import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leadlens.dictionary import CONTACTS, DatasetError, FieldDictionary
from leadlens.operators import profile, quality

FD = FieldDictionary(target="y", categoricals=("g",), numerics=("x", "z"))


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_target_distribution(spark, few):
    assert rows(profile.target_distribution(few, CONTACTS), "label", "n", "rate") == [("no", 5, 4 / 9), ("yes", 4, 4 / 9)]
    odd = spark.createDataFrame([("maybe",), (None,), ("no",)], "subscribe string")
    assert rows(profile.target_distribution(odd, CONTACTS), "label", "n", "rate") == [("no", 1, 0.0), ("yes", 0, 0.0)]
    with pytest.raises(DatasetError):
        profile.target_distribution(few.drop("subscribe"), CONTACTS)


def test_categorical_distribution(few):
    got = profile.categorical_distribution(few, ["contact", "education"], CONTACTS)
    assert ("contact", "cellular", 6, 0) in rows(got, "column", "value", "n", "position")
    first = got.where("column = 'education' AND position = 0").first()
    assert (first["value"], first["n"]) == ("unknown", 1)
    by = profile.categorical_by_target(few, ["contact"], CONTACTS)
    assert rows(by, "value", "label", "n") == [
        ("cellular", "no", 2), ("cellular", "yes", 4), ("telephone", "no", 3),
    ]


def test_rate_by_category(spark, few):
    got = profile.rate_by_category(few, ["poutcome", "contact"], CONTACTS)
    assert rows(got.where("column = 'poutcome'"), "position", "value", "n_pos", "n") == [
        (0, "success", 2, 2), (1, "failure", 1, 2), (2, "nonexistent", 1, 5),
    ]
    assert rows(got.where("column = 'contact'"), "value", "rate") == [("cellular", 2 / 3), ("telephone", 0.0)]
    gaps = spark.createDataFrame([("a", None), ("a", "yes"), ("b", None), (None, "yes")], "g string, y string")
    assert rows(profile.rate_by_category(gaps, ["g"], FD), "value", "n", "rate") == [("a", 1, 1.0), ("b", 0, None)]


def test_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 9, 10)] + [(None,)], "x double")
    assert rows(profile.numeric_histogram(df, "x", bins=5), "bin", "lo", "hi", "n") == [(0, 0, 2, 2), (1, 2, 4, 1), (4, 8, 10, 2)]
    assert rows(profile.numeric_histogram(df.where("x = 2"), "x"), "bin", "lo", "n") == [(0, 2, 1)]
    assert profile.numeric_histogram(df.limit(0), "x").collect() == []


def test_quantile_bins_follow_the_definition(spark):
    values = [1, 1, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 10, 10.5]
    df = spark.createDataFrame([(float(v), "yes" if v > 5 else "no") for v in values], "x double, y string")
    got = profile.rate_by_numeric(df, "x", FD, bins=4)
    assert rows(got, "lo", "hi", "n") == [(1, 1.5, 4), (1.5, 5, 4), (5, 8.5, 3), (8.5, 10.5, 4)]
    assert rows(got, "bin", "n_pos") == [(0, 0), (1, 0), (2, 3), (3, 4)]
    tied = spark.createDataFrame([(float(v), "no") for v in [0] * 12 + list(range(1, 10))], "x double, y string")
    assert rows(profile.rate_by_numeric(tied, "x", FD, bins=8), "lo", "hi") == [(0, 1.5), (1.5, 4), (4, 6.5), (6.5, 9)]
    few = profile.rate_by_numeric(df.where("x <= 3"), "x", FD, bins=4)
    assert rows(few, "bin", "lo", "n") == [(0, 1, 4), (1, 2, 1), (2, 3, 1)]


def test_quantile_bins_match_pandas_on_random_values(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.gamma(2.0, 10.0, 3000), 3)
    x[:1000] = 7.25  # a third of the rows share one value
    frame = pd.DataFrame({"x": x, "y": np.where(rng.random(3000) < 0.3, "yes", "no")})
    cut = pd.qcut(frame.x, 8, duplicates="drop")
    want = frame.groupby(cut, observed=True).y.agg(["count", lambda s: (s == "yes").sum()])
    span = profile.value_range(spark.createDataFrame(frame), "x", rows_per_bucket=50)
    assert len(span.edges) > 20
    label = F.col("y")
    got = profile.rate_by_quantile_bin(spark.createDataFrame(frame), "x", label, label == "yes", 8, span).orderBy("bin")
    assert [(r["n"], r["n_pos"]) for r in got.collect()] == [tuple(r) for r in want.itertuples(index=False)]


def test_correlation_matrix_matches_pandas(spark):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame({"x": rng.normal(1e6, 3, 500), "z": rng.normal(0, 1, 500)})
    frame["x2"] = frame.x * 0.5 + rng.normal(0, 1, 500)
    frame.loc[::7, "z"] = None
    frame.loc[::5, "x2"] = None
    frame["c"] = 0.1
    frame["only"] = np.where(frame.x2.isna(), rng.normal(0, 1, 500), 4.25)  # constant beside x2
    frame["y"] = np.where(rng.random(500) < 0.4, "yes", "no")
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None), "x double, z double, x2 double, c double, only double, y string")
    got = {(r["x"], r["y"]): r["r"] for r in profile.correlation_matrix(df.repartition(7), FD, ["x2", "c", "only"]).collect()}
    frame["y"] = (frame.y == "yes").astype(float)
    want = frame.corr()
    assert len(got) == 36
    for a in frame.columns:
        for b in frame.columns:
            if "c" in (a, b) or {a, b} == {"x2", "only"}:
                assert got[a, b] is None
            else:
                assert got[a, b] == pytest.approx(want.loc[a, b], abs=6e-4), (a, b)


def test_correlation_of_little(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, None), (3.0, 3.0), (4.0, 5.0)], "x double, z double")
    got = {(r["x"], r["y"]): r["r"] for r in profile.correlation_matrix(df, FD).collect()}
    assert got["x", "z"] == 0.982
    assert profile.correlation_matrix(df.limit(0), FD).collect() == []
    assert profile.correlation_matrix(df.select("x"), FD).collect() == []


def test_missing_overview(few):
    got = {r["column"]: (r["n_missing"], r["share"]) for r in quality.missing_overview(few, CONTACTS).collect()}
    assert {c for c, (n, _) in got.items() if n} == {"job", "education", "default", "housing", "loan"}
    assert got["job"] == (1, 1 / 9) and len(got) == 20
    assert quality.missing_overview(few.limit(0), CONTACTS).collect() == []


def test_audit_and_duplicates(spark, few):
    bad = few.union(few.where("id = 11").withColumns({"age": F.lit(5.0), "month": F.lit("x"), "campaign": F.lit(None).cast("double")}).select(*[F.col(f"`{c}`") for c in few.columns]))
    got = {r["rule"]: r["n_violations"] for r in quality.constraint_audit(bad, quality.contact_rules()).collect()}
    assert {r for r, n in got.items() if n} == {"age_17_to_100", "month_known", "campaign_not_null"}
    assert rows(quality.duplicate_keys(bad, "id"), "key", "n") == [(11, 2)]


def test_results_do_not_depend_on_partitioning(leaning):
    runs = []
    for n in (1, 7, 60):
        df = leaning.repartition(n)
        runs.append(
            [
                rows(profile.rate_by_category(df, ["job", "month"], CONTACTS), "column", "value", "n", "rate", "position"),
                rows(profile.rate_by_numeric(df, "nr_employed", CONTACTS), "bin", "lo", "hi", "n", "rate"),
            ]
        )
    assert runs[0] == runs[1] == runs[2]
