import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlens.dictionary import SCAN_THRESHOLDS, Config
from leadlens.operators import benefit, evaluate


def scored(spark, labels, scores):
    return spark.createDataFrame([(int(y), float(s)) for y, s in zip(labels, scores)], "label int, score double")


SIX = ([1, 0, 1, 0, 0, 1], [0.9, 0.8, 0.7, 0.6, 0.5, 0.5])


def brute(labels, scores):
    """AUC by pairs, AP and F1 by every threshold, straight from the definitions."""
    y, s = np.asarray(labels), np.asarray(scores)
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg]) if len(pos) and len(neg) else None
    ap, f1s, before = 0.0, [], 0.0
    for t in sorted(set(s), reverse=True):
        tp, called = ((s >= t) & (y == 1)).sum(), (s >= t).sum()
        ap += (tp / len(pos) - before) * tp / called if len(pos) else 0
        before = tp / len(pos) if len(pos) else 0
        f1s.append((round(2 * tp / (called + len(pos)), 12), -t))
    best = max(f1s)
    return auc, ap, -best[1], best[0]


def test_known_six(spark):
    row = evaluate.evaluate(scored(spark, *SIX), "m").first()
    assert round(row["average_precision"], 4) == 0.7222 and round(row["roc_auc"], 4) == 0.6111


@pytest.mark.parametrize("rows_per_bucket", [20, 100_000])
@pytest.mark.parametrize("kind", ["fine", "tied", "hot"])
def test_against_brute_force(spark, kind, rows_per_bucket):
    rng = np.random.default_rng(8)
    s = rng.random(400) ** 3
    if kind == "tied":
        s = np.round(s, 1)
    if kind == "hot":
        s[:140] = 0.125
    y = rng.random(400) < 0.2 + 0.4 * s
    df = scored(spark, y, s).repartition(5)
    auc, ap, threshold, f1 = brute(y, s)
    row = evaluate.evaluate(df, "m", rows_per_bucket=rows_per_bucket).first()
    assert row["roc_auc"] == pytest.approx(auc) and row["average_precision"] == pytest.approx(ap)
    assert row["threshold"] == threshold and row["f1"] == pytest.approx(f1)
    assert row["tp"] + row["fn"] == y.sum() and row["tp"] + row["fp"] == (s >= threshold).sum()
    hist = evaluate.score_histogram(df, rows_per_bucket)
    best = evaluate.best_f1(hist).first()
    assert (best["threshold"], best["f1"]) == (threshold, pytest.approx(f1))
    curve = evaluate.pr_curve(hist).collect()
    assert len(curve) == len(set(s)) + 1
    assert [(r["precision"], r["recall"]) for r in curve if r["threshold"] is None] == [(1.0, 0.0)]


def test_one_class_only(spark):
    none = evaluate.evaluate(scored(spark, [0, 0, 0], [0.1, 0.2, 0.3]), "m").first()
    assert (none["roc_auc"], none["average_precision"], none["f1"], none["threshold"]) == (None, None, 0.0, 0.1)
    every = evaluate.evaluate(scored(spark, [1, 1], [0.1, 0.2]), "m").first()
    assert (every["roc_auc"], every["average_precision"]) == (None, 1.0)


def test_threshold_from_other_rows(spark):
    other = scored(spark, [1, 0], [0.75, 0.1])
    row = evaluate.evaluate(scored(spark, *SIX), "m", threshold_from=other).first()
    assert row["threshold"] == 0.75 and (row["tp"], row["fp"]) == (1, 1)


# Published confusion matrices (tn, fp, fn, tp) with precision, recall, F1, accuracy to four places.
MATRICES = [
    ((3463, 447, 214, 376), None, None, 0.5322, 0.8531),
    ((3488, 422, 223, 367), None, None, 0.5323, 0.8567),
]


@pytest.mark.parametrize("matrix,precision,recall,f1,accuracy", MATRICES)
def test_published_matrices(spark, matrix, precision, recall, f1, accuracy):
    tn, fp, fn, tp = matrix
    df = spark.range(1).selectExpr(
        f"explode(concat(array_repeat(named_struct('label', 0, 'score', 0D), {tn}), array_repeat(named_struct('label', 0, 'score', 1D), {fp}),"
        f" array_repeat(named_struct('label', 1, 'score', 0D), {fn}), array_repeat(named_struct('label', 1, 'score', 1D), {tp}))) AS r"
    ).select("r.*")
    row = evaluate.threshold_metrics(df, 0.5).first()
    assert (round(row["f1"], 4), round(row["accuracy"], 4)) == (f1, accuracy)
    assert tuple(evaluate.confusion(df, 0.5).first()) == matrix


# The published scan, threshold -> (called, true positives, net, lift over calling all).
SCAN = {
    0.05: (4500, 590, 14000, 0), 0.1: (4468, 590, 14320, 320), 0.2: (3511, 555, 20390, 6390),
    0.3: (2027, 485, 28230, 14230), 0.4: (1334, 444, 31060, 17060), 0.5: (994, 414, 31460, 17460),
    0.6: (852, 390, 30480, 16480), 0.7: (707, 348, 27730, 13730), 0.8: (393, 222, 18270, 4270),
}


def test_published_scan(spark):
    levels = list(SCAN)
    labels, scores = [], []
    for i, t in enumerate(levels):
        called, tp = SCAN[t][:2]
        after = SCAN[levels[i + 1]][:2] if i + 1 < len(levels) else (0, 0)
        n, p = called - after[0], tp - after[1]
        labels += [1] * p + [0] * (n - p)
        scores += [t] * n
    df = scored(spark, labels, scores)
    got = {r["threshold"]: r for r in benefit.benefit_scan(df).collect()}
    assert list(SCAN_THRESHOLDS) == levels
    for t, (called, tp, net, lift) in SCAN.items():
        r = got[t]
        assert (r["called"], r["tp"], r["net"], r["lift_vs_all"]) == (called, tp, net, lift)
    assert round(got[0.5]["precision"], 4) == 0.4165 and round(got[0.5]["recall"], 4) == 0.7017
    assert benefit.best_benefit(benefit.benefit_scan(df)).first()["threshold"] == 0.5


def test_benefit_arithmetic(spark):
    """Seven scores, three sales; calls cost 10 and a sale brings 100."""
    df = scored(spark, [0, 1, 0, 1, 0, 0, 1], [0.15, 0.22, 0.31, 0.48, 0.57, 0.66, 0.93])
    everyone = benefit.benefit_at(df, 0.0).first()
    assert (everyone["called"], everyone["tp"], everyone["cost"], everyone["revenue"], everyone["net"], everyone["lift_vs_all"]) == (7, 3, 70, 300, 230, 0)
    some = benefit.benefit_at(df, 0.48).first()
    assert (some["called"], some["tp"], some["net"], some["baseline_net"], some["lift_vs_all"]) == (4, 2, 160, 230, -70)
    assert (some["precision"], some["recall"], some["call_rate"]) == (0.5, 2 / 3, 4 / 7)
    nobody = benefit.benefit_at(df, 0.94).first()
    assert (nobody["called"], nobody["net"], nobody["lift_vs_all"], nobody["precision"], nobody["recall"], nobody["call_rate"]) == (0, 0, -230, 0, 0, 0)
    free = benefit.benefit_scan(df, [0.7, 0.2, 0.2], Config(cost_per_call=0.0))
    assert [r["tp"] for r in free.orderBy("position").collect()] == [1, 3, 3]
    assert benefit.best_benefit(free).first()["position"] == 1  # the first of equal thresholds
    empty = benefit.benefit_at(scored(spark, [], []), 0.5).first()
    assert (empty["called"], empty["net"]) == (0, 0)


def test_gain_table(spark):
    df = scored(spark, [1] * 20 + [0] * 80, [i / 100 for i in range(100, 0, -1)])
    rows = evaluate.gain_table(evaluate.score_histogram(df, 7)).orderBy("part").collect()
    assert [r["n"] for r in rows] == [10] * 10
    assert [r["gain"] for r in rows][:3] == [0.5, 1.0, 1.0] and rows[0]["lift"] == 5.0
    tied = evaluate.gain_table(evaluate.score_histogram(scored(spark, [1, 0, 0, 0], [0.5, 0.5, 0.5, 0.1]))).collect()
    assert sorted((r["part"], r["n"]) for r in tied) == [(1, 3), (8, 1)]


def test_keyed_records_equal_those_of_each_key(spark):
    """Ties, a key of one label, a NULL key; with many buckets and with one."""
    rng = np.random.default_rng(12)
    rows = [(k, int(rng.random() < 0.3), float(rng.choice([rng.random(), 0.25, 0.5]))) for k in ("a", "b", "c", None) for _ in range(300)]
    rows += [("one", 1, x / 10) for x in range(10)]
    df = spark.createDataFrame(rows, "model string, label int, score double").repartition(5)
    for rows_per_bucket in (20, 100_000):
        got = {r["model"]: r.asDict() for r in evaluate.evaluate_keyed(df, rows_per_bucket=rows_per_bucket).collect()}
        assert set(got) == {"a", "b", "c", None, "one"}
        for key, record in got.items():
            own = df.where(F.col("model").eqNullSafe(F.lit(key)))
            want = evaluate.evaluate(own.select("label", "score"), "x").first().asDict()
            assert {c: v for c, v in record.items() if c != "model"} == pytest.approx({c: v for c, v in want.items() if c != "model"}, nan_ok=True)
