"""Exact metrics of ranked scores. Input: a DataFrame with ``label`` (0/1) and ``score``.

Everything starts from one row per distinct score, so ties cost nothing and a score shared by a
third of the table is summed map-side. The ordered part runs per score bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlens.functions.shapes import count_if, ratio, ratio_or_zero, ratio_sql
from leadlens.operators.ranking import ROWS_PER_BUCKET, running_totals, value_range, with_bucket


def score_counts(scored: DataFrame) -> DataFrame:
    """(score, tp, fp) per distinct score."""
    positive = F.col("label") == 1
    return (
        scored.select(F.col("label"), F.col("score").cast("double").alias("score"))
        .groupBy("score")
        .agg(count_if(positive).alias("tp"), count_if(~positive).alias("fp"))
    )


def score_histogram(
    scored: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET, n_rows: int | None = None
) -> DataFrame:
    """(score, tp, fp, cum_tp, cum_fp, n_pos, n_neg): counts per score, cumulative from the highest
    score down, and over all. A caller that knows the rows fit one bucket passes ``n_rows`` and
    saves the pass that finds the edges."""
    one_bucket = n_rows is not None and n_rows <= rows_per_bucket
    edges = () if one_bucket else value_range(scored, "score", rows_per_bucket).edges
    hist = running_totals(score_counts(scored), "score", {"cum_tp": "tp", "cum_fp": "fp"}, edges)
    return hist.withColumnsRenamed({"all_cum_tp": "n_pos", "all_cum_fp": "n_neg"})


def ranked_summary(hist: DataFrame) -> DataFrame:
    """One row (n_pos, n_neg, roc_auc, average_precision) from one pass over the histogram.

    ROC-AUC gives half credit for ties and is NULL when one class is absent; average precision is
    the precision at each distinct score weighted by its gain in recall.
    """
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    behind = tp * (F.col("cum_fp").cast("double") - fp / 2)
    precision = ratio(F.col("cum_tp"), F.col("cum_tp") + F.col("cum_fp"))
    sums = hist.agg(
        F.coalesce(F.sum("tp"), F.lit(0)).alias("n_pos"),
        F.coalesce(F.sum("fp"), F.lit(0)).alias("n_neg"),
        F.sum(behind).alias("behind"),
        F.sum(tp * precision).alias("precise"),
    )
    pairs = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return sums.select(
        "n_pos",
        "n_neg",
        (1 - F.try_divide(F.col("behind"), pairs)).alias("roc_auc"),
        ratio(F.col("precise"), F.col("n_pos")).alias("average_precision"),
    )


def roc_auc(hist: DataFrame) -> DataFrame:
    return ranked_summary(hist).select("roc_auc")


def average_precision(hist: DataFrame) -> DataFrame:
    return ranked_summary(hist).select("average_precision")


def pr_curve(hist: DataFrame) -> DataFrame:
    """(threshold, precision, recall) per distinct score, plus the end point (1, 0) without threshold."""
    curve = hist.select(
        F.col("score").alias("threshold"),
        ratio(F.col("cum_tp"), F.col("cum_tp") + F.col("cum_fp")).alias("precision"),
        ratio_or_zero(F.col("cum_tp"), F.col("n_pos")).alias("recall"),
    )
    end = hist.sparkSession.range(0, 1, 1, 1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return curve.unionByName(end)


_F1 = f"coalesce({ratio_sql('cum_tp * 2', 'cum_tp + cum_fp + n_pos')}, 0D)"


def best_f1(hist: DataFrame) -> DataFrame:
    """One row (threshold, f1): the smallest of the scores with the highest F1."""
    ranked = hist.selectExpr("score AS threshold", f"{_F1} AS f1")
    return ranked.orderBy(F.round("f1", 12).desc(), "threshold").limit(1)


def confusion(scored: DataFrame, threshold: float) -> DataFrame:
    """One row (tn, fp, fn, tp) at score >= threshold."""
    called, positive = F.col("score") >= F.lit(float(threshold)), F.col("label") == 1
    return scored.agg(
        count_if(~called & ~positive).alias("tn"),
        count_if(called & ~positive).alias("fp"),
        count_if(~called & positive).alias("fn"),
        count_if(called & positive).alias("tp"),
    )


def _rates(counts: DataFrame, threshold: Column, *keep: str) -> DataFrame:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.select(
        *keep,
        threshold.alias("threshold"),
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp, tp + fn).alias("recall"),
        ratio_or_zero(tp * 2, tp * 2 + fp + fn).alias("f1"),
        ratio_or_zero(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        "tn", "fp", "fn", "tp",
    )


def threshold_metrics(scored: DataFrame, threshold: float) -> DataFrame:
    """One row (threshold, precision, recall, f1, accuracy, tn, fp, fn, tp); 0 on an empty denominator."""
    return _rates(confusion(scored, threshold), F.lit(float(threshold)))


def evaluate(
    scored: DataFrame,
    name: str,
    threshold_from: DataFrame | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    n_rows: int | None = None,
) -> DataFrame:
    """One row of metrics at the best-F1 threshold. The threshold is chosen on the scored rows
    themselves, whose histogram then holds the confusion matrix too, unless another scored frame
    is given for it."""
    hist = score_histogram(scored, rows_per_bucket, n_rows)
    if threshold_from is not None:
        threshold = best_f1(score_histogram(threshold_from, rows_per_bucket)).first()[0]
        ranked = ranked_summary(hist).first()
        auc, precise = (F.lit(ranked[c]).cast("double").alias(c) for c in ("roc_auc", "average_precision"))
        return threshold_metrics(scored, threshold).select(F.lit(name).alias("model"), auc, precise, "*")
    found = hist.selectExpr(
        "sum(tp) AS n_pos",
        "sum(fp) AS n_neg",
        "sum(CAST(tp AS DOUBLE) * (CAST(cum_fp AS DOUBLE) - CAST(fp AS DOUBLE) / 2D)) AS behind",
        "sum(CAST(tp AS DOUBLE) * CAST(cum_tp AS DOUBLE) / CAST(cum_tp + cum_fp AS DOUBLE)) AS precise",
        "max_by(named_struct('score', score, 'tp', cum_tp, 'fp', cum_fp),"
        f" named_struct('f1', round({_F1}, 12), 'low', -score)) AS best",
    ).where("n_pos + n_neg > 0")
    metrics = _rates(
        found.selectExpr(
            "1D - try_divide(behind, CAST(n_pos AS DOUBLE) * CAST(n_neg AS DOUBLE)) AS roc_auc",
            f"{ratio_sql('precise', 'n_pos')} AS average_precision",
            "best.score AS threshold",
            "n_neg - best.fp AS tn",
            "best.fp AS fp",
            "n_pos - best.tp AS fn",
            "best.tp AS tp",
        ),
        F.col("threshold"),
        "roc_auc",
        "average_precision",
    )
    return metrics.select(F.lit(name).alias("model"), "*")


def long_scores(df: DataFrame, scores: Sequence[str], key: str = "model") -> DataFrame:
    """(key, label, score): a row for each of the score columns named."""
    pairs = F.array(*[F.struct(F.lit(c).alias(key), F.col(f"`{c}`").cast("double").alias("score")) for c in scores])
    return df.select("label", F.explode(pairs).alias("pair")).select(f"pair.{key}", "label", "pair.score")


def keyed_histogram(scored: DataFrame, key: str = "model", rows_per_bucket: int = ROWS_PER_BUCKET, n_rows: int | None = None) -> DataFrame:
    """``score_histogram`` within each key (a model, a segment), for all keys at once. Counts are first summed by (key, score), then by
    (key, bucket); the ordered part runs per key and bucket, so that a large key is cut by its scores. Buckets are common to the keys."""
    rows = scored.select(F.col(f"`{key}`").alias("key"), "label", F.col("score").cast("double").alias("score")).where("score IS NOT NULL")
    edges = () if n_rows is not None and n_rows <= rows_per_bucket else value_range(rows, "score", rows_per_bucket).edges
    positive = F.col("label") == 1
    counts = with_bucket(rows, "score", edges).groupBy("key", "bucket", "score").agg(count_if(positive).alias("tp"), count_if(~positive).alias("fp"))
    inside = Window.partitionBy("key", "bucket").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    local = counts.select("*", *[F.sum(c).over(inside).alias(f"in_{c}") for c in ("tp", "fp")])
    before = Window.partitionBy("key").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("key")
    sums = counts.groupBy("key", "bucket").agg(*[F.sum(c).alias(f"sum_{c}") for c in ("tp", "fp")])  # MAX_BUCKETS rows a key at most
    sums = sums.select(
        "key", "bucket", *[F.coalesce(F.sum(f"sum_{c}").over(before), F.lit(0)).alias(f"off_{c}") for c in ("tp", "fp")],
        F.sum("sum_tp").over(whole).alias("n_pos"), F.sum("sum_fp").over(whole).alias("n_neg"),
    )
    sums = sums.select(F.col("key").alias("of"), F.col("bucket").alias("at"), "off_tp", "off_fp", "n_pos", "n_neg")
    joined = local.join(sums, F.col("key").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("at")))
    cumulated = [(F.col(f"in_{c}") + F.col(f"off_{c}")).alias(f"cum_{c}") for c in ("tp", "fp")]
    return joined.select(F.col("key").alias(key), "score", "tp", "fp", *cumulated, "n_pos", "n_neg")


def evaluate_keyed(scored: DataFrame, key: str = "model", rows_per_bucket: int = ROWS_PER_BUCKET, n_rows: int | None = None) -> DataFrame:
    """The evaluation record of every key in one job: (key, threshold, precision, recall, f1, accuracy, tn, fp, fn, tp, roc_auc, average_precision),
    each at the threshold of its own best F1."""
    hist = keyed_histogram(scored, key, rows_per_bucket, n_rows)
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    behind = tp * (F.col("cum_fp").cast("double") - fp / 2)
    precision = ratio(F.col("cum_tp"), F.col("cum_tp") + F.col("cum_fp"))
    place = F.struct(F.round(F.expr(_F1), 12).alias("f1"), (-F.col("score")).alias("low"), "score", "cum_tp", "cum_fp")
    sums = hist.groupBy(key).agg(
        F.max("n_pos").alias("n_pos"), F.max("n_neg").alias("n_neg"), F.sum(behind).alias("behind"), F.sum(tp * precision).alias("precise"), F.max(place).alias("best"),
    )
    counts = sums.select(
        key, (F.col("n_neg") - F.col("best.cum_fp")).alias("tn"), F.col("best.cum_fp").alias("fp"),
        (F.col("n_pos") - F.col("best.cum_tp")).alias("fn"), F.col("best.cum_tp").alias("tp"), F.col("best.score").alias("at"),
        (1 - F.try_divide(F.col("behind"), F.col("n_pos").cast("double") * F.col("n_neg").cast("double"))).alias("roc_auc"),
        ratio(F.col("precise"), F.col("n_pos")).alias("average_precision"),
    )
    return _rates(counts, F.col("at"), key, "roc_auc", "average_precision")


def gain_table(hist: DataFrame, parts: int = 10) -> DataFrame:
    """(part, n, n_pos, rate, cum_n, cum_pos, gain, lift) by falling score.

    A tied score belongs to the part of its best rank as a whole; parts swallowed by a tie are
    left out.
    """
    cells = hist.selectExpr(
        f"floor((cum_tp + cum_fp - tp - fp) * {parts} / (n_pos + n_neg)) + 1 AS part", "tp", "tp + fp AS size", "n_pos", "n_neg"
    )
    grouped = cells.groupBy("part").agg(
        F.sum("size").alias("n"),
        F.sum("tp").alias("n_pos"),
        F.first("n_pos").alias("all_pos"),
        F.first(F.col("n_pos") + F.col("n_neg")).alias("all_rows"),
    )
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    gain = ratio(F.col("cum_pos"), F.col("all_pos"))
    return (
        grouped.withColumn("cum_n", F.sum("n").over(upto))
        .withColumn("cum_pos", F.sum("n_pos").over(upto))
        .select(
            "part", "n", "n_pos", ratio(F.col("n_pos"), F.col("n")).alias("rate"), "cum_n", "cum_pos",
            gain.alias("gain"), F.try_divide(gain, ratio(F.col("cum_n"), F.col("all_rows"))).alias("lift"),
        )
    )
