"""Ways to code a category that is often unknown: by its own weight of evidence, or by filling the gap.

The weight of evidence of a level is the log of its share of the positives over its share of the negatives; the information value of a
column sums the differences of these shares times the weights. A row's weight is made from the other folds only: totals
less the own fold's, from one aggregate by (column, level, fold). Counts are raised by ``SMOOTHING`` on both sides, so every
weight is finite.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadlens.dictionary import FieldDictionary
from leadlens.functions.shapes import long_values
from leadlens.operators.filters import of_few_levels, require_target

SMOOTHING = 0.5


def level_counts(df: DataFrame, columns: Sequence[str], fd: FieldDictionary, fold: str | None = None) -> DataFrame:
    """(column, value, fold, n_pos, n_neg) of the labelled rows in one scan; without ``fold`` all rows are fold 0."""
    require_target(df, fd)
    target = F.col(f"`{fd.target}`")
    rows = df.where(target.isNotNull())
    place = F.col(f"`{fold}`").cast("int") if fold else F.lit(0)
    values = long_values(rows, list(columns), [place.alias("fold"), (target == fd.positive).alias("won")])
    return values.groupBy("column", "value", "fold").agg(F.count_if("won").alias("n_pos"), F.count_if(~F.col("won")).alias("n_neg"))


def _with_weights(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """woe and iv_part of every level within ``keys``."""
    whole = Window.partitionBy(*keys)
    levels = F.count("*").over(whole)
    share = {s: (F.col(f"n_{s}") + SMOOTHING) / (F.sum(f"n_{s}").over(whole) + SMOOTHING * levels) for s in ("pos", "neg")}
    woe = F.log(share["pos"] / share["neg"])
    return counts.withColumns({"woe": woe, "iv_part": (share["pos"] - share["neg"]) * woe})


def evidence(df: DataFrame, columns: Sequence[str], fd: FieldDictionary) -> DataFrame:
    """(column, value, n_pos, n_neg, rate, woe, iv): every level with its weight, and the information value of its column."""
    counts = of_few_levels(level_counts(df, columns, fd).drop("fold"))
    weighted = _with_weights(counts, ["column"])
    iv = F.sum("iv_part").over(Window.partitionBy("column"))
    rate = F.col("n_pos") / (F.col("n_pos") + F.col("n_neg"))
    return weighted.select("column", "value", "n_pos", "n_neg", rate.alias("rate"), "woe", iv.alias("iv"))


def held_out_evidence(df: DataFrame, columns: Sequence[str], fd: FieldDictionary, fold: str, folds: int) -> DataFrame:
    """(column, value, fold, n_pos, n_neg, woe): the weights that the rows of a fold (0 to ``folds`` - 1) get, counted without that
    fold. A level that only the own fold has keeps its weight from the smoothing alone."""
    counts = level_counts(df, columns, fd, fold)
    totals = counts.groupBy("column", "value").agg(*[F.sum(c).alias(f"all_{c}") for c in ("n_pos", "n_neg")])
    every = of_few_levels(totals).withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    own = counts.select("column", "value", "fold", F.col("n_pos").alias("own_pos"), F.col("n_neg").alias("own_neg"))
    joined = every.join(own, ["column", "value", "fold"], "left").na.fill(0, ["own_pos", "own_neg"])
    rest = joined.select("column", "value", "fold", *[(F.col(f"all_n_{s}") - F.col(f"own_{s}")).alias(f"n_{s}") for s in ("pos", "neg")])
    return _with_weights(rest, ["column", "fold"]).drop("iv_part")


def coded(df: DataFrame, column: str, fd: FieldDictionary, fold: str, folds: int, fill: str) -> DataFrame:
    """``df`` with the column's two codings: ``<column>_woe``, the weight of its level from the other folds, and ``<column>_filled``,
    where the unknown level becomes ``fill``. Rows without the category have NULL weights."""
    weights = held_out_evidence(df, [column], fd, fold, folds).select(F.col("value").alias("_level"), F.col("fold").alias("_fold"), F.col("woe").alias(f"{column}_woe"))
    value = F.col(f"`{column}`")
    joined = df.join(F.broadcast(weights), (value == F.col("_level")) & (F.col(f"`{fold}`").cast("int") == F.col("_fold")), "left")  # levels x folds
    return joined.drop("_level", "_fold").withColumn(f"{column}_filled", F.when(value == fd.unknown, F.lit(fill)).otherwise(value))


def coding_comparison(df: DataFrame, column: str, fd: FieldDictionary, fill: str) -> DataFrame:
    """(coding, value, n_pos, n_neg, rate, woe, iv) of the column as it is, with the unknown level filled by ``fill``, and as known or unknown only:
    what filling the gap loses of the information value, and what the gap alone carries."""
    value = F.col(f"`{column}`")
    unknown = value == fd.unknown
    wide = df.select(
        F.col(f"`{fd.target}`"), value.alias("own_level"), F.when(unknown, F.lit(fill)).otherwise(value).alias("filled"),
        F.when(unknown, F.lit(fd.unknown)).when(value.isNotNull(), F.lit("known")).alias("gap"),
    )
    return evidence(wide, ["own_level", "filled", "gap"], fd).withColumnRenamed("column", "coding")
