"""Per-key running history (row number and previous row) that tolerates a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The keys of more than ``hot_rows`` rows as column ``hot_key``: at most a ``hot_rows``-th of the table's rows."""
    counts = df.groupBy(F.col(key).alias("hot_key")).agg(F.count(F.lit(1)).alias("n"))
    return counts.where((F.col("n") > hot_rows) & F.col("hot_key").isNotNull()).select("hot_key")


def with_history(
    df: DataFrame, key: str, period: Column, order: Sequence[str], previous: Sequence[str], hot: DataFrame
) -> DataFrame:
    """Adds ``n_prev`` (earlier rows of the key) and ``prev_<column>`` for each of ``previous``.

    ``order`` sorts a key's rows and ``period`` must not decrease along it. A window holds all rows
    of an ordinary key, or one period of a key in ``hot`` (hot_key); there, one summary row per period
    carries the count and last row over to the next. Both kinds share one pass and one shuffle.
    """
    ordered = [F.col(c) for c in order]
    last = F.struct(*previous)
    marked = df.join(F.broadcast(hot), F.col(key) == F.col("hot_key"), "left")  # see hot_keys for its size
    marked = marked.withColumn("_period", F.when(F.col("hot_key").isNotNull(), period)).drop("hot_key")
    inside = Window.partitionBy(key, "_period").orderBy(*ordered)
    local = marked.select("*", (F.row_number().over(inside) - 1).alias("_n"), F.lag(last).over(inside).alias("_prev"))
    periods = marked.where(F.col("_period").isNotNull()).groupBy(F.col(key).alias("_key"), F.col("_period").alias("_at"))
    periods = periods.agg(F.count(F.lit(1)).alias("_rows"), F.max_by(last, F.struct(*ordered)).alias("_last"))
    along = Window.partitionBy("_key").orderBy("_at")
    carried = periods.select(
        "_key",
        "_at",
        F.sum("_rows").over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.lag("_last").over(along).alias("_carry"),
    )
    joined = local.join(carried, (F.col(key) == F.col("_key")) & (F.col("_period") == F.col("_at")), "left")
    prev = F.when(F.col("_n") > 0, F.col("_prev")).otherwise(F.col("_carry"))
    return joined.select(
        *[F.col(c) for c in df.columns],
        (F.col("_n") + F.coalesce("_before", F.lit(0))).cast("int").alias("n_prev"),
        *[prev[c].alias(f"prev_{c}") for c in previous],
    )
