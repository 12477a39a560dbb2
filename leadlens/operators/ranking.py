"""Global order without a global sort in one task.

Running totals, order statistics and "the k smallest" all need a total order over the rows.
Each one here splits the value range into many buckets first, keeps one small row per bucket,
and does the ordered work inside the buckets. The results are exact: the sampled edges
only decide how evenly the work is spread.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 50_000
MAX_BUCKETS = 16_384
#: Distinct values that edges are chosen from, in expectation; all that reaches the driver.
SAMPLE = 4 * MAX_BUCKETS


@dataclass(frozen=True)
class ValueRange:
    """Size of a column and the edges that cut it into buckets of about equal row counts."""

    n: int
    n_distinct_approx: int | None
    edges: tuple[float, ...]


def value_range(df: DataFrame, column: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> ValueRange:
    """Size, and edges from a sample of the distinct values: those whose hash falls below a share that lets
    about ``SAMPLE`` of them through. Equal values are summed before they are ordered, so buckets of
    equally many distinct values are balanced. A table of one bucket is not sampled."""
    x = f"CAST(`{column}` AS DOUBLE)"
    row = df.selectExpr(f"count({x}) AS n", f"approx_count_distinct({x}) AS n_distinct").first()
    buckets = min(max(math.ceil(row["n"] / rows_per_bucket), 1), MAX_BUCKETS)
    if buckets == 1:
        return ValueRange(row["n"], row["n_distinct"], ())
    share = min(1.0, SAMPLE / max(row["n_distinct"], 1))
    drawn = df.selectExpr(f"{x} AS v").where(f"v IS NOT NULL AND pmod(xxhash64(v), 1073741824) < {int(share * (1 << 30))}").distinct()
    at = sorted(r["v"] for r in drawn.collect() if math.isfinite(r["v"]))
    edges = {at[i * len(at) // buckets] for i in range(1, buckets)} if at else set()
    return ValueRange(row["n"], row["n_distinct"], tuple(sorted(edges)))


def with_bucket(df: DataFrame, column: str, edges: Sequence[float], name: str = "bucket") -> DataFrame:
    """Adds the bucket of the value: 0 below the first edge, growing with the value."""
    if not edges:
        return df.withColumn(name, F.lit(0))
    splits = [-float("inf"), *edges, float("inf")]
    cut = Bucketizer(splits=splits, inputCol=column, outputCol=name, handleInvalid="keep")
    # never NULL: a NULL check inferred on one side of a join would undo the reuse of its exchange
    return cut.transform(df).withColumn(name, F.coalesce(F.col(name).cast("int"), F.lit(-1)))


def running_totals(
    df: DataFrame, column: str, totals: Mapping[str, str], edges: Sequence[float], descending: bool = True
) -> DataFrame:
    """Adds cumulative sums in the order of ``column``, whose values must be distinct, and the grand
    total of each as ``all_<name>``.

    ``totals`` maps a new column to the column summed. One row per bucket gives the offsets
    (at most ``MAX_BUCKETS`` rows, so that side is broadcast); the ordered window runs per bucket.
    """
    direction = F.desc if descending else F.asc
    bucketed = with_bucket(df, column, edges)
    inside = Window.partitionBy("bucket").orderBy(direction(column)).rowsBetween(Window.unboundedPreceding, 0)
    local = bucketed.select("*", *[F.sum(src).over(inside).alias(f"in_{new}") for new, src in totals.items()])
    before = Window.orderBy(direction("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(direction("bucket")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = (
        bucketed.groupBy("bucket")
        .agg(*[F.sum(src).alias(f"sum_{new}") for new, src in totals.items()])
        .select(
            "bucket",
            *[F.coalesce(F.sum(f"sum_{new}").over(before), F.lit(0)).alias(f"off_{new}") for new in totals],
            *[F.sum(f"sum_{new}").over(whole).alias(f"all_{new}") for new in totals],
        )
    )
    joined = local.join(F.broadcast(offsets), "bucket")
    sums = [(F.col(f"in_{new}") + F.col(f"off_{new}")).alias(new) for new in totals]
    return joined.select(*df.columns, *sums, *[f"all_{new}" for new in totals])


def values_at_ranks(df: DataFrame, column: str, ranks: Sequence[int], span: ValueRange) -> list[float]:
    """The exact values at the given 0-based ascending ranks of the non-null values.

    Bucket sizes locate the few buckets that hold a wanted rank; only their values are
    aggregated and ordered, a share of about ranks / buckets of the table.
    """
    if not ranks or not span.n:
        return []
    values = df.select(F.col(f"`{column}`").cast("double").alias("value")).where(F.col("value").isNotNull())
    bucketed = with_bucket(values, "value", span.edges)
    start, wanted = 0, {}
    for row in sorted(bucketed.groupBy("bucket").count().collect(), key=lambda r: r["bucket"]):
        inside = [r for r in ranks if start <= r < start + row["count"]]
        if inside:
            wanted[row["bucket"]] = (start, inside)
        start += row["count"]
    hits = (
        bucketed.where(F.col("bucket").isin(*wanted))
        .groupBy("bucket", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(Window.partitionBy("bucket").orderBy("value")))
    )
    conds = [
        (F.col("bucket") == b) & (F.col("upto") > r - first) & (F.col("upto") - F.col("n") <= r - first)
        for b, (first, inside) in wanted.items()
        for r in inside
    ]
    found = hits.where(_any(conds)).collect()
    by_rank = {}
    for row in found:
        first, inside = wanted[row["bucket"]]
        for r in inside:
            if row["upto"] - row["n"] <= r - first < row["upto"]:
                by_rank[r] = row["value"]
    return [by_rank[r] for r in ranks]


def _any(conds: Sequence[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def quantiles(df: DataFrame, column: str, fractions: Sequence[float], span: ValueRange) -> list[float]:
    """Exact quantiles with linear interpolation between neighbouring order statistics."""
    places = [(span.n - 1) * q for q in fractions]
    ranks = sorted({r for p in places for r in (math.floor(p), math.ceil(p))})
    at = dict(zip(ranks, values_at_ranks(df, column, ranks, span)))
    return [at[math.floor(p)] + (at[math.ceil(p)] - at[math.floor(p)]) * (p - math.floor(p)) for p in places]


_DIGITS = 3
_BOUNDARY_ROWS = 20_000


def sort_key(df: DataFrame, column: str, complete: bool = False) -> Column:
    """The key, and for a row without one a hash of all its cells, so that every row has a place of its own. ``complete``: no row
    lacks a key, and no other column is read."""
    col = F.col(f"`{column}`")
    if complete:
        return col if df.schema[column].dataType.typeName() == "string" else col.cast("bigint")
    whole = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in df.columns])
    if df.schema[column].dataType.typeName() == "string":
        return F.coalesce(col, F.hex(whole))
    return F.coalesce(col.cast("bigint"), whole)


def hash_order(key: Column, seed: int) -> Column:
    """A fixed pseudo-random order of the rows: the same on any partitioning and any engine."""
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def smallest_cuts(
    df: DataFrame, group: str, key: str, seed: int, counts: Mapping[str, int], ranks: Mapping[str, Sequence[int]],
    complete: bool = False,
) -> dict[str, list[tuple[str, int]]]:
    """Per group and wanted rank k, the (hash, key) of the k-th smallest row in hash order.

    A radix selection: rows are counted by the leading digits of their hash, the count that
    reaches k names one prefix, and the next round counts inside that prefix only. A round
    returns 4096 counts per cut; about ``_BOUNDARY_ROWS`` rows remain for the last step, where
    copies of a key are counted, not listed.
    """
    place = sort_key(df, key, complete)
    rows = df.select(F.col(f"`{group}`").alias("grp"), place.alias("key"), hash_order(place, seed).alias("h"))
    todo = {(g, k): ("", k) for g, ks in ranks.items() for k in ks if 0 < k <= counts[g]}
    depth, left = 0, max(counts.values(), default=0)
    while left > _BOUNDARY_ROWS and todo:
        depth, left = depth + _DIGITS, left / 16**_DIGITS
        open_prefixes = {(g, prefix) for (g, _), (prefix, _) in todo.items()}
        inside = _any([(F.col("grp") == g) & F.col("h").startswith(p) if p else F.col("grp") == g for g, p in open_prefixes])  # no hash before the first digits
        found: dict[tuple[str, str], list[tuple[str, int]]] = {}
        for r in rows.where(inside).groupBy("grp", F.substring("h", 1, depth).alias("p")).count().collect():
            found.setdefault((r["grp"], r["p"][: depth - _DIGITS]), []).append((r["p"], r["count"]))
        for (g, k), (prefix, rest) in list(todo.items()):
            for p, n in sorted(found[g, prefix]):
                if rest <= n:
                    todo[g, k] = (p, rest)
                    break
                rest -= n
    out: dict[str, list[tuple[str, int]]] = {g: [] for g in ranks}
    if not todo:
        return out
    boundary = _any([(F.col("grp") == g) & F.col("h").startswith(p) for (g, _), (p, _) in todo.items()])
    prefix = F.substring("h", 1, depth) if depth else F.lit("")
    ordered = (
        rows.where(boundary)
        .groupBy("grp", prefix.alias("p"), "h", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(Window.partitionBy("grp", "p").orderBy("h", "key")))
    )
    hits = _any(
        [
            (F.col("grp") == g) & (F.col("p") == p) & (F.col("upto") >= rest) & (F.col("upto") - F.col("n") < rest)
            for (g, _), (p, rest) in todo.items()
        ]
    )
    cuts = {}
    for r in ordered.where(hits).collect():
        for (g, k), (p, rest) in todo.items():
            if (r["grp"], r["p"]) == (g, p) and r["upto"] - r["n"] < rest <= r["upto"]:
                cuts[g, k] = (r["h"], r["key"])
    for g, ks in ranks.items():
        out[g] = [cuts[g, k] for k in ks if (g, k) in cuts]
    return out


def at_or_below(hashed: Column, key: Column, cut: tuple[str, int]) -> Column:
    """Most rows lie above, which the first comparison tells: a hash is computed again for the others only."""
    return (hashed <= cut[0]) & ((hashed < cut[0]) | (key <= cut[1]))
