"""Distributions, rates by segment and bin, and correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlens.dictionary import MAX_LEVELS, MIN_SAMPLE, FieldDictionary
from leadlens.functions.shapes import (
    count_if, declared_position, has_order, long_values, ratio, ratio_sql, rows_from, text,
)
from leadlens.operators.filters import of_few_levels, require_target
from leadlens.operators.ranking import ValueRange, quantiles, value_range


def target_distribution(df: DataFrame, fd: FieldDictionary) -> DataFrame:
    """(label, n, rate): both labels are always present; rate is the positive share of the two."""
    require_target(df, fd)
    stats = df.selectExpr(
        f"count_if(`{fd.target}` = {text(fd.negative)}) AS neg", f"count_if(`{fd.target}` = {text(fd.positive)}) AS pos"
    )
    rate = f"coalesce({ratio_sql('pos', 'neg + pos')}, 0D)"
    return rows_from(
        stats,
        [
            {"label": text(fd.negative), "n": "neg", "rate": rate},
            {"label": text(fd.positive), "n": "pos", "rate": rate},
        ],
    )


def categorical_distribution(df: DataFrame, columns: Sequence[str], fd: FieldDictionary, max_values: int = MAX_LEVELS) -> DataFrame:
    """(column, value, n, position) of several columns in one scan: declared order first and the
    rest by name, or falling count where no order is declared."""
    counts = of_few_levels(long_values(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")), max_values)
    column, value = F.col("column"), F.col("value")
    order = Window.partitionBy("column").orderBy(
        F.coalesce(declared_position(fd, column, value), F.lit(1 << 30)),
        F.when(has_order(fd, column), 0).otherwise(-F.col("n")),
        value,
    )
    return counts.select("*", (F.row_number().over(order) - 1).cast("long").alias("position"))


def categorical_by_target(df: DataFrame, columns: Sequence[str], fd: FieldDictionary) -> DataFrame:
    """(column, value, label, n) over the labelled rows."""
    require_target(df, fd)
    labelled = df.where(F.col(f"`{fd.target}`").isin(fd.negative, fd.positive))
    pairs = long_values(labelled, columns, keep=[F.col(f"`{fd.target}`").alias("label")])
    return pairs.groupBy("column", "value", "label").agg(F.count(F.lit(1)).alias("n"))


def numeric_histogram(
    df: DataFrame, column: str, bins: int = 40, by: str | None = None, fd: FieldDictionary | None = None
) -> DataFrame:
    """(bin, lo, hi[, label], n): equal-width bins over [min, max], empty ones left out."""
    x = F.col(f"`{column}`").cast("double")
    low, high = df.agg(F.min(x), F.max(x)).first()
    if low is None:
        low = high = 0.0
    if high == low:
        bins = 1
    width = (high - low) / bins
    place = F.least(F.floor((x - F.lit(low)) / F.lit(width)), F.lit(bins - 1)) if width else F.lit(0)
    rows = df.where(x.isNotNull())
    if by is not None:
        if fd is not None:
            require_target(df, fd)
            rows = rows.where(F.col(f"`{by}`").isin(fd.negative, fd.positive))
        rows = rows.select(place.cast("long").alias("bin"), F.col(f"`{by}`").alias("label"))
    else:
        rows = rows.select(place.cast("long").alias("bin"))
    counts = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    edge = lambda i: F.lit(low) + i * F.lit(width)
    label = ["label"] if by is not None else []
    return counts.select("bin", edge(F.col("bin")).alias("lo"), edge(F.col("bin") + 1).alias("hi"), *label, "n")


def _segment_counts(df: DataFrame, columns: Sequence[str], fd: FieldDictionary) -> DataFrame:
    require_target(df, fd)
    pairs = long_values(df, columns, keep=[F.col(f"`{fd.target}`").alias("label")])
    return (
        pairs.groupBy("column", "value")
        .agg(F.count("label").alias("n"), count_if(F.col("label") == fd.positive).alias("n_pos"))
        .withColumn("rate", ratio(F.col("n_pos"), F.col("n")))
    )


def rate_by_category(df: DataFrame, columns: Sequence[str], fd: FieldDictionary, max_values: int = MAX_LEVELS) -> DataFrame:
    """(column, value, n, n_pos, rate, position): rate over labelled rows, NULL without any.
    Declared order with undeclared values last, else falling rate."""
    column, value = F.col("column"), F.col("value")
    order = Window.partitionBy("column").orderBy(
        F.coalesce(declared_position(fd, column, value), F.lit(999)),
        F.when(~has_order(fd, column), F.col("rate")).desc_nulls_last(),
        value,
    )
    counts = of_few_levels(_segment_counts(df, columns, fd), max_values)
    return counts.select("*", (F.row_number().over(order) - 1).cast("long").alias("position"))


def segment_rates(df: DataFrame, columns: Sequence[str], fd: FieldDictionary, min_n: int = MIN_SAMPLE) -> DataFrame:
    """(column, value, n, n_pos, rate) of the groups with enough labelled rows, one scan for all columns."""
    return _segment_counts(df, columns, fd).where(F.col("n") >= min_n)


def rate_by_value(df: DataFrame, column: str, label: Column, positive: Column) -> DataFrame:
    """(value, n, n_pos, rate) per distinct value; n counts the rows that have a label."""
    x = F.col(f"`{column}`").cast("double")
    return (
        df.where(x.isNotNull())
        .groupBy(x.alias("value"))
        .agg(F.count(label).alias("n"), count_if(positive).alias("n_pos"))
        .withColumn("rate", ratio(F.col("n_pos"), F.col("n")))
    )


def quantile_edges(df: DataFrame, column: str, bins: int, span: ValueRange) -> list[float]:
    """Distinct equal-frequency edges, snapped to nine decimals so that a row on an edge cannot
    change sides with the last bit of an interpolation."""
    if not span.n:
        return []
    raw = quantiles(df, column, [i / bins for i in range(bins + 1)], span)
    return sorted({round(e, 9) for e in raw})


def rate_by_quantile_bin(
    df: DataFrame, column: str, label: Column, positive: Column, bins: int = 8, span: ValueRange | None = None
) -> DataFrame:
    """(bin, lo, hi, n, n_pos, rate) over equal-frequency bins (lo, hi], the lowest value included."""
    span = span or value_range(df, column)
    edges = quantile_edges(df, column, bins, span)
    if len(edges) < 2:
        edges = (edges * 2)[:2] or [0.0, 0.0]
    x = F.col(f"`{column}`").cast("double")
    place = F.lit(0)
    for e in edges[1:-1]:
        place = place + (x > F.lit(e)).cast("int")
    counts = (
        df.where(x.isNotNull())
        .groupBy(place.cast("long").alias("bin"))
        .agg(F.count(label).alias("n"), count_if(positive).alias("n_pos"))
    )
    bounds = F.array(*[F.lit(e) for e in edges])
    return counts.select(
        "bin",
        F.element_at(bounds, (F.col("bin") + 1).cast("int")).alias("lo"),
        F.element_at(bounds, (F.col("bin") + 2).cast("int")).alias("hi"),
        "n",
        "n_pos",
        ratio(F.col("n_pos"), F.col("n")).alias("rate"),
    )


def rate_by_numeric(df: DataFrame, column: str, fd: FieldDictionary, bins: int = 8) -> DataFrame:
    """(bin, lo, hi, n, n_pos, rate): by value when there are at most ``bins`` values, else by
    equal-frequency bin. The exact distinct count runs only when the sketch is near the limit."""
    require_target(df, fd)
    label = F.col(f"`{fd.target}`")
    positive = label == fd.positive
    span = value_range(df, column)
    few = span.n_distinct_approx <= 20 * bins
    if few:
        few = df.agg(F.count_distinct(F.col(f"`{column}`").cast("double"))).first()[0] <= bins
    if not few:
        return rate_by_quantile_bin(df, column, label, positive, bins, span)
    by_value = rate_by_value(df, column, label, positive)
    place = F.row_number().over(Window.orderBy("value")) - 1
    return by_value.select(
        place.cast("long").alias("bin"), F.col("value").alias("lo"), F.col("value").alias("hi"), "n", "n_pos", "rate"
    )


def correlation_matrix(df: DataFrame, fd: FieldDictionary, extra: Sequence[str] = ()) -> DataFrame:
    """(x, y, r) for all pairs of numerics and the target as 1/0 (unlabelled counts as 0), 3 decimals.

    Pairwise complete; a constant side gives NULL, where ``corr`` would divide by zero. A first
    narrow aggregate gives mean, range and gaps of each column. The second scan sums products of
    centred values: one sum per pair, two per column, and only columns with gaps need sums of
    their own for each partner.
    """
    values = {c: f"CAST(`{c}` AS DOUBLE)" for c in (*fd.numerics, *extra) if c in df.columns}
    if fd.target in df.columns:
        values[fd.target] = f"CASE WHEN `{fd.target}` = {text(fd.positive)} THEN 1D ELSE 0D END"
    names = list(values)
    if len(names) < 2:
        return df.sparkSession.createDataFrame([], "x string, y string, r double")
    table = df.selectExpr(*[f"{sql} AS x{i}" for i, sql in enumerate(values.values())])
    index = range(len(names))
    known = table.selectExpr(
        "count(*) AS n_rows",
        *[f"count(x{i}) AS n{i}" for i in index],
        *[f"avg(x{i}) AS mean{i}" for i in index],
        *[f"min(x{i}) < max(x{i}) AS varies{i}" for i in index],
    ).first()
    varying = [i for i in index if known[f"varies{i}"]]
    gaps = {i for i in varying if known[f"n{i}"] < known["n_rows"]}
    centred = table.selectExpr(*[f"x{i} - double('{known[f'mean{i}']!r}') AS d{i}" for i in varying])

    def side(a: int, b: int) -> str:
        """Name of the sums over column a beside column b; shared by all complete partners."""
        return f"{a}_{b}" if b in gaps and a != b else f"{a}"

    sums, rows = {"n_rows": "count(*)"}, []
    for i in index:
        for j in index:
            if not (i in varying and j in varying):
                r = "CAST(NULL AS DOUBLE)"
            else:
                low, high = min(i, j), max(i, j)
                sums[f"ab_{low}_{high}"] = f"sum(d{low} * d{high})"
                sums[f"n_{low}_{high}"] = f"count(d{low} + d{high})" if {low, high} & gaps else "count(*)"
                n, parts = f"n_{low}_{high}", []
                for a, b in ((low, high), (high, low)):
                    s = side(a, b)
                    own = f"CASE WHEN d{b} IS NOT NULL THEN d{a} END" if s != f"{a}" else f"d{a}"
                    sums[f"a_{s}"], sums[f"aa_{s}"] = f"sum({own})", f"sum({own} * {own})"
                    spread = f"aa_{s} - {ratio_sql(f'a_{s} * a_{s}', n)}"
                    if s != f"{a}":
                        sums[f"varies_{s}"] = f"min({own}) < max({own})"
                        spread = f"CASE WHEN varies_{s} THEN {spread} END"
                    parts.append((f"a_{s}", spread))
                shared = f"ab_{low}_{high} - {ratio_sql(f'{parts[0][0]} * {parts[1][0]}', n)}"
                r = f"round(try_divide({shared}, sqrt({parts[0][1]}) * sqrt({parts[1][1]})), 3) + 0D"
            rows.append({"x": text(names[i]), "y": text(names[j]), "r": r})
    totals = centred.selectExpr(*[f"{sql} AS {name}" for name, sql in sums.items()])
    return rows_from(totals.where("n_rows > 0"), rows)


def correlation_with_flag_sql(x: str, flag: str) -> str:
    """Correlation of a number with a yes/no flag over the rows that have both, from the two group
    means and the overall deviation; NULL when either side is constant."""
    both, yes, no = (f"CASE WHEN {c} THEN {x} END" for c in (f"({flag}) IS NOT NULL", flag, f"NOT ({flag})"))
    n_yes, n_no = f"CAST(count({yes}) AS DOUBLE)", f"CAST(count({no}) AS DOUBLE)"
    r = f"try_divide((avg({yes}) - avg({no})) * sqrt({n_yes} * {n_no}), ({n_yes} + {n_no}) * stddev_pop({both}))"
    return f"CASE WHEN min({both}) < max({both}) THEN {r} END"
