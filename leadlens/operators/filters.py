"""Filter criteria compiled to one predicate, and the values and ranges to choose from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlens.dictionary import MAX_LEVELS, DatasetError, FieldDictionary, FilterCriteria
from leadlens.functions.shapes import count_if, declared_position, has_order, long_values, ratio, ratio_or_zero, rows_from, text


def predicate(criteria: FilterCriteria) -> Column:
    """All conditions joined by AND. An empty list or a missing range restricts nothing; NULL
    never matches a condition."""
    parts = [F.col(f"`{c}`").isin(*values) for c, values in criteria.categorical.items() if values]
    parts += [F.col(f"`{c}`").between(*bounds) for c, bounds in criteria.numeric.items() if bounds is not None]
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def check_criteria(df: DataFrame, criteria: FilterCriteria) -> None:
    unknown = [c for c in (*criteria.categorical, *criteria.numeric) if c not in df.columns]
    if unknown:
        raise DatasetError(f"criteria name unknown columns: {', '.join(unknown)}")


def apply_filter(df: DataFrame, criteria: FilterCriteria) -> DataFrame:
    check_criteria(df, criteria)
    return df.where(predicate(criteria))


def filter_kpis(df: DataFrame, criteria: FilterCriteria, fd: FieldDictionary) -> DataFrame:
    """One row from one scan: rows, kept rows, kept share, positives and rate of the kept rows."""
    check_criteria(df, criteria)
    keep = predicate(criteria)
    labelled = fd.target in df.columns
    positive = F.col(f"`{fd.target}`") == fd.positive if labelled else F.lit(False)
    stats = df.agg(
        F.count(F.lit(1)).alias("n_total"),
        count_if(keep).alias("n_kept"),
        count_if(keep & positive).alias("n_pos"),
    )
    return stats.select(
        "n_total",
        "n_kept",
        ratio_or_zero(F.col("n_kept"), F.col("n_total")).alias("keep_ratio"),
        (F.col("n_pos") if labelled else F.lit(None).cast("long")).alias("n_pos"),
        (ratio(F.col("n_pos"), F.col("n_kept")) if labelled else F.lit(None).cast("double")).alias("positive_rate"),
    )


def of_few_levels(counts: DataFrame, max_values: int = MAX_LEVELS) -> DataFrame:
    """``counts``, rows of (column, value, ...), if no column has more than ``max_values`` values; else the job fails.
    The values are counted, and the counts broadcast, before any row is ordered: an order within a column is
    made in one task, which a column that is no categorical one must not reach."""
    # Both sides use every column, so that they share one exchange and the table is scanned once.
    rest = F.max(F.struct(*[c for c in counts.columns if c != "column"]))
    levels = counts.groupBy(F.col("column").alias("of")).agg(F.count(F.lit(1)).alias("levels"), rest.alias("rest"))
    too_many = F.concat(F.lit("too many values for a categorical column: "), F.col("of"))
    levels = levels.select("of", "rest", F.when(F.col("levels") > max_values, F.raise_error(too_many).cast("long")).otherwise(F.col("levels")).alias("levels"))
    checked = counts.join(F.broadcast(levels), F.col("column") == F.col("of")).where("levels > 0 AND rest IS NOT NULL")  # a row for each column
    return checked.select(*counts.columns)


def category_domain(df: DataFrame, fd: FieldDictionary, max_values: int = MAX_LEVELS) -> DataFrame:
    """(column, position, value, n) for every categorical and the target, in one scan.

    Columns with a declared order follow it, undeclared values after it by name; the others go
    by falling count. A column with more than ``max_values`` values is not a categorical one:
    the job fails before anything is sorted.
    """
    names = [c for c in (*fd.categoricals, fd.target) if c in df.columns]
    counts = of_few_levels(long_values(df, names).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")), max_values)
    column, value = F.col("column"), F.col("value")
    order = Window.partitionBy("column").orderBy(
        F.coalesce(declared_position(fd, column, value), F.lit(1 << 30)),
        F.when(has_order(fd, column), 0).otherwise(-F.col("n")),
        value,
    )
    return counts.select("column", (F.row_number().over(order) - 1).cast("long").alias("position"), "value", "n")


def numeric_bounds(df: DataFrame, fd: FieldDictionary) -> DataFrame:
    """(column, lo, hi) per numeric column and id; columns without any value are left out."""
    names = [c for c in (fd.id, *fd.numerics) if c in df.columns]
    stats = df.selectExpr(*[f"min(`{c}`) AS `lo_{c}`" for c in names], *[f"max(`{c}`) AS `hi_{c}`" for c in names])
    rows = [
        {"column": text(c), "lo": f"CAST(`lo_{c}` AS DOUBLE)", "hi": f"CAST(`hi_{c}` AS DOUBLE)"} for c in names
    ]
    return rows_from(stats, rows).where("lo IS NOT NULL")


def default_criteria(df: DataFrame, fd: FieldDictionary) -> FilterCriteria:
    """Every value of every category and the full range of every number.

    Collects dictionary-sized rows only (``category_domain`` fails on anything larger).
    Applying it drops rows with a missing number or label, as any such condition does.
    """
    values: dict[str, list[str]] = {}
    for row in sorted(category_domain(df, fd).collect(), key=lambda r: (r["column"], r["position"])):
        values.setdefault(row["column"], []).append(row["value"])
    bounds = {r["column"]: (r["lo"], r["hi"]) for r in numeric_bounds(df, fd).collect()}
    return FilterCriteria(
        categorical={c: values[c] for c in (*fd.categoricals, fd.target) if c in values},
        numeric={c: bounds[c] for c in fd.numerics if c in bounds},
    )


def require_target(df: DataFrame, fd: FieldDictionary) -> None:
    if fd.target is None or fd.target not in df.columns:
        raise DatasetError("this analysis needs the target column; the table has no labels")
