"""Small helpers that keep wide statistics in one aggregate and then list them by column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.dictionary import CONTACTS, FieldDictionary


def ratio(num: Column, den: Column) -> Column:
    """num / den as a double, NULL when den is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def ratio_or_zero(num: Column, den: Column) -> Column:
    return F.coalesce(ratio(num, den), F.lit(0.0))


def count_if(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ratio_sql(num: str, den: str) -> str:
    return f"try_divide(CAST({num} AS DOUBLE), CAST({den} AS DOUBLE))"


def rows_from(stats: DataFrame, rows: Sequence[Mapping[str, str]]) -> DataFrame:
    """One output row per mapping of names to SQL expressions over the single row of ``stats``.

    Wide statistics are stated as SQL text: one parsed list instead of a Python call per node.
    """
    structs = [", ".join(f"{text(name)}, {sql}" for name, sql in row.items()) for row in rows]
    return stats.selectExpr("inline(array(" + ", ".join(f"named_struct({s})" for s in structs) + "))")


# Calendar names in the form the tables use.
_MONTHS = CONTACTS.orders["month"]
_WEEKDAYS = (*CONTACTS.orders["day_of_week"], "sat", "sun")


def month_sql(date: str) -> str:
    """The short month name by lookup; ``monthname`` formats anew for every row."""
    return f"element_at(array({', '.join(map(text, _MONTHS))}), month({date}))"


def weekday_sql(date: str) -> str:
    return f"element_at(array({', '.join(map(text, _WEEKDAYS))}), weekday({date}) + 1)"


def long_values(df: DataFrame, columns: Sequence[str], keep: Sequence[Column] = ()) -> DataFrame:
    """(column, value) pairs of the named columns in one pass; NULL values are left out.

    Only the named columns reach the scan, and the pairs are aggregated map-side by every
    caller, so the shuffle holds distinct pairs rather than rows.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
    exploded = df.select(*keep, F.explode(pairs).alias("pair"))
    kept = [c for c in exploded.columns if c != "pair"]
    return exploded.select(*kept, "pair.column", "pair.value").where(F.col("value").isNotNull())


def declared_position(fd: FieldDictionary, column: Column, value: Column) -> Column:
    """0-based place of the value in its column's declared order, NULL when undeclared."""
    branches = None
    for name, order in fd.orders.items():
        place = F.array_position(F.array(*[F.lit(v) for v in order]), value)
        branches = F.when(column == name, place) if branches is None else branches.when(column == name, place)
    if branches is None:
        return F.lit(None).cast("long")
    return F.when(branches > 0, branches - 1)


def has_order(fd: FieldDictionary, column: Column) -> Column:
    return column.isin(*fd.orders) if fd.orders else F.lit(False)
