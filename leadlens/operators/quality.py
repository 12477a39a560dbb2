"""Missing values, rule violations and duplicate keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlens.dictionary import CONTACTS, FieldDictionary
from leadlens.functions.shapes import count_if, ratio_sql, rows_from, text


def missing_overview(df: DataFrame, fd: FieldDictionary) -> DataFrame:
    """(column, kind, n_missing, share, n_null, dictionary_position, rank): unknown tokens per categorical, missing
    values per numeric, over all rows. ``n_null`` counts empty cells of either kind; ``rank`` orders by falling share."""
    names = [c for c in (*fd.categoricals, *fd.numerics) if c in df.columns]
    aggs, rows = ["count(*) AS n_rows"], []
    for i, c in enumerate(names):
        category = c in fd.categoricals
        gap = f"`{c}` = {text(fd.unknown)}" if category else f"`{c}` IS NULL OR isnan(CAST(`{c}` AS DOUBLE))"
        aggs += [f"count_if({gap}) AS `gap_{c}`", f"count_if(`{c}` IS NULL) AS `null_{c}`"]
        rows.append(
            {
                "column": text(c),
                "kind": text("categorical" if category else "numeric"),
                "n_missing": f"`gap_{c}`",
                "share": ratio_sql(f"`gap_{c}`", "n_rows"),
                "n_null": f"`null_{c}`",
                "dictionary_position": f"{i}L",
            }
        )
    found = rows_from(df.selectExpr(*aggs).where("n_rows > 0"), rows)
    by_share = Window.orderBy(F.desc("share"), "dictionary_position")  # a row for each column
    return found.withColumn("rank", F.row_number().over(by_share).cast("long"))


def contact_rules(fd: FieldDictionary = CONTACTS) -> dict[str, Column]:
    """The documented constraints of the contact table, each true for a good row."""
    rules = {
        "age_17_to_100": F.col("age").between(17, 100),
        "month_known": F.col("month").isin(*fd.orders["month"]),
        "day_of_week_known": F.col("day_of_week").isin(*fd.orders["day_of_week"]),
        "campaign_at_least_1": F.col("campaign") >= 1,
        "previous_not_negative": F.col("previous") >= 0,
        "subscribe_known": F.col("subscribe").isNull() | F.col("subscribe").isin(fd.negative, fd.positive),
    }
    for c in (fd.id, *fd.numerics, *fd.categoricals):
        rules[f"{c}_not_null"] = F.col(f"`{c}`").isNotNull()
    return rules


def constraint_audit(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, n_violations) in one scan. A rule on a missing value counts as kept; the not-null
    rules report the missing value itself."""
    names = list(rules)
    stats = df.agg(*[count_if(~rules[r]).alias(r) for r in names])
    return rows_from(stats, [{"rule": text(r), "n_violations": f"`{r}`"} for r in names])


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """(key, n) of the key values that occur more than once; counted map-side before the shuffle."""
    return df.groupBy(F.col(f"`{key}`").alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
