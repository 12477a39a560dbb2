"""Evidence-backed findings about a contact table.

All findings but the segment lift come from one aggregate row, so a report costs two scans
however many findings it lists. Every finding keeps its numbers as typed columns beside the text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlens.dictionary import INSIGHT_COLUMNS, MIN_SAMPLE, UNKNOWN_WARN_SHARE, Config, FieldDictionary
from leadlens.functions.shapes import ratio, ratio_sql, rows_from, text
from leadlens.operators.profile import correlation_with_flag_sql, segment_rates

# Levels and categories of a finding.
INFO, SUGGEST, WARN = "info", "suggest", "warn"
BUSINESS, QUALITY, FEATURE, MODELING = "business", "quality", "feature", "modeling"


def shared_stats(df: DataFrame, fd: FieldDictionary, config: Config = Config()) -> DataFrame:
    """The one aggregate row behind the overall, unknown, sentinel, leakage, correlation and
    over-contact findings. Rate denominators hold labelled rows only."""
    have = set(df.columns)
    aggs = ["count(*) AS n_rows"]
    aggs += [f"count_if(`{c}` = {text(fd.unknown)}) AS `unknown_{c}`" for c in fd.categoricals if c in have]
    if "pdays" in have:
        aggs.append(f"count_if(pdays = {config.never_contacted}) AS n_never")
    if fd.target in have:
        positive = f"`{fd.target}` = {text(fd.positive)}"  # NULL without a label
        aggs += [f"count(`{fd.target}`) AS n_labelled", f"count_if({positive}) AS n_pos"]
        if "duration" in have:
            aggs += [
                f"avg(CASE WHEN {positive} THEN duration END) AS duration_pos",
                f"avg(CASE WHEN NOT ({positive}) THEN duration END) AS duration_rest",
            ]
        if "campaign" in have:
            high = f"coalesce(campaign >= {config.high_frequency_threshold}, false)"
            aggs.append(f"count_if({high}) AS n_high")
            for name, cond in (("rate_high", high), ("rate_low", f"NOT {high}")):
                labelled = f"count_if({cond} AND `{fd.target}` IS NOT NULL)"
                aggs.append(f"{ratio_sql(f'count_if({cond} AND {positive})', labelled)} AS {name}")
        for c in fd.numerics:
            if c in have:
                x = f"CAST(`{c}` AS DOUBLE)"
                aggs.append(f"count_if({x} IS NOT NULL AND `{fd.target}` IS NOT NULL) AS `valid_{c}`")
                aggs.append(f"{correlation_with_flag_sql(x, positive)} AS `r_{c}`")
    return df.selectExpr(*aggs)


def insight_overall(stats: DataFrame) -> DataFrame:
    """(n_rows, n_pos, rate)"""
    return stats.select("n_rows", "n_pos", F.round(ratio(F.col("n_pos"), F.col("n_labelled")), 4).alias("rate")).where(
        "n_rows > 0"
    )


def insight_unknown(stats: DataFrame, fd: FieldDictionary) -> DataFrame:
    """(column, share, level) of the categorical with most unknown values; no row when none has any.
    Ties go to the first column of the dictionary."""
    names = [c for c in fd.categoricals if f"unknown_{c}" in stats.columns]
    if not names:
        return stats.select(
            F.lit("").alias("column"), F.lit(0.0).alias("share"), F.lit(INFO).alias("level")
        ).where(F.lit(False))
    # struct order: the larger count first, then the smaller dictionary position
    places = [f"named_struct('n', `unknown_{c}`, 'place', {-i}, 'column', {text(c)})" for i, c in enumerate(names)]
    worst = stats.selectExpr("n_rows", f"array_max(array({', '.join(places)})) AS best").where("best.n > 0")
    share = ratio(F.col("best.n"), F.col("n_rows"))
    return worst.select(
        F.col("best.column").alias("column"),
        share.alias("share"),
        F.when(share > UNKNOWN_WARN_SHARE, WARN).otherwise(INFO).alias("level"),
    )


def insight_sentinel(stats: DataFrame) -> DataFrame:
    """(n_never, share) of the rows never contacted before."""
    return stats.where("n_rows > 0").select("n_never", ratio(F.col("n_never"), F.col("n_rows")).alias("share"))


def insight_leakage(stats: DataFrame) -> DataFrame:
    """(mean_positive, mean_rest) of the after-the-event column."""
    return stats.where("n_rows > 0").select(
        F.col("duration_pos").alias("mean_positive"), F.col("duration_rest").alias("mean_rest")
    )


def insight_correlation(stats: DataFrame, fd: FieldDictionary, top: int = 3) -> DataFrame:
    """(rank, column, r) of the numerics most correlated with the target, among those with enough
    values that vary. Ties go to the first column of the dictionary."""
    names = [c for c in fd.numerics if f"r_{c}" in stats.columns]
    rows = [
        {"column": text(c), "place": str(i), "n": f"`valid_{c}`", "r": f"`r_{c}`"}
        for i, c in enumerate(names)
    ]
    ranked = rows_from(stats, rows).where((F.col("n") >= MIN_SAMPLE) & F.col("r").isNotNull())
    rank = F.row_number().over(Window.orderBy(F.round(F.abs("r"), 9).desc(), "place")).cast("long")
    return ranked.select(rank.alias("rank"), "column", "r").where(F.col("rank") <= top)


def insight_contact(stats: DataFrame) -> DataFrame:
    """(n_high, rate_high, rate_low, direction) of frequent against normal contact; no row when
    nobody was contacted that often."""
    high, low = F.col("rate_high"), F.col("rate_low")
    direction = F.when(high < low, "lower").when(high > low, "higher").when(high == low, "equal").otherwise("unknown")
    return stats.where("n_high > 0").select("n_high", "rate_high", "rate_low", direction.alias("direction"))


def segment_lift(df: DataFrame, fd: FieldDictionary, columns=INSIGHT_COLUMNS, min_n: int = MIN_SAMPLE) -> DataFrame:
    """(column, best_value, best_rate, worst_value, worst_rate, lift, worst_rate_is_zero) per column
    with at least two large enough groups; ties go to the first value by name."""
    names = [c for c in columns if c in df.columns]
    rates = segment_rates(df, names, fd, min_n)
    best = F.min_by(F.struct("value", "rate"), F.struct(-F.col("rate"), F.col("value")))
    worst = F.min_by(F.struct("value", "rate"), F.struct(F.col("rate"), F.col("value")))
    pairs = (
        rates.groupBy("column")
        .agg(F.count(F.lit(1)).alias("n_groups"), best.alias("best"), worst.alias("worst"))
        .where("n_groups >= 2")
    )
    return pairs.select(
        "column",
        F.col("best.value").alias("best_value"),
        F.col("best.rate").alias("best_rate"),
        F.col("worst.value").alias("worst_value"),
        F.col("worst.rate").alias("worst_rate"),
        ratio(F.col("best.rate"), F.col("worst.rate")).alias("lift"),
        (F.col("worst.rate") == 0).alias("worst_rate_is_zero"),
    )


def _percent(col: Column) -> Column:
    return F.when(col.isNotNull(), F.format_string("%.2f%%", col * 100)).otherwise("n/a")


def _figure(col: Column) -> Column:
    return F.when(col.isNotNull(), F.format_string("%.0f", col)).otherwise("n/a")


def _item(seq, kind, category, level, title, content, **metrics) -> list[Column]:
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    pairs = [p for k, v in metrics.items() for p in (F.lit(k), v.cast("string"))]
    return [
        as_col(seq).cast("long").alias("seq"),
        F.lit(kind).alias("kind"),
        F.lit(category).alias("category"),
        as_col(level).alias("level"),
        as_col(title).alias("title"),
        as_col(content).alias("content"),
        F.create_map(*pairs).alias("metrics"),
    ]


def insight_items(
    df: DataFrame, fd: FieldDictionary, config: Config = Config(), stats: DataFrame | None = None
) -> DataFrame:
    """(seq, kind, category, level, title, content, metrics): overall, quality, business and
    feature findings in that order; quality only without labels; one warning for an empty table.

    The aggregate row is computed once up front; otherwise each finding's branch would prune it
    to its own columns and scan the table again.
    """
    stats = stats or _computed(shared_stats(df, fd, config))
    have = set(df.columns)
    parts = []

    unknown = insight_unknown(stats, fd)
    named = F.col("column")
    parts.append(
        unknown.select(
            *_item(
                1, "unknown", QUALITY, F.col("level"),
                F.concat(F.lit("Most unknown values: "), named),
                F.concat(named, F.lit(" is unknown in "), _percent(F.col("share")), F.lit(" of the rows; keep it as a level of its own or compare an imputation.")),
                column=named, share=_percent(F.col("share")),
            )
        )
    )
    if "pdays" in have:
        share = _percent(F.col("share"))
        parts.append(
            insight_sentinel(stats).select(
                *_item(
                    2, "sentinel", QUALITY, SUGGEST,
                    f"pdays uses {config.never_contacted} for people never called before",
                    F.concat(share, F.lit(" of the rows carry the marker; derive a yes/no feature and do not read it as days.")),
                    share=share,
                )
            )
        )
    if fd.target in have:
        rate = F.col("rate")
        parts.append(
            insight_overall(stats).select(
                *_item(
                    0, "overall", BUSINESS, INFO, "Overall positive rate",
                    F.concat(F.col("n_pos").cast("string"), F.lit(" of "), F.col("n_rows").cast("string"), F.lit(" rows are positive, a rate of "), _percent(rate), F.lit(".")),
                    rows=F.col("n_rows"), positives=F.col("n_pos"), rate=_percent(rate),
                )
            )
        )
        columns = [c for c in INSIGHT_COLUMNS if c in have]
        if columns:
            lift = segment_lift(df, fd, columns)
            place = F.array_position(F.array(*[F.lit(c) for c in columns]), named) + 2
            best = F.concat(F.col("best_value"), F.lit(" "), _percent(F.col("best_rate")))
            worst = F.concat(F.col("worst_value"), F.lit(" "), _percent(F.col("worst_rate")))
            times = F.when(
                F.col("lift").isNotNull(), F.format_string("%.1f times", F.col("lift"))
            ).otherwise("an unbounded factor")
            parts.append(
                lift.select(
                    *_item(
                        place, "segment", BUSINESS, INFO,
                        F.concat(named, F.lit(" separates the rate")),
                        F.concat(F.lit("highest "), best, F.lit(", lowest "), worst, F.lit(": "), times, F.lit(".")),
                        best=best, worst=worst,
                    )
                )
            )
        if "duration" in have:
            pos, rest = _figure(F.col("mean_positive")), _figure(F.col("mean_rest"))
            parts.append(
                insight_leakage(stats).select(
                    *_item(
                        7, "leakage", MODELING, WARN, "duration is known only after the call",
                        F.concat(F.lit("Leave it out of any model used before the call. Mean "), pos, F.lit(" for positives, "), rest, F.lit(" for the rest.")),
                        mean_positive=pos, mean_rest=rest,
                    )
                )
            )
        if any(c in have for c in fd.numerics):
            listed = F.transform(
                F.array_sort(F.collect_list(F.struct("rank", "column", "r"))),
                lambda s: F.struct(s["column"].alias("key"), F.format_string("%+.3f", s["r"]).alias("value")),
            )
            top = insight_correlation(stats, fd).agg(listed.alias("top")).where(F.size("top") > 0)
            text = F.array_join(F.transform("top", lambda s: F.concat(s["key"], F.lit(" "), s["value"])), ", ")
            item = _item(8, "correlation", FEATURE, SUGGEST, "Numerics most correlated with the outcome", text, none=F.lit(""))
            parts.append(top.select(*item[:-1], F.map_from_entries("top").alias("metrics")))
        if "campaign" in have:
            high, low = _percent(F.col("rate_high")), _percent(F.col("rate_low"))
            limit = config.high_frequency_threshold
            parts.append(
                insight_contact(stats).select(
                    *_item(
                        9, "over_contact", BUSINESS, SUGGEST,
                        F.concat(F.lit(f"Rate after {limit} or more calls: "), F.col("direction")),
                        F.concat(high, F.lit(f" with {limit} or more calls, "), low, F.lit(" with fewer; set a limit on calls accordingly.")),
                        rate_high=high, rate_low=low, direction=F.col("direction"),
                    )
                )
            )
    parts.append(
        stats.where("n_rows = 0").select(
            *_item(0, "empty", QUALITY, WARN, "No rows under the current filter", "Widen the filter to see findings.", rows=F.col("n_rows"))
        )
    )
    return reduce(DataFrame.unionByName, parts)


def _computed(stats: DataFrame) -> DataFrame:
    row = stats.first()
    values = []
    for field in stats.schema:
        value = "NULL" if row[field.name] is None else text(str(row[field.name]))
        values.append(f"CAST({value} AS {field.dataType.simpleString()}) AS `{field.name}`")
    return stats.sparkSession.range(0, 1, 1, 1).selectExpr(*values)


def insight_report(df: DataFrame, fd: FieldDictionary, name: str = "train", config: Config = Config()) -> DataFrame:
    """One row: dataset, n_rows, positive_rate and the ordered array of findings."""
    stats = _computed(shared_stats(df, fd, config))
    items = insight_items(df, fd, config, stats)
    fields = ("seq", "title", "category", "level", "content", "metrics")
    by_seq = lambda a, b: F.when(a["seq"] < b["seq"], -1).when(a["seq"] > b["seq"], 1).otherwise(0)
    packed = items.agg(F.array_agg(F.struct(*fields)).alias("items"))
    ordered = F.transform(
        F.array_sort("items", by_seq), lambda s: F.struct(*[s[f].alias(f) for f in fields if f != "seq"])
    )
    rate = ratio(F.col("n_pos"), F.col("n_labelled")) if fd.target in df.columns else F.lit(None).cast("double")
    head = stats.select("n_rows", F.round(rate, 4).alias("positive_rate")).first()
    return packed.select(
        F.lit(name).alias("dataset"),
        F.lit(head["n_rows"]).cast("long").alias("n_rows"),
        F.lit(head["positive_rate"]).cast("double").alias("positive_rate"),
        ordered.alias("items"),
    )
