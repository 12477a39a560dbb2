"""The registered queries: every operator on the driver tables or on tables derived from them."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.dictionary import CONTACTS, Config, FieldDictionary, FilterCriteria
from leadlens.functions.shapes import month_sql, weekday_sql
from leadlens.operators import benefit, boosting, encode, evaluate, features, filters, forest, insights, levels, models, newton, portable, profile, quality, quantiles, state
from leadlens.plans import training
from leadlens.plans.campaign import BROKEN_COLUMNS, broken_export, contacts, export_folder, kept_contacts, labelled, table, unlabelled
from leadlens.sources import audited, readers, sinks
from leadlens.sources.shared import app_path, remove
from leadlens.streaming import files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CRITERIA = FilterCriteria(categorical={"contact": ["cellular"]}, numeric={"age": (30.0, 60.0)})
RATE_COLUMNS = ["poutcome", "education", "day_of_week"]
DISTRIBUTION_COLUMNS = ["month", "day_of_week", "job"]

# Trees, rounds, iterations, points and candidates are those of the defaults, and metrics are over all test rows. Fits of trees, the grid
# search and the comparison of models learn from all training rows; the other fits still from a bounded number of them.
WHOLE = Config()
BOUNDED = Config(fit_rows=4000)

LINES = FieldDictionary(
    target="l_returnflag",
    positive="R",
    negative="N",
    categoricals=("l_linestatus", "ship_month", "ship_weekday"),
    numerics=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
)

BROKEN = FieldDictionary(id="id", target="subscribe", categoricals=("job",), numerics=("age",))

DOCUMENTS = FieldDictionary(
    target="toxic", positive="1", negative="0", categoricals=("lang", "source"), numerics=("n_chars",)
)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def campaign_fixture(spark, folder):
    return contacts(spark, folder)


@query
def contacts_kept(spark, folder):
    """The contact table through the manifest of tables kept across applications."""
    return kept_contacts(spark, folder)


@query
def filtered_rate(spark, folder):
    """Flagship: filter, then the rate by earlier outcome."""
    return profile.rate_by_category(filters.apply_filter(contacts(spark, folder), CRITERIA), ["poutcome"], CONTACTS)


# Ingest


@query
def conformed_contacts(spark, folder):
    """The CSV export of the contacts, read and cleaned."""
    return readers.read_dataset(spark, export_folder(spark, folder), "train", CONTACTS)


@query
def coercion_failures(spark, folder):
    return readers.coercion_failures(readers.scan(spark, f"{export_folder(spark, folder)}/train.csv"), CONTACTS)


@query
def malformed_rows(spark, folder):
    """Rows of an export with a cell too many or too few."""
    return readers.malformed_rows(spark, broken_export(spark, folder), BROKEN_COLUMNS)


@query
def audited_export(spark, folder):
    """Rows, malformed rows and failed cells of the export, from what the scan that cleans it noted."""
    path = app_path(spark, f"audited-{uuid.uuid4().hex}")
    found = audited.read_audited(spark, f"{export_folder(spark, folder)}/train.csv", CONTACTS, path).report()
    remove(spark, path)
    return found


@query
def audited_rejects(spark, folder):
    """The lines with a cell too many or too few, read back from beside the clean rows."""
    path = app_path(spark, f"audited-{uuid.uuid4().hex}")
    found = audited.read_audited(spark, broken_export(spark, folder), BROKEN, path, columns=BROKEN_COLUMNS)
    return found.rejects.select("line", F.array_join("failed", ",").alias("failed"))


@query
def dataset_description(spark, folder):
    df = contacts(spark, folder)
    parts = {"train": labelled(df), "test": unlabelled(df)}
    train, test = [readers.describe(part, CONTACTS).withColumn("dataset", F.lit(name)) for name, part in parts.items()]
    return train.unionByName(test)


@query
def dictionary_table(spark, folder):
    return readers.dictionary_table(contacts(spark, folder), CONTACTS)


@query
def filtered_preview(spark, folder):
    return readers.preview(filters.apply_filter(contacts(spark, folder), CRITERIA), CONTACTS)


# Filters


@query
def filter_kpis(spark, folder):
    return filters.filter_kpis(contacts(spark, folder), CRITERIA, CONTACTS)


@query
def filter_default_criteria(spark, folder):
    df = contacts(spark, folder)
    return filters.filter_kpis(df, filters.default_criteria(df, CONTACTS), CONTACTS)


@query
def category_domain(spark, folder):
    return filters.category_domain(contacts(spark, folder), CONTACTS)


@query
def numeric_bounds(spark, folder):
    return filters.numeric_bounds(contacts(spark, folder), CONTACTS)


# Profiles


@query
def target_distribution(spark, folder):
    return profile.target_distribution(contacts(spark, folder), CONTACTS)


@query
def categorical_distribution(spark, folder):
    return profile.categorical_distribution(contacts(spark, folder), DISTRIBUTION_COLUMNS, CONTACTS)


@query
def categorical_by_target(spark, folder):
    return profile.categorical_by_target(contacts(spark, folder), DISTRIBUTION_COLUMNS, CONTACTS)


@query
def numeric_histogram(spark, folder):
    return profile.numeric_histogram(contacts(spark, folder), "age")


@query
def numeric_histogram_by_target(spark, folder):
    return profile.numeric_histogram(contacts(spark, folder), "duration", by="subscribe", fd=CONTACTS)


@query
def price_histogram(spark, folder):
    return profile.numeric_histogram(table(spark, folder, "orders"), "o_totalprice")


@query
def rate_by_category(spark, folder):
    return profile.rate_by_category(contacts(spark, folder), RATE_COLUMNS, CONTACTS)


@query
def rate_by_value(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("n", F.col("l_linenumber"))
    return profile.rate_by_numeric(lines, "n", LINES).drop("hi")


@query
def rate_by_quantile_bin(spark, folder):
    return profile.rate_by_numeric(contacts(spark, folder), "age", CONTACTS)


@query
def rate_by_quantile_bin_price(spark, folder):
    status = F.col("o_orderstatus")
    return profile.rate_by_quantile_bin(table(spark, folder, "orders"), "o_totalprice", status, status == "F")


@query
def rate_by_quantile_bin_tied(spark, folder):
    return profile.rate_by_numeric(contacts(spark, folder), "campaign", CONTACTS, bins=10)


@query
def rate_by_quantile_bin_lines(spark, folder):
    flag = F.col("l_returnflag")
    return profile.rate_by_quantile_bin(table(spark, folder, "lineitem"), "l_extendedprice", flag, flag == "R", bins=10)


@query
def quantiles_of_all_numbers(spark, folder):
    """Deciles of every number of the contacts, three scans in all."""
    found = quantiles.quantile_table(contacts(spark, folder), CONTACTS.numerics, [k / 10 for k in range(11)])
    return found.select("column", "fraction", F.round("value", 9).alias("value"))


@query
def rates_by_quantile_bin_all(spark, folder):
    return quantiles.rates_by_quantile_bin(contacts(spark, folder), CONTACTS.numerics, CONTACTS)


def merged_state(spark, folder) -> DataFrame:
    """The state of the contacts, merged from those of two halves."""
    df = contacts(spark, folder)
    return state.merged([state.profile_state(df.where(f"id % 2 = {k}"), CONTACTS) for k in (0, 1)])


@query
def rates_of_merged_states(spark, folder):
    return state.rates(merged_state(spark, folder))


@query
def statistics_of_merged_states(spark, folder):
    found = state.statistics(merged_state(spark, folder))
    return found.withColumns({c: F.round(c, 6) for c in ("mean", "deviation")})


@query
def correlations_of_merged_states(spark, folder):
    found = state.correlations(merged_state(spark, folder))
    return found.withColumn("r", F.round("r", 6) + 0.0)


@query
def correlation_matrix(spark, folder):
    df = contacts(spark, folder).withColumn("one", F.lit(1.0))
    return profile.correlation_matrix(df, CONTACTS, extra=["one"])


@query
def missing_overview(spark, folder):
    return quality.missing_overview(contacts(spark, folder), CONTACTS)


@query
def segment_rates(spark, folder):
    return profile.segment_rates(contacts(spark, folder), CONTACTS.categoricals, CONTACTS)


def dated_lines(spark, folder) -> DataFrame:
    return table(spark, folder, "lineitem").withColumns(
        {"ship_month": F.expr(month_sql("l_shipdate")), "ship_weekday": F.expr(weekday_sql("l_shipdate"))}
    )


@query
def segment_rates_lines(spark, folder):
    return profile.segment_rates(dated_lines(spark, folder), LINES.categoricals, LINES)


def labelled_documents(spark, folder) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").cast("string").alias("toxic"))
    return documents.join(labels, "doc_id")


@query
def rate_by_category_documents(spark, folder):
    return profile.rate_by_category(labelled_documents(spark, folder), DOCUMENTS.categoricals, DOCUMENTS)


@query
def rate_by_quantile_bin_documents(spark, folder):
    return profile.rate_by_numeric(labelled_documents(spark, folder), "n_chars", DOCUMENTS, bins=4)


# Insights


@query
def segment_lift(spark, folder):
    return insights.segment_lift(contacts(spark, folder), CONTACTS)


@query
def insight_overall(spark, folder):
    return insights.insight_overall(insights.shared_stats(contacts(spark, folder), CONTACTS))


@query
def insight_unknown(spark, folder):
    return insights.insight_unknown(insights.shared_stats(contacts(spark, folder), CONTACTS), CONTACTS)


@query
def insight_sentinel(spark, folder):
    return insights.insight_sentinel(insights.shared_stats(contacts(spark, folder), CONTACTS))


@query
def insight_leakage(spark, folder):
    found = insights.insight_leakage(insights.shared_stats(contacts(spark, folder), CONTACTS))
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


@query
def insight_correlation(spark, folder):
    found = insights.insight_correlation(insights.shared_stats(contacts(spark, folder), CONTACTS), CONTACTS)
    return found.withColumn("r", F.round("r", 6))


@query
def insight_contact(spark, folder):
    return insights.insight_contact(insights.shared_stats(contacts(spark, folder), CONTACTS))


@query
def insight_report(spark, folder):
    """The findings with their texts; metrics as key=value in order of the keys."""
    items = insights.insight_items(contacts(spark, folder), CONTACTS)
    pairs = F.transform(F.array_sort(F.map_entries("metrics")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return items.select("seq", "kind", "category", "level", "title", "content", F.array_join(pairs, ", ").alias("metrics"))


@query
def insight_report_written(spark, folder):
    """The report as its JSON sink wrote it, read back; a row for each finding in the report's order."""
    report = insights.insight_report(contacts(spark, folder), CONTACTS)
    path = app_path(spark, f"report-{uuid.uuid4().hex}")
    sinks.write_insight_report(report, path)
    read = spark.read.schema(report.schema).json(path)
    found = read.select("dataset", "n_rows", "positive_rate", F.posexplode("items").alias("position", "item"))
    fields = [F.col(f"item.{c}").alias(c) for c in ("title", "category", "level", "content")]
    return found.select("dataset", "n_rows", "positive_rate", F.col("position").cast("long").alias("position"), *fields)


# Features and quality


@query
def derived_features(spark, folder):
    df = contacts(spark, folder)
    return features.model_view(df).select("id", *features.FLAGS)


@query
def age_buckets(spark, folder):
    """Ages moved so that both edges and missing ages occur."""
    shifted = F.when(F.col("id") % 50 == 0, None).otherwise((F.col("age") - 18) * 4)
    view = features.model_view(contacts(spark, folder).withColumn("age", shifted))
    return view.groupBy("age_bucket").agg(F.count(F.lit(1)).alias("n"), F.min("age").alias("lo"), F.max("age").alias("hi"))


@query
def model_view(spark, folder):
    return features.model_view(contacts(spark, folder))


@query
def leakage_view(spark, folder):
    return features.leakage_view(contacts(spark, folder))


@query
def field_mapping(spark, folder):
    return features.field_mapping(contacts(spark, folder))


@query
def field_mapping_written(spark, folder):
    """The mapping as its JSON sink wrote it, read back."""
    mapping = features.field_mapping(contacts(spark, folder))
    path = app_path(spark, f"mapping-{uuid.uuid4().hex}")
    sinks.write_field_mapping(mapping, path)
    return spark.read.schema(mapping.schema).json(path)


@query
def constraint_audit(spark, folder):
    return quality.constraint_audit(contacts(spark, folder), quality.contact_rules())


@query
def duplicate_keys(spark, folder):
    return quality.duplicate_keys(table(spark, folder, "lineitem"), "l_orderkey")


@query
def duplicate_contacts(spark, folder):
    """The contacts with every 29th one twice: those are found, and no other."""
    df = contacts(spark, folder)
    return quality.duplicate_keys(df.unionByName(df.where("id % 29 = 0")), "id")


@query
def feature_columns(spark, folder):
    return features.feature_columns(contacts(spark, folder))


@query
def default_coding(spark, folder):
    """The column that is unknown most often, as it is, filled by its main level, and as known or not."""
    found = levels.coding_comparison(contacts(spark, folder), "default", CONTACTS, "no")
    return found.withColumns({c: F.round(c, 9) for c in ("rate", "woe", "iv")})


@query
def default_held_out(spark, folder):
    """The weights of the levels for the rows of each of three folds."""
    df = contacts(spark, folder).withColumn("fold", F.col("id") % 3)
    found = levels.held_out_evidence(df, ["default", "poutcome"], CONTACTS, "fold", 3)
    return found.withColumns({"fold": F.col("fold").cast("long"), "woe": F.round("woe", 9)})


# Splits and encodings


@query
def stratified_split(spark, folder):
    train, test = encode.stratified_split(labelled(contacts(spark, folder)), CONTACTS)
    parts = [part.select("id", "subscribe", F.lit(name).alias("part")) for name, part in (("train", train), ("test", test))]
    return parts[0].unionByName(parts[1])


@query
def split_sizes_of_text_ids(spark, folder):
    """Sizes of a split by text ids of which every third is missing: exact per label all the same."""
    df = labelled(contacts(spark, folder))
    named = df.withColumn("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("C"), F.col("id"))))
    _, test = encode.stratified_split(named, replace(CONTACTS, id_type="string"))
    return test.groupBy("subscribe").agg(F.count("*").alias("n"))


@query
def stratified_folds(spark, folder):
    df = encode.with_folds(labelled(contacts(spark, folder)), CONTACTS)
    return df.select("id", "subscribe", F.col("fold").cast("long").alias("fold"))


@query
def class_weights(spark, folder):
    return encode.class_weights(contacts(spark, folder), CONTACTS)


@query
def one_hot_matrix(spark, folder):
    view = features.model_view(contacts(spark, folder))
    return encode.one_hot_slots(view, features.feature_lists()[0], "id")


@query
def scaled_features(spark, folder):
    view = features.model_view(contacts(spark, folder))
    columns = features.feature_lists()[1]
    scaled = encode.scaled_features(view, columns, "id")
    return scaled.select("id", *[(F.round(f"{c}_z", 6) + 0.0).alias(f"{c}_z") for c in columns])


# Ranked scores


def tied_scores(spark, folder) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(
        "CAST(l_returnflag = 'R' AS INT) AS label", "round(l_discount * 10, 6) AS score"
    )


def fine_scores(spark, folder) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    top = lines.agg(F.max("l_extendedprice")).first()[0]
    return lines.selectExpr("CAST(l_returnflag = 'R' AS INT) AS label", f"l_extendedprice / double('{top + 1!r}') AS score")


@query
def score_histogram(spark, folder):
    return evaluate.score_histogram(tied_scores(spark, folder)).drop("n_pos", "n_neg")


@query
def score_histogram_fine(spark, folder):
    return evaluate.score_histogram(fine_scores(spark, folder)).drop("n_pos", "n_neg")


@query
def roc_auc(spark, folder):
    found = evaluate.roc_auc(evaluate.score_histogram(tied_scores(spark, folder)))
    return found.select(F.round("roc_auc", 9).alias("roc_auc"))


@query
def average_precision(spark, folder):
    found = evaluate.average_precision(evaluate.score_histogram(tied_scores(spark, folder)))
    return found.select(F.round("average_precision", 9).alias("average_precision"))


@query
def ranked_summary_fine(spark, folder):
    found = evaluate.ranked_summary(evaluate.score_histogram(fine_scores(spark, folder)))
    rates = [F.round(c, 9).alias(c) for c in ("roc_auc", "average_precision")]
    return found.select("n_pos", "n_neg", *rates)


@query
def pr_curve(spark, folder):
    return evaluate.pr_curve(evaluate.score_histogram(tied_scores(spark, folder)))


@query
def pr_curve_fine(spark, folder):
    return evaluate.pr_curve(evaluate.score_histogram(fine_scores(spark, folder)))


@query
def best_f1(spark, folder):
    return evaluate.best_f1(evaluate.score_histogram(tied_scores(spark, folder)))


@query
def best_f1_fine(spark, folder):
    return evaluate.best_f1(evaluate.score_histogram(fine_scores(spark, folder)))


@query
def confusion(spark, folder):
    return evaluate.confusion(tied_scores(spark, folder), 0.4)


@query
def threshold_metrics(spark, folder):
    return evaluate.threshold_metrics(tied_scores(spark, folder), 0.4)


@query
def evaluation_record(spark, folder):
    found = evaluate.evaluate(fine_scores(spark, folder), "price")
    rounded = [F.round(c, 9).alias(c) for c in ("roc_auc", "average_precision")]
    return found.select(*[c for c in found.columns if c not in ("roc_auc", "average_precision")], *rounded)


@query
def keyed_evaluation(spark, folder):
    """Two scores of every line item, and the second within each line status, evaluated in one job."""
    lines = table(spark, folder, "lineitem")
    top = lines.agg(F.max("l_extendedprice")).first()[0]
    wide = lines.selectExpr(
        "CAST(l_returnflag = 'R' AS INT) AS label", "round(l_discount * 10, 6) AS tied", f"l_extendedprice / double('{top + 1!r}') AS fine", "l_linestatus"
    )
    by_status = wide.selectExpr("concat('fine:', l_linestatus) AS model", "label", "fine AS score")
    found = evaluate.evaluate_keyed(evaluate.long_scores(wide, ["tied", "fine"]).unionByName(by_status))
    rounded = [F.round(c, 9).alias(c) for c in ("roc_auc", "average_precision")]
    return found.select(*[c for c in found.columns if c not in ("roc_auc", "average_precision")], *rounded)


@query
def gain_table(spark, folder):
    return evaluate.gain_table(evaluate.score_histogram(tied_scores(spark, folder)))


@query
def gain_table_fine(spark, folder):
    return evaluate.gain_table(evaluate.score_histogram(fine_scores(spark, folder)))


@query
def benefit_at_threshold(spark, folder):
    return benefit.benefit_at(tied_scores(spark, folder), 0.4)


@query
def benefit_scan(spark, folder):
    return benefit.benefit_scan(fine_scores(spark, folder))


@query
def best_benefit(spark, folder):
    return benefit.best_benefit(benefit.benefit_scan(tied_scores(spark, folder)))


# Models


def _fitted_metrics(name: str, config: Config = WHOLE) -> Query:
    def run(spark, folder):
        df = labelled(contacts(spark, folder))
        return training.train_and_compare(df, [name], config=config, quick=True).comparison

    return run


QUERIES["fit_logistic"] = _fitted_metrics("logistic_regression", BOUNDED)
QUERIES["fit_forest"] = _fitted_metrics("random_forest")
QUERIES["fit_boosted_a"] = _fitted_metrics("boosted_a")
QUERIES["fit_boosted_b"] = _fitted_metrics("boosted_b")


#: Inputs of few distinct values, whose thresholds can be listed in SQL.
ROUND_INPUTS = (portable.Input("campaign"), portable.Input("previous"), portable.Input("contact", "cellular"))
NEWTON_INPUTS = (portable.Input("campaign"), portable.Input("previous"))
NEWTON_PROBLEMS = [newton.Problem(k, c) for k in range(3) for c in (0.1, 1.0, 10.0)]


def coded_contacts(spark, folder) -> DataFrame:
    df = labelled(contacts(spark, folder))
    return df.withColumns({"label": encode.target_code(CONTACTS), "weight": F.lit(1.0)})


@query
def boosted_first_round(spark, folder):
    """The tree of the first round: four leaves over three inputs, from all labelled rows."""
    settings = boosting.Boosting(rounds=1, rate=0.1, leaves=4, penalty=1.0)
    model = boosting.boost(coded_contacts(spark, folder), ROUND_INPUTS, settings)
    parts = portable.tables(spark, model)[1]
    return parts.selectExpr(*[f"CAST({c} AS BIGINT) AS {c}" for c in ("node", "input", "yes", "no")], "threshold", "round(value, 9) AS value")


@query
def newton_steps(spark, folder):
    """Coefficients of nine problems, three folds by three penalties, after three Newton steps each, from all labelled rows."""
    rows = coded_contacts(spark, folder).withColumn("fold", F.col("id") % 3)
    solved = newton.solve(rows, NEWTON_INPUTS, NEWTON_PROBLEMS, fold="fold", steps=3, fixed=True)
    out = [(s.problem.fold, s.problem.c, *[round(b, 8) + 0.0 for b in s.coefficients]) for s in solved]
    return spark.createDataFrame(out, "fold long, c double, campaign double, previous double, intercept double")


@query
def bootstrap_weights(spark, folder):
    """Sizes and label weights of the samples of 25 trees."""
    return forest.bootstrap_sums(coded_contacts(spark, folder), "label", "id", 25)


#: A model as tables: two small trees and a coefficient over three inputs.
FIXED_INPUTS = [(0, "poutcome", "success", 0.0, 0.0, 1.0), (1, "lending_rate3m", None, 2.5, 2.5, 1.5), (2, "age", None, 40.0, 0.0, 1.0)]
FIXED_PARTS = [
    (0, 0, 0, 0.5, 1, 2, None), (0, 1, 1, -0.25, 3, 4, None), (0, 2, None, None, None, None, 0.75), (0, 3, None, None, None, None, -0.5),
    (0, 4, None, None, None, None, -1.25), (1, 0, 2, 45.5, 1, 2, None), (1, 1, None, None, None, None, 0.125), (1, 2, None, None, None, None, -0.0625),
    (-1, 0, 1, None, None, None, -0.3), (-1, 1, None, None, None, None, 0.2),
]


@query
def portable_scores(spark, folder):
    """A model given by two tables scores all contacts."""
    model = portable.from_tables(spark.createDataFrame(FIXED_INPUTS, portable.INPUTS), spark.createDataFrame(FIXED_PARTS, portable.PARTS))
    return portable.scores(contacts(spark, folder), model, keep=["id"]).select("id", F.round("score", 9).alias("score"))


@query
def grid_search(spark, folder):
    """(model, settings, cv_score, is_best) of all four grids over three stratified folds."""
    train, test = training.split_frames(labelled(contacts(spark, folder)), CONTACTS, WHOLE)
    counts, rows = encode.label_counts(train, CONTACTS), []
    for name in models.CANDIDATES:
        tuned = models.tune(name, train, counts, config=WHOLE)
        rows += [(name, str(dict(point)), score, point == tuned.settings) for point, score in tuned.points]
    train.unpersist()
    test.unpersist()
    return spark.createDataFrame(rows, "model string, settings string, cv_score double, is_best boolean")


@query
def model_comparison(spark, folder):
    """All four candidates with their default settings on one split."""
    return training.train_and_compare(labelled(contacts(spark, folder)), config=WHOLE, quick=True).comparison


@query
def leakage_experiment(spark, folder):
    return training.leakage_experiment(labelled(contacts(spark, folder)), config=BOUNDED)


@query
def batch_scores(spark, folder):
    """Fit, save, load, and score the rows without a label."""
    df = contacts(spark, folder)
    train, test = training.split_frames(labelled(df), CONTACTS, BOUNDED)
    model = models.fit("logistic_regression", train, encode.label_counts(train, CONTACTS), config=BOUNDED)
    path = app_path(spark, f"model-{uuid.uuid4().hex}")
    models.save_model(model, path)
    model = models.load_model(path)
    remove(spark, path)
    train.unpersist()
    test.unpersist()
    return models.batch_scores(model, unlabelled(df))


# Streams


@query
def stream_filtered_events(spark, folder):
    """The events of two types with a value in a range, read as a file stream until it is drained."""
    schema = table(spark, folder, "events").schema
    stream = files.file_stream(spark, f"{folder}/events.parquet", schema)
    wanted = FilterCriteria(categorical={"event_type": ["click", "purchase"]}, numeric={"value": (10.0, 60.0)})
    kept = files.filtered_stream(stream, wanted)
    path = app_path(spark, f"events-{uuid.uuid4().hex}")
    files.drain(kept, f"{path}/rows", f"{path}/checkpoint")
    remove(spark, f"{path}/checkpoint")
    return spark.read.schema(kept.schema).parquet(f"{path}/rows")
