"""Every registered query against its SQL, and the shape of the plans that matter at scale."""

import numpy as np
import pandas as pd
import pytest
from compare import differences, open_oracle
from conftest import SMALL, plan_of
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from leadlens.operators import evaluate, ranking
from leadlens.plans import campaign, catalog, training
from leadlens.plans.oracle import oracle_queries

QUERIES, ORACLE = catalog.QUERIES, oracle_queries()
FITTED = {
    "fit_logistic", "fit_forest", "fit_boosted_a", "fit_boosted_b", "grid_search", "model_comparison",
    "leakage_experiment", "batch_scores",
}


@pytest.fixture(scope="module")
def oracle():
    with open_oracle(SMALL) as con:
        yield con


def test_only_fits_lack_sql():
    assert set(QUERIES) - set(ORACLE) == FITTED and not set(ORACLE) - set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_matches_its_sql(spark, oracle, name):
    assert differences(QUERIES[name](spark, SMALL), oracle, ORACLE[name]) is None


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["column", "value", "n", "n_pos", "rate", "position"]


@pytest.mark.parametrize("name", ["fit_logistic", "batch_scores"])
def test_fitted_queries_return_rows(spark, name):
    rows = QUERIES[name](spark, SMALL).collect()
    if name == "batch_scores":
        assert all(0 <= r["score"] <= 1 for r in rows)
        assert len(rows) == campaign.unlabelled(campaign.contacts(spark, SMALL)).count()
    else:
        assert len(rows) == 1 and rows[0]["average_precision"] > 0


def skewed_sources(folder):
    """Copies of the small tables in which one customer has a third of the orders, spread over
    the days, and one order has a third of the lines."""
    rng = np.random.default_rng(4)
    read = lambda name: pd.read_parquet(f"{SMALL}/{name}.parquet")
    orders, lines = read("orders"), read("lineitem")
    orders.loc[rng.random(len(orders)) < 0.34, "o_custkey"] = 7
    lines.loc[rng.random(len(lines)) < 0.34, "l_orderkey"] = 3
    for name, frame in (("orders", orders), ("lineitem", lines), ("customer", read("customer"))):
        frame.to_parquet(f"{folder}/{name}.parquet", coerce_timestamps="us", allow_truncated_timestamps=True)


@pytest.mark.parametrize("hot_rows", [100, 1_000_000])
def test_contacts_with_a_hot_customer(spark, tmp_path, hot_rows):
    skewed_sources(tmp_path)
    tables = [campaign.table(spark, str(tmp_path), name) for name in campaign.SOURCES]
    df = campaign.build_contacts(*tables, hot_rows=hot_rows)
    import duckdb

    con = duckdb.connect()
    for name in campaign.SOURCES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet')")
    assert differences(df, con, ORACLE["campaign_fixture"]) is None


def test_contacts_follow_changed_sources(spark, tmp_path):
    skewed_sources(tmp_path)
    first = campaign.contacts(spark, str(tmp_path))
    assert campaign.contacts(spark, str(tmp_path)) is first
    orders = pd.read_parquet(tmp_path / "orders.parquet")
    orders.head(10).to_parquet(tmp_path / "orders.parquet", coerce_timestamps="us", allow_truncated_timestamps=True)
    spark.catalog.refreshByPath(str(tmp_path))
    assert campaign.contacts(spark, str(tmp_path)).count() == 10


def test_queries_read_only_their_columns(spark):
    plan = plan_of(QUERIES["filtered_rate"](spark, SMALL))
    assert "ReadSchema: struct<age:double,contact:string,poutcome:string,subscribe:string>" in plan
    assert "EqualTo(contact,cellular)" in plan


def test_scores_are_never_sorted_in_one_task(spark):
    scores = catalog.fine_scores(spark, SMALL)
    plan = plan_of(evaluate.score_histogram(scores, rows_per_bucket=100))
    singles = [p for p in plan.split("\n\n") if "SinglePartition" in p]
    # the one-row-per-bucket offsets are the only thing gathered, then broadcast
    assert len(singles) == 1 and "sum_cum_tp" in singles[0]
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


def test_split_moves_no_rows(spark):
    df = campaign.labelled(campaign.contacts(spark, SMALL))
    from leadlens.dictionary import CONTACTS
    from leadlens.operators.encode import stratified_split, with_folds

    train, test = stratified_split(df, CONTACTS)
    assert "Exchange" not in plan_of(train) + plan_of(test) + plan_of(with_folds(df, CONTACTS))


@pytest.mark.parametrize("name", ["segment_rates", "rate_by_category", "category_domain", "campaign_fixture", "benefit_scan"])
def test_no_cross_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_many_buckets_keep_exact_sums(spark):
    scores = catalog.fine_scores(spark, SMALL)
    few, many = (evaluate.ranked_summary(evaluate.score_histogram(scores, n)).first() for n in (10**9, 60))
    assert few["n_pos"] == many["n_pos"]
    assert few["roc_auc"] == pytest.approx(many["roc_auc"], abs=1e-12)
    assert len(ranking.value_range(scores, "score", 60).edges) > 64
    assert scores.agg(F.count(F.lit(1))).first()[0] == few["n_pos"] + few["n_neg"]


@pytest.mark.parametrize("name", ["fit_boosted_a", "fit_boosted_b", "fit_forest", "grid_search", "model_comparison"])
def test_trees_and_comparisons_learn_from_all_training_rows(spark, leaning, monkeypatch, name):
    """On 5,760 contacts: 4,608 training rows, of which no fit takes a part."""
    many = leaning.crossJoin(spark.range(8).select(F.col("id").alias("copy"))).withColumn("id", F.col("id") * 8 + F.col("copy")).drop("copy")
    seen, own = [], training.split_frames

    def split(df, fd, config):
        train, test = own(df, fd, config)
        seen.append((train.count(), test.count()))
        train.unpersist(), test.unpersist()
        raise StopIteration

    monkeypatch.setattr(catalog, "contacts", lambda spark, folder: many)
    monkeypatch.setattr(training, "split_frames", split)
    with pytest.raises(StopIteration):
        QUERIES[name](spark, SMALL)
    assert seen == [(4608, 1152)]
