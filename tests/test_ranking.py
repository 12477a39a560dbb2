"""Bucketed order against brute force: ties, a third of the rows on one value, copies of a key."""

import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from leadlens.dictionary import CONTACTS, Config, FieldDictionary
from leadlens.operators import encode, ranking
from leadlens.plans import training
from leadlens.operators.history import hot_keys, with_history

FD = FieldDictionary(id="id", target="y", categoricals=(), numerics=("x",))


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("rows_per_bucket", [10, 100_000])
def test_running_totals(spark, rows_per_bucket, descending):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"x": np.unique(rng.lognormal(0, 2, 800)), "n": 1})
    frame["n"] = rng.integers(0, 50, len(frame))
    df = spark.createDataFrame(frame).repartition(5)
    span = ranking.value_range(df, "x", rows_per_bucket)
    assert (len(span.edges) > 50) == (rows_per_bucket == 10)
    got = ranking.running_totals(df, "x", {"upto": "n"}, span.edges, descending).toPandas()
    want = frame.sort_values("x", ascending=not descending)
    want["upto"] = want.n.cumsum()
    merged = got.merge(want, on="x", suffixes=("", "_want"))
    assert len(merged) == len(frame) and (merged.upto == merged.upto_want).all()


def test_many_buckets_ask_a_second_sketch(spark):
    df = spark.range(5000).select(F.col("id").cast("double").alias("x"))
    span = ranking.value_range(df, "x", 10)
    assert 400 < len(span.edges) < 500
    assert ranking.values_at_ranks(df, "x", [0, 1234, 4999], span) == [0.0, 1234.0, 4999.0]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.just(2.5), st.floats(-100, 100, width=32)), min_size=1, max_size=60))
def test_quantiles_match_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    span = ranking.value_range(df, "x", 7)
    fractions = [0, 0.125, 0.5, 0.9, 1]
    got = ranking.quantiles(df, "x", fractions, span)
    assert got == pytest.approx(list(np.quantile(values, fractions)), abs=1e-9)


def brute_order(ids, seed):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{i}:{seed}".encode()).hexdigest(), i))


def labelled_ids(spark, n, share=0.2):
    return spark.range(n).select("id", F.when(F.col("id") % 5 == 0, "yes").otherwise("no").alias("y"), F.lit(1.0).alias("x"))


@pytest.mark.parametrize("boundary", [20_000, 20])
def test_split_takes_the_smallest_hashes(spark, monkeypatch, boundary):
    monkeypatch.setattr(ranking, "_BOUNDARY_ROWS", boundary)
    df = labelled_ids(spark, 3001).repartition(7)
    train, test = encode.stratified_split(df, FD, Config(seed=7))
    got = {r["id"] for r in test.collect()}
    assert len(got) == math.ceil(3001 * 0.2) and train.count() == 3001 - len(got)
    for label, ids in (("yes", range(0, 3001, 5)), ("no", [i for i in range(3001) if i % 5])):
        ordered = brute_order(ids, 7)
        k = len(got & set(ordered))
        assert got & set(ordered) == set(ordered[:k]) and abs(k - len(ordered) * 0.2) <= 1, label


@pytest.mark.parametrize("boundary", [20_000, 20])
def test_folds_are_equal_and_whole(spark, monkeypatch, boundary):
    monkeypatch.setattr(ranking, "_BOUNDARY_ROWS", boundary)
    df = encode.with_folds(labelled_ids(spark, 1000), FD, Config(folds=3))
    sizes = {(r["y"], r["fold"]): r["count"] for r in df.groupBy("y", "fold").count().collect()}
    assert sizes == {("no", 0): 267, ("no", 1): 267, ("no", 2): 266, ("yes", 0): 67, ("yes", 1): 67, ("yes", 2): 66}
    again = encode.with_folds(labelled_ids(spark, 1000).repartition(9), FD, Config(folds=3))
    assert sorted(df.select("id", "fold").collect()) == sorted(again.select("id", "fold").collect())


def test_copies_of_a_hot_id_stay_together(spark, monkeypatch):
    monkeypatch.setattr(ranking, "_BOUNDARY_ROWS", 50)
    copies = labelled_ids(spark, 2000).withColumn("id", F.when(F.col("id") < 700, 41).otherwise(F.col("id")))
    train, test = encode.stratified_split(copies.withColumn("y", F.lit("no")), FD)
    a, b = ({r["id"] for r in part.select("id").distinct().collect()} for part in (train, test))
    assert not a & b and train.count() + test.count() == 2000


def test_rows_without_an_id_keep_a_place(spark):
    df = labelled_ids(spark, 500).withColumn("id", F.when(F.col("id") % 50 > 0, F.col("id")))
    train, test = encode.stratified_split(df, FD)
    assert train.count() + test.count() == 500
    assert encode.with_folds(df, FD).where("fold IS NULL").count() == 0
    named = df.withColumn("id", F.concat(F.lit("c"), F.col("id")))
    train, test = encode.stratified_split(named, FD)
    assert train.count() + test.count() == 500 and 90 <= test.count() <= 115


def test_split_of_tiny_tables(spark):
    for n in (0, 1, 2, 6):
        train, test = encode.stratified_split(labelled_ids(spark, n), FD)
        assert test.count() == math.ceil(n * 0.2) and train.count() + test.count() == n


@pytest.mark.parametrize("hot_rows", [5, 10_000])
def test_history_of_a_hot_key(spark, hot_rows):
    rng = np.random.default_rng(11)
    n = 900
    frame = pd.DataFrame(
        {
            "k": np.where(rng.random(n) < 0.34, 1, rng.integers(2, 300, n)),
            "day": rng.integers(0, 40, n),
            "id": rng.permutation(n),
            "state": rng.choice(list("FOP"), n),
        }
    )
    df = spark.createDataFrame(frame).repartition(6)
    hot = hot_keys(df, "k", hot_rows)
    assert (1 in {r["hot_key"] for r in hot.collect()}) == (hot_rows == 5)
    got = with_history(df, "k", F.col("day"), ["day", "id"], ["day", "state"], hot).toPandas().sort_values("id")
    want = frame.sort_values(["k", "day", "id"])
    by = want.groupby("k")
    want = want.assign(n_prev=by.cumcount(), prev_day=by.day.shift(), prev_state=by.state.shift()).sort_values("id")
    assert list(got.n_prev) == list(want.n_prev)
    assert list(got.prev_day.fillna(-1)) == list(want.prev_day.fillna(-1))
    assert list(got.prev_state.fillna("")) == list(want.prev_state.fillna(""))


def test_edges_come_from_a_bounded_sample(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SAMPLE", 200)
    df = spark.range(40_000).selectExpr("CAST(id * 37 % 40009 AS DOUBLE) AS x")
    span = ranking.value_range(df, "x", rows_per_bucket=4000)
    assert span.n == 40_000 and len(span.edges) == 9
    sizes = [r["count"] for r in ranking.with_bucket(df, "x", span.edges).groupBy("bucket").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 8000
    assert ranking.values_at_ranks(df, "x", [0, 19_999, 39_999], span) == [sorted(i * 37 % 40009 for i in range(40_000))[k] for k in (0, 19_999, 39_999)]


def test_rows_without_an_id_split_exactly(spark):
    rows = [(None if i % 3 else i, "yes" if i % 2 else "no", i) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, subscribe string, extra long")
    _, test = encode.stratified_split(df, CONTACTS)
    assert {r["subscribe"]: r["count"] for r in test.groupBy("subscribe").count().collect()} == {"yes": 60, "no": 60}


def test_fit_rows_are_drawn_from_labels_counted_once(spark, leaning, monkeypatch):
    """The scan that counts the labels of the training rows serves the second split as well."""
    scans, own = [], encode.label_state
    monkeypatch.setattr(encode, "label_state", lambda df, fd: scans.append(1) or own(df, fd))
    train, test = training.split_frames(leaning, CONTACTS, Config(fit_rows=100))
    assert len(scans) == 2 and train.count() == 100 and test.count() == math.ceil(0.2 * leaning.count())


def test_cuts_are_whole_at_equal_hashes(spark):
    """A row is at or below a cut by its hash first, then by its key."""
    rows = spark.createDataFrame([("a", 9), ("b", 1), ("b", 5), ("b", 6), ("c", 0), (None, 1)], "h string, k long")
    below = rows.select(ranking.at_or_below(F.col("h"), F.col("k"), ("b", 5)).alias("x"))
    assert [r["x"] for r in below.collect()] == [True, True, True, False, False, None]
