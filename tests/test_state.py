"""States of parts add up to the state of the whole."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlens.dictionary import CONTACTS, FieldDictionary
from leadlens.operators import profile, state


def numbers_of(rows, keys):
    return {tuple(r[k] for k in keys): [-1 if v is None else v for k, v in r.asDict().items() if k not in keys] for r in rows}


def test_merged_parts_equal_the_whole(spark, leaning, tmp_path):
    df = leaning.withColumns({"age": F.when(F.col("id") % 9 > 0, F.col("age")), "subscribe": F.when(F.col("id") % 11 > 0, F.col("subscribe"))})
    grid = {"age": 10.0, "duration": 60.0}
    whole = state.profile_state(df, CONTACTS, grid)
    for k in range(3):
        state.profile_state(df.where(F.col("id") % 3 == k), CONTACTS, grid).write.parquet(str(tmp_path / f"day{k}"))
    both = state.merged([spark.read.parquet(str(tmp_path / f"day{k}")) for k in range(3)])
    want, got = (numbers_of(x.collect(), ["kind", "column", "key"]) for x in (whole, both))
    assert set(got) == set(want)
    for key, values in want.items():
        assert got[key] == pytest.approx(values, rel=1e-12), key


def test_readings_equal_the_operators(leaning):
    df = leaning.withColumns({"age": F.when(F.col("id") % 9 > 0, F.col("age")), "subscribe": F.when(F.col("id") % 11 > 0, F.col("subscribe"))}).persist()
    found = state.profile_state(df, CONTACTS, {"age": 10.0})
    want = {(r["column"], r["value"]): (r["n"], r["n_pos"], r["rate"]) for r in profile.rate_by_category(df, CONTACTS.categoricals, CONTACTS).collect()}
    assert {(r["column"], r["value"]): (r["n"], r["n_pos"], r["rate"]) for r in state.rates(found).collect()} == want
    table = df.toPandas()
    for r in state.statistics(found).collect():
        own = table[r["column"]].dropna()
        assert (r["n"], r["n_missing"]) == (len(own), len(table) - len(own)) and (r["lo"], r["hi"]) == (own.min(), own.max())
        assert (r["mean"], r["deviation"]) == (pytest.approx(own.mean()), pytest.approx(own.std(ddof=0)))
    pairs = {(r["column"], r["other"]): r["r"] for r in state.correlations(found).collect()}
    assert len(pairs) == 45
    for (a, b), r in pairs.items():
        own = table[[a, b]].dropna()
        assert r == pytest.approx(np.corrcoef(own[a], own[b])[0, 1], abs=1e-9)
    cells = {r["lo"]: r["n"] for r in state.histogram(found, "age", 10.0).collect()}
    assert cells == (table["age"].dropna() // 10 * 10).value_counts().to_dict()


def test_empty_tables_and_constant_numbers(leaning):
    assert state.profile_state(leaning.limit(0), CONTACTS).count() == 0
    assert state.merged([state.profile_state(leaning.limit(0), CONTACTS), state.profile_state(leaning.limit(5), CONTACTS)]).where("kind = 'rows'").first()["n"] == 5
    flat = state.profile_state(leaning.withColumn("age", F.lit(4.0)), CONTACTS)
    assert {r["r"] for r in state.correlations(flat).where("column = 'age' OR other = 'age'").collect()} == {None}
    assert state.rates(state.profile_state(leaning.drop("subscribe"), CONTACTS)).where("rate IS NOT NULL").count() == 0


def test_readings_scan_their_own_columns_and_sum_before_they_list(spark, leaning, tmp_path):
    """No row is listed once per pair of numbers, and rates read no number."""
    leaning.write.parquet(str(tmp_path / "rows"))
    found = state.profile_state(spark.read.parquet(str(tmp_path / "rows")), CONTACTS)
    plan = found.where("kind = 'pair'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("Generate") < plan.rindex("Aggregate")
    of_levels = state.rates(state.merged([found, found]))._jdf.queryExecution().executedPlan().toString()
    assert of_levels.count("FileScan") == 2  # the levels of either state


def test_more_numbers_than_are_summed_together(spark):
    rng = np.random.default_rng(5)
    names = [f"c{i}" for i in range(13)]
    rows = [[None if rng.random() < 0.2 else float(rng.integers(0, 50)) for _ in names] for _ in range(60)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names))
    found = state.profile_state(df, FieldDictionary(categoricals=(), numerics=tuple(names)))
    table = df.toPandas()
    pairs = {(r["column"], r["other"]): (r["n"], r["r"]) for r in state.correlations(found).collect()}
    assert len(pairs) == 78 and found.where("kind = 'rows'").first()["n"] == 60
    for (a, b), (n, r) in pairs.items():
        own = table[[a, b]].dropna()
        assert n == len(own) and r == pytest.approx(np.corrcoef(own[a], own[b])[0, 1], abs=1e-9)
    assert {r["column"]: r["n_missing"] for r in state.statistics(found).collect()} == {c: int(table[c].isna().sum()) for c in names}
