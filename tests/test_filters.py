import pytest
from conftest import SMALL, plan_of
from pyspark.sql import functions as F

from leadlens.dictionary import CONTACTS, DatasetError, FilterCriteria
from leadlens.operators import filters
from leadlens.plans.campaign import table


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_default_criteria_keep_everything(few):
    criteria = filters.default_criteria(few, CONTACTS)
    assert criteria.numeric["age"] == (19.0, 67.0)
    assert criteria.categorical["subscribe"] == ["no", "yes"]
    assert len(criteria.categorical) == 11 and len(criteria.numeric) == 10
    assert filters.apply_filter(few, criteria).count() == 9


def test_conditions(few):
    apply = lambda **kw: ids(filters.apply_filter(few, FilterCriteria(**kw)))
    assert apply(categorical={"job": ["services", "admin."]}) == [15, 17]
    assert apply(categorical={"job": []}) == ids(few)
    assert apply(numeric={"age": (29, 44)}) == [11, 15, 17, 18, 19]  # both ends belong to the range
    assert apply(numeric={"age": None}) == ids(few)
    assert apply(categorical={"poutcome": ["failure", "success"]}, numeric={"campaign": (2, 20)}) == [14, 16]


def test_missing_never_matches(spark):
    df = spark.createDataFrame([(1, None, None), (2, "a", 1.0), (3, "a", float("nan"))], "id long, job string, age double")
    criteria = FilterCriteria(categorical={"job": ["a"]}, numeric={"age": (0, 10)})
    assert ids(filters.apply_filter(df, criteria)) == [2]


def test_unknown_columns(few):
    with pytest.raises(DatasetError, match="nope, never"):
        filters.apply_filter(few, FilterCriteria(categorical={"nope": ["x"]}, numeric={"never": (0, 1)}))


def test_kpis(few):
    criteria = FilterCriteria(numeric={"lending_rate3m": (0.5, 3.5)})
    assert tuple(filters.filter_kpis(few, criteria, CONTACTS).first()) == (9, 5, 5 / 9, 4, 0.8)
    empty = filters.filter_kpis(few.limit(0), criteria, CONTACTS).first()
    assert tuple(empty) == (0, 0, 0.0, 0, None)
    unlabelled = filters.filter_kpis(few.drop("subscribe"), criteria, CONTACTS).first()
    assert tuple(unlabelled) == (9, 5, 5 / 9, None, None)


def test_domain_order(spark, few):
    rows = sorted(filters.category_domain(few, CONTACTS).collect(), key=lambda r: (r["column"], r["position"]))
    of = lambda c: [r["value"] for r in rows if r["column"] == c]
    assert of("month") == ["mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov"]
    assert of("marital") == ["married", "single", "divorced"]
    weekend = few.selectExpr("'sun' AS day_of_week").union(few.selectExpr("'sat'")).union(few.select("day_of_week"))
    rows = filters.category_domain(weekend, CONTACTS).orderBy("position").collect()
    assert [r["value"] for r in rows] == ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]


def test_domain_refuses_a_column_of_many_values(spark, few):
    with pytest.raises(Exception, match="too many values"):
        filters.category_domain(few, CONTACTS, max_values=5).collect()


def test_bounds_skip_empty_columns(few):
    rows = filters.numeric_bounds(few.withColumn("pdays", F.lit(None).cast("double")), CONTACTS).collect()
    got = {r["column"]: (r["lo"], r["hi"]) for r in rows}
    assert got["age"] == (19, 67) and got["id"] == (11, 19) and "pdays" not in got


def test_missing_target_is_an_error(few):
    with pytest.raises(DatasetError, match="target"):
        filters.require_target(few.drop("subscribe"), CONTACTS)


def test_filter_reaches_the_scan(spark):
    criteria = FilterCriteria(categorical={"o_orderstatus": ["F"]}, numeric={"o_totalprice": (1000.0, 2000.0)})
    kept = filters.apply_filter(table(spark, SMALL, "orders"), criteria).select("o_orderkey")
    plan = plan_of(kept)
    assert "GreaterThanOrEqual(o_totalprice,1000.0)" in plan and "EqualTo(o_orderstatus,F)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan
