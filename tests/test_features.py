import json

import pytest

from leadlens.dictionary import CONTACTS, Config, DatasetError
from leadlens.operators import features
from leadlens.sources import sinks


def test_flags_and_buckets(few):
    rows = features.model_view(few).orderBy("id").collect()
    of = lambda c: [r[c] for r in rows]
    assert of("is_ever_contacted") == [0, 1, 0, 1, 0, 1, 0, 0, 1]
    assert of("is_high_frequency") == [0, 0, 0, 1, 0, 0, 1, 0, 0]
    assert of("was_previous_success") == [0, 1, 0, 0, 0, 1, 0, 0, 0]
    assert of("contact_cellular") == [0, 1, 1, 0, 1, 1, 0, 1, 1]
    labels = ["<=30", "31-45", "46-60", ">60"]
    assert of("age_bucket") == [labels[i - 1] for i in (2, 3, 1, 4, 2, 3, 1, 2, 2)]


def test_missing_and_boundary_values(spark):
    df = spark.createDataFrame(
        [(a,) for a in (0.0, 1.0, 30.0, 31.0, 45.0, 60.0, 61.0, 200.0, 201.0, None)], "age double"
    ).selectExpr("age", "CAST(NULL AS DOUBLE) AS pdays", "CAST(NULL AS DOUBLE) AS campaign", "'a' AS poutcome", "CAST(NULL AS STRING) AS contact")
    rows = df.selectExpr(*[f"{sql} AS {name}" for name, sql in features.derived_sql().items()]).collect()
    assert [r["age_bucket"] for r in rows] == ["nan", "<=30", "<=30", "31-45", "31-45", "46-60", ">60", ">60", "nan", "nan"]
    first = rows[0]
    assert [first[c] for c in features.FLAGS] == [1, 0, 0, 0]
    custom = features.derived_sql(Config(high_frequency_threshold=3, never_contacted=-1))
    assert df.selectExpr("CAST(4 AS DOUBLE) AS campaign", "-1D AS pdays").selectExpr(
        f"{custom['is_high_frequency']} AS h", f"{custom['is_ever_contacted']} AS e"
    ).first() == (1, 0)


def test_duration_is_left_out_unless_asked_for(few):
    plain = features.with_features(few)
    assert "duration" not in plain.columns and "id" not in plain.columns and "age" in plain.columns
    assert "duration" in features.with_features(few, config=Config(include_duration=True)).columns
    categorical, numeric = features.feature_lists()
    assert (len(categorical), len(numeric)) == (11, 13)
    assert len(features.feature_lists(config=Config(include_duration=True))[1]) == 14


def test_missing_column(few):
    with pytest.raises(DatasetError, match="pdays"):
        features.with_features(few.drop("pdays"))


def test_views(spark, few):
    features.register_views(few)
    assert spark.table("v_leakage_features").columns == ["id", "duration", "subscribe"]
    assert "duration" not in spark.table("v_model_features").columns


def test_field_mapping(few, tmp_path):
    mapping = features.field_mapping(few)
    rows = mapping.collect()
    assert [r["field"] for r in rows if r["section"] == "dropped"] == ["id", "duration"]
    assert [r["in_model"] for r in rows if r["section"] == "numeric" and r["field"] == "duration"] == [False]
    assert {r["field"] for r in rows if r["section"] == "derived"} == {*features.FLAGS, "age_bucket"}
    assert len([r for r in rows if r["section"].startswith("model_")]) == 24
    assert [r["n_missing"] for r in rows if r["section"] == "categorical" and r["field"] == "job"] == [1]
    sinks.write_field_mapping(mapping, str(tmp_path / "mapping"))
    [part] = (tmp_path / "mapping").glob("part-*.json")
    assert len([json.loads(line) for line in part.read_text(encoding="utf-8").splitlines()]) == len(rows)
