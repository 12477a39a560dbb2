import json

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from leadlens.dictionary import CONTACTS, Config, DatasetError
from leadlens.operators import encode, features, models
from leadlens.plans import training

QUICK = Config(forest_trees=5, boosted_a_rounds=3, boosted_b_rounds=3, logistic_iterations=30)


@pytest.fixture(scope="module")
def parts(leaning):
    train, test = encode.stratified_split(leaning, CONTACTS)
    return train.persist(), test.persist()


def test_label_counts_and_coding(few):
    assert encode.label_counts(few, CONTACTS) == {"no": 5, "yes": 4}
    coded = encode.encode_target(few, CONTACTS).orderBy("id")
    assert [r["label"] for r in coded.collect()] == [0, 1, 1, 0, 0, 1, 0, 0, 1]
    odd = few.withColumn("subscribe", F.when(F.col("id") == 11, "maybe").otherwise(F.col("subscribe")))
    with pytest.raises(DatasetError, match="maybe"):
        encode.encode_target(odd, CONTACTS)
    with pytest.raises(DatasetError, match="None"):
        encode.label_counts(few.withColumn("subscribe", F.lit(None).cast("string")), CONTACTS)
    with pytest.raises(DatasetError, match="target"):
        encode.stratified_split(few.drop("subscribe"), CONTACTS)


def test_split_keeps_the_rate(leaning, parts):
    train, test = parts
    rate = lambda df: df.agg(F.avg((F.col("subscribe") == "yes").cast("double"))).first()[0]
    assert train.count() == 576 and test.count() == 144
    assert rate(test) == pytest.approx(rate(leaning), abs=0.01)


def test_weights(few):
    rows = {r["label"]: r for r in encode.class_weights(few, CONTACTS).collect()}
    assert rows["no"]["balanced_weight"] == pytest.approx(0.9) and rows["yes"]["balanced_weight"] == pytest.approx(9 / 8)
    assert (rows["no"]["positive_weight"], rows["yes"]["positive_weight"]) == (1.0, pytest.approx(5 / 4))
    own = encode.ClassWeights(7, 2)
    assert own.positive == pytest.approx(3.5) and own.balanced(True) == pytest.approx(9 / 4)
    assert encode.ClassWeights(5, 0).positive == 5


def test_one_hot_of_unseen_and_missing(spark):
    fit_on = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "g string")
    model = Pipeline(stages=encode.one_hot_stages(["g"])).fit(fit_on)
    new = spark.createDataFrame([("a",), ("c",), ("z",), (None,)], "g string")
    hot = [r[0] for r in model.transform(new).select(vector_to_array("g_hot")).collect()]
    assert hot == [[1, 0, 0], [0, 0, 1], [0, 0, 0], [0, 0, 0]]
    wide = spark.range(30).select(F.col("id").cast("string").alias("g"))
    with pytest.raises(DatasetError, match="g"):
        encode.check_levels(wide, ["g"], limit=10)


def test_scaling(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0), (3, None, 5.0)], "id long, x double, c double")
    rows = encode.scaled_features(df, ["x", "c"], "id").orderBy("id").collect()
    assert [(r["x_z"], r["c_z"]) for r in rows] == [(-1, 0), (1, 0), (0, 0)]


def test_vector_holds_exactly_the_features(leaning):
    model = Pipeline(stages=encode.encoding_stages()).fit(leaning)
    vectors = model.transform(leaning).select("features")
    categorical, numeric = features.feature_lists()
    view = features.model_view(leaning)
    levels = sum(view.select(c).distinct().count() for c in categorical)
    assert vectors.first()[0].size == levels + len(numeric)


def test_pipeline_on_ready_features(leaning):
    view = features.model_view(leaning).withColumn("label", encode.target_code(CONTACTS)).withColumn("w_balanced", F.lit(1.0))
    model = encode.build_pipeline(models.estimator("logistic_regression", config=QUICK), raw_input=False).fit(view)
    assert len(model.stages) == 5 and models.scored(model, view).count() == 720


def test_factory():
    with pytest.raises(DatasetError, match="stacking"):
        models.estimator("stacking")
    assert len(models.candidate("random_forest").points()) == 6
    assert models.candidate("logistic_regression").points() == [{"C": 0.1}, {"C": 1.0}, {"C": 10.0}]
    assert (models.estimator("random_forest").settings.trees, models.estimator("random_forest").settings.depth) == (200, None)
    assert models.estimator("boosted_b", {"leaves": 31}).settings.leaves == 31
    assert (models.estimator("boosted_a").settings.depth, models.estimator("boosted_a").settings.leaves) == (6, 64)
    assert models.estimator("logistic_regression", {"C": 2.0}, 100).getRegParam() == pytest.approx(1 / 200)


@pytest.mark.parametrize("name", list(models.CANDIDATES))
def test_every_candidate_fits_and_scores_raw_rows(parts, name):
    train, test = parts
    chosen = {"depth": 4, "leaf": 5} if name == "random_forest" else None
    model = models.fit(name, train, encode.label_counts(train, CONTACTS), config=QUICK, settings=chosen)
    raw = test.drop("subscribe").withColumn("job", F.lit("astronaut"))
    scores = [r["score"] for r in models.batch_scores(model, raw).collect()]
    assert len(scores) == 144 and all(0 <= s <= 1 for s in scores) and len(set(scores)) > 5


def test_logistic_agrees_with_a_newton_solve(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    x, n = rng.normal(0, 1, (300, 2)), 300
    y = (rng.random(n) < 1 / (1 + np.exp(-(x @ [1.0, -2.0] - 1)))).astype(float)
    weights = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    beta = np.zeros(3)
    full = np.hstack([x, np.ones((n, 1))])
    penalty = np.diag([1.0, 1.0, 0.0])  # C = 1: summed weighted loss plus half the squared norm
    for _ in range(50):
        p = 1 / (1 + np.exp(-full @ beta))
        hessian = (full * (weights * p * (1 - p))[:, None]).T @ full + penalty
        beta -= np.linalg.solve(hessian, full.T @ (weights * (p - y)) + penalty @ beta)
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense(r), float(a), float(w)) for r, a, w in zip(x, y, weights)], ["features", "label", "w_balanced"])
    fitted = models.estimator("logistic_regression", {"C": 1.0}, n, Config()).fit(df)
    assert list(fitted.coefficients) + [fitted.intercept] == pytest.approx(list(beta), abs=5e-3)


def test_grid_search_refits_the_best_point(parts):
    train, test = parts
    tuned = models.tune("logistic_regression", train, encode.label_counts(train, CONTACTS), config=QUICK)
    assert len(tuned.points) == 3 and tuned.cv_score == max(s for _, s in tuned.points)
    assert tuned.settings == next(p for p, s in tuned.points if s == tuned.cv_score)
    base = 1 / train.count() * train.where("subscribe = 'yes'").count()
    assert tuned.cv_score > base


def test_training_job_writes_everything(spark, leaning, tmp_path):
    folder = str(tmp_path)
    names = ["logistic_regression", "boosted_a"]
    result = training.train_and_compare(leaning, names, config=QUICK, quick=True, folder=folder)
    rows = result.comparison.collect()
    assert [r["model"] for r in rows] == names and sum(r["is_best"] for r in rows) == 1
    best = max(rows, key=lambda r: r["average_precision"])
    assert best["is_best"] and result.best.name == best["model"] and best["cv_score"] == 0.0
    assert all(r["tn"] + r["fp"] + r["fn"] + r["tp"] == 144 for r in rows)
    assert result.thresholds.count() == 9
    model = models.load_model(f"{folder}/best_model")
    again = sorted(models.batch_scores(model, leaning.drop("subscribe")).collect())
    assert again == sorted(models.batch_scores(result.best.model, leaning.drop("subscribe")).collect())
    [part] = (tmp_path / "training_report").glob("part-*.json")
    report = json.loads(part.read_text(encoding="utf-8"))
    assert report["best_model"] == best["model"] and len(report["models"]) == 2
    assert len(report["benefit_by_threshold"]) == 9 and report["assumptions"]["cost_per_call"] == 10.0
    assert (tmp_path / "field_mapping" / "_SUCCESS").exists()


def test_threshold_from_held_out_training_rows(leaning):
    kept = training.train_and_compare(leaning, ["logistic_regression"], config=QUICK, quick=True, threshold_share=0.25)
    row = kept.comparison.first()
    assert 0 <= row["threshold"] <= 1 and row["tn"] + row["fp"] + row["fn"] + row["tp"] == 144


def test_leakage_experiment(leaning, tmp_path):
    # a duration that follows the outcome, as it does after the event
    leaking = leaning.withColumn("duration", F.when(F.col("subscribe") == "yes", F.col("duration") + 300).otherwise(F.col("duration")))
    rows = training.leakage_experiment(leaking, config=QUICK, folder=str(tmp_path)).collect()
    without, given = rows
    assert (without["variant"], given["variant"]) == ("without_duration", "with_duration")
    assert given["average_precision"] > without["average_precision"]
    assert given["ap_gap"] == pytest.approx(given["average_precision"] - without["average_precision"], abs=1e-9)
    assert (tmp_path / "leakage_comparison" / "_SUCCESS").exists()
