"""Target coding, exact stratified selection, weights, one-hot and scaling."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.base import Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.dictionary import CONTACTS, MAX_LEVELS, Config, DatasetError, FieldDictionary
from leadlens.functions.shapes import rows_from, text
from leadlens.operators.features import feature_lists, feature_stage
from leadlens.operators.filters import require_target
from leadlens.operators.ranking import at_or_below, hash_order, smallest_cuts, sort_key


def label_counts(df: DataFrame, fd: FieldDictionary) -> dict[str, int]:
    """Rows per label; any other label, or none, is an error that lists up to 20 of them."""
    return label_state(df, fd)[0]


def label_state(df: DataFrame, fd: FieldDictionary) -> tuple[dict[str, int], bool]:
    """``label_counts``, and whether every row has an id, from one scan."""
    require_target(df, fd)
    target = F.col(f"`{fd.target}`")
    known = target.isin(fd.negative, fd.positive)
    unnamed = F.col(f"`{fd.id}`").isNull() if fd.id in df.columns else F.lit(False)
    counted = df.groupBy(target.alias("label")).agg(F.count(F.lit(1)).alias("n"), F.max(known).alias("known"), F.count_if(unnamed).alias("unnamed"))
    rows = counted.orderBy(F.col("known").desc_nulls_last(), "label").limit(22).collect()
    wrong = [str(r["label"]) for r in rows if not r["known"]]
    if wrong:
        raise DatasetError(f"labels other than {fd.negative}/{fd.positive}: {', '.join(wrong[:20])}")
    found = {r["label"]: r["n"] for r in rows}
    return {label: found.get(label, 0) for label in (fd.negative, fd.positive)}, not any(r["unnamed"] for r in rows)


def encode_target(df: DataFrame, fd: FieldDictionary, output: str = "label") -> DataFrame:
    """Adds the label as 1.0 / 0.0 after checking that every row has one of the two."""
    label_counts(df, fd)
    return df.withColumn(output, target_code(fd))


def target_code(fd: FieldDictionary) -> Column:
    return F.when(F.col(f"`{fd.target}`") == fd.positive, 1.0).otherwise(0.0)


def test_sizes(counts: Mapping[str, int], share: float) -> dict[str, int]:
    """ceil(total * share) rows shared out to the labels by largest remainder; ties to the first label."""
    total = sum(counts.values())
    if not total:
        return {label: 0 for label in counts}
    wanted = math.ceil(round(total * share, 9))
    exact = {label: n * wanted / total for label, n in counts.items()}
    sizes = {label: math.floor(x) for label, x in exact.items()}
    spare = sorted(counts, key=lambda label: (-(exact[label] - sizes[label]), list(counts).index(label)))
    for label in spare[: wanted - sum(sizes.values())]:
        sizes[label] += 1
    return sizes


def _side(df: DataFrame, fd: FieldDictionary, seed: int, cuts: Mapping[str, list[tuple[str, int]]], complete: bool) -> Column:
    """Number of cuts of its label that lie before the row in hash order."""
    key = sort_key(df, fd.id, complete)
    hashed = hash_order(key, seed)
    out = F.lit(0)
    for label, points in cuts.items():
        passed = sum([(~at_or_below(hashed, key, p)).cast("int") for p in points], F.lit(0))
        out = F.when(F.col(f"`{fd.target}`") == label, passed).otherwise(out)
    return out


def stratified_split(
    df: DataFrame, fd: FieldDictionary, config: Config = Config(), state: tuple[dict[str, int], bool] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with exact sizes per label: the test rows are the first of their label in hash order.

    Only the cut points are computed; membership is then a row-wise comparison, so no row is
    ranked or shuffled. Rows that share an id fall on the same side. A caller that has the ``label_state`` of ``df`` saves its scan.
    """
    counts, complete = state or label_state(df, fd)
    sizes = test_sizes(counts, config.test_size)
    cuts = smallest_cuts(df, fd.target, fd.id, config.seed, counts, {label: [k] for label, k in sizes.items()}, complete)
    key = sort_key(df, fd.id, complete)
    hashed = hash_order(key, config.seed)
    is_test = F.lit(False)
    for label, points in cuts.items():
        if points:
            is_test = is_test | ((F.col(f"`{fd.target}`") == label) & at_or_below(hashed, key, points[0]))
    return df.where(~is_test), df.where(is_test)


def with_folds(df: DataFrame, fd: FieldDictionary, config: Config = Config(), output: str = "fold") -> DataFrame:
    """Adds a stratified fold number: each label's hash order cut into equal consecutive parts.

    The hash uses the seed after the split's, so folds do not depend on the split.
    """
    counts, complete = label_state(df, fd)
    ranks = {
        label: [-(-n * i // config.folds) for i in range(1, config.folds)] if n else [] for label, n in counts.items()
    }
    cuts = smallest_cuts(df, fd.target, fd.id, config.seed + 1, counts, ranks, complete)
    return df.withColumn(output, _side(df, fd, config.seed + 1, cuts, complete))


@dataclass(frozen=True)
class ClassWeights:
    """Weights against imbalance, from the label counts of the training rows."""

    n_neg: int
    n_pos: int

    @property
    def positive(self) -> float:
        return self.n_neg / max(self.n_pos, 1)

    def balanced(self, positive: bool) -> float:
        own = self.n_pos if positive else self.n_neg
        return (self.n_neg + self.n_pos) / (2 * own) if own else 0.0

    def columns(self, fd: FieldDictionary) -> dict[str, Column]:
        is_pos = F.col(f"`{fd.target}`") == fd.positive
        return {
            "w_balanced": F.when(is_pos, self.balanced(True)).otherwise(self.balanced(False)),
            "w_positive": F.when(is_pos, self.positive).otherwise(1.0),
        }


def class_weights(df: DataFrame, fd: FieldDictionary) -> DataFrame:
    """(label, n, balanced_weight, positive_weight)"""
    require_target(df, fd)
    stats = df.selectExpr(
        f"count_if(`{fd.target}` = {text(fd.negative)}) AS neg", f"count_if(`{fd.target}` = {text(fd.positive)}) AS pos"
    )
    upweight = "CAST(neg AS DOUBLE) / CAST(greatest(pos, 1) AS DOUBLE)"
    rows = [
        {
            "label": text(label),
            "n": own,
            "balanced_weight": f"try_divide(CAST(neg + pos AS DOUBLE), CAST({own} * 2 AS DOUBLE))",
            "positive_weight": upweight if own == "pos" else "1D",
        }
        for label, own in ((fd.negative, "neg"), (fd.positive, "pos"))
    ]
    return rows_from(stats, rows)


class PopulationScaler(Estimator):
    """Standardises by the population deviation; a constant column is only centred and a missing
    value becomes the mean. Fitting is one aggregate; the result is a SQL stage that saves with
    the pipeline and runs inside the JVM."""

    inputCols = Param(Params._dummy(), "inputCols", "columns to scale", TypeConverters.toListString)
    suffix = Param(Params._dummy(), "suffix", "appended to the scaled columns", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = (), suffix: str = "_z"):
        super().__init__()
        self._set(inputCols=list(inputCols), suffix=suffix)

    def _fit(self, dataset: DataFrame) -> Transformer:
        names, suffix = self.getOrDefault("inputCols"), self.getOrDefault("suffix")
        aggs = []
        for c in names:
            x = f"CAST(`{c}` AS DOUBLE)"
            aggs.append(f"coalesce(avg({x}), 0D)")
            aggs.append(f"CASE WHEN min({x}) < max({x}) THEN stddev_pop({x}) ELSE 1D END")
        row = dataset.selectExpr(*aggs).first()
        scaled = [
            f"coalesce((CAST(`{c}` AS DOUBLE) - double('{row[2 * i]!r}')) / double('{row[2 * i + 1]!r}'), 0D)"
            f" AS `{c}{suffix}`"
            for i, c in enumerate(names)
        ]
        return SQLTransformer(statement=f"SELECT *, {', '.join(scaled)} FROM __THIS__")


def check_levels(df: DataFrame, columns: Sequence[str], limit: int = MAX_LEVELS) -> None:
    """Level lists are held by the driver, so a column that is no categorical one is refused. Well
    above the error of the sketch, the estimate is enough."""
    counts = df.selectExpr(*[f"approx_count_distinct(`{c}`) AS `{c}`" for c in columns]).first().asDict()
    wide = [c for c, n in counts.items() if n > limit]
    if wide:
        raise DatasetError(f"too many levels for one-hot: {', '.join(wide)}")


def one_hot_stages(columns: Sequence[str]) -> list:
    """Levels sorted by name, none dropped; an unseen or missing level gives the zero vector."""
    index, hot = [f"{c}_ix" for c in columns], [f"{c}_hot" for c in columns]
    return [
        StringIndexer(inputCols=list(columns), outputCols=index, stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True),
    ]


def encoding_stages(fd: FieldDictionary = CONTACTS, config: Config = Config(), raw_input: bool = True) -> list:
    """Stages up to the feature vector: (raw -> features ->) one-hot, scaling, assembly."""
    categorical, numeric = feature_lists(fd, config)
    assembled = [f"{c}_hot" for c in categorical] + [f"{c}_z" for c in numeric]
    return [
        *([feature_stage(config)] if raw_input else []),
        *one_hot_stages(categorical),
        PopulationScaler(inputCols=numeric),
        VectorAssembler(inputCols=assembled, outputCol="features"),
    ]


def build_pipeline(
    estimator, fd: FieldDictionary = CONTACTS, config: Config = Config(), raw_input: bool = True
) -> Pipeline:
    """Encoding and model as one pipeline, on raw rows or on rows that already have the features."""
    return Pipeline(stages=[*encoding_stages(fd, config, raw_input), estimator])


def one_hot_slots(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """(key, <column>_slot ..): the position of the 1 in each fitted one-hot vector, -1 for the zero vector."""
    check_levels(df, columns)
    model = Pipeline(stages=one_hot_stages(columns)).fit(df)
    slots = [
        (F.array_position(vector_to_array(F.col(f"{c}_hot")), F.lit(1.0)) - 1).cast("long").alias(f"{c}_slot")
        for c in columns
    ]
    return model.transform(df).select(key, *slots)


def scaled_features(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """(key, <column>_z ..)"""
    model = PopulationScaler(inputCols=list(columns)).fit(df)
    return model.transform(df).select(key, *[f"{c}_z" for c in columns])
