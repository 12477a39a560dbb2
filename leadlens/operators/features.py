"""Derived features, model columns and their lineage.

The derivations are SQL expressions, used both by ``with_features`` and by the first stage of a
saved pipeline, so that training and scoring cannot drift apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml.base import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.dictionary import CONTACTS, Config, DatasetError, FieldDictionary
from leadlens.functions.shapes import rows_from, text

# Age edges (right-closed) and the level of an age outside them.
AGE_EDGES = (0, 30, 45, 60, 200)
AGE_LABELS = ("<=30", "31-45", "46-60", ">60")
AGE_NONE = "nan"

FLAGS = ("is_ever_contacted", "is_high_frequency", "was_previous_success", "contact_cellular")

_DERIVED_TITLES = {
    "is_ever_contacted": "reached by an earlier campaign",
    "is_high_frequency": "called often in the running campaign",
    "was_previous_success": "earlier campaign succeeded",
    "contact_cellular": "called on a mobile line",
    "age_bucket": "age in four ranges",
}


def derived_sql(config: Config = Config()) -> dict[str, str]:
    """Name -> SQL expression. A missing pdays counts as contacted, a missing count as not frequent."""
    ranges = " ".join(
        f"WHEN age > {lo} AND age <= {hi} THEN '{label}'" for lo, hi, label in zip(AGE_EDGES, AGE_EDGES[1:], AGE_LABELS)
    )
    return {
        "is_ever_contacted": f"CAST(NOT (pdays <=> {config.never_contacted}) AS INT)",
        "is_high_frequency": f"CAST(coalesce(campaign >= {config.high_frequency_threshold}, false) AS INT)",
        "was_previous_success": "CAST(poutcome <=> 'success' AS INT)",
        "contact_cellular": "CAST(contact <=> 'cellular' AS INT)",
        "age_bucket": f"CASE {ranges} ELSE '{AGE_NONE}' END",
    }


def check_feature_input(df: DataFrame, fd: FieldDictionary = CONTACTS) -> None:
    missing = [c for c in (fd.id, *fd.categoricals, *fd.numerics) if c not in df.columns]
    if missing:
        raise DatasetError(f"feature input lacks columns: {', '.join(missing)}")


def feature_lists(fd: FieldDictionary = CONTACTS, config: Config = Config()) -> tuple[list[str], list[str]]:
    """(categorical, numeric) model inputs; the after-the-event column only on request."""
    raw = [c for c in fd.numerics if config.include_duration or c != "duration"]
    return [*fd.categoricals, "age_bucket"], [*raw, *FLAGS]


def with_features(df: DataFrame, fd: FieldDictionary = CONTACTS, config: Config = Config()) -> DataFrame:
    """The table without id (and duration unless included), with flags and the age range added."""
    check_feature_input(df, fd)
    drop = [fd.id] + ([] if config.include_duration else ["duration"])
    derived = {name: F.expr(sql) for name, sql in derived_sql(config).items()}
    return df.withColumns(derived).drop(*drop)


#: What a training frame carries along beside the features.
CARRIED = ("id", "subscribe", "label", "w_balanced", "w_positive", "fold")


class FeatureStage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """First pipeline stage: raw rows in, exactly the model's columns out, categorical ones first; of other columns only those named by
    ``carried`` stay, in front. Raw columns that are missing are an error that names them. It saves and loads with the pipeline."""

    includeDuration = Param(Params._dummy(), "includeDuration", "whether the after-the-event column is an input", TypeConverters.toBoolean)
    highFrequency = Param(Params._dummy(), "highFrequency", "calls from which on a contact is called often", TypeConverters.toInt)
    neverContacted = Param(Params._dummy(), "neverContacted", "days that stand for no earlier contact", TypeConverters.toInt)
    carried = Param(Params._dummy(), "carried", "columns that stay beside the features", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, includeDuration: bool = False, highFrequency: int = 6, neverContacted: int = 999, carried: Sequence[str] = CARRIED):
        super().__init__()
        self._set(includeDuration=includeDuration, highFrequency=highFrequency, neverContacted=neverContacted, carried=list(carried))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        config = Config(include_duration=get("includeDuration"), high_frequency_threshold=get("highFrequency"), never_contacted=get("neverContacted"))
        needed = [c for c in (*CONTACTS.categoricals, *CONTACTS.numerics) if config.include_duration or c != "duration"]
        missing = [c for c in needed if c not in dataset.columns]
        if missing:
            raise DatasetError(f"feature input lacks columns: {', '.join(missing)}")
        categorical, numeric = feature_lists(CONTACTS, config)
        derived = {name: F.expr(sql) for name, sql in derived_sql(config).items()}
        kept = [c for c in get("carried") if c in dataset.columns]
        return dataset.withColumns(derived).select(*[F.col(f"`{c}`") for c in (*kept, *categorical, *numeric)])


def feature_stage(config: Config = Config(), carried: Sequence[str] = CARRIED) -> FeatureStage:
    return FeatureStage(
        includeDuration=config.include_duration, highFrequency=config.high_frequency_threshold, neverContacted=config.never_contacted, carried=carried
    )


def feature_columns(df: DataFrame, config: Config = Config()) -> DataFrame:
    """(position, feature, type, distinct, n_missing): the columns that the feature stage gives the model, as they come out of it."""
    out = feature_stage(config, carried=()).transform(df)
    stats = out.selectExpr(*[e for c in out.columns for e in (f"count(DISTINCT `{c}`) AS `d_{c}`", f"count_if(`{c}` IS NULL) AS `m_{c}`")])
    rows = [
        {"position": f"{i}L", "feature": text(c), "type": text(t), "distinct": f"`d_{c}`", "n_missing": f"`m_{c}`"} for i, (c, t) in enumerate(out.dtypes)
    ]
    return rows_from(stats, rows)


def register_views(df: DataFrame, fd: FieldDictionary = CONTACTS, config: Config = Config()) -> None:
    """``v_model_features`` without, ``v_leakage_features`` with only the after-the-event column."""
    model_view(df, fd, config).createOrReplaceTempView("v_model_features")
    leakage_view(df, fd).createOrReplaceTempView("v_leakage_features")


def model_view(df: DataFrame, fd: FieldDictionary = CONTACTS, config: Config = Config()) -> DataFrame:
    categorical, numeric = feature_lists(fd, config)
    label = [fd.target] if fd.target in df.columns else []
    return with_features(df.withColumn("row_id", F.col(fd.id)), fd, config).select(
        F.col("row_id").alias(fd.id), *[F.col(f"`{c}`") for c in (*categorical, *numeric, *label)]
    )


def leakage_view(df: DataFrame, fd: FieldDictionary = CONTACTS) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in (fd.id, "duration", fd.target) if c in df.columns])


def field_mapping(
    df: DataFrame, fd: FieldDictionary = CONTACTS, config: Config = Config()
) -> DataFrame:
    """(section, position, field, title, treatment, in_model, n_missing): where every raw and derived
    field goes, with the number of missing values (unknown for categoricals) it brings along."""
    check_feature_input(df, fd)
    categorical, numeric = feature_lists(fd, config)
    model = {*categorical, *numeric}
    out: list[tuple[str, str, str, str, bool]] = []
    if fd.target:
        coding = f"{fd.negative}=0, {fd.positive}=1"
        out.append(("target", fd.target, fd.title(fd.target), coding, False))
    out.append(("dropped", fd.id, fd.title(fd.id), "identifier, no input", False))
    if not config.include_duration:
        out.append(("dropped", "duration", fd.title("duration"), "known after the event", False))
    out += [("numeric", c, fd.title(c), "standardised", c in model) for c in fd.numerics]
    out += [("categorical", c, fd.title(c), "one-hot, unseen ignored", c in model) for c in fd.categoricals]
    out += [
        ("derived", c, t, "one-hot, unseen ignored" if c == "age_bucket" else "0/1, standardised", True)
        for c, t in _DERIVED_TITLES.items()
    ]
    out += [("model_categorical", c, fd.title(c), "one-hot, unseen ignored", True) for c in categorical]
    out += [("model_numeric", c, fd.title(c), "standardised", True) for c in numeric]

    wide = df.withColumns({name: F.expr(sql) for name, sql in derived_sql(config).items()})
    gaps = {}
    for field in {f for _, f, *_ in out} & set(wide.columns):
        gap = f"`{field}` IS NULL"
        if field in fd.categoricals:
            gap += f" OR `{field}` = {text(fd.unknown)}"
        elif field == "age_bucket":
            gap = f"age_bucket = {text(AGE_NONE)}"
        gaps[field] = f"count_if({gap}) AS `gap_{field}`"
    rows = [
        {
            "section": text(section),
            "position": f"{i}L",
            "field": text(field),
            "title": text(title),
            "treatment": text(treatment),
            "in_model": str(used).lower(),
            "n_missing": f"`gap_{field}`" if field in gaps else "CAST(NULL AS BIGINT)",
        }
        for i, (section, field, title, treatment, used) in enumerate(out)
    ]
    return rows_from(wide.selectExpr(*gaps.values()), rows)
