"""Scan, schema check and cleaning of contact records."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.dictionary import DatasetError, FieldDictionary
from leadlens.functions.cleaning import finite, is_token, parsed, present, stripped
from leadlens.functions.shapes import ratio_sql, rows_from, text

DATASETS = ("train", "test")


def resolve_dataset(name: str) -> str:
    """The dataset name in lower case; anything but train or test is an error."""
    found = str(getattr(name, "value", name)).strip().lower()
    if found not in DATASETS:
        raise DatasetError(f"unknown dataset {name!r}: choose one of {', '.join(DATASETS)}")
    return found


def scan(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The raw file. CSV is read as text with its header: a positional schema would silently
    take reordered columns for one another."""
    try:
        if fmt == "csv":
            return spark.read.option("header", True).option("escape", '"').csv(path)
        return spark.read.format(fmt).load(path)
    except AnalysisException as error:
        raise DatasetError(f"cannot read {path}: {error.getCondition() or error}") from error


def read_dataset(
    spark: SparkSession, folder: str, name: str, fd: FieldDictionary, fmt: str = "csv", persist: bool = False, strict: bool = False
) -> DataFrame:
    """``<folder>/<name>.<fmt>``, checked, projected and cleaned. ``persist`` keeps it for reuse. ``strict`` counts the
    rows of a CSV file with too many or too few cells first and refuses a file that has any."""
    dataset = resolve_dataset(name)
    if strict and fmt == "csv" and (bad := malformed_rows(spark, f"{folder}/{dataset}.{fmt}").first()["n_malformed"]):
        raise DatasetError(f"{bad} malformed rows in {folder}/{dataset}.{fmt}")
    df = conform(scan(spark, f"{folder}/{dataset}.{fmt}", fmt), fd, labelled=dataset == "train")
    return df.persist(StorageLevel.MEMORY_AND_DISK) if persist else df


def _is_text(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() in ("string", "varchar", "char")


def check_columns(columns: Iterable[str], fd: FieldDictionary, labelled: bool) -> None:
    have = set(columns)
    missing = [c for c in fd.required(labelled) if c not in have]
    if missing:
        raise DatasetError(f"missing columns: {', '.join(missing)}")


def clean_category(cell: str, fd: FieldDictionary) -> str:
    """NA tokens count as missing before stripping; a blank cell strips to '' and stays."""
    return f"coalesce({present(cell)}, {text(fd.unknown)})"


def clean_target(cell: str) -> str:
    return f"lower({present(cell)})"


def _text(df: DataFrame, column: str) -> str:
    return f"`{column}`" if _is_text(df, column) else f"CAST(`{column}` AS STRING)"


def _number(df: DataFrame, column: str) -> str:
    return parsed(f"`{column}`") if _is_text(df, column) else f"CAST(`{column}` AS DOUBLE)"


def _id(df: DataFrame, fd: FieldDictionary) -> str:
    """The id in its declared type; a stripped text where that is ``string``."""
    return f"try_cast({stripped(f'`{fd.id}`') if _is_text(df, fd.id) else f'`{fd.id}`'} AS {fd.id_type})"


def conform(df: DataFrame, fd: FieldDictionary, labelled: bool, keep: Sequence[str] = ()) -> DataFrame:
    """The dictionary's columns in order, cleaned row by row; other columns are dropped, but for those in ``keep``.

    Numbers take two projections, so that a parsed value is tested without parsing it again.
    """
    check_columns(df.columns, fd, labelled)
    names = fd.required(labelled)
    read = []
    for name in names:
        cell = _text(df, name)
        if name == fd.target:
            cell = clean_target(cell)
        elif name in fd.categoricals:
            cell = clean_category(cell, fd)
        elif name in fd.numerics:
            cell = _number(df, name)
        elif name == fd.id:
            cell = _id(df, fd)
        read.append(f"{cell} AS `{name}`")
    checked = [f"{finite(f'`{c}`')} AS `{c}`" if c in fd.numerics else f"`{c}`" for c in names]
    kept = [f"`{c}`" for c in keep]
    return df.selectExpr(*read, *kept).selectExpr(*checked, *kept)


def coercion_failures(df: DataFrame, fd: FieldDictionary) -> DataFrame:
    """(column, n_failed): cells of the raw table that hold something other than a number, or an id of another type."""
    names = [c for c in fd.numerics if c in df.columns]
    read, failed = [], []
    if fd.id in df.columns:
        there = f"`{fd.id}` IS NOT NULL AND NOT ({is_token(f'`{fd.id}`')})" if _is_text(df, fd.id) else f"`{fd.id}` IS NOT NULL"
        read += [f"{there} AS `there_{fd.id}`", f"{_id(df, fd)} AS `{fd.id}`"]
        failed.append(f"count_if(`there_{fd.id}` AND `{fd.id}` IS NULL) AS `{fd.id}`")
    for c in names:
        there = f"`{c}` IS NOT NULL AND NOT ({is_token(f'`{c}`')})" if _is_text(df, c) else f"`{c}` IS NOT NULL"
        read += [f"{there} AS `there_{c}`", f"{_number(df, c)} AS `{c}`"]
    failed += [f"count_if(`there_{c}` AND ({finite(f'`{c}`')}) IS NULL) AS `{c}`" for c in names]
    stats = df.selectExpr(*read).selectExpr(*failed)
    return rows_from(stats, [{"column": text(c), "n_failed": f"`{c}`"} for c in ([fd.id] if fd.id in df.columns else []) + names])


def malformed_rows(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """One row: n_rows and n_malformed of a CSV file, those with more or fewer cells than columns. ``columns`` names them
    where the file has no header."""
    names = columns or scan(spark, path).columns
    schema = ", ".join(f"`{c}` string" for c in [*names, "_malformed"])
    whole = {"header": columns is None, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed", "columnPruning": False}
    rows = spark.read.schema(schema).options(**whole).csv(path)
    # Spark wants the other columns to be read as well: their lengths, which are never below zero.
    cells = ", ".join(f"`{c}`" for c in names)
    return rows.selectExpr("count(*) AS n_rows", f"count_if(`_malformed` IS NOT NULL AND length(concat_ws('', {cells})) >= 0) AS n_malformed")


def describe(df: DataFrame, fd: FieldDictionary) -> DataFrame:
    """One row: size, whether a target exists, label counts and the positive rate of labelled rows."""
    if fd.target in df.columns:
        pos, neg = f"count_if(`{fd.target}` = {text(fd.positive)})", f"count_if(`{fd.target}` = {text(fd.negative)})"
    else:
        pos = neg = "CAST(NULL AS BIGINT)"
    stats = df.selectExpr("count(*) AS n_rows", f"{pos} AS n_pos", f"{neg} AS n_neg")
    return stats.selectExpr(
        "n_rows",
        f"{len(df.columns)}L AS n_columns",
        f"{str(fd.target in df.columns).lower()} AS has_target",
        "n_pos",
        "n_neg",
        f"round({ratio_sql('n_pos', 'n_pos + n_neg')}, 4) AS positive_rate",
    )


def dictionary_table(df: DataFrame, fd: FieldDictionary) -> DataFrame:
    """(position, column, title, meaning, n_rows, n_null) for the described columns the table has."""
    names = [c for c in fd.columns if c in df.columns and c in fd.descriptions]
    stats = df.selectExpr("count(*) AS n_rows", *[f"count_if(`{c}` IS NULL) AS `null_{c}`" for c in names])
    return rows_from(
        stats,
        [
            {
                "position": f"{i}L",
                "column": text(c),
                "title": text(fd.descriptions[c][0]),
                "meaning": text(fd.descriptions[c][1]),
                "n_rows": "n_rows",
                "n_null": f"`null_{c}`",
            }
            for i, c in enumerate(names)
        ],
    )


def preview(df: DataFrame, fd: FieldDictionary, n: int = 500) -> DataFrame:
    """The first n rows by id, as a bounded top-n rather than a full sort."""
    order = [fd.id] if fd.id in df.columns else df.columns
    return df.orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in order]).limit(n)
