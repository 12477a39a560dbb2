"""Tables kept across applications: versions, a manifest that publishes them, and their expiry.

Below ``<shared folder>/kept/<name>`` lie

* ``begun/<version>``: a row written before an attempt to make the table,
* ``data/<version>``: what that attempt wrote, as Parquet,
* ``manifest/<version>``: a row written when the data is complete. From then on the version exists.

Each folder is written by one job, so that applications never write to the same place. The one file of a manifest appears by a
rename: an attempt that ends early, at whatever point, publishes nothing. A version is read only if it was made from the wanted
state and its files have the number and size that its manifest states.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leadlens.dictionary import DatasetError
from leadlens.sources.shared import remove, shared_folder

NOTE = "version string, state string, at double, schema string, n_files long, n_bytes long"
WEEK = 7 * 24 * 3600.0


def _listed(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Path, length and time of every file below ``paths``; contents stay unread."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths)).select("path", "length", "modificationTime")


def fingerprint(spark: SparkSession, paths: Sequence[str], *recipe: str) -> str:
    """The state of a table made from ``paths``: names, sizes and times of their files, and the text of the recipe."""
    file = F.xxhash64("path", "length", "modificationTime")
    row = _listed(spark, paths).agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(file)).first()
    return hashlib.md5(repr((sorted(paths), tuple(row), recipe)).encode()).hexdigest()


def _place(spark: SparkSession, name: str, folder: str | None) -> str:
    if not name or not name.replace("-", "").replace("_", "").isalnum():
        raise DatasetError(f"not a name of a kept table: {name!r}")
    return f"{shared_folder(spark, folder)}/kept/{name}"


def _note(spark: SparkSession, path: str, row: tuple) -> None:
    spark.createDataFrame([row], NOTE).coalesce(1).write.json(path)


def _notes(spark: SparkSession, path: str) -> list[Row]:
    """A row for each version, the newest first. Expiry keeps them few."""
    try:
        return spark.read.schema(NOTE).option("recursiveFileLookup", True).json(path).orderBy(F.desc("at"), "version").collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def _size(spark: SparkSession, path: str) -> tuple[int, int]:
    try:
        return tuple(_listed(spark, [path]).agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first())
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return 0, 0
        raise


def _is_whole(spark: SparkSession, place: str, note: Row) -> bool:
    return _size(spark, f"{place}/data/{note['version']}") == (note["n_files"], note["n_bytes"])


def _read(spark: SparkSession, place: str, version: str, schema: str) -> DataFrame:
    return spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(f"{place}/data/{version}")


def publish(df: DataFrame, name: str, state: str, folder: str | None = None) -> DataFrame:
    """Writes ``df`` as a new version of the table and reads it back. Applications that publish the same state at once
    each make a version of their own; readers take the newest."""
    spark = df.sparkSession
    place, version, schema = _place(spark, name, folder), uuid.uuid4().hex, df.schema.json()
    _note(spark, f"{place}/begun/{version}", (version, state, time.time(), schema, None, None))
    df.write.parquet(f"{place}/data/{version}")
    size = _size(spark, f"{place}/data/{version}")
    _note(spark, f"{place}/manifest/{version}", (version, state, time.time(), schema, *size))
    return _read(spark, place, version, schema)


def kept(spark: SparkSession, name: str, state: str, build: Callable[[], DataFrame], folder: str | None = None) -> DataFrame:
    """The newest whole version of the table that was made from ``state``, by this or another application; where there is
    none, what ``build`` returns, published."""
    place = _place(spark, name, folder)
    for note in _notes(spark, f"{place}/manifest"):
        if note["state"] == state and _is_whole(spark, place, note):
            return _read(spark, place, note["version"], note["schema"])
    return publish(build(), name, state, folder)


def versions(spark: SparkSession, name: str, folder: str | None = None) -> DataFrame:
    """(version, state, at, n_files, n_bytes, published, whole): a row for every attempt that has not expired."""
    place = _place(spark, name, folder)
    published = {n["version"]: n for n in _notes(spark, f"{place}/manifest")}
    begun = [n for n in _notes(spark, f"{place}/begun") if n["version"] not in published]
    rows = [(n["version"], n["state"], n["at"], n["n_files"], n["n_bytes"], True, _is_whole(spark, place, n)) for n in published.values()]
    rows += [(n["version"], n["state"], n["at"], None, None, False, False) for n in begun]
    return spark.createDataFrame(rows, "version string, state string, at double, n_files long, n_bytes long, published boolean, whole boolean")


def expire(spark: SparkSession, name: str, seconds: float = WEEK, folder: str | None = None) -> list[str]:
    """Removes what is older than ``seconds``: versions, except the newest whole one, and attempts that never ended. Returns
    their names. ``seconds`` must exceed the time that a job takes to make or to read a version. The manifest goes first, so that
    nobody starts to read what is being removed; a removal that ends early is taken up by the next."""
    place, before = _place(spark, name, folder), time.time() - seconds
    published = _notes(spark, f"{place}/manifest")
    newest = next((n["version"] for n in published if _is_whole(spark, place, n)), None)
    young = {n["version"] for n in published if n["at"] >= before} | {newest}
    attempts = _notes(spark, f"{place}/begun")
    old = [n["version"] for n in published if n["version"] not in young]
    old += [n["version"] for n in attempts if n["at"] < before and n["version"] not in young and n["version"] not in old]
    for version in old:
        for part in ("manifest", "data", "begun"):
            remove(spark, f"{place}/{part}/{version}")
    return old
