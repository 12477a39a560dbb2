"""A CSV file cleaned and audited in one scan of it.

The rows are written once: clean ones and, beside them, those with a cell too many or too few, which keep their line as it stood. The scan
notes in each row which of its cells are no value of their type; the counts are then read from that one column of the written table.
(``observe`` would count while writing, but once a session has used it, Spark's logistic models can't be sent to tasks any more.)
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.dictionary import FieldDictionary
from leadlens.functions.cleaning import is_token
from leadlens.sources.readers import check_columns, conform, scan

RAW = "_malformed"


@dataclass(frozen=True)
class Audited:
    """The clean rows, the rejected lines (line, and ``failed``: columns whose cell is no value of their type), and what was counted."""

    clean: DataFrame
    rejects: DataFrame
    n_rows: int
    n_malformed: int
    failures: dict[str, int]

    def report(self) -> DataFrame:
        """(measure, column, n): rows, malformed, and failed cells of each column."""
        rows = [("rows", None, self.n_rows), ("malformed", None, self.n_malformed), *[("failed", c, n) for c, n in self.failures.items()]]
        return self.clean.sparkSession.createDataFrame(rows, "measure string, column string, n long")


def read_audited(spark: SparkSession, path: str, fd: FieldDictionary, target: str, labelled: bool = True, columns: Sequence[str] | None = None) -> Audited:
    """Reads the CSV file or folder ``path`` once, writes it to ``target`` as Parquet and reads that back. ``columns`` names the cells where the
    file has no header. Failed cells are counted in all rows, malformed ones included, as ``readers.coercion_failures`` counts them."""
    names = list(columns or scan(spark, path).columns)
    check_columns(names, fd, labelled)
    schema = ", ".join(f"`{c}` string" for c in [*names, RAW])
    options = {"header": columns is None, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW, "columnPruning": False}
    rows = spark.read.schema(schema).options(**options).csv(path)
    typed = [c for c in ([fd.id] if fd.id in names else []) + [c for c in fd.numerics if c in names]]
    there = [f"`{c}` IS NOT NULL AND NOT ({is_token(f'`{c}`')}) AS `there_{c}`" for c in typed]
    kept = [RAW, *[f"there_{c}" for c in typed]]
    cleaned = conform(rows.selectExpr("*", *there), fd, labelled, keep=kept)
    failed = ", ".join(f"CASE WHEN `there_{c}` AND `{c}` IS NULL THEN '{c}' END" for c in typed)
    wanted = [f"`{c}`" for c in fd.required(labelled)]
    out = cleaned.selectExpr(*wanted, f"`{RAW}` AS line", f"array_compact(array({failed})) AS failed" if typed else "CAST(array() AS ARRAY<STRING>) AS failed", f"`{RAW}` IS NOT NULL AS rejected")
    out.write.mode("overwrite").partitionBy("rejected").parquet(target)
    back = spark.read.schema(out.schema).parquet(target)
    measures = [F.count(F.lit(1)).alias("rows"), F.count_if("rejected").alias("malformed")]
    found = back.agg(*measures, *[F.count_if(F.array_contains("failed", c)).alias(f"failed_{i}") for i, c in enumerate(typed)]).first()
    return Audited(
        back.where("NOT rejected").selectExpr(*wanted), back.where("rejected").select("line", "failed"),
        found["rows"], found["malformed"], {c: found[f"failed_{i}"] for i, c in enumerate(typed)},
    )
