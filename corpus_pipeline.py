"""A training corpus from raw documents: language identification, near-duplicate removal, benchmark decontamination, secret
scans and packing. Each stage's result is written as Parquet and reread as the next one's documents.

Stage functions take (spark, docs, sf_dir). All but the last return the columns of their documents; the last
returns the pieces of the packed sequences. What the operators do with NULL, empty and repeated rows holds here too.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leadlens.llm.common import documents, shared_folder
from leadlens.llm.decontamination import without_benchmark
from leadlens.llm.language_id import known_language
from leadlens.llm.minhash import one_of_each
from leadlens.llm.packing import packing
from leadlens.llm.secrets import without_secrets


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those that no learned language codes better than raw bytes."""
    return known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group of near-duplicates."""
    return one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a benchmark item is found."""
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts by their kinds."""
    return without_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the tokens of what is left into sequences."""
    return packing(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("minhash_dedup", near_duplicates),
    ("decontamination", benchmark),
    ("secret_scan", secrets),
    ("packing", pack),
]

#: Model scores and tokenizers can't be stated in SQL; tests compare the pipeline with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to a new folder of the shared one."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
