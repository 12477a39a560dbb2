"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leadlens.llm.chat import CHAT_SQL, chat_format
from leadlens.llm.common import documents
from leadlens.llm.decontamination import decontamination
from leadlens.llm.language_id import language_id
from leadlens.llm.minhash import MINHASH_SQL, near_duplicates
from leadlens.llm.mixing import MIXING_SQL, mixing
from leadlens.llm.packing import packing
from leadlens.llm.phrases import PHRASES_SQL, collocations
from leadlens.llm.quality_classifier import quality_classifier
from leadlens.llm.quality_rules import QUALITY_SQL, quality_rules
from leadlens.llm.secrets import SECRETS_SQL, secrets
from leadlens.llm.sharding import sharding
from leadlens.llm.spelling import SPELLING_SQL, spelling
from leadlens.llm.warc import WARC_SQL, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": lambda spark, d: language_id(documents(spark, d)),
    "op2_decontamination": lambda spark, d: decontamination(documents(spark, d), spark.read.parquet(f"{d}/benchmark.parquet")),
    "op3_warc": lambda spark, d: warc(spark.read.parquet(f"{d}/pages.parquet")),
    "op4_chat_format": lambda spark, d: chat_format(spark.read.parquet(f"{d}/conversations.parquet")),
    "op5_sharding": lambda spark, d: sharding(documents(spark, d)),
    "op6_minhash": lambda spark, d: near_duplicates(documents(spark, d)),
    "op7_secrets": lambda spark, d: secrets(documents(spark, d)),
    "op8_quality_rules": lambda spark, d: quality_rules(documents(spark, d)),
    "op9_quality_classifier": lambda spark, d: quality_classifier(documents(spark, d), spark.read.parquet(f"{d}/labels.parquet")),
    "op10_packing": lambda spark, d: packing(documents(spark, d)),
    "op11_phrases": lambda spark, d: collocations(documents(spark, d)),
    "op12_spelling": lambda spark, d: spelling(documents(spark, d)),
    "op13_mixing": lambda spark, d: mixing(documents(spark, d)),
}

ORACLE: dict[str, str] = {
    "op3_warc": WARC_SQL,
    "op4_chat_format": CHAT_SQL,
    "op6_minhash": MINHASH_SQL,
    "op7_secrets": SECRETS_SQL,
    "op8_quality_rules": QUALITY_SQL,
    "op11_phrases": PHRASES_SQL,
    "op12_spelling": SPELLING_SQL,
    "op13_mixing": MIXING_SQL,
}
