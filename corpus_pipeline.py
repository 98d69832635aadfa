"""From raw documents to a training mix: quality, near duplicates, benchmarks, secrets, mixing.

Each stage takes the documents that the one before has written and returns documents; the last one
returns their readings in the order of training positions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimwright.llm.decontaminate import uncontaminated
from claimwright.llm.mixing import readings
from claimwright.llm.quality import clean
from claimwright.llm.secrets import redact
from claimwright.llm.simhash import keep_one
from claimwright.session import settle


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that fail a line rule, and documents that the quality rules reject."""
    return clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: three-word shingles, two bits."""
    return keep_one(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes documents of which at least one word in twenty is benchmark text."""
    return uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in the texts; every document stays."""
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The readings of the mix with their texts, sorted by training position."""
    return readings(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("mixing", mixing),
]

# XXH64 fingerprints and the secret test battery are beyond the SQL; tests hold a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = settle(docs, name)
    return docs
