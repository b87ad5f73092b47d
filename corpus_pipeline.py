"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one
before it kept; the first four return the columns of documents. What a stage
returns is written as Parquet in the shared checkpoint folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from blotter.llm import exact_dedup, near_dedup, packing, repetition, secrets
from blotter.llm.common import documents, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the repetition rules go."""
    return repetition.drop_rejected(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8), the smallest doc_id stays."""
    return near_dedup.drop_near_copies(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Owner-specific live secrets are replaced in the text; n_chars follows."""
    return secrets.redact_live(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences."""
    return packing.pack(docs)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("secrets", redact), ("packing", pack)]

#: SQL expresses neither suffix arrays nor packing; tests/llm hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
