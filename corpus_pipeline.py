"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Rejected, repeated and contaminated documents go; the mix repeats or drops documents to meet the
sources' targets; the last stage gives every remaining row its shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontam, jaccard, mixing, quality, sharding
from millrace.llm.common import documents, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what passes the word rules and the compression bands."""
    return quality.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near copies (five-word Jaccard of 0.8 or more)."""
    return jaccard.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item within its error budget."""
    return decontam.clean_documents(docs, documents(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; none that it does not take."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row, copies included."""
    return sharding.sharded(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

#: Compression, XXH64 fingerprints and edit distances over windows are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
