"""The corpus pipeline: language ID, near-duplicates, decontamination, mixing and sharding of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import decontaminate, external_shuffle, language, mixing, simhash
from clickloom.llm.common import settle, table
from clickloom.llm.queries import SHARDS, held_out


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; fitted on the labelled rows that are not held out."""
    return language.keep_identified(docs, docs.filter(~held_out(docs)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least doc_id."""
    return simhash.keep_first(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes their words."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in shuffled shards: the columns of documents with size, shard and slot."""
    sized = docs.withColumn("size", external_shuffle.text_bytes(docs["text"]))
    return external_shuffle.external_shuffle(sized, "size", SHARDS)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# Fingerprints, the classifier and the seeded orders have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
