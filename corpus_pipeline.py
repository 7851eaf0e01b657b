"""The training-data pipeline: documents to shards, each stage written and read again.

A stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns
of documents; the last one adds where each row goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wordloom.llm import contamination, language, mixing, near, sharding
from wordloom.llm.common import load, remainder, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in no language: null texts and texts without a letter."""
    told = language.predict(docs, language.train(docs, remainder("doc_id", 4) != 2))
    return told.where(told.lang_pred != language.NONE).select(*(f"`{c}`" for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each class."""
    return near.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a test item."""
    return contamination.decontaminated(docs, load(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it."""
    return mixing.mix(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with shard and slot."""
    return sharding.shard(docs)


STAGES = [
    ("language", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

# Learnt scores, sampled similarity and hashes of the engine's own have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
