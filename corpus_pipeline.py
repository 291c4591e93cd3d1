"""The corpus pipeline: language ID, near-dedup, decontamination, mixing to target weights, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's ``docs``.  All stages but the last return the columns of
``docs``; the last returns the shard of every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, language_id, mixing, near_dedup, sharding
from tessera.llm.common import stored
from tessera.sources.tables import table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not recognised go."""
    return language_id.keep_identified(docs, language_id.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays (five-word shingles, similarity 0.8)."""
    return near_dedup.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are dropped, kept or repeated so that domain tokens match the target weights."""
    return mixing.apply_mix(docs, mixing.mix(docs, table(spark, sf_dir, "labels")))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and place of every row."""
    return sharding.shard(docs)


STAGES = [
    ("language_id", language),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("sharding", shards),
]
#: The stages hash words, fit models and build graph components, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
