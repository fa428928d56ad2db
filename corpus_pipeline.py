"""A training-data pipeline of the operators; each stage works on all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.llm import decontaminate, language, mixing, sharding, simhash
from trackspark.llm.common import crc_part, materialise


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose two best languages cannot be told apart, go."""
    learn_from = crc_part("doc_id", 4) != 2
    return language.accepted(docs, language.learn(docs, learn_from))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: the one with the smallest id, null last.

    Near copies have fingerprints of three-word shingles that differ in at most three bits.
    """
    return simhash.without_near_copies(docs, n=3, bits=3)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go, each told by its id and text."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination_by_key(docs, items)
    bad = found.where("contaminated").select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_text")).distinct()
    same = (F.xxhash64(docs.text) == bad["_text"]) & docs.doc_id.eqNullSafe(bad["_id"])
    return docs.join(bad, same, "left_anti").select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document stays as often as the mix takes it."""
    return mixing.mixed_rows(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and place of each row of the mix."""
    return sharding.shard(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminated),
    ("mix", mixed),
    ("shard", sharded),
]

#: Compression and hashed shingles cannot be told in SQL; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
