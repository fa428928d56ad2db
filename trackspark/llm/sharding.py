"""Rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Parts of a shard whose rows are numbered apart.
PARTS = 4096
#: Equal rows that are numbered at once; more of them are dealt over the parts of their shard.
PIECE = 1 << 14


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the smallest -ln(u) / weight, u being uniform in key and shard.

    A shard's value does not depend on the others, so one more shard takes rows only into
    itself, and each gets rows in proportion to its weight.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("shards need weights over zero")
    return place_of_least(shard_costs(key, weights))


def shard_costs(key: Column, weights: Sequence[float]) -> Column:
    """-ln(u) / weight of each shard as an array."""
    costs = []
    for shard, weight in enumerate(weights):
        h = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11)
        costs.append(-F.log((h + 0.5) / F.lit(float(1 << 53))) / F.lit(float(weight)))
    return F.array(*costs)


def place_of_least(costs: Column) -> Column:
    return (F.array_position(costs, F.array_min(costs)) - 1).cast("int")


def shard(docs: DataFrame, shards: int = 16, weights: Sequence[float] | None = None,
          doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of ``docs``.

    Law ``key``: id and shard count decide. size is the text's bytes plus one (null: none plus
    one). slot numbers the rows of a shard from 0 without a gap, in a fixed order of hash part,
    id, size and checksum. grown_shard is the shard with one more of weight 1. Equal rows are
    counted before they are shuffled; pieces of at most PIECE of them go to parts of their own and are
    dealt out again there, so a row that repeats without bound is no task of its own.
    A null id is a key like any other; equal texts of different ids go where their ids go.
    """
    weights = list(weights or [1.0] * shards)
    data = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"),
                       (F.octet_length(data) + F.lit(1)).cast("long").alias("size"),
                       F.crc32(data.cast("binary")).alias("text_crc32"))
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1,
                                                      F.lit(PIECE).cast("long"))))
    rows = rows.withColumn("n", F.least(F.col("n") - F.col("at"), F.lit(PIECE)))
    key = F.col("doc_id").cast("string")
    rows = rows.withColumn("costs", shard_costs(key, [*weights, 1.0]))
    rows = rows.select("doc_id", "size", "text_crc32", "at", "n",
                       place_of_least(F.slice("costs", 1, len(weights))).alias("shard"),
                       place_of_least(F.col("costs")).alias("grown_shard"),
                       F.pmod(F.xxhash64(key, "text_crc32", "at"), F.lit(PARTS)).alias("part"))
    parts = rows.groupBy("shard", "part").agg(F.sum("n").alias("rows"))
    before = W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("shard", "part", F.coalesce(F.sum("rows").over(before),
                                                     F.lit(0)).alias("base"))
    inside = (W.partitionBy("shard", "part").orderBy("doc_id", "size", "text_crc32", "at")
              .rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("ahead", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    rows = rows.join(parts, ["shard", "part"])
    first = F.col("base") + F.col("ahead")
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.explode(F.sequence(first, first + F.col("n") - 1)).alias("slot"), "grown_shard")
