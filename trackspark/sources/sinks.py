"""Sinks: sample tables and state documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackspark.config import CLEAN_SCHEMA, MATCH, RAW_SCHEMA, MatchConfig


def write_raw_csv(raw: DataFrame, path: str) -> None:
    raw.select(*RAW_SCHEMA.names).write.mode("overwrite").option("header", False).csv(path)


def match_key(df: DataFrame) -> list[str]:
    """``match_id`` where the rows have one."""
    return [c for c in df.columns if c == "match_id"]


def write_clean_csv(clean: DataFrame, path: str) -> None:
    """CSV with a header; rows with a ``match_id`` go to one folder per match."""
    match = match_key(clean)
    clean.select(*CLEAN_SCHEMA.names, *match).write.mode("overwrite").option(
        "header", True).partitionBy(*match).csv(path)


def write_chunks(chunked: DataFrame, path: str) -> None:
    """Parquet by ``chunkId``, below ``match_id`` if there is one: the plain layout of folders.

    Tasks are cut and joined by the advisory partition size, so a chunk with most of the rows spans
    several files. ``chunks.write_indexed_chunks`` is the layout for long matches.
    """
    folders = [*match_key(chunked), "chunkId"]
    chunked.hint("rebalance", *[F.col(c) for c in folders]).write.mode("overwrite").partitionBy(
        *folders).parquet(path)


def positions_documents(latest: DataFrame, grids: DataFrame | None = None,
                        batch_id: int = 0, cfg: MatchConfig = MATCH) -> DataFrame:
    """One state document per match; a document holds one entry per sensor."""
    entry = F.struct("sid", "ts", "x", "y", "z", "half", "matchSecond", "speed_kmh")
    docs = latest.groupBy("match_id").agg(
        F.max("matchSecond").alias("currentMatchSecond"),
        F.array_sort(F.collect_list(entry)).alias("positions"))
    if grids is not None:
        heat = grids.groupBy("match_id").agg(F.map_from_entries(F.collect_list(
            F.struct(F.col("sid").cast("string"), "grid"))).alias("heatmap_by_sid"))
        docs = docs.join(heat, "match_id", "left")
    field = F.struct(F.lit(cfg.x_min).alias("xMin"), F.lit(cfg.x_max).alias("xMax"),
                     F.lit(cfg.y_min).alias("yMin"), F.lit(cfg.y_max).alias("yMax"))
    return docs.withColumns({
        "batchId": F.lit(batch_id).cast("bigint"),
        "generatedAtUnix": F.unix_micros(F.current_timestamp()) / 1e6, "field": field})


def stats_documents(stats: DataFrame, batch_id: int = 0) -> DataFrame:
    """One document per match: sensor -> zone -> distance and time."""
    zone = F.struct("intensity", F.struct("distance_1m", "time_1m"))
    sensors = stats.groupBy("match_id", "sid").agg(
        F.map_from_entries(F.collect_list(zone)).alias("zones"))
    return sensors.groupBy("match_id").agg(F.map_from_entries(F.collect_list(
        F.struct(F.col("sid").cast("string"), "zones"))).alias("stats")).withColumn(
        "batchId", F.lit(batch_id).cast("bigint"))


def write_documents(docs: DataFrame, path: str) -> None:
    docs.write.mode("overwrite").option("ignoreNullFields", False).json(path)
