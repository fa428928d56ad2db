"""Chunked samples with an index: files of many chunks, and a table of what each file holds.

Samples lie in folders of a match and ``SPAN`` chunks, sorted by chunk, in files of about the
advisory size. The index has one row per file and chunk, so ranges of chunks are found, counted
and fed to a stream without listing folders or asking for file times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.config import CHUNKED_SCHEMA, MATCH_CHUNKED_SCHEMA
from trackspark.sources.feed import ChunkFeed
from trackspark.sources.sinks import match_key

#: Chunks of a folder.
SPAN = 60
#: The leading underscore keeps it out of reads of the data.
INDEX = "_index"


def write_indexed_chunks(chunked: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write chunks and their index; with ``mode="append"`` add new ones to both.

    Tasks are cut and joined by the advisory partition size, so a hot chunk spans several files
    and sparse ones share one. The index comes from one pass over the chunk column of the new
    files.
    """
    spark = chunked.sparkSession
    folders = [*match_key(chunked), "span"]
    sized = chunked.withColumn("span", F.floor(F.col("chunkId") / SPAN).cast("int")).hint(
        "rebalance", *[F.col(c) for c in folders])
    sized.sortWithinPartitions(*folders, "chunkId", "ts", "sid").write.mode(mode).partitionBy(
        *folders).parquet(path)

    base = r"((?:match_id=[^/]+/)?span=[^/]+/[^/]+)$"
    held = spark.read.schema(CHUNKED_SCHEMA).parquet(path).select(
        *match_key(chunked), "chunkId", F.col("_metadata.file_size").alias("bytes"),
        F.regexp_extract("_metadata.file_path", base, 1).alias("file"))
    if mode == "append":
        known = chunk_index(spark, path).select("file").distinct()
        held = held.join(known, "file", "left_anti")
    held.groupBy(*match_key(chunked), "file", "chunkId").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("bytes").alias("bytes")
    ).coalesce(1 if mode == "append" else 8).write.mode(mode).parquet(f"{path}/{INDEX}")


def chunk_index(spark: SparkSession, path: str) -> DataFrame:
    """(match_id if there is one, file, chunkId, n_rows, bytes of the file)."""
    return spark.read.parquet(f"{path}/{INDEX}")


def indexed_row_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows per match and chunk, from the index alone."""
    index = chunk_index(spark, path)
    return index.groupBy(*match_key(index), "chunkId").agg(F.sum("n_rows").alias("n_rows"))


def read_indexed_chunks(spark: SparkSession, path: str, first: int | None = None,
                        last: int | None = None, match_id: int | None = None) -> DataFrame:
    """Samples of a range of chunks; only the files that hold some of it are opened.

    The driver gets the names of these files, as it does for any read. A range without chunks
    gives no rows.
    """
    index = chunk_index(spark, path)
    schema = MATCH_CHUNKED_SCHEMA if match_key(index) else CHUNKED_SCHEMA
    wanted = F.lit(True)
    for column, low, high in (("chunkId", first, last), ("match_id", match_id, match_id)):
        if low is not None:
            wanted &= F.col(column) >= low
        if high is not None:
            wanted &= F.col(column) <= high
    files = [f"{path}/{r['file']}" for r in
             index.where(wanted).select("file").distinct().collect()]
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*files).where(
        wanted).select(*schema.names)


def read_chunk_feed(spark: SparkSession, path: str, chunks_per_trigger: int, position: str,
                    last: int | None = None) -> DataFrame:
    """Indexed chunks as a stream in chunk order, all matches side by side.

    A trigger takes the chunks up to the next multiple of ``chunks_per_trigger`` that has any.
    ``position`` is a folder of the query's own, next to its checkpoint; ``last`` ends the feed.
    """
    spark.dataSource.register(ChunkFeed)
    reader = spark.readStream.format(ChunkFeed.name()).schema(MATCH_CHUNKED_SCHEMA).options(
        path=path, index=INDEX, chunks=str(chunks_per_trigger), position=position)
    return (reader if last is None else reader.option("last", str(last))).load()
