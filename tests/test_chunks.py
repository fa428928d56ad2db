"""Indexed chunks, and the feed whose offset is the chunk."""

import os
import time

import pytest
from pyspark.sql import functions as F

from trackspark.config import MATCH_CHUNKED_SCHEMA
from trackspark.operators import clean
from trackspark.plans import fixtures
from trackspark.sources import chunks
from trackspark.sources.feed import ChunkFeedReader
from trackspark.streaming import pipeline

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def chunked(spark):
    one = clean.with_chunk_id(fixtures.clean(spark, SF_DIR)).drop("event_id", "user_id", "event_type")
    two = one.where("chunkId between 100 and 900").withColumn("match_id", F.lit(2))
    return one.unionByName(two).cache()


@pytest.fixture(scope="module")
def written(spark, chunked, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("chunks") / "k")
    chunks.write_indexed_chunks(chunked.repartition(5), path)
    return path


def test_index_counts_each_row_once(spark, chunked, written):
    want = {tuple(r) for r in chunked.groupBy("match_id", "chunkId").count().collect()}
    assert {tuple(r) for r in chunks.indexed_row_counts(spark, written).collect()} == want
    index = chunks.chunk_index(spark, written).collect()
    assert all(r["bytes"] == os.path.getsize(f"{written}/{r['file']}") for r in index)


@pytest.mark.parametrize("first, last, match", [(None, None, None), (130, 185, None), (0, 59, 2),
                                                (59, 60, 1), (10_000, None, None), (500, None, 2)])
def test_range_opens_only_its_files(spark, chunked, written, first, last, match):
    got = chunks.read_indexed_chunks(spark, written, first, last, match)
    want = chunked.where(F.col("chunkId").between(first or 0, last if last is not None else 1 << 30)
                         & ((F.col("match_id") == match) if match else F.lit(True)))
    keys = ["match_id", "chunkId", "sid", "ts"]
    assert sorted(got.select(*keys).collect()) == sorted(want.select(*keys).collect())
    held = {f"span={(c // 60)}/" for c in range(first or 0, min(last or 4000, 4000) + 1)}
    assert all(any(s in f for s in held) for f in got.inputFiles())


def test_hot_chunk_spans_files_and_sparse_ones_share_one(spark, chunked, tmp_path):
    hot = chunked.where("match_id = 1").repartition(8).withColumn(
        "chunkId", F.least("chunkId", F.lit(7)))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        chunks.write_indexed_chunks(hot, str(tmp_path / "h"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert chunks.chunk_index(spark, str(tmp_path / "h")).where("chunkId = 7").count() > 1
    few = chunked.where("chunkId < 60 and match_id = 1")
    chunks.write_indexed_chunks(few, str(tmp_path / "f"))
    assert chunks.chunk_index(spark, str(tmp_path / "f")).select("file").distinct().count() == 1


def feed(spark, path, out, step, last=None):
    stream = chunks.read_chunk_feed(spark, path, step, f"{out}/position", last)
    timed = stream.withColumn("event_time", F.timestamp_seconds("matchSecond"))
    counted = timed.withWatermark("event_time", "5 seconds").groupBy(
        "match_id", F.window("event_time", "1 minute")).count()
    query = (counted.writeStream.format("noop").outputMode("update")
             .option("checkpointLocation", f"{out}/check").start())
    return pipeline.drain(query)


def seen(query):
    rows = sum(p["numInputRows"] for p in query.recentProgress)
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress
                  for s in p["stateOperators"])
    return rows, dropped


def test_feed_is_in_chunk_order_whatever_the_file_times(spark, chunked, written, tmp_path):
    """File times run against the order of play; nothing is lost, also over a stop."""
    now = time.time()
    for r in chunks.chunk_index(spark, written).select("file", "chunkId").distinct().collect():
        os.utime(f"{written}/{r['file']}", (now, now - r["chunkId"]))
    first = feed(spark, written, tmp_path, 300, last=1000)
    again = feed(spark, written, tmp_path, 300)
    (a, lost_a), (b, lost_b) = seen(first), seen(again)
    assert lost_a == lost_b == 0 and a == chunked.where("chunkId <= 1000").count()
    assert a + b == chunked.count()
    with_rows = [p for p in again.recentProgress if p["numInputRows"]]
    assert len(with_rows) > 5


def test_feed_takes_chunks_that_are_added(spark, chunked, tmp_path):
    path, out = str(tmp_path / "k"), str(tmp_path / "out")
    chunks.write_indexed_chunks(chunked.where("chunkId < 120"), path)
    a, _ = seen(feed(spark, path, out, 1000))
    chunks.write_indexed_chunks(chunked.where("chunkId between 120 and 400"), path, "append")
    b, lost = seen(feed(spark, path, out, 1000))
    assert (a, b, lost) == (chunked.where("chunkId < 120").count(),
                            chunked.where("chunkId between 120 and 400").count(), 0)
    assert seen(feed(spark, path, out, 1000)) == (0, 0)


def test_reader_steps_over_gaps_and_splits_a_range_by_file(spark, chunked, tmp_path):
    path = str(tmp_path / "k")
    chunks.write_indexed_chunks(
        chunked.where("match_id = 1 and (chunkId < 50 or chunkId >= 3000)"), path)
    options = {"path": path, "index": chunks.INDEX, "chunks": "100",
               "position": str(tmp_path / "at")}
    reader = ChunkFeedReader(chunked.select("match_id", "chunkId").schema, options)
    at, ends = reader.initialOffset(), []
    while (end := reader.latestOffset()) != at:
        parts = reader.partitions(at, end)
        assert parts and len({p.file for p in parts}) == len(parts)
        ends.append(end["chunk"])
        at = end
    assert ends[0] < 100 and ends[1] // 100 >= 30 and ends == sorted(ends)
    assert reader.partitions(at, at) == []
    resumed = ChunkFeedReader(chunked.select("match_id", "chunkId").schema, options)
    assert resumed.latestOffset() == at


def test_the_feed_hands_on_a_large_file_in_pieces(spark, chunked, tmp_path):
    path = str(tmp_path / "large")
    rows = chunked.where("match_id = 1 and chunkId < 600").crossJoin(spark.range(400)).drop("id")
    rows = rows.withColumn("chunkId", F.col("chunkId") % 60).coalesce(1)
    chunks.write_indexed_chunks(rows, path)
    reader = ChunkFeedReader(MATCH_CHUNKED_SCHEMA, {
        "path": path, "index": chunks.INDEX, "chunks": "100", "position": str(tmp_path / "at")})
    parts = reader.partitions({"chunk": 9}, {"chunk": 40})
    sizes = [b.num_rows for part in parts for b in reader.read(part)]
    assert sum(sizes) == rows.where("chunkId between 10 and 40").count()
    assert len(parts) < len(sizes) and max(sizes) <= 10_000
