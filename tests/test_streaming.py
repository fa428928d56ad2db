"""Streaming forms against their batch twins, with several batches, late rows and restarts."""

import random

import pytest
from pyspark.sql import functions as F

from trackspark.config import CLEAN_SCHEMA, POSITION_SCHEMA
from trackspark.operators import clean, heatmap, running, snapshot
from trackspark.sources import batchlog, readers, sinks
from trackspark.streaming import live, pipeline

SCHEMA = "match_id int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}"
                                      for f in POSITION_SCHEMA.fields)


def batch(spark, seed, low, high, n=80):
    rng = random.Random(seed)
    data = []
    for _ in range(n):
        second = rng.uniform(low, high)
        data.append((rng.choice([1, 2]), rng.choice([13, 14, 47, 4]), int(second * 1e12),
                     float(rng.randrange(-60000, 60000)), 0.0, 0.0, 1, second,
                     rng.choice([0.5, 12.0, 30.0])))
    return spark.createDataFrame(data, SCHEMA)


class Feed:
    """Adds one file at a time and drains the query after each, keeping its checkpoint."""

    def __init__(self, spark, tmp_path, build, mode="update", schema=SCHEMA):
        self.spark, self.build, self.mode, self.schema = spark, build, mode, schema
        self.source, self.log, self.check = (str(tmp_path / n) for n in ("in", "log", "check"))

    def add(self, df):
        df.coalesce(1).write.mode("append").parquet(self.source)
        stream = readers.read_position_stream(self.spark, self.source, schema=self.schema)
        query = pipeline.start_log(self.build(stream), self.log, self.check, self.mode)
        query.awaitTermination()
        return query


def rows(df, *cols):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                  for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def batches(spark):
    parts = [batch(spark, i, i * 50, i * 50 + 60) for i in range(3)]
    return parts, parts[0].unionByName(parts[1]).unionByName(parts[2])


def test_running_stats(spark, tmp_path, batches):
    # the watermark allows nothing older than 5 s, so the twin gets rows in order
    parts = [batch(spark, i, i * 60, i * 60 + 60) for i in range(3)]
    feed = Feed(spark, tmp_path, pipeline.running_stats_stream)
    for part in parts:
        feed.add(part)
    keys = ["match_id", "sid", "intensity", "window_start_s"]
    got = batchlog.read_batch_log(spark, feed.log, keys)
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    cols = (*keys, "distance_1m", "ping_count", "time_1m")
    assert rows(got, *cols) == rows(running.running_stats(whole), *cols)


def test_late_rows_of_closed_windows_are_dropped(spark, tmp_path):
    feed = Feed(spark, tmp_path, pipeline.running_stats_stream)
    feed.add(batch(spark, 1, 0, 59))
    feed.add(batch(spark, 2, 300, 310))
    before = feed.spark.read.parquet(feed.log).count()
    feed.add(batch(spark, 3, 0, 59))
    assert feed.spark.read.parquet(feed.log).count() == before


def test_latest_never_goes_back(spark, tmp_path, batches):
    parts, whole = batches
    feed = Feed(spark, tmp_path, pipeline.latest_stream)
    for part in (parts[2], parts[0], parts[1]):
        feed.add(part)
    got = batchlog.read_batch_log(spark, feed.log, ["match_id", "sid"])
    cols = ("match_id", "sid", "ts", "x", "matchSecond")
    assert rows(got, *cols) == rows(snapshot.latest_positions(whole), *cols)


def test_heatmap_cells(spark, tmp_path, batches):
    parts, whole = batches
    feed = Feed(spark, tmp_path, pipeline.heatmap_stream)
    for part in parts:
        feed.add(part)
    keys = ["match_id", "sid", "grid_row", "grid_col"]
    got = batchlog.read_batch_log(spark, feed.log, keys)
    assert rows(got, *keys, "n") == rows(heatmap.heatmap_cells(whole), *keys, "n")


def test_rolling_from_second_log(spark, tmp_path):
    parts = [batch(spark, i, i * 60, i * 60 + 60) for i in range(2)]
    feed = Feed(spark, tmp_path, pipeline.second_stats_stream)
    for part in parts:
        feed.add(part)
    keys = ["match_id", "sid", "intensity", "second"]
    got = running.rolling_frames(batchlog.read_batch_log(spark, feed.log, keys))
    want = running.rolling_stats(parts[0].unionByName(parts[1]))
    assert rows(got, *keys, "distance", "time_s") == rows(want, *keys, "distance", "time_s")


def test_sliding_window_stream_agrees_where_it_has_emitted(spark, tmp_path):
    part = batch(spark, 8, 0, 100, 120)
    feed = Feed(spark, tmp_path, pipeline.sliding_stats_stream, "append")
    feed.add(part)
    feed.add(batch(spark, 9, 400, 401, 5))  # moves the watermark past the first part
    keys = ["match_id", "sid", "intensity", "second"]
    got = {r[:4]: r[4:] for r in rows(spark.read.parquet(feed.log), *keys, "distance", "time_s")}
    want = rows(running.rolling_stats(part), *keys, "distance", "time_s")
    assert want and all(got[r[:4]] == pytest.approx(r[4:]) for r in want)


def test_due_events_once_each(spark, tmp_path):
    events = spark.createDataFrame(
        [(1, 5.0, "a"), (1, 30.0, "b"), (1, 75.0, "c"), (1, 500.0, "d"), (2, 10.0, "e")],
        "match_id int, second double, msg string")
    source, clock, due = (str(tmp_path / n) for n in ("in", "clock", "due"))
    step = pipeline.due_events_batch(events, clock, due)
    for low in (0, 40, 80):
        batch(spark, low, low, low + 20).coalesce(1).write.mode("append").parquet(source)
        readers.read_position_stream(spark, source, schema=SCHEMA).writeStream.foreachBatch(
            step).option("checkpointLocation", str(tmp_path / "check")).trigger(
            availableNow=True).start().awaitTermination()
    got = {(r.batch_id, r.msg) for r in spark.read.parquet(due).collect()}
    assert got == {(0, "a"), (0, "e"), (1, "b"), (2, "c")}
    step(batch(spark, 80, 80, 100), 2)  # a retried batch replaces itself
    assert {(r.batch_id, r.msg) for r in spark.read.parquet(due).collect()} == got


def test_failure_of_one_query_stops_the_other(spark, tmp_path):
    source = str(tmp_path / "in")
    batch(spark, 1, 0, 10).write.parquet(source)

    def stream():
        return readers.read_position_stream(spark, source, schema=SCHEMA)

    def broken(df, batch_id):
        raise ValueError("broken sink")

    good = pipeline.start_log(pipeline.latest_stream(stream()), str(tmp_path / "a"),
                              str(tmp_path / "ca"), trigger="1 second", name="good")
    bad = stream().writeStream.foreachBatch(broken).option(
        "checkpointLocation", str(tmp_path / "cb")).trigger(processingTime="1 second").start()
    with pytest.raises(Exception, match="broken sink"):
        pipeline.run_together(spark, [good, bad])
    assert not good.isActive and not bad.isActive


def test_state_documents(spark, tmp_path, batches):
    _, whole = batches
    latest = snapshot.latest_positions(whole)
    grids = heatmap.dense_grid(heatmap.smooth(heatmap.heatmap_cells(whole)))
    path = str(tmp_path / "doc")
    sinks.write_documents(sinks.positions_documents(latest, grids, 7), path)
    with open(f"{path}/zz-broken.json", "w") as out:
        out.write('{"match_id": 1, "positions": [')
    docs = readers.read_positions_state(spark, path).collect()
    assert {d.match_id for d in docs} == {1, 2} and {d.batchId for d in docs} == {7}
    first = docs[0]
    assert first.field.xMin == -68000 and len(first.positions) == 4
    assert first.currentMatchSecond == max(p.matchSecond for p in first.positions)
    assert len(first.heatmap_by_sid["13"]) == 50
    stats = running.latest_stats(running.running_stats(whole))
    sinks.write_documents(sinks.stats_documents(stats), str(tmp_path / "stats"))
    back = readers.read_stats_state(spark, str(tmp_path / "stats")).select(
        "match_id", F.explode("stats").alias("sid", "z")).select(
        "match_id", F.col("sid").cast("int").alias("sid"), F.explode("z").alias("intensity", "v")
    ).select("match_id", "sid", "intensity", "v.*")
    cols = ("match_id", "sid", "intensity", "distance_1m", "time_1m")
    assert rows(back, *cols) == rows(stats, *cols)


def test_live_view_equals_batch(spark, tmp_path):
    parts = [batch(spark, i, i * 60, i * 60 + 60) for i in range(2)]
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(source)
        stream = readers.read_position_stream(spark, source, schema=SCHEMA)
        live.start_live(stream, out, check, trigger=None).awaitTermination()
    whole = parts[0].unionByName(parts[1])
    docs, stats = live.live_documents(spark, out)
    got = docs.select("match_id", "batchId", "currentMatchSecond", F.inline("positions"))
    cols = ("match_id", "sid", "ts", "x", "matchSecond")
    assert rows(got, *cols) == rows(snapshot.latest_positions(whole), *cols)
    assert {r.batchId for r in got.collect()} == {1}
    cells = heatmap.heatmap_cells(clean.without_balls(whole))
    want = heatmap.smooth(cells).agg(F.sum("value")).first()[0]
    heat = docs.select(F.explode("heatmap_by_sid").alias("sid", "grid")).select(
        F.aggregate(F.flatten("grid"), F.lit(0.0), lambda a, v: a + v).alias("s"))
    assert heat.agg(F.sum("s")).first()[0] == pytest.approx(want)
    flat = stats.select("match_id", F.explode("stats").alias("sid", "z")).select(
        "match_id", F.col("sid").cast("int").alias("sid"), F.explode("z").alias("intensity", "v")
    ).select("match_id", "sid", "intensity", "v.*")
    cols = ("match_id", "sid", "intensity", "distance_1m", "time_1m")
    assert rows(flat, *cols) == rows(running.latest_stats(running.running_stats(whole)), *cols)


def test_stream_reads_the_chunk_folders(spark, tmp_path):
    part = batch(spark, 5, 0, 4).drop("match_id")
    path = str(tmp_path / "chunks")
    full = part.select(*[
        (F.col(f.name) if f.name in part.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in CLEAN_SCHEMA.fields])
    sinks.write_chunks(clean.with_chunk_id(full), path)
    stream = readers.read_position_stream(spark, path).withColumn("match_id", F.lit(1))
    feed = pipeline.start_log(pipeline.latest_stream(stream), str(tmp_path / "log"),
                              str(tmp_path / "check"))
    feed.awaitTermination()
    assert len(feed.recentProgress) > 1  # one chunk file per batch
    got = batchlog.read_batch_log(spark, str(tmp_path / "log"), ["match_id", "sid"])
    cols = ("sid", "ts", "matchSecond")
    want = snapshot.latest_positions(part.withColumn("match_id", F.lit(1)))
    assert rows(got, *cols) == rows(want, *cols)


def test_empty_source_folder_starts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = readers.read_position_stream(spark, str(tmp_path / "in"))
    assert stream.columns[-1] == "chunkId" and stream.isStreaming


def test_log_reads_follow_the_keys_not_the_batches(spark, tmp_path):
    path, want = str(tmp_path / "log"), {}
    write = batchlog.batch_log(path, keys=["k"], every=4)
    for n in range(19):
        rows_ = [(k, 100 * n + k) for k in {n % 3, n % 5, 7 if n == 2 else 0}]
        want |= dict(rows_)
        write(spark.createDataFrame(rows_, "k int, v int"), n)
        if n == 9:  # a retried batch replaces itself
            write(spark.createDataFrame(rows_, "k int, v int"), n)
        got = {r.k: r.v for r in batchlog.read_batch_log(spark, path, ["k"]).collect()}
        assert got == want
    assert len(batchlog._numbers(spark, path, "batch_id")) <= 8
    assert batchlog._bases(spark, path) == [11, 15] and batchlog.newest_batch(spark, path) == 18
    torn = tmp_path / "log" / "_base" / "upto=18"  # a base without its marker does not count
    torn.mkdir()
    assert {r.k: r.v for r in batchlog.read_batch_log(spark, path, ["k"]).collect()} == want
    assert {r.k for r in batchlog.read_batch_log(spark, path, ["k"], {"v": 207}).collect()} == {7}
