"""Streaming queries. State lives in the state store or in written tables, never on the driver.

Every sink is a batch log (see ``sources.batchlog``): updates are written per batch and the newest
version of a key wins on read. Checkpoints are kept, so a stopped query resumes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trackspark.config import MATCH, MatchConfig
from trackspark.operators.heatmap import heatmap_cells
from trackspark.operators.running import running_stats, zone_samples
from trackspark.operators.snapshot import latest_positions
from trackspark.sources.batchlog import EVERY, batch_log


def start_log(stream: DataFrame, path: str, checkpoint: str, mode: str = "update",
              trigger: str | None = None, name: str | None = None,
              shape: Callable[[DataFrame], DataFrame] | None = None,
              keys: Sequence[str] | None = None, every: int = EVERY) -> StreamingQuery:
    """Write a stream to a batch log; without a trigger it drains what is there and stops.

    With ``keys`` the log is compacted every so many batches.
    """
    writer = stream.writeStream.foreachBatch(batch_log(path, shape, keys, every)).outputMode(
        mode).option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(
        availableNow=True)
    return writer.start()


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait until the source has nothing more, then stop; errors of the query are raised."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def latest_stream(valid: DataFrame, tie: tuple[str, ...] = ()) -> DataFrame:
    """Newest sample per sensor; late rows never replace newer ones."""
    return latest_positions(valid, tie)


def running_stats_stream(valid: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    return running_stats(valid, cfg)


def second_stats_stream(valid: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    """Per-second sums in update mode; trailing 60 s sums are windows over this small log.

    Compared with a sliding window of one second steps this keeps one state row per second
    instead of writing every sample into 60 windows.
    """
    samples = zone_samples(valid, cfg).withWatermark("event_time", cfg.watermark)
    grouped = samples.groupBy(
        "match_id", "sid", "intensity", F.window("event_time", "1 second"))
    return grouped.agg(
        F.coalesce(F.sum("metres"), F.lit(0.0)).alias("metres"), F.count("sid").alias("pings"),
    ).select("match_id", "sid", "intensity",
             F.unix_seconds(F.col("window.start")).cast("int").alias("second"),
             "metres", "pings")


def sliding_stats_stream(valid: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    """Chained form in append mode: one-second sums, then a sliding 60 s window."""
    samples = zone_samples(valid, cfg).withWatermark("event_time", cfg.watermark)
    seconds = samples.groupBy(
        "match_id", "sid", "intensity", F.window("event_time", "1 second")).agg(
        F.coalesce(F.sum("metres"), F.lit(0.0)).alias("metres"), F.count("sid").alias("pings"))
    sliding = F.window(F.window_time("window"), "60 seconds", "1 second")
    return seconds.groupBy("match_id", "sid", "intensity", sliding).agg(
        F.sum("metres").alias("distance"),
        (F.sum("pings") * F.lit(cfg.player_sample_s)).alias("time_s"),
    ).select("match_id", "sid", "intensity",
             (F.unix_seconds(F.col("window.end")) - 1).cast("int").alias("second"),
             "distance", "time_s")


def heatmap_stream(valid_players: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    """Cell counts in the state store; smoothing is applied when the log is read."""
    return heatmap_cells(valid_players, cfg)


def due_events_batch(events: DataFrame, clock_path: str, out_path: str
                     ) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` step that writes events reached since the batch before.

    The clock table of a batch has one row per match: the second reached so far. It is read
    back by the next batch, so the step survives a restart and a retried batch gives the same.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark: SparkSession = batch.sparkSession
        now = batch.groupBy("match_id").agg(F.max("matchSecond").alias("now_s"))
        if batch_id > 0:
            before = spark.read.parquet(f"{clock_path}/batch_id={batch_id - 1}").select(
                "match_id", F.col("now_s").alias("before_s"))
            moved = now.join(before, "match_id", "full").select(
                "match_id", "before_s", F.greatest("now_s", "before_s").alias("now_s"))
        else:
            moved = now.withColumn("before_s", F.lit(None).cast("double"))
        moved.write.mode("overwrite").parquet(f"{clock_path}/batch_id={batch_id}")
        reached = spark.read.parquet(f"{clock_path}/batch_id={batch_id}")
        due = events.join(reached, "match_id").where(
            (F.col("second") <= F.col("now_s"))
            & (F.col("before_s").isNull() | (F.col("second") > F.col("before_s"))))
        due.select("match_id", F.col("now_s").alias("t"), *[
            c for c in events.columns if c != "match_id"]
        ).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    return step


def run_together(spark: SparkSession, queries: list[StreamingQuery],
                 timeout_s: float | None = None) -> None:
    """Run until one query ends, stop the others, raise the error of a failed one."""
    try:
        while all(q.isActive for q in queries):
            if timeout_s is None:
                spark.streams.awaitAnyTermination()
            else:
                if not spark.streams.awaitAnyTermination(timeout_s):
                    break
            spark.streams.resetTerminated()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
    for q in queries:
        error = q.exception()
        if error is not None:
            raise RuntimeError(f"stream {q.name or q.id} failed: {error}")
