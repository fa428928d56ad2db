"""Raw samples onto the match clock, units, chunks and valid positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackspark.config import MATCH, MatchConfig
from trackspark.functions.zones import is_ball
from trackspark.operators.sizes import small_side

#: Seconds of a match clock's slice.
SLICE_S = 60


def _with_units(df: DataFrame) -> DataFrame:
    metres_per_second = F.col("v_abs") * F.lit(1e-6)
    return df.withColumns({
        "x_m": F.col("x") / F.lit(1000.0),
        "y_m": F.col("y") / F.lit(1000.0),
        "z_m": F.col("z") / F.lit(1000.0),
        "speed_m_s": metres_per_second,
        "speed_kmh": metres_per_second * F.lit(3.6),
        "acceleration_m_s2": F.col("a_abs") * F.lit(1e-6),
    })


def clean_samples(raw: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    """Samples inside either half, with half, continuous match second and metric units.

    Filter and projection only, so the clock range reaches the scan as a pushed predicate.
    """
    first = F.col("ts").between(cfg.first_half_start_ts, cfg.first_half_end_ts)
    second = F.col("ts").between(cfg.second_half_start_ts, cfg.second_half_end_ts)
    per_second = F.lit(cfg.ts_per_second)
    in_first = (F.col("ts") - F.lit(cfg.first_half_start_ts)) / per_second
    in_second = F.lit(cfg.second_half_offset_s) + (
        (F.col("ts") - F.lit(cfg.second_half_start_ts)) / per_second)
    kept = raw.where(first | second)
    return _with_units(kept.withColumns({
        "half": F.when(first, F.lit(1)).otherwise(F.lit(2)),
        "matchSecond": F.when(first, in_first).otherwise(in_second),
    }))


def clean_matches(raw: DataFrame, clock: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    """As ``clean_samples`` for many matches, each with its own clock.

    ``clock`` has (match_id, half, start_ts, end_ts, offset_s). Clocks are cut into slices of time
    and joined by match and slice: where the clock table is too large to be sent to all tasks, a
    match with a large part of all rows is dealt over as many keys as it has slices.
    """
    width = SLICE_S * cfg.ts_per_second

    def slice_of(ts: str) -> Column:
        return F.floor(F.col(ts) / F.lit(width))

    sliced = clock.withColumnRenamed("match_id", "c_match_id").withColumn(
        "c_slice", F.explode(F.sequence(slice_of("start_ts"), slice_of("end_ts"))))
    joined = raw.join(
        small_side(sliced),
        (F.col("match_id") == F.col("c_match_id")) & (slice_of("ts") == F.col("c_slice"))
        & F.col("ts").between(F.col("start_ts"), F.col("end_ts")),
    )
    second = F.col("offset_s") + (F.col("ts") - F.col("start_ts")) / F.lit(cfg.ts_per_second)
    return _with_units(joined.withColumn("matchSecond", second)).drop(
        "c_match_id", "c_slice", "start_ts", "end_ts", "offset_s")


def with_chunk_id(clean: DataFrame, seconds: int = MATCH.chunk_seconds) -> DataFrame:
    if seconds <= 0:
        raise ValueError("chunk length must be greater than 0")
    return clean.withColumn("chunkId", F.floor(F.col("matchSecond") / F.lit(seconds)).cast("int"))


def in_field(cfg: MatchConfig = MATCH) -> Column:
    return F.col("x").between(cfg.x_min, cfg.x_max) & F.col("y").between(cfg.y_min, cfg.y_max)


def valid_positions(clean: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    """Rows with a sensor, a time and a position inside the field (borders included)."""
    return clean.where(F.col("sid").isNotNull() & F.col("ts").isNotNull() & in_field(cfg))


def without_balls(positions: DataFrame) -> DataFrame:
    return positions.where(~is_ball(F.col("sid")))


def position_columns(positions: DataFrame, keep: tuple[str, ...] = ("match_id",)) -> DataFrame:
    """The columns later operators need; a missing speed counts as standing still."""
    return positions.select(
        *keep,
        F.col("sid").cast("int").alias("sid"),
        F.col("ts").cast("bigint").alias("ts"),
        F.col("x").cast("double").alias("x"),
        F.col("y").cast("double").alias("y"),
        F.col("z").cast("double").alias("z"),
        F.col("half").cast("int").alias("half"),
        F.col("matchSecond").cast("double").alias("matchSecond"),
        F.coalesce(F.col("speed_kmh"), F.lit(0.0)).alias("speed_kmh"),
    )


def chunk_row_counts(chunked: DataFrame) -> DataFrame:
    return chunked.groupBy("match_id", "chunkId").agg(F.count("*").alias("n_rows"))
