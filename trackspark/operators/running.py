"""Running statistics per sensor and zone, and their player and team sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackspark.config import MATCH, TEAMS, MatchConfig
from trackspark.functions.numbers import round_half_even
from trackspark.functions.zones import (
    distance_increment,
    event_time,
    intensity,
    sample_interval,
)
from trackspark.operators.clean import without_balls


def zone_samples(valid: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    """Non-ball samples with zone, event time and metres covered."""
    return without_balls(valid).select(
        "match_id", "sid", "matchSecond",
        event_time(F.col("matchSecond")).alias("event_time"),
        intensity(F.col("speed_kmh"), cfg).alias("intensity"),
        distance_increment(F.col("speed_kmh"), cfg.player_sample_s).alias("metres"),
    )


def intensity_zone_counts(valid: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    return zone_samples(valid, cfg).groupBy("match_id", "sid", "intensity").agg(
        F.count("*").alias("n_samples"))


def running_stats(valid: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    """Distance and time per sensor, zone and tumbling window; batch or stream alike.

    Sums are combined on the map side, so a match shuffles at most
    sensors x zones x windows rows however many samples it has.
    """
    samples = zone_samples(valid, cfg)
    if samples.isStreaming:
        samples = samples.withWatermark("event_time", cfg.watermark)
    return (
        samples.groupBy("match_id", "sid", "intensity", F.window("event_time", cfg.stats_window))
        .agg(F.coalesce(F.sum("metres"), F.lit(0.0)).alias("distance_1m"),
             F.count("sid").alias("ping_count"))
        .select("match_id", "sid", "intensity",
                F.unix_seconds(F.col("window.start")).alias("window_start_s"),
                "distance_1m", "ping_count",
                (F.col("ping_count") * sample_interval(F.col("sid"), cfg)).alias("time_1m"))
    )


def latest_stats(stats: DataFrame) -> DataFrame:
    """Newest window of every (sensor, zone); a zone keeps its value until it recurs."""
    newest = F.max_by(F.struct("distance_1m", "time_1m", "window_start_s"),
                      F.col("window_start_s"))
    return stats.groupBy("match_id", "sid", "intensity").agg(newest.alias("s")).select(
        "match_id", "sid", "intensity", "s.*")


def second_stats(valid: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    """Distance and sample count per sensor, zone and whole match second."""
    return (
        zone_samples(valid, cfg)
        .groupBy("match_id", "sid", "intensity",
                 F.floor("matchSecond").cast("int").alias("second"))
        .agg(F.coalesce(F.sum("metres"), F.lit(0.0)).alias("metres"),
             F.count("sid").alias("pings"))
    )


def rolling_frames(seconds: DataFrame, cfg: MatchConfig = MATCH, span: int = 60) -> DataFrame:
    """Trailing sums at each second that has data, from per-second sums.

    A window key holds at most one row per match second.
    """
    w = Window.partitionBy("match_id", "sid", "intensity").orderBy("second").rangeBetween(
        -(span - 1), 0)
    return seconds.select(
        "match_id", "sid", "intensity", "second",
        F.sum("metres").over(w).alias("distance"),
        (F.sum("pings").over(w) * sample_interval(F.col("sid"), cfg)).alias("time_s"))


def rolling_stats(valid: DataFrame, cfg: MatchConfig = MATCH, span: int = 60) -> DataFrame:
    """True sliding statistics over the last ``span`` seconds."""
    return rolling_frames(second_stats(valid, cfg), cfg, span)


def player_rolling_stats(entities: DataFrame, stats: DataFrame, cfg: MatchConfig = MATCH,
                         sensor_agg: str = "sum") -> DataFrame:
    """Rolling totals per visible player from the stats of the sensors in use.

    ``sensor_agg='sum'`` adds both feet; ``'avg'`` gives the path of one body.
    """
    if sensor_agg not in ("sum", "avg"):
        raise ValueError("sensor_agg must be 'sum' or 'avg'")
    sensors = entities.where(F.col("type") == "player").select(
        "match_id", "entity", "team", "role", "roster_order", "speed_kmh",
        F.size("sids").alias("n_sids"), F.explode("sids").alias("sid"))
    joined = sensors.join(stats, ["match_id", "sid"], "left")
    share = F.lit(1.0) if sensor_agg == "sum" else F.lit(1.0) / F.col("n_sids")

    def total(value: str, zone: str | None = None) -> Column:
        v = F.col(value) * share
        v = v if zone is None else F.when(F.col("intensity") == zone, v)
        return F.coalesce(F.sum(v), F.lit(0.0))

    return (
        joined.groupBy("match_id", "entity", "team", "role", "roster_order", "speed_kmh")
        .agg(total("distance_1m").alias("distance"),
             total("distance_1m", "Sprint").alias("sprint_distance"),
             total("distance_1m", "High-Speed Run").alias("high_speed_distance"),
             total("time_1m").alias("active_time"))
        .select("match_id", F.col("entity").alias("player"), "team", "role", "roster_order",
                "speed_kmh", intensity(F.col("speed_kmh"), cfg).alias("intensity"),
                "distance", "sprint_distance", "high_speed_distance", "active_time")
    )


def rounded_player_stats(rows: DataFrame) -> DataFrame:
    """Two digits, as shown in the statistics table."""
    numbers = ("speed_kmh", "distance", "sprint_distance", "high_speed_distance", "active_time")
    return rows.withColumns({c: round_half_even(F.col(c), 2) for c in numbers})


def team_rolling_stats(player_rows: DataFrame) -> DataFrame:
    """Totals of both teams; a team without visible players shows zeros."""
    names = ("distance", "sprint_distance", "high_speed_distance", "active_time")
    sums = [F.coalesce(F.sum(F.when(F.col("team") == t, F.col(n))), F.lit(0.0)).alias(f"{n}_{i}")
            for i, t in enumerate(TEAMS) for n in names]
    wide = player_rows.groupBy("match_id").agg(*sums)
    teams = F.array(*[F.struct(F.lit(t).alias("team"),
                               *[F.col(f"{n}_{i}").alias(n) for n in names])
                      for i, t in enumerate(TEAMS)])
    return wide.select("match_id", F.inline(teams))
