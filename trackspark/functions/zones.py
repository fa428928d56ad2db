"""Running-intensity zones and per-sample increments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trackspark.config import BALL_SIDS, MATCH, MatchConfig


def is_ball(sid: Column) -> Column:
    return sid.isin(*BALL_SIDS)


def intensity(speed_kmh: Column, cfg: MatchConfig = MATCH) -> Column:
    """Zone label of a speed; cut-offs are strict, missing and NaN speeds are standing."""
    speed = F.nanvl(speed_kmh, F.lit(None).cast("double"))
    return (
        F.when(speed > cfg.sprint_kmh, "Sprint")
        .when(speed > cfg.high_speed_kmh, "High-Speed Run")
        .when(speed > cfg.low_speed_kmh, "Low-Speed Run")
        .when(speed > cfg.trot_kmh, "Trot")
        .otherwise("Standing")
    )


def sample_interval(sid: Column, cfg: MatchConfig = MATCH) -> Column:
    """Seconds one sample of a sensor stands for."""
    return F.when(is_ball(sid), F.lit(cfg.ball_sample_s)).otherwise(F.lit(cfg.player_sample_s))


def distance_increment(speed_kmh: Column, seconds: float) -> Column:
    """Metres covered during one sample."""
    return (F.nanvl(speed_kmh, F.lit(None).cast("double")) / F.lit(3.6)) * F.lit(seconds)


def event_time(match_second: Column) -> Column:
    """Match time as a timestamp counted from 1970-01-01."""
    return F.timestamp_seconds(match_second)
