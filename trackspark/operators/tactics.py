"""Per-tick tactics: active ball, nearest player, possession, pressure, shape, momentum.

Everything here works on fused entities that are laid out by (match_id, tick). One window and
one aggregation over that layout give a wide row per tick, so no operator joins a tick with
itself. A tick holds at most one row per entity.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackspark.config import (
    BALL_SIDS_BY_HALF,
    MATCH,
    NEUTRAL,
    TEAM_A,
    TEAM_B,
    MatchConfig,
)
from trackspark.functions.numbers import distance_m, distance_mm, normalise, round_half_even
from trackspark.functions.text import clock_text
from trackspark.functions.zones import intensity

SIDES = (("a", TEAM_A), ("b", TEAM_B))


def _ball_structs() -> dict[str, Column]:
    """Best ball under each rule, as window or group aggregates over the rows of a tick."""
    ball = F.col("type") == "ball"
    sid = F.get("sids", F.lit(0))
    by_time_speed = F.struct("ts", "speed_kmh", (-sid).alias("neg_sid"), "x", "y", "entity")
    by_time = F.struct("ts", (-sid).alias("neg_sid"), "x", "y", "speed_kmh", "entity")
    best = {"any": F.max(F.when(ball, by_time_speed)), "latest": F.max(F.when(ball, by_time))}
    for half, sids in BALL_SIDS_BY_HALF.items():
        best[f"half{half}"] = F.max(F.when(ball & sid.isin(*sids), by_time_speed))
    return best


def with_balls(fused: DataFrame) -> DataFrame:
    """Add ``active`` and ``latest`` ball structs and the current half to each entity row.

    The active ball is the newest (then fastest) among those allowed in the current half, or
    among all when none of them is visible. The latest ball is the newest of all.
    """
    w = Window.partitionBy("match_id", "tick")
    best = _ball_structs()
    rows = fused.withColumns({
        "current_half": F.max("half").over(w),
        "current_second": F.max("raw_second").over(w),
        **{f"_{k}": v.over(w) for k, v in best.items()},
    })
    active = F.coalesce(
        *[F.when(F.col("current_half") == h, F.col(f"_half{h}")) for h in BALL_SIDS_BY_HALF],
        F.col("_any"))
    return rows.withColumns({"active": active, "latest": F.col("_latest")}).drop(
        *[f"_{k}" for k in best])


def _nearest(player: Column, distance: Column) -> Column:
    who = F.struct(F.col("entity").alias("player"), "team", distance.alias("distance"))
    return F.min_by(who, F.when(player & distance.isNotNull(),
                                F.struct(distance, F.col("roster_order"))))


def tick_state(fused: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    """One wide row per (match_id, tick); the input of every tactical operator."""
    w = Window.partitionBy("match_id", "tick")
    player = F.col("type") == "player"
    rows = with_balls(fused).withColumns({
        "d_m": distance_m(F.col("x"), F.col("y"), F.col("active.x"), F.col("active.y")),
        "d_latest_mm": distance_mm(F.col("x"), F.col("y"), F.col("latest.x"), F.col("latest.y")),
    })
    for s, team in SIDES:
        mine = player & (F.col("team") == team)
        rows = rows.withColumns({
            f"_cx_{s}": F.avg(F.when(mine, F.col("x"))).over(w),
            f"_cy_{s}": F.avg(F.when(mine, F.col("y"))).over(w),
        })
    aggs = [
        F.max("current_half").alias("current_half"),
        F.max("current_second").alias("current_second"),
        F.sum("n_raw").alias("raw_sensors"),
        F.count("entity").alias("visible_objects"),
        F.count_if(player).alias("visible_players"),
        F.max("active").alias("ball"),
        F.max("latest").alias("latest_ball"),
        _nearest(player, F.col("d_m")).alias("near"),
        _nearest(player, F.col("d_latest_mm")).alias("near_latest"),
        F.collect_list(F.when(
            (player & (F.col("speed_kmh") > cfg.player_anomaly_kmh))
            | ((F.col("type") == "ball") & (F.col("speed_kmh") > cfg.ball_anomaly_kmh)),
            F.struct(F.when(player, "player_speed").otherwise("ball_speed").alias("kind"),
                     F.col("entity").alias("subject"), F.col("speed_kmh").alias("value")),
        )).alias("speeding"),
    ]
    for s, team in SIDES:
        mine = player & (F.col("team") == team)

        def of(column: str, mine: Column = mine) -> Column:
            return F.when(mine, F.col(column))

        spread = distance_m(F.col("x"), F.col("y"), F.col(f"_cx_{s}"), F.col(f"_cy_{s}"))

        def zero(value: Column) -> Column:
            return F.coalesce(value, F.lit(0.0))

        aggs += [
            F.count_if(mine & (F.col("d_m") <= cfg.pressure_radius_m)).alias(f"pressure_{s}"),
            F.count_if(mine).alias(f"visible_{s}"),
            zero(F.avg(of("speed_kmh"))).alias(f"avg_speed_{s}"),
            zero(F.max(of("speed_kmh"))).alias(f"max_speed_{s}"),
            zero((F.max(of("y")) - F.min(of("y"))) / 1000.0).alias(f"width_m_{s}"),
            zero((F.max(of("x")) - F.min(of("x"))) / 1000.0).alias(f"depth_m_{s}"),
            zero(F.avg(F.when(mine, spread))).alias(f"compactness_m_{s}"),
            F.count_if(mine & (F.col("speed_kmh") > cfg.high_speed_kmh)).alias(f"runners_{s}"),
        ]
    return rows.groupBy("match_id", "tick").agg(*aggs)


def active_ball(state: DataFrame) -> DataFrame:
    return _ball_rows(state, "ball")


def latest_ball(state: DataFrame) -> DataFrame:
    return _ball_rows(state, "latest_ball")


def _ball_rows(state: DataFrame, column: str) -> DataFrame:
    ball = F.col(column)
    return state.where(ball.isNotNull()).select(
        "match_id", "tick", (-ball["neg_sid"]).cast("int").alias("sid"),
        ball["entity"].alias("ball"), ball["x"].alias("x"), ball["y"].alias("y"),
        ball["ts"].alias("ts"), ball["speed_kmh"].alias("speed_kmh"))


def nearest_player(state: DataFrame) -> DataFrame:
    """Closest player to the active ball; equal distances go to the roster order."""
    return state.where(F.col("near").isNotNull()).select(
        "match_id", "tick", F.col("near.player").alias("player"),
        F.col("near.team").alias("team"), F.col("near.distance").alias("distance_m"))


def possession_team(cfg: MatchConfig = MATCH) -> Column:
    """Team of the nearest player inside the possession radius, else neutral."""
    close = F.col("near.distance") <= cfg.possession_radius_m
    return F.when(close, F.col("near.team")).otherwise(F.lit(NEUTRAL))


def live_possession(state: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    return state.select(
        "match_id", "tick", F.col("near.player").alias("player"),
        possession_team(cfg).alias("team"), F.col("near.distance").alias("distance_m"))


def confidence_band(distance: Column, cfg: MatchConfig = MATCH) -> Column:
    return (
        F.when(distance <= cfg.possession_high_mm, "High")
        .when(distance <= cfg.possession_medium_mm, "Medium")
        .when(distance <= cfg.possession_low_mm, "Low")
        .when(distance.isNotNull(), "Loose Ball")
        .otherwise("Unavailable")
    )


def possession_confidence(state: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    """Tracking estimate from the latest ball with a confidence band."""
    d = F.col("near_latest.distance")
    held = d <= cfg.possession_low_mm
    return state.select(
        "match_id", "tick",
        F.when(held, F.col("near_latest.player")).alias("possessor"),
        F.when(held, F.col("near_latest.team")).otherwise("").alias("team"),
        (d / 1000.0).alias("distance_m"), confidence_band(d, cfg).alias("confidence"))


def _per_team(state: DataFrame, names: dict[str, str]) -> DataFrame:
    teams = F.array(*[
        F.struct(F.lit(team).alias("team"), *[F.col(f"{c}_{s}").alias(n) for n, c in names.items()])
        for s, team in SIDES])
    return state.select("match_id", "tick", F.inline(teams))


def pressure_index(state: DataFrame) -> DataFrame:
    """Players of each team inside the pressure radius around the ball."""
    return _per_team(state, {"players_near_ball": "pressure"})


def team_shape(state: DataFrame) -> DataFrame:
    """Shape of both teams; an invisible team shows zeros."""
    return _per_team(state, {
        "visible_players": "visible", "avg_speed": "avg_speed", "max_speed": "max_speed",
        "width_m": "width_m", "depth_m": "depth_m", "compactness_m": "compactness_m",
        "high_speed_players": "runners"})


def momentum_raw(state: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    """Heuristic share of both teams in percent, one digit."""
    team = possession_team(cfg)
    share = F.when(F.col("ball.x").isNotNull(),
                   normalise(F.col("ball.x"), cfg.x_min, cfg.x_max, 1.0))

    def score(s: str, name: str, ball_share: Column) -> Column:
        held = F.when(team == name, F.lit(cfg.momentum_possession)).otherwise(F.lit(0.0))
        field = F.coalesce(ball_share * F.lit(cfg.momentum_ball), F.lit(0.0))
        cap = F.lit(cfg.momentum_cap)
        near = F.least(cap, F.col(f"pressure_{s}") * F.lit(cfg.momentum_pressure))
        fast = F.least(cap, F.col(f"runners_{s}") * F.lit(cfg.momentum_runner))
        return held + field + near + fast

    scored = state.withColumns({
        "_a": score("a", TEAM_A, share), "_b": score("b", TEAM_B, F.lit(1.0) - share)})
    total = F.col("_a") + F.col("_b")

    def percent(c: str) -> Column:
        safe = F.when(total > 0, total)
        return F.coalesce(round_half_even(F.col(c) / safe * F.lit(100.0), 1), F.lit(50.0))

    return scored.select(
        "match_id", "tick", "current_second", percent("_a").alias("momentum_a"),
        percent("_b").alias("momentum_b"), "pressure_a", "pressure_b",
        "compactness_m_a", "compactness_m_b")


def changed_ticks(rows: DataFrame) -> DataFrame:
    """Ticks whose match second differs from the tick before; the others are repeats."""
    w = Window.partitionBy("match_id").orderBy("tick")
    before = F.lag("current_second").over(w)
    return rows.where(F.col("current_second").isNotNull()).withColumn("_before", before).where(
        F.col("_before").isNull() | (F.col("_before") != F.col("current_second"))).drop("_before")


def smoother(alpha: float) -> Callable:
    """One smoothing step: blend, scale to 100 and round to one digit.

    A closure, so that it travels to the workers by value.
    """

    def step(previous: tuple | None, raw: tuple) -> tuple:
        if previous is None:
            return raw
        a, b = (p * (1.0 - alpha) + r * alpha for p, r in zip(previous, raw))
        total = a + b
        if total <= 0:
            return previous
        return round(a / total * 100.0, 1), round(b / total * 100.0, 1)

    return step


def momentum_smoothed(raw: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    """Exponential smoothing over the changed ticks of each match.

    Each step rounds, so it cannot be regrouped: a match is sequential, matches run in parallel.
    A group has at most one row per match second.
    """
    step = smoother(cfg.momentum_alpha)
    narrow = changed_ticks(raw).select(
        "match_id", "tick", "current_second", "momentum_a", "momentum_b")

    def smooth(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("tick")
        state, out = None, []
        for pair in zip(pdf["momentum_a"], pdf["momentum_b"]):
            state = step(state, pair)
            out.append(state)
        return pdf.assign(momentum_a=[s[0] for s in out], momentum_b=[s[1] for s in out])

    return narrow.groupBy("match_id").applyInPandas(smooth, narrow.schema)


def statistics_history(raw: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    """Newest changed ticks with pressure, smoothed momentum and compactness."""
    smoothed = momentum_smoothed(raw, cfg).select("match_id", "tick", "momentum_a", "momentum_b")
    rows = changed_ticks(raw.drop("momentum_a", "momentum_b"))
    w = Window.partitionBy("match_id").orderBy(F.desc("tick"))
    recent = rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= cfg.history_rows)
    return recent.join(smoothed, ["match_id", "tick"]).select(
        "match_id", "tick", F.col("current_second").alias("match_second"),
        clock_text(F.col("current_second")).alias("time"), "pressure_a", "pressure_b",
        "momentum_a", "momentum_b",
        round_half_even(F.col("compactness_m_a"), 2).alias("compactness_a"),
        round_half_even(F.col("compactness_m_b"), 2).alias("compactness_b"))


def anomalies(state: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    """(kind, subject, value) rows: speeds, few visible players, loose ball."""
    few = F.when(
        F.col("visible_players") < cfg.min_visible_players,
        F.struct(F.lit("few_visible").alias("kind"), F.lit("team players").alias("subject"),
                 F.col("visible_players").cast("double").alias("value")))
    loose = F.when(
        (possession_team(cfg) == NEUTRAL) & F.col("near.distance").isNotNull(),
        F.struct(F.lit("loose_ball").alias("kind"), F.col("near.player").alias("subject"),
                 F.col("near.distance").alias("value")))
    rows = F.filter(F.concat("speeding", F.array(few, loose)), lambda r: r.isNotNull())
    return state.select("match_id", "tick", F.inline(rows))


def kpi_per_tick(state: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    return state.select(
        "match_id", "tick", "visible_objects", "raw_sensors",
        clock_text(F.col("current_second")).alias("match_time"), "current_half",
        "visible_players", F.col("ball.speed_kmh").alias("ball_speed_kmh"),
        possession_team(cfg).alias("possession_team"))


def fastest_players(entity_rows: DataFrame, k: int = 5, cfg: MatchConfig = MATCH) -> DataFrame:
    """Top ``k`` current speeds per tick."""
    w = Window.partitionBy("match_id", "tick").orderBy(F.desc("speed_kmh"), "roster_order")
    players = entity_rows.where(F.col("type") == "player")
    return players.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "match_id", "tick", "rank", F.col("entity").alias("player"), "team", "speed_kmh",
        intensity(F.col("speed_kmh"), cfg).alias("intensity"))


def fastest_player(entity_rows: DataFrame) -> DataFrame:
    """The single fastest player per tick; ties go to the roster order."""
    best = F.max_by(F.struct(F.col("entity").alias("player"), "team", "speed_kmh"),
                    F.struct("speed_kmh", -F.col("roster_order")))
    return entity_rows.where(F.col("type") == "player").groupBy("match_id", "tick").agg(
        best.alias("p")).select("match_id", "tick", "p.*")


def top_sprinters(player_rows: DataFrame, k: int = 5) -> DataFrame:
    """Largest sprint distances of the rolling window, zeros left out."""
    w = Window.partitionBy("match_id").orderBy(F.desc("sprint_distance"), "roster_order")
    ranked = player_rows.where(F.col("sprint_distance") > 0).withColumn(
        "rank", F.row_number().over(w))
    return ranked.where(F.col("rank") <= k).select(
        "match_id", "rank", "player", "team", "sprint_distance")
