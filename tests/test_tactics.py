"""Snapshots, fusion and tactical operators on hand-made scenes."""

import math
import random

import pytest
from pyspark.sql import functions as F

from trackspark.config import MATCH
from trackspark.dims import sensor_dim
from trackspark.operators import running, snapshot, tactics
from trackspark.operators.ticks import next_tick

COLS = ("match_id int, sid int, ts bigint, x double, y double, z double, half int, "
        "matchSecond double, speed_kmh double")


def samples(spark, rows):
    """rows: (match_id, sid, second, x, y, speed[, half])"""
    full = [(m, s, int(sec * 1e12), float(x), float(y), 0.0, (rest[0] if rest else 1), float(sec), v)
            for m, s, sec, x, y, v, *rest in rows]
    return spark.createDataFrame(full, COLS)


def state_at(spark, rows, tick=0):
    snap = snapshot.snapshot(samples(spark, rows))
    fused = snapshot.fuse(snap, sensor_dim(spark), keep_unknown=True)
    return tactics.tick_state(fused.where(F.col("tick") == tick))


def test_snapshot_carries_forward_and_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(m, s, rng.randrange(0, 60_000) / 1000, rng.randrange(100), 0, 1.0)
            for m in (1, 2) for s in (13, 14, 47) for _ in range(15)]
    got = {(r.match_id, r.tick, r.sid): r.x for r in snapshot.snapshot(samples(spark, rows)).collect()
           if r.tick < 70}
    want = {}
    for m, s, sec, x, _, _ in sorted(rows, key=lambda r: r[2]):
        for tick in range(int(sec), 70):
            want[(m, tick, s)] = float(x)
    assert got == want


def test_next_tick_equals_brute_force(spark):
    """Ticks side by side, far apart and on the times of rows; one match has none."""
    rng = random.Random(3)
    times = [0.0, 5.0, 59.999, 60.0, 60.0, 61.5, 1e3, 5e11, 1e12, 2e12, -3.0] + [
        rng.uniform(0, 400) for _ in range(200)]
    ticks = {1: [5.0, 5.5, 60.0, 61.4, 300.25, 1e12], 2: [-10.0, 400.0], 4: [1.0]}
    rows = spark.createDataFrame([(m, t) for m in (1, 2, 3) for t in [*times, None]],
                                 "match_id int, at double")
    marks = spark.createDataFrame([(m, t, i) for m, ts in ticks.items() for i, t in enumerate(ts)],
                                  "match_id int, t double, n int")
    got = sorted((r.match_id, r["at"], r.t, r.n) for r in next_tick(
        rows, marks, F.col("at")).collect())
    want = sorted((m, t, *min((u, i) for i, u in enumerate(ticks[m]) if u >= t))
                  for m in (1, 2) for t in times if any(u >= t for u in ticks[m]))
    assert got == want


def test_next_tick_takes_many_rows_of_one_bucket(spark):
    """A frame to the end of its partition is summed anew for each row: rows squared a bucket."""
    n = 20_000
    rows = spark.range(n).selectExpr("1 as match_id", "id", "60 * (id / 20000) as at")
    marks = spark.range(1, 61).selectExpr("1 as match_id", "cast(id as double) as t")
    found = next_tick(rows, marks, F.col("at"))
    assert "unboundedfollowing" not in found._jdf.queryExecution().toString().lower()
    got = found.agg(F.count("id"), F.count_if(F.ceil("at") == F.col("t"))).first()
    assert tuple(got) == (n, n - 1)  # the row at 0 meets the tick at 1


def test_snapshot_at_far_and_close_ticks_equals_brute_force(spark):
    rng = random.Random(8)
    data = [(1, rng.choice([13, 14]), rng.uniform(0, 200)) for _ in range(600)]
    ticks = [0.25, 0.75, 3.0, 3.0000001, 100.5, 1e9]
    rows = [(m, sid, int(t * 1e12), i, 0, 0, 1, t, 1.0) for i, (m, sid, t) in enumerate(data)]
    positions = spark.createDataFrame(
        rows, "match_id int, sid int, ts long, x int, y int, z int, half int, "
        "matchSecond double, speed_kmh double").repartition(3)
    marks = spark.createDataFrame([(1, t) for t in ticks], "match_id int, t double")
    got = {(r.t, r.sid): r.x for r in snapshot.snapshot_at(positions, marks).collect()}
    want = {}
    for t in ticks:
        for sid in (13, 14):
            before = [(r[2], r[3]) for r in rows if r[1] == sid and r[7] <= t]
            if before:
                want[t, sid] = max(before)[1]
    assert got == want


def test_snapshot_at_fractional_ticks(spark):
    rng = random.Random(5)
    rows = [(1, s, rng.randrange(0, 30_000) / 1000, rng.randrange(100), 0, 1.0)
            for s in (13, 14) for _ in range(20)]
    times = [0.25, 3.5, 3.75, 11.0, 29.125, 40.0]
    ticks = spark.createDataFrame([(1, t) for t in times], "match_id int, t double")
    got = {(r.t, r.sid): r.x for r in snapshot.snapshot_at(samples(spark, rows), ticks).collect()}
    want = {}
    for t in times:
        for _, s, sec, x, _, _ in sorted(rows, key=lambda r: r[2]):
            if sec <= t:
                want[(t, s)] = float(x)
    assert got == want


def test_tie_column_decides_equal_times(spark):
    rows = samples(spark, [(1, 13, 1.0, 5, 0, 1.0), (1, 13, 1.0, 3, 0, 1.0)]).withColumn(
        "seq", F.when(F.col("x") == 3, 2).otherwise(1))
    assert snapshot.latest_positions(rows, ("seq",)).first().x == 3.0
    plan = snapshot.latest_positions(rows)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_fusion_prefers_feet(spark):
    rows = [(1, 13, 0.5, 100, 0, 4.0), (1, 14, 0.5, 200, 0, 8.0), (1, 97, 0.5, 900, 0, 9.0),
            (1, 99, 0.5, 700, 10, 2.0), (1, 105, 0.5, 1, 1, None), (1, 999, 0.5, 5, 5, 1.0)]
    latest = snapshot.latest_positions(samples(spark, rows))
    out = {r.entity: r for r in snapshot.entities(latest, sensor_dim(spark), ("match_id",)).collect()}
    assert set(out) == {"Nick Gertje", "Leon Krapf", "Referee"}
    assert (out["Nick Gertje"].x, out["Nick Gertje"].sids) == (150.0, [13, 14])
    assert out["Nick Gertje"].speed_kmh == 6.0 and out["Nick Gertje"].label == "N. Gertje"
    assert (out["Leon Krapf"].x, out["Leon Krapf"].sids) == (700.0, [99])
    assert out["Referee"].speed_kmh == 0.0 and out["Referee"].label == "Referee"


def test_active_ball_rules(spark):
    base = [(1, 13, 0.1, 0, 0, 1.0)]
    both = base + [(1, 4, 0.2, 1, 1, 5.0), (1, 12, 0.3, 2, 2, 5.0)]
    s = state_at(spark, both)
    assert tactics.active_ball(s).first().sid == 4       # 12 is not in play in half 1
    assert tactics.latest_ball(s).first().sid == 12
    only = base + [(1, 12, 0.3, 2, 2, 5.0)]
    assert tactics.active_ball(state_at(spark, only)).first().sid == 12
    half2 = [(1, 13, 0.1, 0, 0, 1.0, 2)] + [(1, 4, 0.2, 1, 1, 5.0), (1, 12, 0.3, 2, 2, 5.0)]
    assert tactics.active_ball(state_at(spark, half2)).first().sid == 12
    tie = base + [(1, 4, 0.2, 1, 1, 5.0), (1, 8, 0.2, 2, 2, 7.0), (1, 10, 0.2, 3, 3, 7.0)]
    s = state_at(spark, tie)
    assert tactics.active_ball(s).first().sid == 8       # faster, then lower id
    assert tactics.latest_ball(s).first().sid == 4


@pytest.mark.parametrize("mm, team, band", [
    (1500, "Team A", "High"), (1501, "Team A", "Medium"), (3000, "Team A", "Medium"),
    (3001, "Neutral", "Low"), (5000, "Neutral", "Low"), (5001, "Neutral", "Loose Ball")])
def test_possession_limits(spark, mm, team, band):
    s = state_at(spark, [(1, 47, 0.1, mm, 0, 1.0), (1, 4, 0.1, 0, 0, 1.0)])
    live = tactics.live_possession(s).first()
    assert (live.player, live.team, live.distance_m) == ("Dennis Dotterweich", team, mm / 1000)
    estimate = tactics.possession_confidence(s).first()
    assert estimate.confidence == band
    assert (estimate.possessor is None) == (band == "Loose Ball")
    near = {r.team: r.players_near_ball for r in tactics.pressure_index(s).collect()}
    assert near == {"Team A": int(mm <= 5000), "Team B": 0}


def test_nearest_tie_follows_roster(spark):
    rows = [(1, 63, 0.1, 100, 0, 1.0), (1, 47, 0.1, -100, 0, 1.0), (1, 4, 0.1, 0, 0, 1.0)]
    assert tactics.nearest_player(state_at(spark, rows)).first().player == "Dennis Dotterweich"


def test_no_ball_and_no_team(spark):
    s = state_at(spark, [(1, 105, 0.1, 0, 0, 1.0)])
    assert tactics.nearest_player(s).count() == 0
    assert tactics.possession_confidence(s).first().confidence == "Unavailable"
    shape = tactics.team_shape(s).collect()
    assert [(r.visible_players, r.width_m, r.compactness_m) for r in shape] == [(0, 0.0, 0.0)] * 2
    m = tactics.momentum_raw(s).first()
    assert (m.momentum_a, m.momentum_b) == (50.0, 50.0)
    live = tactics.live_possession(s).first()
    assert (live.player, live.team, live.distance_m) == (None, "Neutral", None)


def test_team_shape_by_hand(spark):
    rows = [(1, 47, 0.1, 0, 0, 10.0), (1, 49, 0.1, 3000, 4000, 20.0), (1, 4, 0.1, 0, 0, 1.0)]
    a = tactics.team_shape(state_at(spark, rows)).where("team = 'Team A'").first()
    assert (a.visible_players, a.avg_speed, a.max_speed) == (2, 15.0, 20.0)
    assert (a.width_m, a.depth_m, a.compactness_m, a.high_speed_players) == (4.0, 3.0, 2.5, 1)


def test_momentum_by_hand(spark):
    rows = [(1, 47, 0.1, 0, 0, 20.0), (1, 63, 0.1, 4000, 0, 1.0), (1, 4, 0.1, 0, 0, 1.0)]
    m = tactics.momentum_raw(state_at(spark, rows)).first()
    a, b = 35 + 12.5 + 5 + 4, 12.5 + 5
    assert (m.momentum_a, m.momentum_b) == (round(a / (a + b) * 100, 1), round(b / (a + b) * 100, 1))


def test_anomaly_rules(spark):
    rows = [(1, 47, 0.1, 9000, 0, 40.1), (1, 49, 0.1, 9500, 0, 40.0), (1, 4, 0.1, 0, 0, 180.1)]
    got = {(r.kind, r.subject): r.value for r in tactics.anomalies(state_at(spark, rows)).collect()}
    assert got == {
        ("player_speed", "Dennis Dotterweich"): 40.1, ("ball_speed", "Ball 4"): 180.1,
        ("few_visible", "team players"): 2.0, ("loose_ball", "Dennis Dotterweich"): 9.0}


@pytest.mark.parametrize("n, expected", [(11, True), (12, False)])
def test_visible_player_limit(spark, n, expected):
    feet = [13, 47, 49, 19, 53, 23, 57, 59, 61, 63, 65, 67][:n]
    s = state_at(spark, [(1, f, 0.1, 0, 0, 1.0) for f in feet])
    kinds = {r.kind for r in tactics.anomalies(s).collect()}
    assert ("few_visible" in kinds) == expected


def test_smoothing_skips_repeated_seconds_and_sums_to_100(spark):
    rng = random.Random(7)
    rows, second = [], 0.0
    for m in (1, 2):
        for tick in range(200):
            second = second if rng.random() < 0.3 else tick + rng.random()
            a = round(rng.uniform(0, 100), 1)
            rows.append((m, tick, second, a, round(100 - a, 1)))
    raw = spark.createDataFrame(
        rows, "match_id int, tick int, current_second double, momentum_a double, momentum_b double")
    got = sorted(tuple(r) for r in tactics.momentum_smoothed(raw).collect())
    want, state, before = [], {}, {}
    for m, tick, sec, a, b in rows:
        if before.get(m) == sec:
            continue
        before[m] = sec
        if m in state:
            pa, pb = state[m]
            na, nb = pa * (1 - 0.15) + a * 0.15, pb * (1 - 0.15) + b * 0.15
            a, b = round(na / (na + nb) * 100.0, 1), round(nb / (na + nb) * 100.0, 1)
        state[m] = (a, b)
        want.append((m, tick, sec, a, b))
    assert got == sorted(want)
    assert all(abs(r[3] + r[4] - 100) <= 0.11 for r in got)


def test_trail_has_newest_ticks_with_data(spark):
    rows = [(1, 13, s + 0.5, s, 0, 1.0) for s in (1, 2, 5, 9, 20, 21, 40)]
    out = snapshot.trail(samples(spark, rows), sensor_dim(spark)).orderBy("tick").collect()
    assert [r.tick for r in out] == [5, 9, 20, 21, 40]
    assert [r.fade and round(r.fade, 3) for r in out] == [0.14, 0.28, 0.42, 0.56, None]


def test_player_stats_sum_or_average_feet(spark):
    latest = snapshot.latest_positions(samples(
        spark, [(1, 13, 0.1, 0, 0, 4.0), (1, 14, 0.1, 0, 0, 6.0)]))
    ents = snapshot.entities(latest, sensor_dim(spark), ("match_id",))
    stats = spark.createDataFrame(
        [(1, 13, "Sprint", 3.0, 1.0), (1, 14, "Trot", 5.0, 2.0)],
        "match_id int, sid int, intensity string, distance_1m double, time_1m double")
    total = running.player_rolling_stats(ents, stats).first()
    assert (total.distance, total.sprint_distance, total.active_time) == (8.0, 3.0, 3.0)
    assert running.player_rolling_stats(ents, stats, sensor_agg="avg").first().distance == 4.0
    teams = {r.team: r.distance for r in running.team_rolling_stats(
        running.player_rolling_stats(ents, stats)).collect()}
    assert teams == {"Team A": 8.0, "Team B": 0.0}
    shown = running.rounded_player_stats(running.player_rolling_stats(
        ents, stats.withColumn("distance_1m", F.col("distance_1m") + 0.125))).first()
    assert (shown.distance, shown.sprint_distance) == (8.25, 3.12)  # half to even
    with pytest.raises(ValueError):
        running.player_rolling_stats(ents, stats, sensor_agg="max")


def test_rolling_window_is_sixty_seconds(spark):
    rows = [(1, 13, float(s) + 0.5, 0, 0, 36.0) for s in (0, 30, 59, 60, 130)]
    got = {r.second: r.distance for r in running.rolling_stats(samples(spark, rows)).collect()}
    one = 36.0 / 3.6 * 0.005
    assert {s: round(d / one) for s, d in got.items()} == {0: 1, 30: 2, 59: 3, 60: 3, 130: 1}
    assert math.isclose(got[0], one)


def test_tactics_add_no_shuffle_to_the_snapshot_layout(spark):
    snap = snapshot.snapshot(samples(spark, [(1, 13, 0.1, 0, 0, 1.0)]))
    state = tactics.tick_state(snapshot.fuse(snap, sensor_dim(spark), keep_unknown=True))
    plan = state._jdf.queryExecution().executedPlan().toString()
    # combined samples by (sensor, tick), carry-forward by sensor, layout by tick; no more
    assert plan.count("Exchange hashpartitioning") == 3
    assert MATCH.last_tick == 3597
