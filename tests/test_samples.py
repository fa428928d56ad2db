"""Cleaning, validity, zones, chunks and their edge cases."""

import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from trackspark.config import CLEAN_SCHEMA, MATCH, RAW_SCHEMA
from trackspark.dims import match_clock, sensor_dim
from trackspark.functions.numbers import finite, round_half_even
from trackspark.functions.zones import intensity, sample_interval
from trackspark.operators import clean, heatmap, running
from trackspark.sources import readers, sinks

S1, E1 = MATCH.first_half_start_ts, MATCH.first_half_end_ts
S2, E2 = MATCH.second_half_start_ts, MATCH.second_half_end_ts


def raw(spark, rows):
    """rows: (match_id, sid, ts, x, y, v_abs)"""
    df = spark.createDataFrame(rows, "match_id int, sid int, ts bigint, x int, y int, v_abs bigint")
    zeros = ["z", "vx", "vy", "vz", "ax", "ay", "az"]
    return df.select("*", F.lit(0).cast("bigint").alias("a_abs"), *[F.lit(0).alias(c) for c in zeros])


def test_half_bounds_are_inclusive(spark):
    times = [S1 - 1, S1, E1, E1 + 1, S2 - 1, S2, E2, E2 + 1, None]
    out = clean.clean_samples(raw(spark, [(1, 13, t, 0, 0, 0) for t in times]))
    rows = {r.ts: (r.half, r.matchSecond) for r in out.collect()}
    assert rows == {S1: (1, 0.0), E1: (1, 1804.0), S2: (2, 1804.0), E2: (2, 3597.0)}


def test_units_and_null_coordinates_survive_cleaning(spark):
    out = clean.clean_samples(raw(spark, [(1, 13, S1, None, 1500, 2_000_000)])).first()
    assert out.x_m is None and out.y_m == 1.5
    assert out.speed_m_s == 2_000_000 * 1e-6 and out.speed_kmh == 2_000_000 * 1e-6 * 3.6


def test_valid_positions_borders(spark):
    points = [(-68000, 0), (68000, 0), (0, 32500), (0, -32500), (-68001, 0), (0, 32501), (None, 0)]
    rows = [(1, 13, S1 + i, x, y, 0) for i, (x, y) in enumerate(points)]
    rows.append((1, None, S1, 0, 0, 0))
    kept = clean.valid_positions(clean.clean_samples(raw(spark, rows)))
    assert kept.count() == 4


def test_many_matches_use_their_own_clock(spark):
    rows = [(m, 13, t, 0, 0, 0) for m in (1, 2, 3) for t in (S1, S2 + 10**12, 5)]
    single = clean.clean_samples(raw(spark, rows)).select("match_id", "half", "matchSecond")
    multi = clean.clean_matches(raw(spark, rows), match_clock(spark, [1, 2])).select(
        "match_id", "half", "matchSecond")
    expected = {tuple(r) for r in single.collect() if r.match_id < 3}
    assert {tuple(r) for r in multi.collect()} == expected and len(expected) == 4


def test_zone_cutoffs_are_strict_and_nan_stands(spark):
    speeds = [(0.5,), (1.0,), (1.1,), (11.0,), (14.0,), (14.1,), (24.0,), (24.1,), (None,),
              (float("nan"),)]
    df = spark.createDataFrame(speeds, "v double")
    zones = [r.z for r in df.select(intensity(F.col("v")).alias("z")).collect()]
    assert zones == ["Standing", "Standing", "Trot", "Trot", "Low-Speed Run", "High-Speed Run",
                     "High-Speed Run", "Sprint", "Standing", "Standing"]


def test_all_null_speeds_give_zero_distance(spark):
    rows = raw(spark, [(1, 13, S1, 0, 0, None), (1, 13, S1 + 1, 0, 0, None)])
    out = running.running_stats(clean.clean_samples(rows)).first()
    assert (out.distance_1m, out.ping_count, out.time_1m) == (0.0, 2, 0.01)


def test_sample_interval(spark):
    df = spark.createDataFrame([(4,), (13,)], "sid int")
    assert [r[0] for r in df.select(sample_interval(F.col("sid"))).collect()] == [0.0005, 0.005]


def test_finite(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("NaN",), ("Infinity",), (None,)], "v string")
    assert [r[0] for r in df.select(finite(F.col("v"))).collect()] == [1.5, None, None, None, None]


@pytest.mark.parametrize("digits", [0, 1, 2])
def test_rounding_equals_python(spark, digits):
    values = [6.25, 49.55, 50.05, 50.15, 0.05, 2.5, 3.5, 99.95, 1.005, 2.675, 0.0, 12.345]
    values += [i / 1000 for i in range(0, 100000, 37)] + [i / 40 for i in range(400)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(round_half_even(F.col("v"), digits)).collect()]
    assert got == [float(round(v, digits)) for v in values]


def test_raw_csv_bad_field_becomes_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text("13,5,1,2,3,4,5,0,0,0,0,0,0\nxx,6,1,2,3,4,5,0,0,0,0,0,0\n")
    rows = readers.read_raw_csv(spark, str(tmp_path)).orderBy("ts").collect()
    assert [(r.sid, r.ts) for r in rows] == [(13, 5), (None, 6)]


def test_clean_csv_round_trip(spark, tmp_path):
    out = clean.clean_samples(raw(spark, [(1, 13, S1 + 7, 1, None, 3)]))
    sinks.write_clean_csv(out, str(tmp_path / "c"))
    back = readers.read_clean_csv(spark, str(tmp_path / "c"))
    assert back.columns == [*CLEAN_SCHEMA.names, "match_id"]
    assert back.collect() == out.select(*CLEAN_SCHEMA.names, "match_id").collect()
    sinks.write_clean_csv(out.drop("match_id"), str(tmp_path / "flat"))
    back = readers.read_clean_csv(spark, str(tmp_path / "flat"))
    assert back.schema == CLEAN_SCHEMA
    assert back.collect() == out.select(*CLEAN_SCHEMA.names).collect()


def test_storage_keeps_two_matches_apart(spark, tmp_path):
    rows = [(m, 13, S1 + s * 10**12, m, 0, 0) for m in (1, 2) for s in range(3 * m)]
    out = clean.clean_samples(raw(spark, rows))
    sinks.write_clean_csv(out, str(tmp_path / "c"))
    sinks.write_chunks(clean.with_chunk_id(out), str(tmp_path / "k"))
    for back in (readers.read_clean_csv(spark, str(tmp_path / "c")),
                 readers.read_chunks(spark, str(tmp_path / "k"))):
        got = {r.match_id: r["count"] for r in back.groupBy("match_id").count().collect()}
        assert got == {1: 3, 2: 6}
    assert readers.read_chunks(spark, str(tmp_path / "k"), 1, 2, 2).count() == 2


def test_chunks_prune_and_list_in_order(spark, tmp_path):
    rows = [(1, 13, S1 + s * 10**12 + i, 0, 0, 0) for s in (2, 10, 0, 11) for i in range(5)]
    chunked = clean.with_chunk_id(clean.clean_samples(raw(spark, rows))).drop("match_id")
    sinks.write_chunks(chunked, str(tmp_path / "k"))
    chunks = readers.read_chunks(spark, str(tmp_path / "k"))
    assert [r[0] for r in readers.list_chunks(chunks).collect()] == [0, 2, 10, 11]
    part = readers.read_chunks(spark, str(tmp_path / "k"), 2, 10)
    assert part.count() == 10
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(chunkId" in plan
    wide = clean.with_chunk_id(clean.clean_samples(raw(spark, rows)), 10)
    assert {r[0] for r in wide.select("chunkId").distinct().collect()} == {0, 1}


def test_one_hot_chunk_is_spread_over_tasks(spark, tmp_path):
    rows = [(1, 13, S1 + i * 1000, 0, 0, 0) for i in range(4000)]
    chunked = clean.with_chunk_id(clean.clean_samples(raw(spark, rows))).drop("match_id")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        sinks.write_chunks(chunked, str(tmp_path / "h"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list((tmp_path / "h" / "chunkId=0").glob("*.parquet"))
    assert len(files) > 1
    assert readers.read_chunks(spark, str(tmp_path / "h")).count() == 4000


def test_schemas_are_nullable():
    assert all(f.nullable for f in RAW_SCHEMA.fields + CLEAN_SCHEMA.fields)
    assert RAW_SCHEMA.names[:3] == ["sid", "ts", "x"] and len(CLEAN_SCHEMA) == 21


def test_sensor_dim_has_every_sensor_once(spark):
    rows = sensor_dim(spark).collect()
    assert len(rows) == 42 and len({r.sid for r in rows}) == 42


def test_filter_reaches_the_scan(spark, tmp_path):
    raw(spark, [(1, 13, S1, 0, 0, 0)]).write.parquet(str(tmp_path / "p"))
    out = clean.valid_positions(clean.clean_samples(spark.read.parquet(str(tmp_path / "p"))))
    plan = out.select("sid", "x")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan
    assert "ReadSchema: struct<sid:int,ts:bigint,x:int,y:int>" in plan


# ---- heatmap -----------------------------------------------------------------------------

def positions(spark, points):
    return spark.createDataFrame([(1, 13, x, y) for x, y in points],
                                 "match_id int, sid int, x double, y double")


def test_interior_sample_has_the_kernel_total(spark):
    grid = heatmap.smooth(heatmap.heatmap_cells(positions(spark, [(0.0, 0.0)])))
    assert math.isclose(grid.agg(F.sum("value")).first()[0], 24.803952058231992, rel_tol=1e-12)
    assert len(heatmap.kernel()) == 109


def test_cells_clamp_and_skip_bad_coordinates(spark):
    points = [(68000.0, 32500.0), (-68000.0, -32500.0), (9e9, -9e9), (float("nan"), 0.0),
              (float("inf"), 0.0), (None, 0.0)]
    cells = {(r.grid_row, r.grid_col) for r in heatmap.heatmap_cells(positions(spark, points)).collect()}
    assert cells == {(49, 79), (0, 0), (0, 79)}


def test_kernel_is_cut_at_the_corner(spark):
    grid = heatmap.smooth(heatmap.heatmap_cells(positions(spark, [(-68000.0, -32500.0)])))
    rows = grid.collect()
    assert min(r.grid_row for r in rows) == 0 and max(r.grid_row for r in rows) == 5
    expected = sum(w for i, j, w in heatmap.kernel() if i >= 0 and j >= 0)
    assert math.isclose(sum(r.value for r in rows), expected)


def test_dense_grid_equals_sparse_cells(spark):
    sparse = heatmap.smooth(heatmap.heatmap_cells(positions(spark, [(0.0, 0.0), (60000.0, 0.0)])))
    grid = heatmap.dense_grid(sparse).first().grid
    assert len(grid) == 50 and all(len(r) == 80 for r in grid)
    for r in sparse.collect():
        assert grid[r.grid_row][r.grid_col] == r.value
    assert sum(v > 0 for row in grid for v in row) == sparse.count()


@pytest.mark.parametrize("n", [1, 2, 3, 19, 20, 21, 100])
def test_zmax_is_the_indexed_value(spark, n):
    values = [1.0 + i for i in range(n)]
    df = spark.createDataFrame([(1, "All", v) for v in values] + [(1, "All", 0.0)],
                               "match_id int, selection string, value double")
    assert heatmap.zmax(df).first().zmax == max(1.0, values[int((n - 1) * 0.95)])


@pytest.mark.parametrize("bad", [
    {"x_min": 1, "x_max": 1}, {"y_min": 2, "y_max": 1}, {"heat_cols": 0}, {"heat_rows": -1},
    {"kernel_radius": -1}, {"kernel_sigma": 0.0}])
def test_bad_grid_settings_raise(spark, bad):
    with pytest.raises(ValueError):
        heatmap.heatmap_cells(positions(spark, [(0.0, 0.0)]), replace(MATCH, **bad))


def test_clock_slices_deal_a_hot_match_over_keys(spark, monkeypatch):
    """The shuffled form gives what the broadcast one does, and halves end inclusively."""
    rows = [(1 + (i % 10 == 0), 13, S1 + i * 10**12 // 2, 0, 0, 0) for i in range(4000)]
    rows += [(1, 14, t, 0, 0, 0) for t in (S1 - 1, S1, E1, E1 + 1, S2 - 1, S2, E2, E2 + 1)]
    clock = match_clock(spark, [1, 2])
    cols = ["match_id", "sid", "ts", "half", "matchSecond"]
    want = sorted(clean.clean_matches(raw(spark, rows), clock).select(*cols).collect())
    monkeypatch.setattr(clean, "small_side", lambda df: df.hint("shuffle_merge"))
    got = clean.clean_matches(raw(spark, rows), clock).select(*cols)
    assert sorted(got.collect()) == want
    assert sum(r.sid == 14 for r in want) == 4
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "c_slice" in plan
