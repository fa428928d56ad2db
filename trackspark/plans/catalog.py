"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark import dims
from trackspark.config import MATCH, RAW_SCHEMA
from trackspark.functions.pitch import pitch_x, pitch_y
from trackspark.functions.text import short_label
from trackspark.operators import (
    clean,
    events,
    heatmap,
    metadata,
    possession,
    running,
    snapshot,
    tactics,
)
from trackspark.operators.ticks import minute_ticks
from trackspark.plans import fixtures as fx
from trackspark.session import materialise, work_dir
from trackspark.sources import batchlog, chunks, readers, sinks
from trackspark.streaming import live, pipeline, stateful

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(name: str) -> Column:
    return F.round(F.col(name), 6).alias(name)


def r9(name: str) -> Column:
    return F.round(F.col(name), 9).alias(name)


# ---- shared inputs -----------------------------------------------------------------------

def _snapshot(spark: SparkSession, sf_dir: str, every: int | None = None) -> DataFrame:
    return snapshot.snapshot(fx.positions(spark, sf_dir), fx.TIE, every=every)


def _fused(spark: SparkSession, sf_dir: str, every: int | None = None) -> DataFrame:
    return snapshot.fuse(_snapshot(spark, sf_dir, every), dims.sensor_dim(spark),
                         keep_unknown=True)


def _entities(spark: SparkSession, sf_dir: str, every: int | None = None) -> DataFrame:
    return snapshot.entities(_snapshot(spark, sf_dir, every), dims.sensor_dim(spark))


def _state(spark: SparkSession, sf_dir: str, every: int | None = None) -> DataFrame:
    return tactics.tick_state(_fused(spark, sf_dir, every))


def _latest_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = snapshot.latest_positions(fx.positions(spark, sf_dir), fx.TIE)
    return snapshot.entities(latest, dims.sensor_dim(spark), ("match_id",))


def _player_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = running.latest_stats(running.running_stats(fx.positions(spark, sf_dir)))
    return running.player_rolling_stats(_latest_entities(spark, sf_dir), stats)


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = metadata.parse_rows(fx.possession_rows(spark, sf_dir))
    return metadata.timed_rows(materialise(parsed, "possession-rows"))


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.merge_intervals(metadata.possession_intervals(_timed(spark, sf_dir)))


def _timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = materialise(_merged(spark, sf_dir), "possession-merged")
    timeline = possession.possession_timeline(merged, dims.player_dim(spark))
    return materialise(timeline, "possession-timeline")


def _minutes(spark: SparkSession) -> DataFrame:
    return minute_ticks(fx.matches(spark))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.match_events(fx.match_event_lines(spark, sf_dir))


# ---- samples -----------------------------------------------------------------------------

@query
def raw_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "raw-csv")
    sinks.write_raw_csv(fx.raw_samples(spark, sf_dir), path)
    return readers.read_raw_csv(spark, path).select(*RAW_SCHEMA.names)


@query
def clean_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.clean(spark, sf_dir).select(
        "match_id", "event_id", "sid", "ts", "x", "y", "z", "half", r9("matchSecond"), r9("x_m"),
        r9("y_m"), r9("z_m"), r9("speed_m_s"), r9("speed_kmh"), r9("acceleration_m_s2"))


@query
def clean_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "clean-csv")
    sinks.write_clean_csv(fx.clean(spark, sf_dir), path)
    return readers.read_clean_csv(spark, path).select(
        "match_id", "sid", "ts", "x", "y", "z", "v_abs", "a_abs", "half", r9("matchSecond"), r9("x_m"),
        r9("y_m"), r9("z_m"), r9("speed_m_s"), r9("speed_kmh"), r9("acceleration_m_s2"))


def _written_chunks(spark: SparkSession, sf_dir: str) -> str:
    path = work_dir(spark, "chunks")
    chunks.write_indexed_chunks(clean.with_chunk_id(fx.clean(spark, sf_dir)), path)
    return path


@query
def chunk_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.indexed_row_counts(spark, _written_chunks(spark, sf_dir))


@query
def chunk_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    second_half = int(MATCH.second_half_offset_s)
    return chunks.read_indexed_chunks(
        spark, _written_chunks(spark, sf_dir), second_half, MATCH.last_tick, fx.MATCH_ID
    ).select("match_id", "chunkId", "sid", "ts", "x", "y", "half", r9("matchSecond"))


@query
def valid_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.positions(spark, sf_dir).select(
        "match_id", "sid", "ts", "x", "y", "z", "half", r9("matchSecond"), r9("speed_kmh"))


@query
def non_ball_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.without_balls(fx.positions(spark, sf_dir)).select(
        "match_id", "sid", "ts", "x", "y")


# ---- running statistics ------------------------------------------------------------------

def _stats_columns(stats: DataFrame) -> DataFrame:
    return stats.select("match_id", "sid", "intensity", "window_start_s", r6("distance_1m"),
                        "ping_count", r6("time_1m"))


@query
def intensity_zone_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.intensity_zone_counts(fx.positions(spark, sf_dir))


@query
def running_stats_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats_columns(running.running_stats(fx.positions(spark, sf_dir)))


@query
def running_stats_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = running.latest_stats(running.running_stats(fx.positions(spark, sf_dir)))
    return stats.select("match_id", "sid", "intensity", "window_start_s", r6("distance_1m"),
                        r6("time_1m"))


@query
def rolling_stats_60s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.rolling_stats(fx.positions(spark, sf_dir)).select(
        "match_id", "sid", "intensity", "second", r6("distance"), r6("time_s"))


@query
def player_rolling_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _player_rows(spark, sf_dir).select(
        "match_id", "player", "team", "role", r6("speed_kmh"), "intensity", r6("distance"),
        r6("sprint_distance"), r6("high_speed_distance"), r6("active_time"))


@query
def team_rolling_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.team_rolling_stats(_player_rows(spark, sf_dir)).select(
        "match_id", "team", r6("distance"), r6("sprint_distance"), r6("high_speed_distance"),
        r6("active_time"))


@query
def top_sprinters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _player_rows(spark, sf_dir).withColumn(
        "sprint_distance", F.round("sprint_distance", 6))
    return tactics.top_sprinters(rows, 8)


@query
def player_minute_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance and time per player, minute and zone: samples to players in one plan."""
    stats = running.running_stats(fx.positions(spark, sf_dir))
    roster = dims.sensor_dim(spark).where(F.col("type") == "player").select(
        "sid", "entity", "team")
    return stats.join(roster, "sid").groupBy(
        "match_id", F.col("entity").alias("player"), "team", "window_start_s", "intensity",
    ).agg(F.sum("distance_1m").alias("distance"), F.sum("time_1m").alias("time_s"),
          F.sum("ping_count").alias("pings")).select(
        "match_id", "player", "team", "window_start_s", "intensity", r6("distance"),
        r6("time_s"), "pings")


# ---- positions and entities --------------------------------------------------------------

@query
def latest_position_per_sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.latest_positions(fx.positions(spark, sf_dir), fx.TIE).select(
        "match_id", "sid", "ts", "x", "y", "z", "half", r9("matchSecond"), r9("speed_kmh"))


@query
def current_match_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = snapshot.latest_positions(fx.positions(spark, sf_dir), fx.TIE)
    return snapshot.current_state(latest).select(
        "match_id", r9("currentMatchSecond"), "current_half")


@query
def sensor_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshot(spark, sf_dir).select(
        "match_id", "tick", "sid", "ts", "x", "y", "half", r9("matchSecond"), r9("speed_kmh"))


@query
def sensor_snapshot_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State at fractional times: 30.5, 60.5, ... on the match clock."""
    points = F.transform(F.sequence(F.lit(30), F.lit(MATCH.last_tick), F.lit(30)),
                         lambda s: s + F.lit(0.5))
    ticks = fx.matches(spark).select("match_id", F.explode(points).alias("t"))
    return snapshot.snapshot_at(fx.positions(spark, sf_dir), ticks, fx.TIE).select(
        "match_id", "t", "sid", "ts", "x", "y", r9("matchSecond"))


@query
def entity_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entities(spark, sf_dir).select(
        "match_id", "tick", "entity", "label", "type", "team", "role", r9("x"), r9("y"), "ts",
        r9("matchSecond"), F.array_join("sids", ",").alias("sids"), r9("speed_kmh"))


@query
def pitch_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entities(spark, sf_dir).select(
        "match_id", "tick", short_label(F.col("entity")).alias("label"),
        F.round(pitch_x(F.col("y")), 6).alias("pitch_x"),
        F.round(pitch_y(F.col("x")), 6).alias("pitch_y"))


@query
def trail_last5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.trail(fx.positions(spark, sf_dir), dims.sensor_dim(spark), fx.TIE).select(
        "match_id", "tick", "trail_index", r9("fade"), "entity", "type", r9("x"), r9("y"))


@query
def kpi_per_tick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tactics.kpi_per_tick(_state(spark, sf_dir)).withColumn(
        "ball_speed_kmh", F.round("ball_speed_kmh", 9))


# ---- tactics -----------------------------------------------------------------------------

@query
def active_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tactics.active_ball(_state(spark, sf_dir)).withColumn(
        "speed_kmh", F.round("speed_kmh", 9))


@query
def latest_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tactics.latest_ball(_state(spark, sf_dir)).withColumn(
        "speed_kmh", F.round("speed_kmh", 9))


@query
def nearest_player(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tactics.nearest_player(_state(spark, sf_dir)).select(
        "match_id", "tick", "player", "team", r9("distance_m"))


@query
def live_possession(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tactics.live_possession(_state(spark, sf_dir)).select(
        "match_id", "tick", "player", "team", r9("distance_m"))


@query
def possession_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tactics.possession_confidence(_state(spark, sf_dir)).select(
        "match_id", "tick", "possessor", "team", r9("distance_m"), "confidence")


@query
def pressure_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tactics.pressure_index(_state(spark, sf_dir))


@query
def team_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tactics.team_shape(_state(spark, sf_dir)).select(
        "match_id", "tick", "team", "visible_players", r9("avg_speed"), r9("max_speed"),
        r9("width_m"), r9("depth_m"), r9("compactness_m"), "high_speed_players")


@query
def momentum_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tactics.momentum_raw(_state(spark, sf_dir)).select(
        "match_id", "tick", "momentum_a", "momentum_b")


@query
def momentum_smoothed(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tactics.momentum_raw(_state(spark, sf_dir))
    return tactics.momentum_smoothed(raw).select(
        "match_id", "tick", r9("current_second"), "momentum_a", "momentum_b")


@query
def statistics_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tactics.statistics_history(tactics.momentum_raw(_state(spark, sf_dir)))
    return rows.withColumn("match_second", F.round("match_second", 9))


@query
def anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tactics.anomalies(_state(spark, sf_dir)).select(
        "match_id", "tick", "kind", "subject", r9("value"))


@query
def fastest_players_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tactics.fastest_players(_entities(spark, sf_dir, 60), 8).withColumn(
        "speed_kmh", F.round("speed_kmh", 9))


@query
def fastest_player(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tactics.fastest_player(_entities(spark, sf_dir)).withColumn(
        "speed_kmh", F.round("speed_kmh", 9))


# ---- many matches ------------------------------------------------------------------------

def _league_momentum(spark: SparkSession, sf_dir: str) -> DataFrame:
    snap = snapshot.snapshot(fx.league_positions(spark, sf_dir), fx.TIE)
    fused = snapshot.fuse(snap, dims.sensor_dim(spark), keep_unknown=True)
    return tactics.momentum_raw(tactics.tick_state(fused))


@query
def league_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight matches, one with half of all rows, each on its own clock."""
    return fx.league_samples(spark, sf_dir).select(
        "match_id", "event_id", "sid", "ts", "x", "y", "half", r9("matchSecond"), r9("speed_kmh"))


@query
def league_running_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats_columns(running.running_stats(fx.league_positions(spark, sf_dir)))


@query
def league_momentum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tactics.momentum_smoothed(_league_momentum(spark, sf_dir)).select(
        "match_id", "tick", r9("current_second"), "momentum_a", "momentum_b")


@query
def league_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tactics.statistics_history(_league_momentum(spark, sf_dir))
    return rows.withColumn("match_second", F.round("match_second", 9))


@query
def league_player_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics table as shown: two digits, all matches."""
    positions = fx.league_positions(spark, sf_dir)
    latest = snapshot.latest_positions(positions, fx.TIE)
    entities = snapshot.entities(latest, dims.sensor_dim(spark), ("match_id",))
    stats = running.latest_stats(running.running_stats(positions))
    rows = running.rounded_player_stats(running.player_rolling_stats(entities, stats))
    return rows.select("match_id", "player", "team", "role", "speed_kmh", "intensity", "distance",
                       "sprint_distance", "high_speed_distance", "active_time")


# ---- heatmaps ----------------------------------------------------------------------------

def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heatmap.heatmap_cells(clean.without_balls(fx.positions(spark, sf_dir)))


def _selection_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heatmap.by_selection(_cells(spark, sf_dir), dims.selection_dim(spark))


@query
def heatmap_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(spark, sf_dir)


@query
def heatmap_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heatmap.smooth(_cells(spark, sf_dir)).select(
        "match_id", "sid", "grid_row", "grid_col", r6("value"))


@query
def heatmap_by_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = heatmap.smooth(_selection_cells(spark, sf_dir), ("match_id", "selection"))
    return grid.select("match_id", "selection", "grid_row", "grid_col", r6("value"))


@query
def heatmap_zmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = heatmap.smooth(_selection_cells(spark, sf_dir), ("match_id", "selection"))
    return heatmap.zmax(grid).select("match_id", "selection", r6("zmax"))


@query
def heatmap_cell_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir).select("match_id", "grid_row", "grid_col").distinct()
    return heatmap.with_centres(cells).select(
        "match_id", "grid_row", "grid_col", r6("centre_x"), r6("centre_y"), r6("display_x"),
        r6("display_y"))


@query
def heatmap_grid_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense grids, taken apart again into one row per cell."""
    grids = heatmap.dense_grid(heatmap.smooth(_cells(spark, sf_dir)))
    rows = grids.select("match_id", "sid", F.posexplode("grid").alias("grid_row", "line"))
    return rows.select("match_id", "sid", "grid_row", F.posexplode("line").alias(
        "grid_col", "value")).withColumn("value", F.round("value", 6))


# ---- possession metadata -----------------------------------------------------------------

@query
def possession_rows_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = metadata.parse_rows(fx.possession_rows(spark, sf_dir))
    return parsed.select(
        "match_id", "file_player", "half", "line_no", "event_text", "kind",
        F.size("times").alias("n_times"), r6("raw_time"),
        F.round(F.get("times", F.lit(1)), 6).alias("second_time"))


@query
def possession_half_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offset of each file and the line where its clock starts again."""
    timed = _timed(spark, sf_dir)
    return timed.groupBy(*metadata.FILE, "offset_s").agg(
        F.min("line_no").alias("first_line"), F.count("*").alias("n_rows"))


@query
def possession_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.possession_intervals(_timed(spark, sf_dir)).select(
        "match_id", "player", "half", "line_no", r6("start_s"), r6("end_s"))


@query
def possession_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir).select("match_id", "player", r6("start_s"), r6("end_s"))


@query
def possession_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.quality_report(_timed(spark, sf_dir)).withColumn(
        "open_begin_s", F.round("open_begin_s", 6))


@query
def possession_metadata_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.metadata_counts(_merged(spark, sf_dir))


@query
def player_name_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.name_resolution(fx.possession_rows(spark, sf_dir))


# ---- possession --------------------------------------------------------------------------

@query
def current_possessors(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = materialise(_merged(spark, sf_dir), "possession-merged")
    return possession.current_possessors(merged, fx.second_ticks(spark)).select(
        "match_id", "t", "player", r6("start_s"))


@query
def possession_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timeline(spark, sf_dir).select("match_id", r6("left_s"), r6("right_s"), "player")


def _time_on_ball(spark: SparkSession, sf_dir: str, window_s: float | None) -> DataFrame:
    return possession.time_on_ball(_timeline(spark, sf_dir), _minutes(spark), window_s)


@query
def time_on_ball_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _time_on_ball(spark, sf_dir, None).select("match_id", "t", "player", r6("seconds"))


@query
def time_on_ball_60s(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = _time_on_ball(spark, sf_dir, MATCH.rolling_possession_s)
    return seconds.select("match_id", "t", "player", r6("seconds"))


@query
def time_on_ball_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = _time_on_ball(spark, sf_dir, None).withColumn("seconds", F.round("seconds", 6))
    return possession.time_on_ball_topk(seconds, dims.player_dim(spark), 10)


def _team_possession(spark: SparkSession, sf_dir: str, window_s: float | None) -> DataFrame:
    return possession.team_possession(
        _time_on_ball(spark, sf_dir, window_s), _minutes(spark), dims.player_dim(spark), window_s)


@query
def team_possession_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _team_possession(spark, sf_dir, None).select("match_id", "t", "team", r6("seconds"))


@query
def team_possession_60s(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _team_possession(spark, sf_dir, MATCH.rolling_possession_s)
    return rows.select("match_id", "t", "team", r6("seconds"))


@query
def possession_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _team_possession(spark, sf_dir, None).withColumn("seconds", F.round("seconds", 6))
    return possession.possession_share(rows).select(
        "match_id", "t", "team", "seconds", r9("share"))


@query
def possession_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = materialise(_merged(spark, sf_dir), "possession-merged")
    official = possession.current_possessors(merged, _minutes(spark))
    estimate = tactics.possession_confidence(_state(spark, sf_dir, 60))
    return possession.possession_agreement(official, estimate)


# ---- match events ------------------------------------------------------------------------

@query
def match_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).withColumn("second", F.round("second", 6)).orderBy("second")


@query
def due_events_per_tick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.due_events(_events(spark, sf_dir), fx.second_ticks(spark)).withColumn(
        "second", F.round("second", 6))


# ---- metadata files ----------------------------------------------------------------------

@query
def possession_files_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Possession from latin-1 files in folders of the halves, as an export writes them."""
    path = work_dir(spark, "possession-files")
    fx.write_possession_files(spark, sf_dir, path)
    parsed = metadata.parse_rows(readers.read_possession_files(spark, path, fx.MATCH_ID))
    timed = metadata.timed_rows(materialise(parsed, "possession-rows"))
    return metadata.merge_intervals(metadata.possession_intervals(timed)).select(
        "match_id", "player", r6("start_s"), r6("end_s"))


@query
def match_event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "event-files")
    fx.write_event_files(spark, sf_dir, path)
    found = events.match_events(readers.read_event_files(spark, path, fx.MATCH_ID))
    return found.withColumn("second", F.round("second", 6))


# ---- state documents ---------------------------------------------------------------------

@query
def json_state_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write both state documents, read them back and flatten them to one row per sensor."""
    positions = fx.positions(spark, sf_dir)
    latest = snapshot.latest_positions(positions, fx.TIE)
    grids = heatmap.dense_grid(heatmap.smooth(_cells(spark, sf_dir)))
    stats = running.latest_stats(running.running_stats(positions))
    path = work_dir(spark, "state")
    sinks.write_documents(sinks.positions_documents(latest, grids), f"{path}/positions")
    sinks.write_documents(sinks.stats_documents(stats), f"{path}/stats")

    docs = readers.read_positions_state(spark, f"{path}/positions")
    rows = docs.select(
        "match_id", F.round("currentMatchSecond", 6).alias("current_second"),
        F.inline("positions"))
    rows = rows.select("match_id", "current_second", "sid", "ts", "x", "y", "z", "half",
                       r6("matchSecond"), r6("speed_kmh"))
    grids = docs.select("match_id", F.explode("heatmap_by_sid").alias("sid_text", "grid"))
    total = F.aggregate(F.flatten("grid"), F.lit(0.0), lambda a, v: a + v)
    heat = grids.select("match_id", F.col("sid_text").cast("int").alias("sid"),
                        F.round(total, 4).alias("heat"))
    zones = readers.read_stats_state(spark, f"{path}/stats").select(
        "match_id", F.explode("stats").alias("sid_text", "zones"))
    sums = zones.select(
        "match_id", F.col("sid_text").cast("int").alias("sid"), F.explode("zones").alias("z_", "v")
    ).groupBy("match_id", "sid").agg(
        F.round(F.sum("v.distance_1m"), 6).alias("distance"),
        F.round(F.sum("v.time_1m"), 6).alias("time_s"))
    return rows.join(heat, ["match_id", "sid"], "left").join(sums, ["match_id", "sid"], "left")


# ---- streams -----------------------------------------------------------------------------

def _drain(spark: SparkSession, stream: DataFrame, name: str, mode: str = "update") -> str:
    path = work_dir(spark, name)
    pipeline.start_log(stream, f"{path}/log", f"{path}/checkpoint", mode).awaitTermination()
    return f"{path}/log"


@query
def stream_running_stats_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = pipeline.running_stats_stream(fx.position_stream(spark, sf_dir))
    log = _drain(spark, stream, "stream-stats")
    return _stats_columns(batchlog.read_batch_log(
        spark, log, ["match_id", "sid", "intensity", "window_start_s"]))


def _feed_log(spark: SparkSession, path: str, out: str, step: int, last: int | None = None) -> str:
    """Running statistics of the chunk feed up to ``last``; called again, it goes on from there."""
    feed = chunks.read_chunk_feed(spark, path, step, f"{out}/position", last)
    valid = clean.position_columns(clean.valid_positions(feed), ("match_id",))
    query = pipeline.start_log(pipeline.running_stats_stream(valid), f"{out}/log",
                               f"{out}/checkpoint", trigger="0 seconds")
    pipeline.drain(query)
    return f"{out}/log"


STATS_KEY = ["match_id", "sid", "intensity", "window_start_s"]


@query
def stream_running_stats_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunk feed over many triggers: in chunk order, nothing is too late."""
    path = _written_chunks(spark, sf_dir)
    log = _feed_log(spark, path, work_dir(spark, "stream-chunks"), 450)
    return _stats_columns(batchlog.read_batch_log(spark, log, STATS_KEY))


@query
def stream_resumed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feed, stopped in the first half and started again from its checkpoint."""
    path, out = _written_chunks(spark, sf_dir), work_dir(spark, "stream-resumed")
    _feed_log(spark, path, out, 600, last=1500)
    log = _feed_log(spark, path, out, 600)
    return _stats_columns(batchlog.read_batch_log(spark, log, STATS_KEY))


@query
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seventh of the samples comes three minutes late: closed windows do not take them."""
    path, out = work_dir(spark, "late-chunks"), work_dir(spark, "stream-late")
    rows = clean.with_chunk_id(fx.clean(spark, sf_dir))
    late = F.when(F.col("event_id") % 7 == 0, 180).otherwise(0)
    chunks.write_indexed_chunks(rows.withColumn("chunkId", F.col("chunkId") + late), path)
    return _stats_columns(batchlog.read_batch_log(
        spark, _feed_log(spark, path, out, 450), STATS_KEY))


@query
def stream_rolling_stats_60s(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = pipeline.second_stats_stream(fx.position_stream(spark, sf_dir))
    log = _drain(spark, stream, "stream-seconds")
    seconds = batchlog.read_batch_log(spark, log, ["match_id", "sid", "intensity", "second"])
    return running.rolling_frames(seconds).select(
        "match_id", "sid", "intensity", "second", r6("distance"), r6("time_s"))


@query
def stream_latest_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = pipeline.latest_stream(fx.position_stream(spark, sf_dir), fx.TIE)
    log = _drain(spark, stream, "stream-latest")
    return batchlog.read_batch_log(spark, log, ["match_id", "sid"]).select(
        "match_id", "sid", "ts", "x", "y", "z", "half", r9("matchSecond"), r9("speed_kmh"))


@query
def stream_heatmap_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    players = clean.without_balls(fx.position_stream(spark, sf_dir))
    log = _drain(spark, pipeline.heatmap_stream(players), "stream-heat")
    return batchlog.read_batch_log(spark, log, ["match_id", "sid", "grid_row", "grid_col"])


@query
def stream_momentum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five runs of one query, each from the checkpoint of the one before."""
    path, out = work_dir(spark, "momentum-input"), work_dir(spark, "stream-momentum")
    whole = materialise(tactics.momentum_raw(_state(spark, sf_dir)), "momentum-raw")
    step = MATCH.last_tick // 5 + 1
    for part in range(5):
        whole.where(F.floor(F.col("tick") / step) == part).write.mode("append").parquet(path)
        raw = spark.readStream.schema(whole.schema).parquet(path)
        with stateful.state_store(spark):
            pipeline.start_log(stateful.momentum_stream(raw), f"{out}/log", f"{out}/checkpoint",
                               "append").awaitTermination()
    return spark.read.parquet(f"{out}/log").select(
        "match_id", "tick", r9("current_second"), "momentum_a", "momentum_b")


def _live_table(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """One of the tables that one query over one scan of the chunk feed gives."""
    path, out = _written_chunks(spark, sf_dir), work_dir(spark, "stream-live")
    feed = chunks.read_chunk_feed(spark, path, 900, f"{out}/position")
    valid = clean.position_columns(clean.valid_positions(feed), ("match_id",))
    pipeline.drain(live.start_live(valid, f"{out}/log", f"{out}/checkpoint", "0 seconds"))
    return live.live_tables(spark, f"{out}/log")[kind]


@query
def stream_live_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _live_table(spark, sf_dir, "heatmap")


@query
def stream_live_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats_columns(_live_table(spark, sf_dir, "stats"))


@query
def stream_due_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "stream-due")
    step = pipeline.due_events_batch(_events(spark, sf_dir), f"{path}/clock", f"{path}/due")
    fx.position_stream(spark, sf_dir).writeStream.foreachBatch(step).option(
        "checkpointLocation", f"{path}/checkpoint").trigger(
        availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/due").select(
        "match_id", F.round("t", 6).alias("t"), F.round("second", 6).alias("second"), "kind",
        "subject", "msg")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return player_minute_zones(spark, sf_dir)
