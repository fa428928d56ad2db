"""State by match and sensor: equal to the batch operators, over stops, and gone at the end."""

import gc
import random
import time
import weakref

import pandas as pd
import pytest
from pyspark.sql import functions as F

from test_streaming import SCHEMA, batch, rows
from trackspark.operators import clean, heatmap, running, snapshot, tactics
from trackspark.sources import readers
from trackspark.streaming import live, pipeline, stateful


def momentum_rows(spark, low, high, seed):
    rng = random.Random(seed)
    data = []
    for m in (1, 2):
        for tick in range(low, high):
            a = round(rng.uniform(0, 100), 1)
            data.append((m, tick, tick + 0.5, a, round(100 - a, 1)))
    return spark.createDataFrame(
        data, "match_id int, tick int, current_second double, momentum_a double, momentum_b double")


def drained(spark, df, tmp_path, build, mode, schema=SCHEMA):
    """One more file, one more run of the query from its checkpoint."""
    source, log, check = (str(tmp_path / n) for n in ("in", "log", "check"))
    df.coalesce(1).write.mode("append").parquet(source)
    with stateful.state_store(spark):
        stream = build(readers.read_position_stream(spark, source, schema=schema))
        pipeline.start_log(stream, log, check, mode).awaitTermination()
    return log, check


def test_momentum_over_stops_equals_batch_and_ends(spark, tmp_path):
    parts = [momentum_rows(spark, 40 * i, 40 * i + 40, i) for i in range(5)]
    for part in parts:
        log, check = drained(spark, part, tmp_path, stateful.momentum_stream, "append",
                             part.schema)
    drained(spark, parts[1], tmp_path, stateful.momentum_stream, "append", parts[1].schema)
    cols = ("match_id", "tick", "current_second", "momentum_a", "momentum_b")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    assert rows(spark.read.parquet(log), *cols) == rows(tactics.momentum_smoothed(whole), *cols)
    assert stateful.state_rows(spark, check, "last").count() == 2


def test_a_silent_match_leaves_no_momentum_state(spark, tmp_path):
    def build(stream):
        return stateful.momentum_stream(stream, idle_s=0.5)

    part = momentum_rows(spark, 0, 9, 1)
    _, check = drained(spark, part, tmp_path, build, "append", part.schema)
    assert stateful.state_rows(spark, check, "last").count() == 2
    time.sleep(1)
    drained(spark, part.withColumn("match_id", F.lit(3)), tmp_path, build, "append", part.schema)
    left = stateful.state_rows(spark, check, "last").select("key.*").collect()
    assert [r[0] for r in left] == [3]


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    tmp_path = tmp_path_factory.mktemp("live")
    parts = [batch(spark, i, i * 60, i * 60 + 60) for i in range(4)]
    for part in parts:
        log, check = drained(spark, part, tmp_path, stateful.live_stream, "update")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return tmp_path, whole, live.live_tables(spark, log), check


def test_one_pass_gives_all_three_tables(spark, run):
    _, whole, tables, _ = run
    cols = ("match_id", "sid", "ts", "x", "matchSecond")
    assert rows(tables["positions"], *cols) == rows(snapshot.latest_positions(whole), *cols)
    cols = ("match_id", "sid", "grid_row", "grid_col", "n")
    cells = heatmap.heatmap_cells(clean.without_balls(whole))
    assert rows(tables["heatmap"], *cols) == rows(cells, *cols)
    cols = ("match_id", "sid", "intensity", "window_start_s", "distance_1m", "ping_count", "time_1m")
    assert rows(tables["stats"], *cols) == rows(running.running_stats(whole), *cols)


def test_closed_windows_leave_the_state(spark, run):
    _, _, _, check = run
    assert stateful.state_rows(spark, check, "newest").count() == 8
    starts = stateful.state_rows(spark, check, "windows").select("user_map_key.window_start_s")
    assert {r[0] for r in starts.distinct().collect()} <= {180}


def test_silent_sensors_leave_no_state(spark, tmp_path):
    def build(stream):
        return stateful.live_stream(stream, idle_s=0.5)

    drained(spark, batch(spark, 1, 0, 60), tmp_path, build, "update")
    time.sleep(1)
    _, check = drained(spark, batch(spark, 2, 0, 60).withColumn("match_id", F.lit(9)), tmp_path,
                       build, "update")
    for variable in ("newest", "reached", "cells", "windows"):
        left = stateful.state_rows(spark, check, variable).select("key.match_id").distinct()
        assert [r[0] for r in left.collect()] in ([9], [] if variable == "windows" else [9])


def test_matches_one_after_the_other_lose_nothing(spark, tmp_path):
    parts = [batch(spark, 5, 3000, 3060).withColumn("match_id", F.lit(1)),
             batch(spark, 6, 0, 60).withColumn("match_id", F.lit(2))]
    for part in parts:
        log, _ = drained(spark, part, tmp_path, stateful.live_stream, "update")
    want = running.running_stats(parts[0].unionByName(parts[1]))
    cols = ("match_id", "sid", "intensity", "window_start_s", "ping_count")
    assert rows(live.live_tables(spark, log)["stats"], *cols) == rows(want, *cols)


def test_rows_of_closed_windows_and_older_samples_change_nothing(spark, tmp_path):
    for part in (batch(spark, 1, 100, 119), batch(spark, 2, 300, 310), batch(spark, 4, 311, 312),
                 batch(spark, 3, 100, 119)):
        log, _ = drained(spark, part, tmp_path, stateful.live_stream, "update")
    tables = live.live_tables(spark, log)
    open_ = tables["stats"].where("window_start_s = 60").agg(F.sum("ping_count")).first()[0]
    want = running.running_stats(batch(spark, 1, 100, 119)).agg(F.sum("ping_count")).first()[0]
    assert open_ == want
    assert tables["positions"].agg(F.min("matchSecond")).first()[0] >= 300


class Held:
    """Value and map states, and the clock, of one key."""

    def __init__(self):
        self.map = {}

    def getValueState(self, *_):
        return Held()

    getMapState = getValueState

    def getCurrentProcessingTimeInMs(self):
        return 0

    def registerTimer(self, at):
        pass

    def exists(self):
        return None in self.map

    def get(self):
        return self.map[None]

    def update(self, value):
        self.map[None] = value

    def containsKey(self, key):
        return key in self.map

    def getValue(self, key):
        return self.map[key]

    def updateValue(self, key, value):
        self.map[key] = value

    def keys(self):
        return list(self.map)

    def removeKey(self, key):
        del self.map[key]


def test_a_sensor_holds_one_frame_of_a_trigger_at_a_time():
    rng, alive, most = random.Random(1), [], []
    full = pd.DataFrame([
        {"match_id": 1, "sid": 7, "ts": rng.randrange(500), "x": float(i), "y": 0.0, "z": 0.0,
         "half": 1, "matchSecond": i / 10, "speed_kmh": 3.0, "tie": i, "grid_row": i % 3,
         "grid_col": 1 if i % 5 else None, "intensity": rng.choice(["low", "high", None]),
         "metres": 0.5, "window_start_s": i // 600 * 60} for i in range(2000)])

    def frames():
        for at in range(0, len(full), 100):
            frame = full[at:at + 100].reset_index(drop=True)
            alive.append(weakref.ref(frame))
            yield frame
            del frame
            gc.collect()
            most.append(sum(r() is not None for r in alive))

    sensor = stateful.LiveSensor(60.0, 120, 0.1, 7200.0)
    sensor.init(Held())
    out = pd.concat(sensor.handleInputRows((1, 7), frames(), Held()))
    assert max(most) <= 2  # the last one may still be bound
    first = full.sort_values(["ts", "tie"]).iloc[-1]
    assert out[out.kind == "positions"][["ts", "x"]].values.tolist() == [[first.ts, first.x]]
    heat = out[out.kind == "heatmap"]
    assert dict(zip(zip(heat.grid_row, heat.grid_col), heat.n)) == dict(
        full.groupby(["grid_row", "grid_col"]).size())
    stats = out[out.kind == "stats"]
    assert dict(zip(zip(stats.intensity, stats.window_start_s), stats.ping_count)) == dict(
        full.groupby(["intensity", "window_start_s"]).size())
    assert stats.distance_1m.sum() == full[full.intensity.notna()].metres.sum()
