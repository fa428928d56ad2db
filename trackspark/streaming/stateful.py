"""Keyed state that ends: one scan gives positions, heatmap and statistics; matches leave no state.

State lies in the state store by match and sensor, and each key goes by its own clock: matches may
be played one after the other or side by side. A timer ends a key: when no row of it came for
``idle_s``, or for ``OVER_S`` after the last second of a match, all that is held for it goes.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from trackspark.config import MATCH, MatchConfig
from trackspark.functions.numbers import is_finite
from trackspark.functions.zones import distance_increment, intensity, is_ball
from trackspark.operators.heatmap import cell_index, check_grid
from trackspark.operators.tactics import smoother

# processors travel with the query, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

POSITION = ("ts", "x", "y", "z", "half", "matchSecond", "speed_kmh")
LIVE_DDL = (
    "kind string, match_id int, sid int, ts long, x double, y double, z double, half int, "
    "matchSecond double, speed_kmh double, grid_row int, grid_col int, n long, "
    "intensity string, window_start_s long, distance_1m double, ping_count long, time_1m double")
#: Kinds of rows, the columns that tell one from another and those that follow.
KINDS = {
    "positions": (("match_id", "sid"), POSITION),
    "heatmap": (("match_id", "sid", "grid_row", "grid_col"), ("n",)),
    "stats": (("match_id", "sid", "intensity", "window_start_s"),
              ("distance_1m", "ping_count", "time_1m")),
}
_COLUMNS = [part.split()[0] for part in LIVE_DDL.split(", ")]

#: Seconds by the clock after which a key without rows ends, in general and after a match's end.
IDLE_S, OVER_S = 3600, 60
_CONF = {
    # the store that knows timers
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # timers are looked at in batches with rows, so a drained query can stop
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in the store that knows timers."""
    before = {key: spark.conf.get(key, None) for key in _CONF}
    for key, value in _CONF.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


class _Ending(StatefulProcessor):
    """Keeps one timer per key, by the clock of the machines."""

    idle_s: float

    def init(self, handle) -> None:
        self.handle = handle
        self.ends = handle.getValueState("ends", "at long")

    def _lives_for(self, seconds: float, timer_values) -> None:
        if self.ends.exists():
            self.handle.deleteTimer(self.ends.get()[0])
        at = timer_values.getCurrentProcessingTimeInMs() + int(seconds * 1000)
        self.handle.registerTimer(at)
        self.ends.update((at,))

    def _forget(self) -> None:
        raise NotImplementedError

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._forget()
        self.ends.clear()
        return iter(())

    def close(self) -> None:
        pass


def _folded(rows: Iterator[pd.DataFrame], reached: float) -> tuple[
        pd.DataFrame, float, dict[tuple[int, int], int], dict[tuple[str, int], tuple[float, int]]]:
    """(newest sample, second reached, cell counts, window sums) of the rows of one key.

    Frames are taken one by one, so what is held does not grow with their number.
    """
    last: pd.DataFrame | None = None
    counts: Counter[tuple[int, int]] = Counter()
    sums: dict[tuple[str, int], tuple[float, int]] = {}
    for pdf in rows:
        newest = pdf.sort_values(["ts", "tie"]).iloc[[-1]]
        last = newest if last is None else pd.concat([last, newest], ignore_index=True
                                                     ).sort_values(["ts", "tie"]).iloc[[-1]]
        reached = max(reached, float(pdf["matchSecond"].max()))
        for (row, col), n in pdf.groupby(["grid_row", "grid_col"]).size().items():
            counts[int(row), int(col)] += int(n)
        timed = pdf[pdf["intensity"].notna()].groupby(["intensity", "window_start_s"])
        for (zone, start), metres, pings in timed["metres"].agg(["sum", "size"]).itertuples():
            m, p = sums.get((zone, int(start)), (0.0, 0))
            sums[zone, int(start)] = m + float(metres), p + int(pings)
    return last, reached, counts, sums


class LiveSensor(_Ending):
    """State of one sensor: newest sample, cell counts, sums of open windows.

    A window is closed once the sensor has a sample ``delay_s`` after its end.
    """

    def __init__(self, idle_s: float, delay_s: int, sample_s: float, end_s: float,
                 window_s: int = 60):
        self.idle_s, self.delay_s, self.end_s = idle_s, delay_s, end_s
        self.sample_s, self.window_s = sample_s, window_s

    def init(self, handle) -> None:
        super().init(handle)
        self.newest = handle.getValueState(
            "newest", "tie long, ts long, x double, y double, z double, half int, "
            "matchSecond double, speed_kmh double")
        self.reached = handle.getValueState("reached", "second double")
        self.cells = handle.getMapState("cells", "grid_row int, grid_col int", "n long")
        self.windows = handle.getMapState("windows", "intensity string, window_start_s long",
                                          "metres double, pings long")

    def _forget(self) -> None:
        for state in (self.newest, self.reached, self.cells, self.windows):
            state.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        out: list[dict] = []
        both = {"match_id": key[0], "sid": key[1]}
        before = self.reached.get()[0] if self.reached.exists() else float("-inf")
        last, now, counts, sums = _folded(rows, before)

        first = last.iloc[-1]
        held = self.newest.get() if self.newest.exists() else None
        if held is None or (held[1], held[0]) < (int(first["ts"]), int(first["tie"])):
            held = (int(first["tie"]), int(first["ts"]),
                    *(None if pd.isna(first[c]) else first[c].item() for c in POSITION[1:]))
            self.newest.update(held)
            out.append(both | {"kind": "positions"} | dict(zip(POSITION, held[1:], strict=True)))

        for cell, n in sorted(counts.items()):
            n += self.cells.getValue(cell)[0] if self.cells.containsKey(cell) else 0
            self.cells.updateValue(cell, (n,))
            out.append(both | {"kind": "heatmap", "grid_row": cell[0], "grid_col": cell[1], "n": n})

        # as with a watermark, rows of this batch close windows for the next one
        closed = before - self.delay_s
        for at, (metres, pings) in sorted(sums.items()):
            if at[1] + self.window_s <= closed:
                continue
            if self.windows.containsKey(at):
                m, p = self.windows.getValue(at)
                metres, pings = metres + m, pings + p
            self.windows.updateValue(at, (metres, pings))
            out.append(both | {
                "kind": "stats", "intensity": at[0], "window_start_s": at[1],
                "distance_1m": metres, "ping_count": pings,
                "time_1m": pings * self.sample_s})
        for at in [k for k in self.windows.keys()
                   if k[1] + self.window_s <= now - self.delay_s]:
            self.windows.removeKey(at)
        self.reached.update((now,))
        self._lives_for(OVER_S if now >= self.end_s else self.idle_s, timerValues)
        # plain objects, so that whole numbers with gaps stay whole
        yield pd.DataFrame({c: pd.Series([r.get(c) for r in out], dtype=object)
                            for c in _COLUMNS})


def live_stream(valid: DataFrame, tie: str | None = None, cfg: MatchConfig = MATCH,
                idle_s: float = IDLE_S) -> DataFrame:
    """Rows of all KINDS, told apart by ``kind``, from one pass over a valid stream."""
    check_grid(cfg)
    ball = is_ball(F.col("sid"))
    usable = ~ball & is_finite(F.col("x")) & is_finite(F.col("y"))
    timed = F.col("ts").isNotNull() & F.col("matchSecond").isNotNull()
    rows = valid.where(F.col("sid").isNotNull() & timed).select(
        F.col("match_id").cast("int"), "sid", "ts",
        *[F.col(c).cast("double") for c in ("x", "y", "z")], "half", "matchSecond", "speed_kmh",
        (F.lit(0) if tie is None else F.col(tie)).cast("long").alias("tie"),
        F.when(usable, cell_index(F.col("y").cast("double"), cfg.y_min, cfg.y_max,
                                  cfg.heat_rows, cfg)).alias("grid_row"),
        F.when(usable, cell_index(F.col("x").cast("double"), cfg.x_min, cfg.x_max,
                                  cfg.heat_cols, cfg)).alias("grid_col"),
        F.when(~ball, intensity(F.col("speed_kmh"), cfg)).alias("intensity"),
        F.coalesce(distance_increment(F.col("speed_kmh"), cfg.player_sample_s), F.lit(0.0)
                   ).alias("metres"),
        (F.floor(F.col("matchSecond") / 60) * 60).cast("long").alias("window_start_s"))
    delay = int(cfg.watermark.split()[0])
    return rows.groupBy("match_id", "sid").transformWithStateInPandas(
        LiveSensor(idle_s, delay, cfg.player_sample_s, cfg.match_seconds), LIVE_DDL, "Update",
        "ProcessingTime")


class Momentum(_Ending):
    """State of one match: last tick, its second and the smoothed values."""

    def __init__(self, alpha: float, last_tick: int, idle_s: float):
        self.step, self.last_tick, self.idle_s = smoother(alpha), last_tick, idle_s

    def init(self, handle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "tick int, second double, a double, b double")

    def _forget(self) -> None:
        self.last.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows)).sort_values("tick")
        tick, second, *pair = self.last.get() if self.last.exists() else (-1, None, None, None)
        values = None if second is None else tuple(pair)
        out = []
        for now, at, *raw in pdf[["tick", "current_second", "momentum_a",
                                  "momentum_b"]].itertuples(index=False):
            if now <= tick or pd.isna(at) or at == second:
                continue
            values = self.step(values, tuple(raw))
            tick, second = int(now), float(at)
            out.append((key[0], tick, second, *values))
        if values is not None:
            self.last.update((tick, second, *values))
            self._lives_for(OVER_S if tick >= self.last_tick else self.idle_s, timerValues)
        yield pd.DataFrame(out, columns=["match_id", "tick", "current_second", "momentum_a",
                                         "momentum_b"])


def momentum_stream(raw: DataFrame, cfg: MatchConfig = MATCH, idle_s: float = IDLE_S
                    ) -> DataFrame:
    """Smoothed momentum per match from a stream of raw per-tick values."""
    key = raw.schema["match_id"].dataType.simpleString()
    narrow = raw.select("match_id", "tick", "current_second", "momentum_a", "momentum_b")
    return narrow.groupBy("match_id").transformWithStateInPandas(
        Momentum(cfg.momentum_alpha, cfg.last_tick, idle_s),
        f"match_id {key}, tick int, current_second double, momentum_a double, momentum_b double",
        "Append", "ProcessingTime")


def state_rows(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    """What a stopped query still holds of one state variable."""
    with state_store(spark):
        return spark.read.format("statestore").option("stateVarName", variable).load(checkpoint)
