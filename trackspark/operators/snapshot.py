"""Latest and point-in-time positions, and their fusion into players, balls and officials."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackspark.config import MATCH, MatchConfig
from trackspark.functions.text import short_label
from trackspark.operators.ticks import cut_at_ticks, next_tick

STATE = ("ts", "x", "y", "z", "half", "matchSecond", "speed_kmh")


def newest(positions: DataFrame, keys: list[str], tie: tuple[str, ...] = ()) -> DataFrame:
    """Newest sample per key, combined on the map side; an older row never wins.

    Without tie columns all buffers are plain numbers, so Spark keeps a hash aggregate; rows with
    one time are then interchangeable. Tie columns make equal times exact at the price of a sort
    in each map task.
    """
    grouped = positions.groupBy(*keys)
    if not tie:
        values = [F.max_by(c, "ts").alias(c) for c in STATE if c != "ts"]
        return grouped.agg(F.max("ts").alias("ts"), *values)
    best = F.max_by(F.struct(*STATE), F.struct("ts", *tie))
    return grouped.agg(best.alias("p")).select(*keys, "p.*")


def latest_positions(positions: DataFrame, tie: tuple[str, ...] = ()) -> DataFrame:
    """Newest sample of every sensor."""
    return newest(positions, ["match_id", "sid"], tie)


def tick_samples(positions: DataFrame, tie: tuple[str, ...] = ()) -> DataFrame:
    """Newest sample per sensor and whole match second.

    This is the one shuffle of the raw volume, and the map side has already cut it to one row
    per (match, sensor, second) and task. All later steps see at most
    sensors x match seconds rows per match.
    """
    ticked = positions.withColumn("tick", F.floor("matchSecond").cast("int"))
    return newest(ticked, ["match_id", "sid", "tick"], tie)


def _spans(per_tick: DataFrame, last: Column) -> DataFrame:
    """``until``: the tick before each sensor's next sample, else the last one."""
    w = Window.partitionBy("match_id", "sid").orderBy("tick")
    until = F.coalesce(F.lead("tick").over(w) - 1, last)
    return per_tick.withColumn("until", until).where(F.col("until") >= F.col("tick"))


def _carry_forward(per_tick: DataFrame, last: Column, every: int | None = None) -> DataFrame:
    """Repeat each sensor's sample until its next one; a generator, not a join.

    With ``every`` only its multiples and the last tick are made.
    """
    ticks = F.sequence("tick", "until")
    if every is not None:
        first = (F.greatest(F.ceil(F.col("tick") / every), F.lit(1)) * every).cast("int")
        none = F.array().cast("array<int>")
        regular = F.when(first <= F.col("until"), F.sequence(first, "until", F.lit(every)))
        final = F.when(F.col("until") == last, F.array("until"))
        ticks = F.array_distinct(F.concat(F.coalesce(regular, none), F.coalesce(final, none)))
    return _spans(per_tick, last).select(
        "match_id", "sid", F.explode(ticks).alias("tick"), *STATE)


def snapshot(positions: DataFrame, tie: tuple[str, ...] = (), cfg: MatchConfig = MATCH,
             every: int | None = None) -> DataFrame:
    """State of all sensors at whole match seconds, old positions carried forward.

    A match ends with the regular clock or with its newest sample, whichever is later, so extra
    time is not cut. With ``every`` only multiples of it and the last second are kept. The result
    is laid out by (match_id, tick), which serves entity fusion and all per-tick operators after
    it.
    """
    per_tick = tick_samples(positions, tie)
    # both windows are served by one layout; a match has sensors x seconds rows at most here
    newest_tick = F.max("tick").over(Window.partitionBy("match_id"))
    per_tick = per_tick.withColumn("last", F.greatest(newest_tick, F.lit(cfg.last_tick)))
    return _carry_forward(per_tick, F.col("last"), every).repartition("match_id", "tick")


def snapshot_at(positions: DataFrame, ticks: DataFrame, tie: tuple[str, ...] = ()) -> DataFrame:
    """State of all sensors at given times (match_id, t), which may be fractional.

    Samples are reduced per second, cut at the ticks inside it, before they meet their ticks; a
    match has about sensors x seconds rows from there on.
    """
    w = Window.partitionBy("match_id").orderBy("t")
    numbered = ticks.select("match_id", "t").distinct().withColumn(
        "tick", F.row_number().over(w))
    cut = cut_at_ticks(positions, numbered, F.col("matchSecond"))
    reduced = newest(cut, ["match_id", "sid", "second", "part"], tie)
    mapped = next_tick(reduced, numbered, F.col("matchSecond"))
    per_tick = newest(mapped, ["match_id", "sid", "tick"])
    last = numbered.groupBy("match_id").agg(F.max("tick").alias("last_tick"))
    carried = _carry_forward(per_tick.join(last, "match_id"), F.col("last_tick"))
    return carried.join(numbered, ["match_id", "tick"])


def fuse(positions: DataFrame, dim: DataFrame, keys: tuple[str, ...] = ("match_id", "tick"),
         keep_unknown: bool = False) -> DataFrame:
    """One row per visible entity: foot sensors averaged, extra ones only without feet.

    ``n_raw``, ``half`` and ``matchSecond`` cover all sensors of the entity. Unknown sensors
    form a row without entity when ``keep_unknown`` is set.
    """
    joined = positions.join(dim, "sid", "left" if keep_unknown else "inner")
    feet = F.col("kind") == "feet"

    def pick(agg, value: Column) -> Column:
        return F.coalesce(agg(F.when(feet, value)), agg(F.when(~feet, value)))

    sensors = F.collect_list(F.struct("sensor_order", "sid", feet.alias("is_foot")))
    fused = joined.groupBy(*keys, "entity", "type", "team", "role", "roster_order").agg(
        pick(F.avg, F.col("x")).alias("x"),
        pick(F.avg, F.col("y")).alias("y"),
        pick(F.max, F.col("ts")).alias("ts"),
        pick(F.max, F.col("matchSecond")).alias("matchSecond"),
        pick(F.avg, F.coalesce("speed_kmh", F.lit(0.0))).alias("speed_kmh"),
        F.array_sort(sensors).alias("sensors"),
        F.count("*").alias("n_raw"),
        F.max("half").alias("half"),
        F.max("matchSecond").alias("raw_second"),
    )
    used = F.filter("sensors", lambda s: s["is_foot"])
    chosen = F.when(F.size(used) > 0, used).otherwise(F.col("sensors"))
    return fused.withColumn("sids", F.transform(chosen, lambda s: s["sid"])).drop("sensors")


def entities(positions: DataFrame, dim: DataFrame,
             keys: tuple[str, ...] = ("match_id", "tick")) -> DataFrame:
    """Public form of the fused entities."""
    return fuse(positions, dim, keys).select(
        *keys, "entity", short_label(F.col("entity")).alias("label"), "type", "team", "role",
        "roster_order", "x", "y", "ts", "matchSecond", "sids", "speed_kmh")


def current_state(latest: DataFrame) -> DataFrame:
    """Current match second and half of every match."""
    return latest.groupBy("match_id").agg(
        F.max("matchSecond").alias("currentMatchSecond"), F.max("half").alias("current_half"))


def trail(positions: DataFrame, dim: DataFrame, tie: tuple[str, ...] = (),
          cfg: MatchConfig = MATCH) -> DataFrame:
    """Entities at the newest ticks that have data, with the fade of all but the current one.

    Samples are read once, and are carried to the wanted ticks only.
    """
    match = Window.partitionBy("match_id")
    age = F.dense_rank().over(match.orderBy(F.desc("tick")))
    wanted = F.when(F.col("age") <= cfg.trail_ticks, F.struct(F.col("tick").alias("at"), "age"))
    per_tick = tick_samples(positions, tie).withColumn("age", age).withColumn(
        "recent", F.collect_set(wanted).over(match))
    spans = _spans(per_tick, F.element_at(F.array_sort("recent"), -1)["at"])
    hits = F.filter("recent", lambda r: r["at"].between(F.col("tick"), F.col("until")))
    n = F.size("recent").cast("bigint")
    at = spans.select("match_id", "sid", *STATE, n.alias("n"), F.explode(hits).alias("hit"))
    index = F.col("n") - F.col("hit.age") + 1
    fade = F.when(F.col("hit.age") > 1, index / F.col("n") * F.lit(0.7))
    at = at.select("match_id", "sid", *STATE, F.col("hit.at").alias("tick"),
                   index.alias("trail_index"), fade.alias("fade"))
    return entities(at, dim, ("match_id", "tick", "trail_index", "fade"))
