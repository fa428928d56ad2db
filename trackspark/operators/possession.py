"""Possession from merged intervals: who holds the ball, resolved timeline, time on ball.

Intervals may have any length. The first and the last time bucket of an interval are pieces of
their own; the whole buckets between them are covered by dyadic nodes, at most two per level, so
an interval gives no more rows than twice the logarithm of its length. Inside a bucket each
probe meets the active *players*, not all pieces: a window carries every player's last one
forward. Of the nodes a probe looks up one per level. No set of all pairs is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackspark.config import LOOSE_BALL, MATCH, TEAM_A, TEAM_B, MatchConfig
from trackspark.functions.text import duration_text

BUCKET_S = 60.0


def _bucket(time: str, width: float) -> Column:
    return F.floor(F.col(time) / width)


def _pieces(merged: DataFrame, width: float) -> DataFrame:
    """First and last bucket of each interval; ``start_s`` stays the start of the whole."""
    ends = F.array_distinct(F.array(_bucket("start_s", width), _bucket("end_s", width)))
    cut = merged.select("match_id", "player", "start_s", "end_s", F.explode(ends).alias("b"))
    return cut.select(
        "match_id", "b", "player", "start_s",
        F.greatest(F.col("start_s"), F.col("b") * width).alias("from_s"),
        F.least(F.col("end_s"), (F.col("b") + 1) * width).alias("to_s"),
    ).where(F.col("to_s") > F.col("from_s"))


def _nodes(merged: DataFrame, width: float) -> DataFrame:
    """(match_id, level, node, player, start_s): the whole buckets inside each interval.

    A node of level k holds 2^k buckets. On a level at most the outermost nodes to the left and
    to the right of the range are not part of a larger one.
    """
    spans = merged.select(
        "match_id", "player", "start_s", (_bucket("start_s", width) + 1).alias("lo"),
        _bucket("end_s", width).alias("hi")).where("hi > lo")
    levels = F.sequence(F.lit(0), F.ceil(F.log2(F.col("hi") - F.col("lo") + 1)).cast("int"))
    at = spans.select("match_id", "player", "start_s", "lo", "hi", F.explode(levels).alias("level"))
    at = at.withColumns({"lo": F.expr("-shiftright(-lo, level)"),  # rounded up
                         "hi": F.expr("shiftright(hi, level)")}).where("lo < hi")
    outer = F.array(F.when(F.expr("lo % 2 <> 0"), F.col("lo")),
                    F.when(F.expr("hi % 2 <> 0"), F.col("hi") - 1))
    return at.select("match_id", "level", F.explode(F.array_compact(outer)).alias("node"),
                     "player", "start_s")


def _held_in_bucket(pieces: DataFrame, probes: DataFrame) -> DataFrame:
    extra = [c for c in probes.columns if c not in ("match_id", "b", "t")]
    payload = F.struct("t", *extra).alias("probe")
    players = pieces.select("match_id", "b", "player").distinct()
    asks = probes.join(players, ["match_id", "b"]).select(
        "match_id", "b", "player", "t", F.lit(1).alias("is_probe"), payload,
        F.lit(None).cast("double").alias("start_s"), F.lit(None).cast("double").alias("to_s"))
    probe_type = asks.schema["probe"].dataType
    gives = pieces.select(
        "match_id", "b", "player", F.col("from_s").alias("t"), F.lit(0).alias("is_probe"),
        F.lit(None).cast(probe_type).alias("probe"), "start_s", "to_s")
    w = Window.partitionBy("match_id", "b", "player").orderBy("t", "is_probe").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    seen = asks.unionByName(gives).withColumns({
        "held_from": F.last("start_s", ignorenulls=True).over(w),
        "held_to": F.last("to_s", ignorenulls=True).over(w),
    })
    return seen.where((F.col("is_probe") == 1) & (F.col("held_to") > F.col("t"))).select(
        "match_id", "player", F.col("held_from").alias("start_s"), "probe.*")


def _held_at(merged: DataFrame, probes: DataFrame, width: float) -> DataFrame:
    """For each probe (match_id, t, ...) one row per player whose interval covers ``t``.

    A player's intervals do not overlap, so a probe finds a player in its bucket or on one level.
    """
    probes = probes.withColumn("b", _bucket("t", width))
    near = _held_in_bucket(_pieces(merged, width), probes)
    nodes = _nodes(merged, width)
    # the levels a match has are few, most often none
    asks = probes.join(nodes.select("match_id", "level").distinct(), "match_id").withColumn(
        "node", F.expr("shiftright(b, level)"))
    far = asks.join(nodes, ["match_id", "level", "node"]).select(near.columns)
    return near.unionByName(far)


def current_possessors(merged: DataFrame, ticks: DataFrame, width: float = BUCKET_S) -> DataFrame:
    """Players whose interval covers the tick (start <= t < end) and started last, ties kept."""
    held = _held_at(merged, ticks.select("match_id", "t"), width)
    w = Window.partitionBy("match_id", "t").orderBy(F.desc("start_s"))
    return held.withColumn("_r", F.rank().over(w)).where(F.col("_r") == 1).select(
        "match_id", "t", "player", "start_s")


def possession_timeline(merged: DataFrame, players: DataFrame,
                        width: float = BUCKET_S) -> DataFrame:
    """Elementary segments with one holder each: the interval that started last wins.

    Equal starts go to the roster order, then to the name. Segments end at every interval
    border, the next one may lie many buckets on.
    """
    edges = merged.select("match_id", F.explode(F.array("start_s", "end_s")).alias("t")
                          ).distinct().withColumn("b", _bucket("t", width))
    firsts = edges.groupBy("match_id", "b").agg(F.min("t").alias("first"))
    firsts = firsts.select("match_id", "b", F.lead("first").over(
        Window.partitionBy("match_id").orderBy("b")).alias("first_after"))
    after = F.lead("t").over(Window.partitionBy("match_id", "b").orderBy("t"))
    segments = edges.withColumn("after", after).join(firsts, ["match_id", "b"]).select(
        "match_id", "t", F.coalesce("after", "first_after").alias("right_s")
    ).where(F.col("right_s").isNotNull())
    held = _held_at(merged, segments, width).join(
        players.select("player", "roster_order"), "player", "left")
    rank = F.struct(F.col("start_s"), -F.coalesce("roster_order", F.lit(1 << 20)))
    ordered = held.groupBy("match_id", "t", "right_s", rank.alias("k")).agg(
        F.min("player").alias("player"))
    return ordered.groupBy("match_id", "t", "right_s").agg(
        F.max_by("player", "k").alias("player")).select(
        "match_id", F.col("t").alias("left_s"), "right_s", "player")


def _held_until(timeline: DataFrame, probes: DataFrame, width: float) -> DataFrame:
    """Seconds each player held the ball from match start to each probe (match_id, t).

    Buckets before the probe come from per-bucket sums; the bucket of the probe is summed up to
    it. A segment counts to the bucket of its start with all its length; what of the last one
    lies beyond the probe is taken off again.
    """
    seg = timeline.select(
        "match_id", "player", _bucket("left_s", width).alias("b"),
        F.col("left_s").alias("t"), (F.col("right_s") - F.col("left_s")).alias("len"), "right_s")
    points = probes.select("match_id", "t").distinct().withColumn("b", _bucket("t", width))
    totals = seg.groupBy("match_id", "player", "b").agg(
        F.sum("len").alias("len"), F.max("right_s").alias("right_s"))

    # one row per (player, bucket) that has play or a probe
    players = totals.select("match_id", "player").distinct()
    grid = points.select("match_id", "b").distinct().join(players, "match_id")
    before = Window.partitionBy("match_id", "player").orderBy("b").rowsBetween(
        Window.unboundedPreceding, -1)
    null = F.lit(None).cast("double")
    per_bucket = totals.unionByName(
        grid.withColumns({"len": F.lit(0.0), "right_s": null})).groupBy(
        "match_id", "player", "b").agg(
        F.sum("len").alias("len"), F.max("right_s").alias("right_s")).withColumns({
            "base": F.coalesce(F.sum("len").over(before), F.lit(0.0)),
            "base_right": F.max("right_s").over(before)})

    asks = points.join(per_bucket.select("match_id", "player", "b", "base", "base_right"),
                       ["match_id", "b"])
    rows = asks.select("match_id", "player", "b", "t", "base", F.lit(1).alias("is_probe"),
                       F.lit(0.0).alias("len"), F.col("base_right").alias("right_s")).unionByName(
        seg.select("match_id", "player", "b", "t", null.alias("base"),
                   F.lit(0).alias("is_probe"), "len", "right_s"))
    w = Window.partitionBy("match_id", "b", "player").orderBy("t", "is_probe").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    overhang = F.greatest(F.lit(0.0), F.max("right_s").over(w) - F.col("t"))
    return rows.withColumn(
        "held", F.col("base") + F.sum("len").over(w) - F.coalesce(overhang, F.lit(0.0))
    ).where(F.col("is_probe") == 1).select("match_id", "player", "t", "held")


def time_on_ball(timeline: DataFrame, ticks: DataFrame, window_s: float | None = None,
                 width: float = BUCKET_S) -> DataFrame:
    """Seconds on the ball per player up to each tick, or in the ``window_s`` before it."""
    until = ticks.select("match_id", "t").distinct()
    if window_s is None:
        return _held_until(timeline, until, width).where(F.col("held") > 1e-9).select(
            "match_id", "t", "player", F.col("held").alias("seconds"))
    low = F.greatest(F.lit(0.0), F.col("t") - F.lit(float(window_s)))
    signed = until.select("match_id", F.col("t").alias("tick"), F.explode(F.array(
        F.struct(F.col("t").alias("t"), F.lit(1.0).alias("sign")),
        F.struct(low.alias("t"), F.lit(-1.0).alias("sign")))).alias("p")
        ).select("match_id", "tick", "p.*")
    held = _held_until(timeline, signed, width)
    return held.join(signed, ["match_id", "t"]).groupBy("match_id", "tick", "player").agg(
        F.sum(F.col("held") * F.col("sign")).alias("seconds")).where(
        F.col("seconds") > 1e-9).select("match_id", F.col("tick").alias("t"), "player", "seconds")


def time_on_ball_topk(seconds: DataFrame, players: DataFrame, k: int = 5) -> DataFrame:
    """Leaderboard per tick; ties by name."""
    w = Window.partitionBy("match_id", "t").orderBy(F.desc(F.round("seconds", 6)), "player")
    ranked = seconds.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.join(players.select("player", "team"), "player", "left").select(
        "match_id", "t", "rank", "player", F.coalesce("team", F.lit("")).alias("team"),
        "seconds", duration_text(F.col("seconds")).alias("duration"))


def team_possession(seconds: DataFrame, ticks: DataFrame, players: DataFrame,
                    window_s: float | None = None) -> DataFrame:
    """Seconds of both teams and the loose-ball rest; unknown players count to no team."""
    known = seconds.join(players.select("player", "team"), "player", "left")
    sums = known.groupBy("match_id", "t").agg(
        F.sum(F.when(F.col("team") == TEAM_A, F.col("seconds"))).alias("a"),
        F.sum(F.when(F.col("team") == TEAM_B, F.col("seconds"))).alias("b"))
    low = F.lit(0.0) if window_s is None else F.greatest(
        F.lit(0.0), F.col("t") - F.lit(float(window_s)))
    a, b = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("a", "b"))
    rows = ticks.select("match_id", "t").distinct().join(sums, ["match_id", "t"], "left")
    loose = F.greatest(F.lit(0.0), F.greatest(F.lit(0.0), F.col("t") - low) - a - b)
    teams = F.array(*[F.struct(F.lit(n).alias("team"), v.alias("seconds"))
                      for n, v in ((TEAM_A, a), (TEAM_B, b), (LOOSE_BALL, loose))])
    return rows.select("match_id", "t", F.inline(teams))


def possession_share(team_seconds: DataFrame) -> DataFrame:
    """Positive categories and their part of the total."""
    w = Window.partitionBy("match_id", "t")
    return team_seconds.where(F.col("seconds") > 0).withColumn(
        "share", F.col("seconds") / F.sum("seconds").over(w))


def possession_agreement(possessors: DataFrame, estimate: DataFrame) -> DataFrame:
    """Compare the metadata holder with the tracking estimate at each tick.

    A verdict needs exactly one metadata holder and an estimated one.
    """
    official = possessors.groupBy("match_id", "t").agg(
        F.count("*").alias("n_official"), F.min("player").alias("official"))
    est = estimate.select("match_id", F.col("tick").cast("double").alias("t"), "possessor")
    verdict = (
        F.when(F.coalesce("n_official", F.lit(0)) != 1, "no verdict")
        .when(F.col("possessor") == F.col("official"), "agree")
        .when(F.col("possessor").isNotNull(), "differ")
        .otherwise("no verdict")
    )
    return official.join(est, ["match_id", "t"], "full").select(
        "match_id", "t", F.coalesce("n_official", F.lit(0)).alias("n_official"),
        F.when(F.col("n_official") == 1, F.col("official")).alias("official"),
        "possessor", verdict.alias("verdict"))
