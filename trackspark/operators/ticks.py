"""Mapping rows to evaluation times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackspark.config import MATCH, MatchConfig
from trackspark.operators.sizes import small_side


def minute_ticks(matches: DataFrame, every: int = 60, cfg: MatchConfig = MATCH) -> DataFrame:
    """(match_id, t): multiples of ``every`` and the last second, for each match.

    ``matches`` may name the last second of each match in ``last_tick``.
    """
    last = F.col("last_tick") if "last_tick" in matches.columns else F.lit(cfg.last_tick)
    ends = matches.groupBy("match_id").agg(F.max(last).cast("int").alias("last"))
    regular = F.when(F.col("last") >= every, F.sequence(F.lit(every), "last", F.lit(every)))
    points = F.array_distinct(F.concat(
        F.coalesce(regular, F.array().cast("array<int>")), F.array("last")))
    return ends.select(
        "match_id", F.explode(points.cast("array<double>")).alias("t"))


def next_tick(df: DataFrame, ticks: DataFrame, time: Column, width: float = 60.0) -> DataFrame:
    """Each row with the first tick not before its time; rows after the last tick drop.

    ``ticks`` has (match_id, t, ...). Rows and ticks are merged in time order inside buckets of
    ``width``; a bucket without a later tick takes the first one of the buckets after it. A row
    meets one tick, however far apart ticks lie. The merge runs from late to early, so that every
    frame grows row by row; one that ends with its partition is counted anew for each row.
    """
    tick = F.struct("t", *[c for c in ticks.columns if c not in ("match_id", "t")])
    rows = df.select("match_id", time.cast("double").alias("at"), F.lit(0).alias("is_tick"),
                     F.struct("*").alias("row"))
    marks = ticks.select("match_id", F.col("t").alias("at"), F.lit(1).alias("is_tick"),
                         tick.alias("tick"))
    both = rows.unionByName(marks, allowMissingColumns=True).where(
        F.col("at").isNotNull()).withColumn("b", F.floor(F.col("at") / width))
    later = Window.partitionBy("match_id").orderBy(F.desc("b")).rowsBetween(
        Window.unboundedPreceding, -1)
    firsts = both.groupBy("match_id", "b").agg(
        F.min_by("tick", F.when(F.col("is_tick") == 1, F.col("at"))).alias("first"))
    firsts = firsts.select("match_id", "b", F.last("first", ignorenulls=True).over(later).alias(
        "after"))
    own = Window.partitionBy("match_id", "b").orderBy(F.desc("at"), F.desc("is_tick")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("own", F.last("tick", ignorenulls=True).over(own)).where(
        "is_tick = 0").join(firsts, ["match_id", "b"])
    return found.select("row", F.coalesce("own", "after").alias("tick")).where(
        F.col("tick").isNotNull()).select("row.*", "tick.*")


def cut_at_ticks(df: DataFrame, ticks: DataFrame, time: Column) -> DataFrame:
    """Add ``second`` and ``part``: rows that agree in both have the same next tick.

    ``part`` counts the ticks of the row's second that lie before it, so rows can be reduced per
    second and part before they meet their ticks. Only seconds with ticks are joined.
    """
    second = F.floor(time).alias("second")
    inside = ticks.groupBy("match_id", F.floor("t").alias("second")).agg(
        F.collect_set("t").alias("_ticks"))
    rows = df.select("*", second).join(small_side(inside), ["match_id", "second"], "left")
    before = F.size(F.filter("_ticks", lambda t: t < time))
    return rows.withColumn("part", F.when(F.col("_ticks").isNull(), 0).otherwise(before)).drop(
        "_ticks")
