"""Mixing sources to target weights with hash-threshold histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trackspark.llm.common import materialise

WORD = r"[^\x20\x09-\x0D]+"
#: Bits of the hash that one histogram sees, and how many follow one another. The lowest bits
#: tell rows apart that repeat id and text.
LEVEL_BITS, LEVELS, ROW_BITS = 12, 5, 24
MOST_COPIES = 2


def targets(sources: DataFrame, weights: Sequence[float], share: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code-point order, null last, get the weights in turn. The targets are a level
    times the weight, at most MOST_COPIES times the size: the level is where the sum is the
    share wanted. Sources by the level at which they are full; up to there all are full, the
    rest divides what is left, which is the end of resharing the excess again and again.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    each = F.array(*[F.lit(float(w)) for w in weights])
    rows = sources.withColumn("place", F.row_number().over(order) - 1).withColumn(
        "weight", F.get(each, (F.col("place") % len(weights)).cast("int")))
    rows = rows.withColumn("full", F.col("source_size") * float(MOST_COPIES)).withColumn(
        "full_at", F.col("full") / F.col("weight"))
    everything = W.partitionBy()
    upto = W.orderBy("full_at", "place").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.select(
        "*", (F.sum("source_size").over(everything) * float(share)).alias("wanted"),
        F.coalesce(F.sum("full").over(upto), F.lit(0.0)).alias("full_before"),
        (F.sum("weight").over(everything)
         - F.coalesce(F.sum("weight").over(upto), F.lit(0.0))).alias("weight_left"))
    level = (F.col("wanted") - F.col("full_before")) / F.col("weight_left")
    # the first source, in that order, that the level does not fill gives the level of all;
    # for those behind it, the quotient takes it as full and is lower
    rows = rows.withColumn("level", F.max(F.when(level <= F.col("full_at"), level)).over(everything))
    target = F.least(F.col("full"), F.coalesce(F.col("level") * F.col("weight"), F.col("full")))
    return rows.select("source", "source_size", target.alias("target"))


def _thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, pass, below): the hash bound whose rows have sizes that sum nearest the budget.

    One histogram over the upper hash bits finds the boundary bucket; only its rows are counted
    in the next one, over the bits below. After the last level the boundary bucket, a single row
    but for ties of all bits, is taken if that comes nearer.
    """
    open_ = budgets.select("source", "pass", "budget")
    for level in range(LEVELS):
        shift = 60 - LEVEL_BITS * (level + 1)
        bucket = F.shiftright("h", shift).alias("bucket")
        same = F.col("r.source").eqNullSafe(F.col("b.source"))
        if level:
            above = F.shiftright(F.col("r.h"), shift + LEVEL_BITS) == F.col("b.low")
            hist = rows.alias("r").join(open_.alias("b"), same & above).groupBy(
                F.col("b.source").alias("source"), "pass", "budget", bucket).agg(
                F.sum("r.size").alias("size"))
        else:
            sums = rows.groupBy("source", bucket).agg(F.sum("size").alias("size"))
            hist = sums.alias("r").join(open_.alias("b"), same).select(
                F.col("b.source").alias("source"), "pass", "budget", "bucket", "r.size")
        run = W.partitionBy("source", "pass").orderBy("bucket")
        hist = hist.withColumn("upto", F.sum("size").over(run))
        # the boundary: the first bucket that reaches the budget, else the last
        bound = hist.groupBy("source", "pass").agg(
            F.first("budget").alias("budget"),
            F.min_by(F.struct("bucket", "size", "upto"), F.when(
                F.col("upto") >= F.col("budget"), F.col("bucket"))).alias("reach"),
            F.max_by(F.struct("bucket", "size", "upto"), "bucket").alias("last"))
        bound = bound.withColumn("at", F.coalesce("reach", "last"))
        open_ = materialise(bound.select(
            "source", "pass",
            (F.col("budget") - F.col("at.upto") + F.col("at.size")).alias("budget"),
            F.col("at.bucket").alias("low"), F.col("at.size").alias("size")), "boundary")
    take = F.col("budget") * 2 > F.col("size")
    below = F.shiftleft(F.col("low") + F.when(take, 1).otherwise(0), 60 - LEVEL_BITS * LEVELS)
    return open_.select("source", "pass", below.alias("below"))


def _sized(doc_id: str, text: str, source: str) -> list:
    words = F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(WORD))
    same = F.shiftrightunsigned(F.xxhash64(F.col(doc_id), F.col(text)), 4 + ROW_BITS)
    row = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND((1 << ROW_BITS) - 1)
    return [F.col(source).cast("string").alias("source"), words.cast("long").alias("size"),
            F.shiftleft(same, ROW_BITS).bitwiseOR(row).alias("h")]


def _goals(rows: DataFrame, weights: Sequence[float], share: float) -> DataFrame:
    """(source, source_size, target, below1, below2) from the sized rows: one row per source."""
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = materialise(targets(sums, weights, share), "targets")
    first = F.least(F.col("target"), F.col("source_size").cast("double"))
    passes = F.array(F.struct(F.lit(1).alias("pass"), first.alias("budget")),
                     F.struct(F.lit(2).alias("pass"), (F.col("target") - first).alias("budget")))
    budgets = goal.where("source_size > 0").select("source", F.inline(passes))
    bounds = _thresholds(rows, budgets).groupBy("source").agg(
        F.max(F.when(F.col("pass") == 1, F.col("below"))).alias("below1"),
        F.max(F.when(F.col("pass") == 2, F.col("below"))).alias("below2"))
    return goal.alias("g").join(
        bounds.alias("b"), F.col("g.source").eqNullSafe(F.col("b.source")), "left").select(
        "g.*", "below1", "below2")


def _copies():
    return (F.col("h") < F.coalesce("below1", F.lit(0))).cast("int") + (
        F.col("h") < F.coalesce("below2", F.lit(0))).cast("int")


def mix(docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), share: float = 1.5,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, size, source_size, target, taken) for each row of ``docs``.

    size is the number of words; null and empty texts have none and are never taken. A target
    is met in up to two nested passes: the first takes rows whose hash lies below one bound,
    the second the part of them below a lower bound. The hash is of id and text, so reruns
    agree; of rows that are equal in both as many are taken as the target asks for, it does not
    matter which. The targets cannot be met closer than the size of a single row. An empty table
    gives no rows.
    """
    rows = materialise(docs.select(F.col(doc_id).alias("doc_id"),
                                   *_sized(doc_id, text, source)), "sized")
    goal = _goals(rows, weights, share)
    return rows.alias("r").join(
        goal.alias("g"), F.col("r.source").eqNullSafe(F.col("g.source"))).select(
        F.col("r.doc_id"), F.col("r.size"), "source_size", "target",
        (F.col("r.size") * _copies()).alias("taken"))


def mixed_rows(docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), share: float = 1.5,
               doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs``, as they are, each as often as mix() takes it.

    A filter by source and hash: the texts are neither sorted nor shuffled.
    """
    sized = _sized(doc_id, text, source)
    goal = _goals(materialise(docs.select(*sized), "sized"), weights, share)
    rows = docs.select(F.struct(*docs.columns).alias("doc"), *sized).alias("r")
    rows = rows.join(goal.alias("g"), F.col("r.source").eqNullSafe(F.col("g.source")))
    rows = rows.where((F.col("r.size") > 0) & (_copies() > 0))
    return rows.select("doc", F.explode(F.sequence(F.lit(1), _copies()))).select("doc.*")
