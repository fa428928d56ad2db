"""Connected components by alternating star operations on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackspark.llm.common import materialise


def _sum(edges: DataFrame) -> tuple:
    # one row to the driver: did the last round change anything?
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (u long, v long); root is its smallest member.

    Each half round joins the edges with one smallest neighbour per node, so no node's
    neighbours are gathered in one place; rounds are written to the shared folder, which
    cuts lineage. Edges are symmetric, repeated edges and loops do no harm, no edges give no
    rows.
    """
    edges = materialise(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _sum(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        large = materialise(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), "m")
                 .union(least.select("u", "m")).toDF("u", "v").distinct())
        edges = materialise(small, "small-star")
        after = _sum(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
