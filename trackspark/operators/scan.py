"""Ordered prefix scans that never put a whole key into one task.

A plain window over ``partitionBy(keys)`` sorts all rows of a key in one task, which fails when
one key holds a third of the data. Here every key is cut into buckets along the order column.
Windows run per (key, bucket); one summary row per bucket carries the result across buckets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Prefix:
    """One running value: ``how`` is ``last`` (non-null), ``max`` or ``sum``."""

    name: str
    value: Column
    how: str
    inclusive: bool = False


_LOCAL = {
    "last": lambda c: F.last(c, ignorenulls=True),
    "max": F.max,
    "sum": F.sum,
}


def prefix_scan(df: DataFrame, keys: list[str], order: str, bucket: Column,
                prefixes: list[Prefix]) -> DataFrame:
    """Add each running value over the rows before (or up to) a row.

    Keys must not be null, ``order`` must be unique inside a key and ``bucket`` must not decrease
    along it.
    """
    cols = df.columns
    work = df.withColumns({"_b": bucket, **{f"_v_{p.name}": p.value for p in prefixes}})

    def summary(p: Prefix) -> Column:
        v = F.col(f"_v_{p.name}")
        if p.how == "last":
            return F.max_by(v, F.when(v.isNotNull(), F.col(order)))
        return _LOCAL[p.how](v)

    per_bucket = work.groupBy(*keys, "_b").agg(
        *[summary(p).alias(f"_s_{p.name}") for p in prefixes])
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_bucket.select(
        *keys, "_b",
        *[_LOCAL[p.how](F.col(f"_s_{p.name}")).over(earlier).alias(f"_c_{p.name}")
          for p in prefixes])

    def local(p: Prefix) -> Column:
        w = Window.partitionBy(*keys, "_b").orderBy(order).rowsBetween(
            Window.unboundedPreceding, 0 if p.inclusive else -1)
        return _LOCAL[p.how](F.col(f"_v_{p.name}")).over(w)

    scanned = work.withColumns({f"_l_{p.name}": local(p) for p in prefixes})

    def combined(p: Prefix) -> Column:
        here, before = F.col(f"_l_{p.name}"), F.col(f"_c_{p.name}")
        if p.how == "last":
            out = F.coalesce(here, before)
        elif p.how == "max":
            out = F.greatest(here, before)
        else:
            out = F.coalesce(here, F.lit(0.0)) + F.coalesce(before, F.lit(0.0))
        return out.alias(p.name)

    # same keys as the windows, so the rows are not shuffled again
    return scanned.join(carried, [*keys, "_b"], "left").select(
        *cols, *[combined(p) for p in prefixes])
