"""Size checks that decide how a join side travels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 8 << 20


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS,
               max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast if rows and bytes prove it small, else leave it to shuffle.

    The measure stops after ``max_rows + 1`` rows. Use it for stored dimension tables only, not
    for results that are dear to compute twice.
    """
    rows = df.limit(max_rows + 1).select(
        F.octet_length(F.to_json(F.struct("*"))).cast("long").alias("size"))
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and size <= max_bytes else df
