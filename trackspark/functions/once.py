"""Evaluating dear expressions once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``df.select(*keep, **columns)`` whose columns are evaluated once per row.

    The optimizer copies an expression into every filter and projection that uses its column,
    which multiplies the cost of parsing text. A generator over one struct is a border it does
    not move expressions across.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))
