"""Numeric helpers: sanitising, clamping, rounding, distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(value: Column) -> Column:
    """The value as double; null where it is missing, not a number or infinite."""
    return F.when(is_finite(value), value.try_cast("double"))


def is_finite(value: Column) -> Column:
    """True for usable numbers. NaN sorts above infinity, so one comparison covers both."""
    return F.abs(value.try_cast("double")) < F.lit(float("inf"))


def clamp(value: Column, low: float, high: float) -> Column:
    """Hold a value inside [low, high]. Null gives ``high``, as ``least`` skips it."""
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def normalise(value: Column, low: float, high: float, top: float) -> Column:
    """Share of the way from ``low`` to ``high``, held inside [0, top]."""
    return clamp((value - F.lit(float(low))) / F.lit(float(high) - float(low)), 0.0, top)


def round_half_even(value: Column, digits: int) -> Column:
    """Round the exact binary value to ``digits`` places, ties to even.

    ``F.round`` and ``F.bround`` round the shortest decimal text of a double instead, which
    moves values such as 49.55 (binary 49.5499...) to the other side. The scaled value only
    decides wrongly when it lands on a half; then the error of the product settles it.
    """
    scale = float(10**digits)
    product = value * F.lit(scale)
    carry = value * F.lit(134217729.0)
    high = carry - (carry - value)
    error = (high * F.lit(scale) - product) + (value - high) * F.lit(scale)
    floor = F.floor(product).cast("double")
    tie = (product - floor) == F.lit(0.5)
    up = F.when(error == 0.0, F.pmod(floor, F.lit(2.0)) == 1.0).otherwise(error > 0.0)
    rounded = F.when(tie, floor + up.cast("int")).otherwise(F.rint(product))
    return rounded / F.lit(scale)


def distance_mm(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.hypot(x1 - x2, y1 - y2)


def distance_m(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    dx, dy = x1 - x2, y1 - y2
    return F.sqrt(dx * dx + dy * dy) / F.lit(1000.0)
