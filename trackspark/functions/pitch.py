"""Display coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trackspark.config import MATCH, MatchConfig


def pitch_x(y: Column, cfg: MatchConfig = MATCH, offset: float | None = None) -> Column:
    """Horizontal display coordinate, taken from the raw y axis."""
    return y * F.lit(cfg.pitch_scale_x) + F.lit(cfg.pitch_offset_x if offset is None else offset)


def pitch_y(x: Column, cfg: MatchConfig = MATCH, offset: float | None = None) -> Column:
    """Vertical display coordinate, taken from the raw x axis."""
    return x * F.lit(cfg.pitch_scale_y) + F.lit(cfg.pitch_offset_y if offset is None else offset)


def cell_centre(index: Column, bounds: tuple[int, int], cells: int) -> Column:
    low, high = bounds
    return F.lit(float(low)) + (index + F.lit(0.5)) * F.lit((high - low) / cells)
