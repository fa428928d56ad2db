"""Visit heatmaps: cell counts, Gaussian smoothing, selections.

Smoothing is linear, so samples are first counted per cell and only the counts are spread over
the kernel: the fan-out falls on at most rows x columns cells per sensor, never on samples.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackspark.config import MATCH, MatchConfig
from trackspark.functions.once import computed_once
from trackspark.functions.numbers import is_finite, normalise
from trackspark.functions.pitch import cell_centre, pitch_x, pitch_y


def check_grid(cfg: MatchConfig) -> None:
    if cfg.x_min >= cfg.x_max:
        raise ValueError("x_min must be below x_max")
    if cfg.y_min >= cfg.y_max:
        raise ValueError("y_min must be below y_max")
    if cfg.heat_cols <= 0 or cfg.heat_rows <= 0:
        raise ValueError("the grid needs at least one column and one row")
    if cfg.kernel_radius < 0:
        raise ValueError("the kernel radius must not be negative")
    if cfg.kernel_sigma <= 0:
        raise ValueError("the kernel sigma must be positive")


def cell_index(value: Column, low: float, high: float, cells: int,
               cfg: MatchConfig = MATCH) -> Column:
    """Index of the cell holding a coordinate; outside values go to the border cells."""
    share = normalise(value, low, high, cfg.grid_clamp)
    return F.floor(share * F.lit(cells)).cast("int")


def heatmap_cells(positions: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    """Sample counts per sensor and cell. Unusable coordinates are left out."""
    check_grid(cfg)
    usable = positions.where(
        F.col("sid").isNotNull() & is_finite(F.col("x")) & is_finite(F.col("y"))
    ).select("match_id", "sid", F.col("x").cast("double"), F.col("y").cast("double"))
    return usable.groupBy(
        "match_id", "sid",
        cell_index(F.col("y"), cfg.y_min, cfg.y_max, cfg.heat_rows, cfg).alias("grid_row"),
        cell_index(F.col("x"), cfg.x_min, cfg.x_max, cfg.heat_cols, cfg).alias("grid_col"),
    ).agg(F.count("*").alias("n"))


def kernel(cfg: MatchConfig = MATCH) -> list[tuple[int, int, float]]:
    """(row offset, column offset, weight) of the Gaussian, at most (2 radius + 1)^2 entries."""
    r, spread = cfg.kernel_radius, 2.0 * cfg.kernel_sigma * cfg.kernel_sigma
    points = [(i, j, math.exp(-(i * i + j * j) / spread))
              for i in range(-r, r + 1) for j in range(-r, r + 1)]
    return [p for p in points if p[2] >= cfg.kernel_min_weight]


def smooth(cells: DataFrame, by: tuple[str, ...] = ("match_id", "sid"),
           cfg: MatchConfig = MATCH) -> DataFrame:
    """Spread cell counts with the Gaussian kernel; weight beyond the border is lost.

    The kernel is a literal array in the plan, so spreading is a generator and not a join.
    """
    check_grid(cfg)
    points = F.array(*[F.struct(F.lit(i).alias("dr"), F.lit(j).alias("dc"), F.lit(w).alias("w"))
                       for i, j, w in kernel(cfg)])
    spread = cells.select(*by, "grid_row", "grid_col", "n", F.inline(points))
    placed = spread.select(
        *by, (F.col("grid_row") + F.col("dr")).alias("grid_row"),
        (F.col("grid_col") + F.col("dc")).alias("grid_col"),
        (F.col("n") * F.col("w")).alias("part"),
    ).where(
        F.col("grid_row").between(0, cfg.heat_rows - 1)
        & F.col("grid_col").between(0, cfg.heat_cols - 1))
    return placed.groupBy(*by, "grid_row", "grid_col").agg(F.sum("part").alias("value"))


def by_selection(cells: DataFrame, selections: DataFrame) -> DataFrame:
    """Cell counts of each focus (all players, one team, one player)."""
    return cells.join(selections, "sid").groupBy(
        "match_id", "selection", "grid_row", "grid_col").agg(F.sum("n").alias("n"))


def zmax(smoothed: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    """Robust colour maximum per selection: the value at 95 % of the sorted positive cells.

    A selection has at most rows x columns values, so sorting them as an array is bounded.
    """
    positive = smoothed.where(F.col("value") > 0).groupBy("match_id", "selection").agg(
        F.sort_array(F.collect_list("value")).alias("v"))
    index = F.floor((F.size("v") - 1) * F.lit(cfg.zmax_percentile)).cast("int")
    return positive.select(
        "match_id", "selection", F.greatest(F.lit(1.0), F.get("v", index)).alias("zmax"))


def with_centres(cells: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    """Raw cell centres and their display coordinates."""
    x = cell_centre(F.col("grid_col"), cfg.heat_centre_x, cfg.heat_cols)
    y = cell_centre(F.col("grid_row"), cfg.heat_centre_y, cfg.heat_rows)
    return cells.withColumns({
        "centre_x": x, "centre_y": y,
        "display_x": pitch_x(y, cfg, cfg.heat_offset_x),
        "display_y": pitch_y(x, cfg, cfg.heat_offset_y),
    })


def dense_grid(smoothed: DataFrame, by: tuple[str, ...] = ("match_id", "sid"),
               cfg: MatchConfig = MATCH) -> DataFrame:
    """``array<array<double>>`` of rows and columns, zeros where nothing was seen."""
    def filled(df: DataFrame, keys: tuple[str, ...], index: str, n: int, value: str,
               empty: Column, name: str) -> DataFrame:
        entries = df.groupBy(*keys).agg(F.collect_list(F.struct(index, value)).alias("entries"))
        rows = computed_once(entries, list(keys), known=F.map_from_entries("entries"))
        return rows.select(*keys, F.transform(
            F.sequence(F.lit(0), F.lit(n - 1)),
            lambda i: F.coalesce(F.try_element_at("known", i), empty)).alias(name))

    zeros = F.array_repeat(F.lit(0.0), cfg.heat_cols)
    rows = filled(smoothed, (*by, "grid_row"), "grid_col", cfg.heat_cols, "value", F.lit(0.0),
                  "cells")
    return filled(rows, by, "grid_row", cfg.heat_rows, "cells", zeros, "grid")
