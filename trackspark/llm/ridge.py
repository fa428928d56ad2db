"""Ridge scores from partition-summed normal equations, and isotonic calibration."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Raw scores are counted in this many equal bins over this range for calibration.
BINS, RANGE = 4096, (-1.0, 2.0)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.nan_to_num(flat.reshape(-1, width))


def fit(rows: DataFrame, width: int, expand: Callable[[np.ndarray], np.ndarray], terms: int,
        penalty: float) -> np.ndarray:
    """Weights (bias first) for 0/1 labels from (f array of ``width`` numbers, y).

    Each task sums the outer products of its rows, Spark sums those of the tasks: (terms + 2)
    rows of as many numbers reach the driver, whatever the table. Classes weigh alike. Without
    rows of both classes all weights but the bias, 0.5 or the only class, are zero.
    """
    size = terms + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, size, size))
        for batch in batches:
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
            x = expand(matrix(batch.column(0), width))
            z = np.column_stack([np.ones(len(y)), x, y])
            for k in (0, 1):
                total[k] += z[y == k].T @ z[y == k]
        yield pa.RecordBatch.from_pydict({
            "k": np.repeat([0, 1], size), "i": np.tile(np.arange(size), 2),
            "row": pa.array(list(total.reshape(-1, size)), pa.list_(pa.float64()))})

    sums = rows.select("f", F.col("y").cast("double")).mapInArrow(
        run, "k long, i long, row array<double>")
    sums = sums.groupBy("k", "i").agg(*[F.sum(F.get("row", F.lit(j))).alias(f"s{j}")
                                        for j in range(size)])
    both = np.zeros((2, size, size))
    for r in sums.collect():
        both[r["k"], r["i"]] = r[2:]
    counts = both[:, 0, 0]
    weights = np.zeros(terms + 1)
    if not counts.all():
        weights[0] = 0.5 if not counts.any() else float(counts[1] > 0)
        return weights
    mean = sum(both[k] / counts[k] / 2 for k in (0, 1))
    ridge = np.eye(terms + 1) * penalty
    ridge[0, 0] = 0
    return np.linalg.solve(mean[:-1, :-1] + ridge, mean[:-1, -1])


def score(rows: DataFrame, keep: list[str], width: int,
          expand: Callable[[np.ndarray], np.ndarray], weights: np.ndarray) -> DataFrame:
    """``keep`` columns and raw double from (f)."""
    types = dict(rows.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in keep) + ", raw double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = expand(matrix(batch.column(len(keep)), width))
            raw = weights[0] + x @ weights[1:]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(raw)], [*keep, "raw"])

    return rows.select(*keep, "f").mapInArrow(run, schema)


def isotonic(scored: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Points of the rising step function from raw to the share of label 1, from (raw, y).

    Pooled adjacent violators over BINS counts, with one row and one half before the first to
    keep from 0 and 1; no rows give the identity.
    """
    low, high = RANGE
    at = F.floor((F.col("raw") - low) / (high - low) * BINS)
    rows = (scored.select(F.greatest(F.least(at, F.lit(BINS - 1)), F.lit(0)).alias("bin"), "y")
            .groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("ones"))
            .orderBy("bin").collect())
    if not rows:
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    blocks: list[list[float]] = []
    for r in rows:
        blocks.append([float(r["n"]), float(r["ones"]), float(r["bin"]), float(r["bin"])])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n, ones, _, last = blocks.pop()
            blocks[-1][0] += n
            blocks[-1][1] += ones
            blocks[-1][3] = last
    x, y = [], []
    for n, ones, first, last in blocks:
        for b in {first, last}:
            x.append(low + (b + 0.5) / BINS * (high - low))
            y.append((ones + 0.5) / (n + 1))
    order = np.argsort(x)
    return np.array(x)[order], np.maximum.accumulate(np.array(y)[order])


def calibrated(raw: np.ndarray, points: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Scores from 0 to 1; a trace of the raw score keeps the order inside a level."""
    low, high = RANGE
    trace = (np.clip(raw, low, high) - low) / (high - low)
    return np.clip(0.999 * np.interp(raw, *points) + 0.001 * trace, 0.0, 1.0)


def calibrate(rows: DataFrame, points: tuple[np.ndarray, np.ndarray], doc_id: str,
              held_out: str, threshold: float) -> DataFrame:
    """(doc_id, held_out, score, predicted) from (doc_id, held_out, raw)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = calibrated(batch.column(2).to_numpy(zero_copy_only=False), points)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(value),
                 pa.array((value >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return rows.select(F.col(doc_id), F.col(held_out), "raw").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")


def one_label(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, y) of each id that has one label, 0 or 1, and no other."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min(label).cast("int").alias("y"), F.max(label).cast("int").alias("most"))
    return known.where("y = most").select("doc_id", "y")


def learned(features: DataFrame, labels: DataFrame, label: str, width: int,
            expand: Callable[[np.ndarray], np.ndarray], terms: int, penalty: float,
            threshold: float) -> DataFrame:
    """(doc_id, held_out, score, predicted) from features (doc_id, held_out, f) and labels.

    Only rows that are not held out teach, in the fit and in the calibration. A label that repeats
    counts once; an id whose labels contradict each other teaches nothing.
    """
    known = one_label(labels, label)
    teach = features.where(~F.col("held_out")).join(known, "doc_id")
    weights = fit(teach, width, expand, terms, penalty)
    points = isotonic(score(teach, ["y"], width, expand, weights))
    raw = score(features, ["doc_id", "held_out"], width, expand, weights)
    return calibrate(raw, points, "doc_id", "held_out", threshold)
