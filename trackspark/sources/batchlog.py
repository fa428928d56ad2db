"""Keyed logs of streaming queries: a folder per batch, and now and then a base of all keys.

A batch owns its folder, so a retried one replaces itself. With ``keys`` every ``every``-th batch
also writes a base: the newest version of each key so far. A base counts once its commit marker
is there. Reads take the newest base and the batches after it, so they cost as much as there are
keys and recent changes, however long the query has run. Batches that two bases cover are
removed; readers that still use the base before find theirs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVERY = 64
BASES, MARKER = "_base", "_SUCCESS"


def _folder(spark: SparkSession, path: str) -> tuple:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the folders ``name=`` below a path."""
    fs, folder = _folder(spark, path)
    if not fs.exists(folder):
        return []
    found = (f.getPath().getName().split("=") for f in fs.listStatus(folder))
    return sorted(int(x[1]) for x in found if x[0] == name and len(x) == 2)


def _bases(spark: SparkSession, path: str) -> list[int]:
    out = []
    for upto in _numbers(spark, f"{path}/{BASES}", "upto"):
        fs, marker = _folder(spark, f"{path}/{BASES}/upto={upto}/{MARKER}")
        if fs.exists(marker):
            out.append(upto)
    return out


def newest_batch(spark: SparkSession, path: str) -> int:
    """Number of the last batch, from the names of folders."""
    return max([*_numbers(spark, path, "batch_id"), *_bases(spark, path)])


def _versions(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """Rows of the newest base and of the batches after it, with their ``batch_id``."""
    base = max((b for b in _bases(spark, path) if upto is None or b < upto), default=-1)
    batches = [n for n in _numbers(spark, path, "batch_id")
               if n > base and (upto is None or n <= upto)]
    rows = None
    if batches:
        rows = spark.read.option("basePath", path).parquet(
            *[f"{path}/batch_id={n}" for n in batches])
        rows = rows.withColumn("batch_id", F.col("batch_id").cast("long"))
    if base < 0:
        return spark.read.parquet(path) if rows is None else rows
    held = spark.read.parquet(f"{path}/{BASES}/upto={base}")
    return held if rows is None else held.unionByName(rows)


def _newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    values: list[Column] = [F.col(c) for c in rows.columns if c not in (*keys, "batch_id")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("v"),
                                   F.max("batch_id").alias("batch_id"))


def batch_log(path: str, shape: Callable[[DataFrame], DataFrame] | None = None,
              keys: Sequence[str] | None = None, every: int = EVERY
              ) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer of a log; with ``keys`` it is compacted."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch if shape is None else shape(batch)
        out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        if keys and batch_id % every == every - 1:
            compact(batch.sparkSession, path, keys, batch_id)

    return write


def compact(spark: SparkSession, path: str, keys: Sequence[str], upto: int) -> None:
    """Write the base of all batches up to ``upto``, then remove what two bases cover."""
    before = [b for b in _bases(spark, path) if b < upto]
    _newest(_versions(spark, path, upto), keys).select(*keys, "v.*", "batch_id").write.mode(
        "overwrite").parquet(f"{path}/{BASES}/upto={upto}")
    if before:
        covered = [f"{path}/batch_id={n}" for n in _numbers(spark, path, "batch_id")
                   if n <= before[-1]] + [f"{path}/{BASES}/upto={b}" for b in before[:-1]]
        for folder in covered:
            fs, gone = _folder(spark, folder)
            fs.delete(gone, True)


def read_batch_log(spark: SparkSession, path: str, keys: Sequence[str],
                   only: dict[str, str] | None = None) -> DataFrame:
    """Newest version of every key; ``only`` names columns and the value they must have."""
    rows = _versions(spark, path)
    for column, value in (only or {}).items():
        rows = rows.where(F.col(column) == value)
    return _newest(rows, keys).select(*keys, "v.*")
