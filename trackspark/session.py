"""Session builder and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def build_session(app_name: str = "trackspark", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Session with UTC clock and AQE on. Anything the cluster sets stays as it is."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="trackspark-")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written tables and stream checkpoints.

    Lies under ``spark.checkpoint.dir`` (shared storage on a cluster). Only a local
    master may fall back to a temporary folder of this machine.
    """
    base = _run_folder.get() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = _local_dir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession, name: str = "run") -> Iterator[str]:
    """All work folders made inside lie in one folder, which is removed at the end.

    Results that read them must be written or fetched inside, and streams stopped. Outside of
    it, work folders stay until the owner of ``spark.checkpoint.dir`` removes them.
    """
    path = work_dir(spark, name)
    before = _run_folder.set(path)
    try:
        yield path
    finally:
        _run_folder.reset(before)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a result that several later steps read, and go on from the written table.

    The table is in the shared folder, so a lost executor costs a re-read, not a recompute.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
