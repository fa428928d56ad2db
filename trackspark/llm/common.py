"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackspark.session import materialise

__all__ = ["crc_part", "map_rows", "materialise", "text_bytes"]


def text_bytes(column: str = "text") -> Column:
    """The whole text as UTF-8 bytes; null gives none."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def crc_part(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % parts


def map_rows(df: DataFrame, schema: str,
             fn: Callable[[pa.RecordBatch], dict[str, object]],
             split_bytes: int = 1 << 26) -> DataFrame:
    """``fn`` over Arrow batches, each cut so that its text stays near ``split_bytes``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = batch.num_rows
            if batch.nbytes > split_bytes:
                step = max(1, int(batch.num_rows * split_bytes / batch.nbytes))
            for at in range(0, batch.num_rows, step):
                out = fn(batch.slice(at, step))
                yield pa.RecordBatch.from_pydict(
                    {k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in out.items()})

    return df.mapInArrow(run, schema)


def popcount(words: np.ndarray) -> np.ndarray:
    """Set bits of each row of (n, w) unsigned words."""
    return np.bitwise_count(words).sum(axis=1, dtype=np.int16)
