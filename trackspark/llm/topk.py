"""Exact top-k inner products with block-at-a-time pruning."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trackspark.llm.common import map_rows, materialise

#: Vectors of one range and queries of one block, i.e. of one task at a time.
RANGE, QUERY_BLOCK = 8192, 4096
#: Vectors of a block with common term maxima, and centres by which a range is ordered.
BLOCK, CENTRES = 64, 32
SCALE = 256.0


def quantised(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vec): floor(256 x) of each component as 64-bit integers.

    Rows without id, and vectors that are null or hold null or non-finite components, take no
    part. An empty vector scores 0 with all.
    """
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.where(F.col(vec_id).isNotNull() & x.isNotNull() & ~bad).select(
        F.col(vec_id).cast("long").alias("vec_id"), x.cast("array<double>").alias("x"))

    def run(batch: pa.RecordBatch) -> dict:
        column = batch.column(1)
        flat = np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE).astype("<i8")
        ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
        vecs = [flat[b - n:b].tobytes() for b, n in
                zip(ends, np.diff(np.r_[0, ends]), strict=True)]
        return {"vec_id": batch.column(0), "vec": pa.array(vecs, pa.binary())}

    return map_rows(rows, "vec_id long, vec binary", run)


def _matrix(vecs: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vecs), width), np.int64)
    for i, v in enumerate(vecs):
        row = np.frombuffer(v, "<i8")
        out[i, :len(row)] = row
    return out


def _ordered(docs: np.ndarray) -> np.ndarray:
    """An order in which neighbours are alike: by the nearest of a few members."""
    centres = docs[np.linspace(0, len(docs) - 1, min(CENTRES, len(docs))).astype(int)]
    return np.argsort((docs @ centres.T).argmax(axis=1), kind="stable")


def search(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, docs: np.ndarray,
           k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query_id, vec_id, score) of the k best rows per query, ties to the smaller id.

    Each dimension is two terms, x and -x; a block's bound is the sum of the maxima of the terms
    a query has, weighted by it. Blocks go by falling bound, and a query stops at the first
    bound below its k-th score; an equal bound may still hold a smaller id.
    """
    big = int(np.abs(queries).max(initial=0)) * int(np.abs(docs).max(initial=0))
    kind = np.float64 if big * max(docs.shape[1], 1) < 1 << 52 else np.int64
    queries, docs = queries.astype(kind), docs.astype(kind)
    order = np.lexsort((ids, np.zeros(len(ids))))
    ids, docs = ids[order], docs[order]
    order = _ordered(docs)
    ids, docs = ids[order], docs[order]
    starts = np.arange(0, len(ids), BLOCK)
    most, least = np.maximum.reduceat(docs, starts), np.minimum.reduceat(docs, starts)
    bounds = np.maximum(queries, 0) @ most.T + np.minimum(queries, 0) @ least.T
    rounds = np.argsort(-bounds, axis=1, kind="stable")
    low, none = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    best_score = np.full((len(queries), k), low)
    best_id = np.full((len(queries), k), none)
    active = np.arange(len(queries))
    for r in range(len(starts)):
        block = rounds[active, r]
        alive = bounds[active, block] >= best_score[active, -1]
        active, block = active[alive], block[alive]
        if not len(active):
            break
        by = np.argsort(block, kind="stable")
        cut = np.flatnonzero(np.r_[True, np.diff(block[by]) != 0])
        for rows in np.split(by, cut[1:]):
            q, at = active[rows], starts[block[rows[0]]]
            own = ids[at:at + BLOCK]
            score = (queries[q] @ docs[at:at + BLOCK].T).astype(np.int64)
            score[own[None, :] == query_ids[q][:, None]] = low
            score = np.concatenate([best_score[q], score], axis=1)
            vec = np.concatenate([best_id[q], np.broadcast_to(own, (len(q), len(own)))], axis=1)
            top = np.lexsort((vec, -score.astype(np.float64) if kind is np.float64
                              else np.negative(np.maximum(score, low + 1))), axis=1)[:, :k]
            best_score[q] = np.take_along_axis(score, top, axis=1)
            best_id[q] = np.take_along_axis(vec, top, axis=1)
    real = best_score > low
    return np.repeat(query_ids, real.sum(axis=1)), best_id[real], best_score[real]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``vectors`` for each of ``queries``.

    Both as quantised() gives them; a row with the query's id is its own and no candidate. Of
    query rows that repeat an id, one counts; repeated candidate rows count each. Vectors are
    dealt into ranges of about RANGE rows by hash, queries into blocks; each pair of a range and
    a block is one group of bounded size, whatever the table. Shorter vectors end in zeros.
    """
    queries = queries.groupBy("vec_id").agg(F.min("vec").alias("vec"))
    n, m = vectors.count(), queries.count()
    ranges, blocks = -(-n // RANGE) or 1, -(-m // QUERY_BLOCK) or 1
    range_of = F.pmod(F.xxhash64("vec_id", "vec"), F.lit(ranges))
    block_of = F.pmod(F.xxhash64("vec_id", F.lit("query")), F.lit(blocks))
    left = vectors.select("vec_id", "vec", range_of.alias("range"), F.explode(
        F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")).alias("block"))
    right = queries.select("vec_id", "vec", block_of.alias("block"), F.explode(
        F.sequence(F.lit(0), F.lit(ranges - 1)).cast("array<long>")).alias("range"))

    def run(docs: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if not len(docs) or not len(asked):
            return pd.DataFrame({c: np.empty(0, np.int64) for c in names})
        width = max(docs.vec.map(len).max(), asked.vec.map(len).max()) // 8
        found = search(asked.vec_id.to_numpy(), _matrix(asked.vec, width),
                       docs.vec_id.to_numpy(), _matrix(docs.vec, width), k)
        return pd.DataFrame(dict(zip(names, found, strict=True)))

    found = left.groupBy("range", "block").cogroup(right.groupBy("range", "block")).applyInPandas(
        run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, vec_id: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """top_k() of the rows whose id is divisible by ``every`` against all rows."""
    rows = materialise(quantised(vectors, vec_id, vector), "vectors")
    return top_k(rows, rows.where(F.col("vec_id") % every == 0), k)
