"""Quality scores: random Fourier features of document statistics, ridge, calibration."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackspark.llm import ridge
from trackspark.llm.common import crc_part, map_rows, materialise, text_bytes

STATISTICS = ("log_bytes", "upper", "digits", "exclamations", "bars", "symbols", "stops",
              "non_ascii", "word_length", "unique_words", "repeats", "unique_lines", "lines",
              "top_word", "capitals", "long_words")
#: Random features, width of the Gaussian kernel over standardised statistics, ridge penalty.
FEATURES, SIGMA, PENALTY = 128, 3.0, 1e-4
THRESHOLD = 0.7
SEED = 7


def statistics(text: bytes) -> list[float]:
    """The STATISTICS of a whole text; all zero but for ratios of an empty one."""
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words, lines = text.split(), text.split(b"\n")
    n, letters = len(words) + 1, count[65:91].sum() + count[97:123].sum() + 1
    common = Counter(words)
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        np.log1p(len(text)), count[65:91].sum() / letters, count[48:58].sum() / (len(text) + 1),
        count[33] / n, count[124] / n, count[[35, 36, 37, 38, 42, 64, 94, 126]].sum() / n,
        count[[44, 46, 58, 59, 63]].sum() / n, count[128:].sum() / (len(text) + 1),
        len(text) / n, len(common) / n, same / n, len(set(lines)) / len(lines),
        np.log1p(len(lines)), max(common.values(), default=0) / n,
        sum(w[:1].isupper() for w in words) / n, sum(len(w) > 20 for w in words) / n]


def features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, f): the statistics of each row; null texts are empty."""
    def run(batch: pa.RecordBatch) -> dict:
        rows = [statistics(t) for t in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0), "f": pa.array(rows, pa.list_(pa.float64()))}

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(text).alias("text"))
    return map_rows(rows, "doc_id long, f array<double>", run)


def quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``.

    Statistics are standardised over all documents. Null and empty texts are scored like any
    other; null labels and those of unknown ids teach nothing; without labels all scores are
    near one half. Rows that repeat an id teach each.
    """
    rows = features(docs, doc_id, text).withColumn("held_out", crc_part("doc_id", 4) == 2)
    rows = materialise(rows, "statistics")
    width = len(STATISTICS)
    stats = rows.agg(*[g(F.get("f", F.lit(j))).alias(f"{n}{j}") for j in range(width)
                       for n, g in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = np.array([stats[f"m{j}"] or 0.0 for j in range(width)])
    scale = np.maximum([stats[f"s{j}"] or 0.0 for j in range(width)], 1e-6)
    random = np.random.default_rng(SEED)
    directions = random.normal(0, 1 / SIGMA, (width, FEATURES))
    phase = random.uniform(0, 2 * np.pi, FEATURES)

    def expand(x: np.ndarray) -> np.ndarray:
        x = np.clip((x - mean) / scale, -5, 5)
        return np.cos(x @ directions + phase) * np.sqrt(2 / FEATURES)

    return ridge.learned(rows, labels, "quality", width, expand, FEATURES, PENALTY, THRESHOLD)
