"""Language ID by compression with per-language raw-content dictionaries."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trackspark.llm.common import crc_part, map_rows

#: Bound of the labelled sample: passages per language, and characters of each. Only the
#: dictionaries are made from it; every text is read whole.
PASSAGES, PASSAGE_CHARS = 400, 240
#: Bytes that are compressed at once, so that a dictionary counts along the whole text.
CHUNK = 4096
LEVEL = 12
#: Relative distance of the two smallest sizes below which a text is rejected, and that with
#: score one half.
NARROW, HALF = 0.003, 0.02
UNKNOWN = "und"
_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """Lower-case letters, all else as single blanks."""
    return _OTHER.sub(" ", text.lower()).strip().encode()


class Model:
    """Compressors primed with the dictionaries."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self._models = []
        for name, content in dictionaries.items():
            raw = zstandard.ZstdCompressionDict(
                content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=LEVEL)
            self._models.append((name, zstandard.ZstdCompressor(
                level=LEVEL, dict_data=raw, write_content_size=False, write_dict_id=False)))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected)"""
        if not any(map(str.isalpha, text or "")) or not self._models:
            return UNKNOWN, 0.0, True
        data = letters(text)
        chunks = [data[i:i + CHUNK] for i in range(0, len(data), CHUNK)]
        sizes = sorted((sum(len(m.compress(c)) for c in chunks), n) for n, m in self._models)
        if len(sizes) < 2:
            return sizes[0][1], 1.0, False
        margin = (sizes[1][0] - sizes[0][0]) / sizes[1][0]
        return sizes[0][1], margin / (margin + HALF), margin < NARROW


def learn(docs: DataFrame, learn_from, doc_id: str = "doc_id", text: str = "text",
          lang: str = "lang") -> dict[str, bytes]:
    """A dictionary per language: passages of the documents with the smallest id hashes.

    Passages start at a place that the hash gives. At most PASSAGES times PASSAGE_CHARS
    characters of each language reach the driver. Rows of one id give one passage; the text
    stands for an id that is null.
    """
    h = F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.col(text)), F.lit("passage"))
    start = F.pmod(h, F.greatest(F.length(text) - PASSAGE_CHARS, F.lit(1))) + 1
    rows = docs.where(learn_from & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    rows = rows.select(F.col(lang).alias("lang"), h.alias("h"), F.substring(
        F.col(text), start.cast("int"), F.lit(PASSAGE_CHARS)).alias("passage"))
    # only hashes that can be among the smallest are ranked, four times as many as are needed
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()
    if not sizes:
        return {}
    share = F.element_at(F.create_map(*[F.lit(x) for r in sizes for x in (
        r["lang"], min(1.0, 4 * PASSAGES / r["n"]))]), F.col("lang"))
    rows = rows.where((F.col("h") + float(1 << 63)) / float(1 << 64) <= share)
    rows = rows.groupBy("lang", "h").agg(F.min("passage").alias("passage"))
    place = F.row_number().over(W.partitionBy("lang").orderBy("h"))
    rows = rows.withColumn("place", place).where(F.col("place") <= PASSAGES)
    found: dict[str, list[tuple[int, str]]] = {}
    for r in rows.collect():
        found.setdefault(r["lang"], []).append((r["place"], r["passage"]))
    return {k: b" ".join(letters(p) for _, p in sorted(found[k])) for k in sorted(found)}


def identify(docs: DataFrame, dictionaries: dict[str, bytes], doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for each row of ``docs``.

    The language whose dictionary leaves the fewest bytes wins, the smaller name in a tie.
    score grows with the relative distance m to the next one: m / (m + HALF). Texts that are
    null, empty or without a letter are UNKNOWN with score 0, and so are all if nothing was
    learned. They, and texts with a margin below NARROW, are rejected; with one language only
    there is no margin and nothing else is rejected.
    """
    def run(batch: pa.RecordBatch) -> dict:
        model = Model(dictionaries)
        found = [model.predict(value) for value in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0), "lang_pred": [f[0] for f in found],
                "score": [f[1] for f in found], "rejected": [f[2] for f in found]}

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.col(text).cast("string").alias("text"))
    return map_rows(rows, "doc_id long, lang_pred string, score double, rejected boolean", run)


def accepted(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text") -> DataFrame:
    """The rows of ``docs`` that identify() does not reject, as they are."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(dictionaries)
        for batch in batches:
            yield batch.filter(pa.array(
                [not model.predict(v.as_py())[2] for v in batch.column(place)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def language(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             lang: str = "lang") -> DataFrame:
    """identify() with what three quarters of the ids teach, and ``held_out`` for the rest."""
    held = crc_part(doc_id, 4) == 2
    found = identify(docs, learn(docs, ~held, doc_id, text, lang), doc_id, text)
    return found.select("doc_id", (crc_part("doc_id", 4) == 2).alias("held_out"), "lang_pred",
                        "score", "rejected")
