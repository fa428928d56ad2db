"""Alignment of two tokenizers over a corpus by merge-path partitioning.

The ends of A's and of B's tokens over the same bytes are two sorted lists. Merging them walks
a path through their grid; binary searches along its diagonals cut the path into pieces of
equal length, each of which is merged without knowledge of the others, wherever one text ends
and the next begins. A piece gives the ends both lists hold; an end that a cut divides is put
together afterwards. Ends that both hold cut the tokens into groups.

Neither vocabulary has a token that holds a space behind a character that is none, so a text may
be cut at single spaces between such characters and each part encoded alone. Each different part of a
batch is encoded, merged and written once, whatever its number of copies.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.llm.common import map_rows, materialise

TOKENIZERS = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Ends that one piece of the merge holds.
PIECE = 1 << 16
#: Pairs whose counts are sent to all tasks, the most frequent ones (16 bytes each).
MOST_PAIRS = 1 << 21
#: Bytes of text whose parts are told apart at once.
FLUSH = 1 << 22
#: Parts that are encoded at once, and parts whose tokens a task remembers.
ENCODE, REMEMBERED = 1 << 12, 1 << 16

_CUT = re.compile(r"(?<=\S) (?=\S)")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def byte_alphabet() -> dict[str, int]:
    """Byte of each character in which byte-level vocabularies are written."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, a: bytes, b: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        self.a = Tokenizer.from_str(a.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        known = byte_alphabet()
        special = {t["content"] for t in json.loads(a).get("added_tokens", [])}
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = token.encode() if token in special else bytes(map(known.get, token))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(m[1], 16)]) if (m := _BYTE_PIECE.fullmatch(p))
                        else p.replace("▁", " ").encode() for p in pieces]
        # a token may hold a space behind other white space, where no text is cut
        self.known: dict[str, tuple[array, array] | None] = {}
        self.divisible = (not any("▁" in p.lstrip("▁") for p in pieces)
                          and not any(re.search(r"\S ", t.decode(errors="replace"))
                                  for t in self.bytes_a))

    def parts(self, text: str) -> list[str]:
        """The text between the single spaces that no token spans."""
        return _CUT.split(text) if self.divisible else [text]

    def _by_a(self, parts: list[str]) -> list[list[int]]:
        """A's ids of parts that neither start nor end with white space.

        They are encoded as one text, which is cheaper, and cut at the spaces between them.
        """
        whole = " " + " ".join(parts)
        ids = self.a.encode_batch_fast([whole], add_special_tokens=False)[0].ids
        upto = np.cumsum([len(self.bytes_a[i]) for i in ids])
        ends = np.cumsum([len(p.encode()) + 1 for p in parts])
        at = np.searchsorted(upto, ends, "right").tolist()
        return [ids[s:e] for s, e in zip([0, *at], at, strict=False)]

    def encode(self, parts: list[str]) -> list[tuple[array, array] | None]:
        """Both tokenizers' ids; none where one does not give back the bytes."""
        new = [p for p in parts if p not in self.known]
        bound = [p for p in new if self.divisible and not p[0].isspace() and not p[-1].isspace()]
        ids = dict(zip(bound, self._by_a(bound), strict=True)) if bound else {}
        rest = [p for p in new if p not in ids]
        if rest:
            found = self.a.encode_batch_fast([" " + p for p in rest], add_special_tokens=False)
            ids |= {p: e.ids for p, e in zip(rest, found, strict=True)}
        out = {}
        for part, ys in zip(new, self.b.encode(new, num_threads=1), strict=True):
            xs, own = ids[part], b" " + part.encode()
            same = (b"".join([self.bytes_a[x] for x in xs]) == own
                    and b"".join([self.bytes_b[y] for y in ys]) == own)
            out[part] = (array("i", xs), array("i", ys)) if same else None
        tokens = [out[p] if p in out else self.known[p] for p in parts]
        if len(self.known) < REMEMBERED:
            self.known |= out
        return tokens


def merge_path(a: np.ndarray, b: np.ndarray, piece: int) -> np.ndarray:
    """(pieces + 1, 2) places in ``a`` and ``b`` where the merge is cut; of equal ends A's go first.

    The cut of diagonal d is the point (i, d - i) with a[i - 1] <= b[d - i] and
    b[d - i - 1] < a[i], found for all diagonals at once.
    """
    d = np.minimum(np.arange(0, len(a) + len(b) + piece, piece), len(a) + len(b))
    low, high = np.maximum(d - len(b), 0), np.minimum(d, len(a))
    while (open_ := low < high).any():
        mid = (low[open_] + high[open_]) // 2
        before = a[mid] <= b[d[open_] - mid - 1]
        low[open_] = np.where(before, mid + 1, low[open_])
        high[open_] = np.where(before, high[open_], mid)
    return np.stack([low, d - low], axis=1)


def shared_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> np.ndarray:
    """(k, 2) places of the ends that both strictly rising lists hold."""
    cuts = merge_path(a, b, piece)
    found = []
    for (i0, j0), (i1, j1) in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if i0 and j0 < j1 and a[i0 - 1] == b[j0]:  # the cut before this piece parts a pair
            found.append(np.array([[i0 - 1, j0]]))
        own, other = a[i0:i1], b[j0:j1]
        if len(own) and len(other):
            at = np.searchsorted(other, own)
            i = np.flatnonzero(other[np.minimum(at, len(other) - 1)] == own)
            found.append(np.stack([i0 + i, j0 + at[i]], axis=1))
    return np.concatenate(found) if found else np.empty((0, 2), np.int64)


@dataclass
class Aligned:
    """Different parts of a batch; -1 tokens where the tokenizers do not give back the text."""

    n_a: np.ndarray
    n_b: np.ndarray
    #: part, A id and B id of each link, by part
    part: np.ndarray
    a: np.ndarray
    b: np.ndarray
    #: ids of all tokens and the shared ends among them
    ids: tuple[np.ndarray, np.ndarray]
    shared: np.ndarray

    def keys(self) -> np.ndarray:
        return self.a.astype(np.int64) << 32 | self.b

    def keys_at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the links of the parts at some places, and how many each place has."""
        per_part = np.bincount(self.part, minlength=len(self.n_a))
        first, n = np.cumsum(per_part) - per_part, per_part[places]
        at = np.repeat(first[places] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return self.keys()[at], n

    def texts(self) -> list[bytes]:
        """Groups of each part as text, with a semicolon behind the last."""
        ids_a, ids_b = self.ids
        last_a, last_b = self.shared[:, 0], self.shared[:, 1]
        place_a = np.arange(len(ids_a)) + np.r_[0, last_b + 1][
            np.searchsorted(last_a, np.arange(len(ids_a)))]
        place_b = np.arange(len(ids_b)) + (last_a + 1)[
            np.searchsorted(last_b, np.arange(len(ids_b)))]
        marks = np.array([",", "|", ";"])
        said = np.empty(len(ids_a) + len(ids_b), object)
        for ids, place, last, mark in ((ids_a, place_a, last_a, 1), (ids_b, place_b, last_b, 2)):
            kind = np.zeros(len(ids), np.int64)
            kind[last] = mark
            used, at = np.unique(ids * 3 + kind, return_inverse=True)
            names = np.array([f"{u // 3}{marks[u % 3]}" for u in used.tolist()], object)
            said[place] = names[at]
        tokens = np.maximum(self.n_a, 0) + np.maximum(self.n_b, 0)
        ends = np.cumsum(tokens)
        flat = said.tolist()
        return ["".join(flat[s:e]).encode() for s, e in zip((ends - tokens).tolist(),
                                                            ends.tolist(), strict=True)]


def aligned(pair: Pair, parts: list[str], piece: int = PIECE) -> Aligned:
    """Encode and merge the given parts."""
    n_a, n_b = np.full(len(parts), -1, np.int64), np.full(len(parts), -1, np.int64)
    good_a, good_b = array("i"), array("i")
    for at in range(0, len(parts), ENCODE):
        for k, tokens in enumerate(pair.encode(parts[at:at + ENCODE]), at):
            if tokens is not None:
                n_a[k], n_b[k] = map(len, tokens)
                good_a.extend(tokens[0])
                good_b.extend(tokens[1])
    ids = np.array(good_a, np.int64), np.array(good_b, np.int64)
    ends = [np.cumsum(np.fromiter(map(len, table), np.int64, len(table))[i])
            for table, i in zip((pair.bytes_a, pair.bytes_b), ids, strict=True)]
    shared = shared_ends(*ends, piece)
    part = np.searchsorted(np.cumsum(np.maximum(n_a, 0)), shared[:, 0], "right")
    return Aligned(n_a, n_b, part, ids[0][shared[:, 0]], ids[1][shared[:, 1]], ids, shared)


def _parts_of(pair: Pair, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Different parts, the part at each place, and the number of places of each text."""
    number: dict[str, int] = {}
    at, size = [], np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        if text:
            found = [number.setdefault(p, len(number)) for p in pair.parts(text)]
            at.append(np.array(found, np.int32))
            size[k] = len(found)
    return list(number), np.concatenate(at) if at else np.empty(0, np.int32), size


def _whole(one: Aligned, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which texts have tokens: not empty, and each part is given back."""
    text = np.repeat(np.arange(len(size)), size)
    broken = np.bincount(text, one.n_a[at] < 0, len(size))
    return (size > 0) & (broken == 0)


class _Files:
    """The files' bytes, sent to the tasks once; each task loads them once."""

    def __init__(self, spark: SparkSession, folder: str):
        with open(f"{folder}/{FILE_A}", "rb") as a, open(f"{folder}/{FILE_B}", "rb") as b:
            self.sent = spark.sparkContext.broadcast((a.read(), b.read()))
        self.pair = None

    def __getstate__(self):
        return {"sent": self.sent, "pair": None}

    def load(self) -> Pair:
        if self.pair is None:
            self.pair = Pair(*self.sent.value)
        return self.pair


def aligned_rows(rows: DataFrame, files: _Files) -> DataFrame:
    """(doc_id, n_a, n_b, groups_sha256, links) of (doc_id, text); a link is the pair of its ids."""
    def run(batch: pa.RecordBatch) -> dict:
        pair = files.load()
        parts, at, size = _parts_of(pair, batch.column(1).to_pylist())
        one = aligned(pair, parts)
        keep = _whole(one, at, size)
        text_of = np.repeat(np.arange(len(size)), size)
        kept = keep[text_of]
        keys, n = one.keys_at(at[kept])
        links = np.bincount(text_of[kept], n, len(size)).astype(np.int64)

        def total(value: np.ndarray) -> np.ndarray:
            n = np.zeros(len(size), np.int64)
            np.add.at(n, text_of[kept], value[at[kept]])
            return n

        said, ends = one.texts(), np.cumsum(size)
        hashes = [hashlib.sha256(b"".join([said[p] for p in at[s:e].tolist()])[:-1]).hexdigest()
                  if whole else "" for s, e, whole in zip(
                      (ends - size).tolist(), ends.tolist(), keep.tolist(), strict=True)]
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(links)], pa.int32()), keys)
        return {"doc_id": batch.column(0), "n_a": total(one.n_a), "n_b": total(one.n_b),
                "groups_sha256": hashes, "links": lists}

    return map_rows(rows, "doc_id long, n_a long, n_b long, groups_sha256 string, "
                    "links array<long>", run, FLUSH)


def pair_counts(marked: DataFrame) -> DataFrame:
    """(key, f, is_best): how many links join an A and a B id, and if none joins B's oftener."""
    found = marked.select(F.explode("links").alias("key")).groupBy("key").agg(
        F.count(F.lit(1)).alias("f")).withColumn("b", F.col("key").bitwiseAND((1 << 32) - 1))
    found = materialise(found, "pairs")
    best = found.groupBy("b").agg(F.max("f").alias("best"))
    return materialise(found.join(best, "b").select(
        "key", "f", (F.col("f") == F.col("best")).alias("is_best")), "pair-counts")


def _frequent(pairs: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, counts and flags of the pairs from the lowest power of two that MOST_PAIRS allow."""
    steps = {int(r["e"]): r["n"] for r in pairs.groupBy(
        F.floor(F.log2("f")).alias("e")).agg(F.count(F.lit(1)).alias("n")).collect()}
    least, room = 63, MOST_PAIRS
    while least and room >= steps.get(least - 1, 0):
        least -= 1
        room -= steps.get(least, 0)
    # log2 may round at a power of two, so the same expression decides
    found = pairs.where(F.floor(F.log2("f")) >= least).toArrow()
    key, f, best = (found.column(c).to_numpy() for c in ("key", "f", "is_best"))
    order = np.argsort(key)
    return key[order], f[order], best[order]


def alignment(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
              folder: str = TOKENIZERS) -> DataFrame:
    """One row per row of ``docs``: tokens, groups and links, and how common its links are.

    Texts are encoded once; their links are written with them. Counts of the most frequent pairs
    are sent to the tasks, links of all others are joined with the table of pairs, one way at
    every size. Null and empty texts, and those that a tokenizer does not give back byte for
    byte, have no tokens. Null ids and repeated rows are rows like others.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.col(text).cast("string").alias("text"))
    marked = aligned_rows(rows, _Files(spark, folder)).withColumn(
        "row", F.monotonically_increasing_id())
    marked = materialise(marked, "aligned")
    pairs = pair_counts(marked)
    sent = spark.sparkContext.broadcast(_frequent(pairs))
    same = ["row", "doc_id", "n_a", "n_b", "groups_sha256"]

    def run(batch: pa.RecordBatch) -> dict:
        key, f, best = sent.value
        own = batch.column("links").flatten().to_numpy(zero_copy_only=False)
        n = batch.column("links").value_lengths().to_numpy(zero_copy_only=False)
        text_of = np.repeat(np.arange(len(n)), n)
        place = np.minimum(np.searchsorted(key, own), max(len(key) - 1, 0))
        known = key[place] == own if len(key) else np.zeros(len(own), bool)
        sums = np.zeros(len(n), np.int64)
        np.add.at(sums, text_of[known], f[place[known]])
        n_best = np.bincount(text_of[known], best[place[known]], len(n)).astype(np.int64)
        rare = np.bincount(text_of[~known], minlength=len(n))
        return {c: batch.column(c) for c in same} | {
            "n_links": n.astype(np.int64), "n_best": n_best, "count_sum": sums,
            "rare": pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(rare)], pa.int32()), own[~known])}

    marked = materialise(map_rows(
        marked.select(*same, "links"), "row long, doc_id long, n_a long, n_b long, "
        "groups_sha256 string, n_links long, n_best long, count_sum long, rare array<long>",
        run, FLUSH), "counted")
    rare = marked.select("row", F.explode("rare").alias("key")).groupBy("row", "key").agg(
        F.count(F.lit(1)).alias("n")).join(pairs, "key")
    rare = rare.groupBy("row").agg(
        F.sum(F.when(F.col("is_best"), F.col("n")).otherwise(0)).alias("more_best"),
        F.sum(F.col("n") * F.col("f")).alias("more"))
    zero = F.lit(0).cast("long")
    # each shared end closes one group and is one link
    return marked.join(rare, "row", "left").select(
        "doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links",
        (F.col("n_best") + F.coalesce("more_best", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", zero)).alias("count_sum"), "groups_sha256")
