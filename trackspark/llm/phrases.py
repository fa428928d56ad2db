"""Phrase collocations by vertically partitioned suffix trees.

Every word of the corpus starts a suffix, which is cut after ``depth`` words, at the end of its
piece and where a word, or two in a row, are too rare to be part of a phrase. Prefixes of one
and of two words are counted first; one of two that starts more suffixes than the memory budget
is lengthened by a word and counted again.
Prefixes are then packed into groups of about the budget, so the suffixes of a group fit in the
memory of one task and the subtree below its prefixes is built from them alone: sorted
suffixes are its leaves, common prefixes of neighbours its inner nodes, sums over runs of
leaves the number of occurrences of each phrase. No group needs to know of another one; only
the lengthened prefixes themselves, which have leaves in many groups, are summed over them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackspark.llm.common import map_rows, materialise, text_bytes

# ---- Fixed values: what ends a piece -----------------------------------------------------
BREAKS = b".,;:!?\n\x0b\x0c\r"

#: Suffixes that one group may hold: about 100 bytes each while a subtree is built.
BUDGET = 1 << 20
#: Buckets of prefixes per expected group; whole buckets are packed.
SPREAD = 16
#: Bits of each filter of what is frequent, at most (32 MB).
MOST_BITS = 1 << 28
#: Bytes of text whose suffixes are combined before they are shuffled.
FLUSH = 1 << 23
#: Bytes of a text that are words at once.
BLOCK = 1 << 20

_TABLE = bytes.maketrans(BREAKS + b"\t", b"\n" * len(BREAKS) + b" ")
_NO_WORD = np.uint64(0)


class _Words(dict):
    """Numbers of one language's words, given as they come."""

    def __init__(self, lang: bytes, known: list[tuple[bytes, bytes]]):
        super().__init__()
        self.lang, self.known = lang, known

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self.known)
        self.known.append((self.lang, word))
        return at


def _blocks(text: bytes) -> Iterator[bytes]:
    """The text in parts that end where a word ends."""
    at = 0
    while at < len(text):
        end = at + BLOCK
        while end < len(text) and text[end] not in b" \n":
            end += 1
        yield text[at:end]
        at = end


def numbered(langs: list[bytes], texts: list[bytes]) -> tuple[np.ndarray, list]:
    """Word numbers of all texts, -1 where a piece ends, and (lang, word) by number."""
    known: list[tuple[bytes, bytes]] = []
    words: dict[bytes, _Words] = {}
    parts: list[np.ndarray] = []
    for lang, text in zip(langs, texts, strict=True):
        number = words.get(lang)
        if number is None:
            number = words[lang] = _Words(lang, known)
        for block in _blocks(text.lower().translate(_TABLE)):
            ids: list[int] = []
            for i, piece in enumerate(block.split(b"\n")):
                if i:
                    ids.append(-1)
                ids += [number[w] for w in piece.split(b" ") if w]
            parts.append(np.array(ids, np.int32))
        parts.append(np.array([-1], np.int32))
    return (np.concatenate(parts) if parts else np.empty(0, np.int32)), known


def _hashes(known: list[tuple[bytes, bytes]]) -> np.ndarray:
    h = np.fromiter((xxhash.xxh64_intdigest(w, xxhash.xxh32_intdigest(lang))
                     for lang, w in known), np.uint64, len(known))
    h[h == _NO_WORD] = np.uint64(1)
    return h


def _longer(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of the prefix that goes on with ``word``."""
    h = prefix * np.uint64(0x9E3779B97F4A7C15) ^ word
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@dataclass
class Filter:
    """Hashes of what is frequent: that surely passes, and now and then something else."""

    bits: int
    at: np.ndarray

    def passes(self, h: np.ndarray) -> np.ndarray:
        place = (h & np.uint64(self.bits - 1)).astype(np.int64)
        return (self.at[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


@dataclass
class Partition:
    """What tasks know of the corpus: filters of frequent words and pairs of words, prefixes over
    the budget by their length from two words on, and the group of each bucket of prefixes.
    Hashes that collide share a group or pass a filter, which does no harm.
    """

    words: Filter
    pairs: Filter | None = None
    hot: list[np.ndarray] = field(default_factory=list)
    groups: np.ndarray | None = None

    def pair_hashes(self, ids: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the pair at each place, and whether both are frequent words of one piece."""
        ok = np.r_[self.words.passes(h), False][ids]  # the last stands for -1
        h = np.r_[h, _NO_WORD][ids]
        return _longer(h[:-1], h[1:]), ok[:-1] & ok[1:]

    def suffixes(self, ids: np.ndarray, h: np.ndarray, depth: int
                 ) -> tuple[np.ndarray, np.ndarray]:
        """(m, depth) word numbers of the cut suffixes of two words and more, -1 behind them,
        and the hashes of their first two words."""
        pair, goes_on = self.pair_hashes(ids, h)
        goes_on[goes_on] = self.pairs.passes(pair[goes_on])
        goes_on = np.r_[goes_on, np.zeros(depth, bool)]
        start = np.flatnonzero(goes_on)
        out = np.full((len(start), depth), -1, np.int32)
        out[:, 0], inside = ids[start], np.ones(len(start), bool)
        for d in range(1, depth):
            inside &= goes_on[start + d - 1]
            out[inside, d] = ids[start[inside] + d]
        return out, pair[start]

    def prefixes(self, rows: np.ndarray, pair: np.ndarray, h: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each suffix's prefix; column d tells if its first d + 1 words go on from one
        over the budget. ``h`` are the hashes by number, the last one for no word."""
        prefix, inside = pair, np.ones(len(rows), bool)
        parted = np.zeros(rows.shape, bool)
        for level, known in enumerate(self.hot):
            at = np.minimum(np.searchsorted(known, prefix), len(known) - 1)
            inside = inside & (known[at] == prefix)
            parted[:, level + 1] = inside
            prefix = np.where(inside, _longer(prefix, h[rows[:, level + 2]]), prefix)
        return prefix, parted


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, list]:
    return numbered(batch.column(0).to_pylist(), batch.column(1).to_pylist())


def _counted(batch: pa.RecordBatch) -> dict:
    ids, known = _rows(batch)
    count = np.bincount(ids[ids >= 0], minlength=len(known))
    return {"lang": pa.array([k[0] for k in known], pa.binary()),
            "word": pa.array([k[1] for k in known], pa.binary()),
            "h": _hashes(known).view(np.int64), "f": count.astype(np.int64)}


def _paired(batch: pa.RecordBatch, known_by) -> dict:
    """(h, f) of the pairs of frequent words."""
    ids, known = _rows(batch)
    pair, both = known_by.value.pair_hashes(ids, _hashes(known))
    pair, f = np.unique(pair[both], return_counts=True)
    return {"h": pair.view(np.int64), "f": f.astype(np.int64)}


def _measured(batch: pa.RecordBatch, known_by, depth: int) -> dict:
    """(h, f) of the prefixes that the last hot level lengthened."""
    partition: Partition = known_by.value
    ids, known = _rows(batch)
    h = _hashes(known)
    rows, pair = partition.suffixes(ids, h, depth)
    prefix, parted = partition.prefixes(rows, pair, np.r_[h, _NO_WORD])
    prefix, f = np.unique(prefix[parted[:, len(partition.hot)]], return_counts=True)
    return {"h": prefix.view(np.int64), "f": f.astype(np.int64)}


def _grouped(batch: pa.RecordBatch, known_by, depth: int) -> dict:
    """(grp, words, suffixes, f): the suffixes of a group, equal ones combined, as arrays."""
    partition: Partition = known_by.value
    ids, known = _rows(batch)
    h = _hashes(known)
    rows, pair = partition.suffixes(ids, h, depth)
    prefix, _ = partition.prefixes(rows, pair, np.r_[h, _NO_WORD])
    grp = partition.groups[prefix % np.uint64(len(partition.groups))].astype(np.uint64)
    whole = prefix
    for d in range(1, depth):
        whole = _longer(whole, rows[:, d].astype(np.uint64))
    order = np.argsort(grp << np.uint64(40) | whole >> np.uint64(24))
    rows, grp = rows[order], grp[order]
    new = np.ones(len(rows), bool)  # equal suffixes lie side by side but for hash ties
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    first = np.flatnonzero(new)
    f = np.diff(np.r_[first, len(rows)]).astype(np.int32)
    rows, grp = rows[first], grp[first]
    out: dict = {"grp": [], "words": [], "suffixes": [], "f": []}
    start = np.flatnonzero(np.r_[len(grp) > 0, grp[1:] != grp[:-1]]).tolist()
    for a, b in zip(start, [*start, len(grp)][1:], strict=True):
        used, local = np.unique(rows[a:b], return_inverse=True)
        if used[0] >= 0:
            used, local = np.r_[-1, used], local + 1
        kind = np.uint16 if len(used) < 1 << 16 else np.uint32
        out["grp"].append(int(grp[a]))
        # a word holds no line feed, whatever a language holds
        out["words"].append([b"\n".join(known[i]) for i in used[1:].tolist()])
        out["suffixes"].append(local.astype(kind).tobytes())
        out["f"].append(f[a:b].tobytes())
    return {"grp": pa.array(out["grp"], pa.int32()),
            "words": pa.array(out["words"], pa.list_(pa.binary())),
            "suffixes": pa.array(out["suffixes"], pa.binary()),
            "f": pa.array(out["f"], pa.binary())}


def subtree(rows: np.ndarray, f: np.ndarray, parted: np.ndarray, least: int
            ) -> Iterator[tuple[np.ndarray, int]]:
    """(words, occurrences) of each node from two words on that occurs ``least`` times.

    Rows are cut suffixes, 0 behind their end. Sorted, they are the leaves from left to right;
    two neighbours part at the first column that differs. Nodes whose leaves are ``parted`` among
    groups are given with what this group has of them.
    """
    order = np.lexsort([rows[:, d] for d in range(rows.shape[1] - 1, -1, -1)])
    rows, f, parted = rows[order], f[order], parted[order]
    differs = np.ones(len(rows), bool)
    differs[1:] = rows[1:, 0] != rows[:-1, 0]
    for d in range(1, rows.shape[1]):
        differs[1:] |= rows[1:, d] != rows[:-1, d]
        node = np.flatnonzero(differs)
        total = np.add.reduceat(f, node) if len(node) else f
        keep = ((total >= least) | parted[node, d]) & (rows[node, d] > 0)
        for i, n in zip(node[keep].tolist(), total[keep].tolist(), strict=True):
            yield rows[i, :d + 1], n


def _built(table: pa.Table, known_by, depth: int, least: int) -> pa.Table:
    """Phrases of one group."""
    number: dict[bytes, int] = {b"": 0}
    rows, counts = [], []
    for words, suffixes, f in zip(*(table.column(c).to_pylist() for c in
                                    ("words", "suffixes", "f")), strict=True):
        place = np.array([0, *(number.setdefault(w, len(number)) for w in words)], np.int32)
        kind = np.uint16 if len(place) < 1 << 16 else np.uint32
        rows.append(place[np.frombuffer(suffixes, kind)].reshape(-1, depth))
        counts.append(np.frombuffer(f, np.int32).astype(np.int64))
    by_number = list(number)
    suffixes = np.concatenate(rows)
    h = np.r_[_NO_WORD, _hashes([tuple(k.rsplit(b"\n", 1)) for k in by_number[1:]])]
    _, parted = known_by.value.prefixes(suffixes, _longer(h[suffixes[:, 0]], h[suffixes[:, 1]]), h)
    out = [[], [], [], []]
    for ids, n in subtree(suffixes, np.concatenate(counts), parted, least):
        both = [by_number[i].rsplit(b"\n", 1) for i in ids.tolist() if i]
        for column, value in zip(out, (both[0][0], b" ".join(w for _, w in both), len(both), n),
                                 strict=True):
            column.append(value)
    return pa.table({"lang": pa.array(out[0], pa.binary()), "phrase": pa.array(out[1], pa.binary()),
                     "words": pa.array(out[2], pa.int32()), "f": pa.array(out[3], pa.int64())})


def _packed(sizes: np.ndarray, budget: int) -> np.ndarray:
    """Group of each bucket: the largest first, always into the emptiest group."""
    groups = [(0, g) for g in range(max(1, -(-int(sizes.sum()) // budget)))]
    out = np.zeros(len(sizes), np.int32)
    for b in np.argsort(-sizes, kind="stable").tolist():
        size, g = heapq.heappop(groups)
        out[b] = g
        heapq.heappush(groups, (size + int(sizes[b]), g))
    return out


def _filter_of(frequent: DataFrame) -> Filter:
    """Bits set at the hashes ``h``; at most MOST_BITS, whatever their number."""
    bits = 1 << 16
    while bits < MOST_BITS and bits < 16 * frequent.count():
        bits <<= 1
    place = F.col("h").bitwiseAND(bits - 1) + 1
    parts = frequent.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    out = np.zeros(bits >> 3, np.uint8)
    for r in parts:
        at = (r["part"] - 1) * 4096
        out[at:at + 4096] = np.frombuffer(r["bits"], np.uint8)
    return Filter(bits, out)


def partitioned(texts: DataFrame, frequent: DataFrame, least: int, depth: int, budget: int
                ) -> Partition:
    """Vertical partition: prefixes within the budget, packed into groups.

    The driver gets hashes of prefixes over the budget, fewer than the corpus has budgets, and
    the sizes of SPREAD buckets for each budget.
    """
    share = texts.sparkSession.sparkContext.broadcast
    out = Partition(_filter_of(frequent))

    def counted(task, name: str, at_least: int) -> DataFrame:
        found = map_rows(texts, "h long, f long", task, FLUSH).groupBy("h").agg(
            F.sum("f").alias("f"))
        return materialise(found.where(F.col("f") >= at_least), name)

    sizes = counted(partial(_paired, known_by=share(out)), "pairs", least)
    out.pairs = _filter_of(sizes)
    parts = []
    for _ in range(depth - 2):
        hot = sizes.where(F.col("f") > budget).select("h").toArrow().column("h")
        parts.append(sizes.where(F.col("f") <= budget))
        if not len(hot):
            break
        out.hot.append(np.sort(hot.to_numpy().view(np.uint64)))
        sizes = counted(partial(_measured, known_by=share(out), depth=depth), "prefixes", 1)
    else:
        parts.append(sizes)  # whole suffixes: equal ones are combined, so they need no budget
    kept = parts[0]
    for more in parts[1:]:
        kept = kept.unionByName(more)
    kept = kept.withColumn("f", F.least("f", F.lit(budget)))
    total = kept.agg(F.sum("f")).first()[0] or 0
    buckets = 1 << 10
    while buckets < SPREAD * total / budget:
        buckets <<= 1
    found = kept.groupBy(F.col("h").bitwiseAND(buckets - 1).alias("b")).agg(
        F.sum("f").alias("f")).toArrow()
    size = np.zeros(buckets, np.int64)
    size[found.column("b").to_numpy()] = found.column("f").to_numpy()
    out.groups = _packed(size, budget)
    return out


def frequencies(docs: DataFrame, least: int, depth: int, budget: int, text: str,
                lang: str) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases that occur ``least`` times, and (lang, n)."""
    texts = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).cast("binary").alias("lang"),
        text_bytes(text).alias("text"))
    words = map_rows(texts, "lang binary, word binary, h long, f long", _counted, FLUSH)
    words = materialise(words.groupBy("lang", "word", "h").agg(F.sum("f").alias("f")), "words")
    frequent = words.where(F.col("f") >= least)
    partition = partitioned(texts, frequent, least, depth, budget)
    known_by = texts.sparkSession.sparkContext.broadcast(partition)
    groups = map_rows(texts, "grp int, words array<binary>, suffixes binary, f binary",
                      partial(_grouped, known_by=known_by, depth=depth), FLUSH)

    def built(table: pa.Table) -> pa.Table:
        return _built(table, known_by, depth, least)

    found = groups.groupBy("grp").applyInArrow(
        built, "lang binary, phrase binary, words int, f long")
    # prefixes over the budget have leaves in many groups
    found = found.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).where(
        F.col("f") >= least)
    one = frequent.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("words"), "f")
    both = one.unionByName(found).select(
        F.col("lang").cast("string"), F.col("phrase").cast("string"), "words", "f")
    n = words.groupBy(F.col("lang").cast("string").alias("lang")).agg(F.sum("f").alias("n"))
    return materialise(both, "phrases"), n


def _big(name: str) -> Column:
    return F.col(name).cast("decimal(19,0)")


def collocations(docs: DataFrame, least: int = 100, depth: int = 5, top: int = 2000,
                 budget: int = BUDGET, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases.

    Null texts are empty, a null language is ``und``. Equal scores go by occurrences, then by
    phrase in byte order. Repeated rows count again; an empty table gives no rows.
    """
    f, n = frequencies(docs, least, depth, budget, text, lang)
    phrases = f.where("words > 1")
    cut = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).withColumn(
        "left", F.expr("substring_index(phrase, ' ', k)")).withColumn(
        "right", F.expr("substring(phrase, length(left) + 2)"))
    side = f.select("lang", "phrase", "f")
    cut = cut.join(side.toDF("lang", "left", "l"), ["lang", "left"]).join(
        side.toDF("lang", "right", "r"), ["lang", "right"]).join(n, "lang")
    # decimals: a * n and l * r may pass 64 bits
    cut = cut.withColumns({"_an": _big("f") * _big("n") * F.lit(1000).cast("decimal(4,0)"),
                           "_lr": _big("l") * _big("r")}).withColumn(
        "score", F.expr("_an div _lr"))
    scored = cut.groupBy("lang", "phrase", "words", F.col("f").alias("a"), "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    parts = phrases.where("words > 2").select(
        "lang", "f", F.explode(F.expr(
            "flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1),"
            " i -> array_join(slice(split(phrase, ' '), i, m), ' '))))")).alias("phrase"))
    inside = parts.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    left = scored.join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") < F.col("a")))
    rows = left.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return rows.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
