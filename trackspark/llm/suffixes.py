"""Removal of repeated passages: anchored suffixes, put in order by deep-shallow sorting.

Each string of LENGTH bytes belongs to one anchor: its place with the smallest hash of GRAM
bytes, which depends on the string alone, so equal strings have their anchors at the same
offset. Suffixes are therefore sorted at anchors only, in groups of equal grams, once to the
right and once, reversed, to the left. Members that agree over all strings they own are one
suffix with a count before that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackspark.llm.common import map_rows, materialise, text_bytes

GRAM = 64
#: Starts of a text that are hashed at once.
BLOCK = 1 << 20
#: Bytes that multikey quicksort looks at before blind tries take over.
SHALLOW = 24
#: Distinct suffixes of a gram that one task sorts; the strings of a more frequent gram are
#: counted one by one instead, over all tasks.
MOST = 2048
#: Suffixes up to which a group is compared pair by pair.
PAIRS = 48
KEYS = ("doc_id", "text_key")


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each place on."""
    h, width = data.astype(np.uint64) + np.uint64(1), 1
    while width < GRAM:
        n = len(h) - width
        h = ((h[:n] * np.uint64(0x9E3779B97F4A7C15 + 2 * width))
             ^ (h[:n] >> np.uint64(29))) + h[width:] * np.uint64(0xC2B2AE3D27D4EB4F)
        width *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def anchors(text: bytes, length: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(anchor, first, last, gram, stretch): the anchors and the starts first..last they own.

    Leftmost of equal hashes. stretch is a hash of all that the owned strings cover and of the
    anchor's place in it.
    """
    data, span = np.frombuffer(text, np.uint8), length - GRAM + 1
    for at in range(0, len(text) - length + 1, BLOCK):
        starts = min(BLOCK, len(text) - length + 1 - at)
        grams = gram_hashes(data[at:at + starts + length - 1])
        low = np.uint64((1 << 24) - 1)
        key = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            key, width = np.minimum(key[:-width], key[width:]), width * 2
        if width < span:
            key = np.minimum(key[:starts], key[span - width:span - width + starts])
        anchor = (key[:starts] & low).astype(np.int64)
        cut = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1], True])
        for first, end in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            a = int(anchor[first])
            stretch = xxhash.xxh64_intdigest(
                text[at + first:at + end - 1 + length], a - first)
            yield (at + a, at + first, at + end - 1, int(grams[a].astype(np.int64)),
                   stretch - (1 << 64) if stretch >> 63 else stretch)


def lcp(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class BlindTrie:
    """Branch bytes and depths only; a string is compared once, with the leaf it ends at."""

    def __init__(self, strings: list[bytes], first: int):
        self.strings = strings
        #: a node is [depth, {byte or -1: child}], a leaf the list of equal strings' numbers
        self.root: list = [first]

    def add(self, i: int) -> None:
        s, node = self.strings[i], self.root
        while isinstance(node[-1], dict):
            byte = s[node[0]] if node[0] < len(s) else -1
            node = node[1].get(byte) or next(iter(node[1].values()))
        other = self.strings[node[0]]
        same = lcp(s, other)
        if same == len(s) == len(other):
            node.append(i)
            return
        node = self.root
        while isinstance(node[-1], dict) and node[0] < same:
            node = node[1][s[node[0]] if node[0] < len(s) else -1]
        mine = s[same] if same < len(s) else -1
        if isinstance(node[-1], dict) and node[0] == same:
            node[1][mine] = [i]
        else:
            old = node[:]
            node[:] = [same, {other[same] if same < len(other) else -1: old, mine: [i]}]

    def order(self) -> list[int]:
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            if isinstance(node[-1], dict):
                todo += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                out += node
        return out


def deep_shallow(strings: list[bytes], depth: int = 0) -> list[int]:
    """Order of strings that agree on ``depth`` bytes: quicksort by single bytes first, blind
    tries for the groups that still agree after SHALLOW more."""
    out: list[int] = []
    todo = [(list(range(len(strings))), depth)]
    while todo:
        rows, at = todo.pop()
        if len(rows) < 2:
            out += rows
        elif at >= depth + SHALLOW:
            trie = BlindTrie(strings, rows[0])
            for i in rows[1:]:
                trie.add(i)
            out += trie.order()
        else:
            keys = [strings[i][at] if at < len(strings[i]) else -1 for i in rows]
            pivot = keys[len(keys) // 2]
            parts = {-1: [], 0: [], 1: []}
            for i, k in zip(rows, keys, strict=True):
                parts[(k > pivot) - (k < pivot)].append(i)
            if pivot < 0:  # all of these have ended, so they are equal
                todo += [(parts[1], at)]
                out += parts[0]
            else:
                todo += [(parts[1], at), (parts[0], at + 1), (parts[-1], at)]
    return out


def _depths(strings: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, common prefix of each in that order with the one before; 0 for the first)."""
    order = deep_shallow(strings, depth)
    return np.array(order), np.array(
        [0] + [lcp(strings[a], strings[b]) for a, b in zip(order, order[1:], strict=False)])


def repeated(rows: list[tuple[int, int, int, bytes, bytes, bool]], length: int
             ) -> Iterator[tuple[int, int, int]]:
    """(row, first, last): the owned starts whose string another row of the group has too.

    rows: (anchor, first, last, left reversed, right, asked). A string that starts o bytes before
    the anchor is shared by rows that agree on o bytes to the left and length - o to the right.
    """
    count = len(rows)
    (ro, rl), (lo, ll) = _depths([r[4] for r in rows], 0), _depths([r[3] for r in rows], 0)
    offsets = length - GRAM + 1
    shared = np.zeros((count, offsets), bool)
    if count <= PAIRS:
        right, left = np.zeros((count, count), int), np.zeros((count, count), int)
        for order, depth, out in ((ro, rl, right), (lo, ll, left)):
            for i in range(count - 1):
                run = np.minimum.accumulate(depth[i + 1:])
                out[order[i], order[i + 1:]] = out[order[i + 1:], order[i]] = run
        for i in range(count):
            if rows[i][5]:
                for a, b in zip((length - right[i]).tolist(), left[i].tolist(), strict=True):
                    if a <= b:
                        shared[i, max(a, 0):b + 1] = True
    else:
        runs = np.empty(count, np.int64), np.empty(count, np.int64)
        for o in range(offsets):
            runs[0][ro] = np.cumsum(rl < length - o)
            runs[1][lo] = np.cumsum(ll < o) if o else 0
            _, back, many = np.unique(runs[0] * (count + 1) + runs[1], return_inverse=True,
                                      return_counts=True)
            shared[:, o] = many[back] > 1
    for i, (a, first, last, _, _, asked) in enumerate(rows):
        if asked:
            own = shared[i, a - last:a - first + 1][::-1]
            edge = np.flatnonzero(np.diff(np.r_[False, own, False].astype(np.int8)))
            for s, e in edge.reshape(-1, 2).tolist():
                yield i, first + s, first + e - 1


def _sorted_groups(context: DataFrame, length: int) -> DataFrame:
    """(keys..., first, last) of the asked rows of each gram whose strings repeat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, held = None, []

        def flush() -> pa.RecordBatch:
            rows = [(r["anchor"], r["first"], r["last"], r["left"], r["right"], r["n"] == 1)
                    for r in held]
            found = list(repeated(rows, length)) if len(rows) > 1 else []
            return pa.RecordBatch.from_pydict({
                "doc_id": pa.array([held[i]["doc_id"] for i, _, _ in found], pa.int64()),
                "text_key": pa.array([held[i]["text_key"] for i, _, _ in found], pa.int64()),
                "first": pa.array([a for _, a, _ in found], pa.int64()),
                "last": pa.array([b for _, _, b in found], pa.int64())})

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                for r in batch.slice(at, 512).to_pylist():
                    if r["gram"] != gram:
                        if held:
                            yield flush()
                        gram, held = r["gram"], []
                    held.append(r)
        if held:
            yield flush()

    return context.repartition("gram").sortWithinPartitions("gram").mapInArrow(
        run, "doc_id long, text_key long, first long, last long")


def _context(docs: DataFrame, todo: DataFrame, length: int) -> DataFrame:
    """Each suffix to sort with its text to both sides, or, of a hot gram, its strings' hashes."""
    each = F.struct("anchor", "first", "last", "gram", "n", "hot")
    wanted = todo.groupBy(*KEYS).agg(F.collect_list(each).alias("wanted"))
    on = [docs[k].eqNullSafe(wanted[k]) for k in KEYS]
    # rows that repeat id and text are one place
    rows = docs.join(wanted, on[0] & on[1]).select(
        *[docs[k] for k in KEYS], "text", "wanted").dropDuplicates(list(KEYS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_key", "gram", "anchor", "first", "last", "n", "left", "right",
                 "string"]
        types = [pa.int64()] * 7 + [pa.binary()] * 2 + [pa.int64()]

        def made(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            out: list[tuple] = []
            for i in range(batch.num_rows):
                doc, key, text, wanted = (c[i].as_py() for c in batch.columns)
                for w in wanted:
                    a, first, last = w["anchor"], w["first"], w["last"]
                    if w["hot"]:
                        for p in range(first, last + 1):
                            h = xxhash.xxh64_intdigest(text[p:p + length], 1)
                            h -= (h >> 63) << 64
                            out.append((doc, key, w["gram"], a, p, p, w["n"], None, None, h))
                    else:
                        left = text[max(0, a - length + GRAM):a][::-1]
                        out.append((doc, key, w["gram"], a, first, last, w["n"], left,
                                    text[a:a + length], None))
                    if len(out) >= 8192:
                        yield made(out)
                        out = []
            yield made(out)

    return rows.mapInArrow(
        run, "doc_id long, text_key long, gram long, anchor long, first long, last long, n long, "
             "left binary, right binary, string long")


def repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """(keys..., first, last): starts of strings of ``length`` bytes that start elsewhere too.

    ``docs``: (doc_id, text_key, text binary). Complete, with runs that may touch or overlap.
    """
    def run(batch: pa.RecordBatch) -> dict:
        names = ("anchor", "first", "last", "gram", "stretch")
        out: dict[str, list] = {k: [] for k in (*KEYS, *names)}
        for doc, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for row in anchors(text, length):
                out["doc_id"].append(doc)
                out["text_key"].append(key)
                for name, value in zip(names, row, strict=True):
                    out[name].append(value)
        return {k: pa.array(v, pa.int64()) for k, v in out.items()}

    found = map_rows(docs.select(*KEYS, "text"), "doc_id long, text_key long, anchor long, "
                     "first long, last long, gram long, stretch long", run, 1 << 23)
    found = materialise(found, "anchors")
    place = F.struct(*KEYS, "anchor", "first", "last")
    classes = materialise(found.groupBy("gram", "stretch").agg(
        F.count(F.lit(1)).alias("n"), F.min(place).alias("at")), "suffix-classes")
    # copies of everything an anchor owns
    many = classes.where("n > 1").select("gram", "stretch")
    whole = found.join(many, ["gram", "stretch"]).select(*KEYS, "first", "last")
    # grams with several suffixes, of which one at least stands alone so far
    mixed = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("classes"), F.min("n").alias("least"))
    mixed = mixed.where("classes > 1 and least = 1").select(
        "gram", (F.col("classes") > MOST).alias("hot"))
    mixed = materialise(mixed, "mixed-grams")
    todo = classes.join(mixed, "gram").select("at.*", "gram", "n", "hot")
    context = materialise(_context(docs, todo, length), "suffixes")
    ordered = _sorted_groups(context.where("string is null"), length)
    strings = context.where("string is not null")
    again = strings.groupBy("gram", "string").agg(F.count(F.lit(1)).alias("times"))
    again = again.where("times > 1").select("gram", "string")
    single = strings.where("n = 1").join(again, ["gram", "string"]).select(*KEYS, "first", "last")
    return whole.unionByName(ordered).unionByName(single)


def deduplicated(docs: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text",
                 with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]), one row per row of ``docs``.

    Each byte covered by a string of ``length`` bytes that starts elsewhere too, in the same
    document or another, goes; all of its occurrences do. Null texts are empty, shorter ones
    have no such string. ``with_text`` adds the bytes that stay. Documents are told apart by id
    and text hash; rows that repeat both are copies of each other like any.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(text).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    found = repeats(rows, length)
    # a set: rows that repeat id and text find the same runs, however many they are
    runs = found.groupBy(*KEYS).agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    on = [rows[k].eqNullSafe(runs[k]) for k in KEYS]
    joined = rows.join(runs, on[0] & on[1], "left").select(rows["doc_id"], "text", "runs")

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in (
            "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text)}
        for i in range(batch.num_rows):
            data, marked = batch.column(1)[i].as_py(), batch.column(2)[i].as_py() or []
            kept, at, spans = [], 0, 0
            for first, last in sorted((r["first"], r["last"] + length) for r in marked):
                if first > at or not spans:
                    kept.append(data[at:first])
                    spans += 1
                at = max(at, last)
            kept.append(data[at:])
            kept = b"".join(kept)
            out["n_bytes"].append(len(data))
            out["n_removed"].append(len(data) - len(kept))
            out["n_spans"].append(spans)
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if with_text:
                out["kept"].append(kept)
        return {"doc_id": batch.column(0)} | out

    return map_rows(joined, "doc_id long, n_bytes long, n_removed long, n_spans long, "
                            "kept_sha256 string" + ", kept binary" * with_text, run)
