"""SimHash near-duplicates with a Gray-order hierarchical index.

A fingerprint is the bitwise majority of the hashes of a text's word shingles. Distinct
fingerprints are routed by bands of their bits; in each band group they are sorted by Gray
rank, runs of eight form nodes that hold the bits all their members share, runs of eight nodes
form the next level. A search goes down from the top with the differences found so far and
drops a whole node as soon as they exceed the bound. Bits that a parent holds are not looked
at again below it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackspark.llm.common import map_rows, materialise, popcount, text_bytes
from trackspark.llm.components import components

SEED = 42
#: Bytes of a text that are held as words at once.
BLOCK = 1 << 20
FANOUT = 8
#: Fingerprints of a band group beyond which it is cut into cells.
TILE = 2048
#: Rows of a task that are searched at once.
ROWS = 1 << 15
NO_ID = 1 << 62
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def shingle_hashes(text: bytes, n: int) -> Iterator[np.ndarray]:
    """XXH64 of the space-joined ``n``-word shingles of an A-Z-lowered text, block by block.

    ``bytes.lower`` and ``bytes.split`` know ASCII only, which is what is asked for. A text of
    fewer words has one shingle of all of them, an empty one has none.
    """
    hashed, at, held, seen = xxhash.xxh64_intdigest, 0, [], False
    while at < len(text):
        end = at + BLOCK
        if end < len(text):
            space = _SPACE.search(text, end)
            end = space.start() if space else len(text)
        words = held + text[at:end].lower().split()
        at, held = end, words[max(0, len(words) - n + 1):] if n > 1 else []
        if len(words) < n:
            continue
        seen = True
        joined = b" ".join(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(size + 1) - 1
        starts = (ends - size)[:len(words) - n + 1].tolist()
        yield np.array([hashed(joined[a:b], SEED) for a, b in
                        zip(starts, ends[n - 1:].tolist(), strict=True)], np.uint64)
    if not seen and held:
        yield np.array([hashed(b" ".join(held), SEED)], np.uint64)


def _mixed(h: np.ndarray, j: int) -> np.ndarray:
    """Another hash of the same shingle; the first is the hash itself."""
    if not j:
        return h
    h = h + np.uint64(j * 0x9E3779B97F4A7C15 % 2**64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def fingerprint(text: bytes, n: int, words: int = 1) -> bytes:
    """``words`` times 64 majority bits, big-endian; zero for a text without words."""
    counts, total = np.zeros((words, 64), np.int64), 0
    for block in shingle_hashes(text, n):
        total += len(block)
        for at in range(0, len(block), 1 << 14):
            part = block[at:at + (1 << 14)]
            for j in range(words):
                bits = np.unpackbits(_mixed(part, j).astype(">u8").view(np.uint8).reshape(-1, 8),
                                     axis=1)
                counts[j] += bits.sum(axis=0, dtype=np.uint32)
    return np.packbits(counts * 2 > total, axis=1).tobytes()


def fingerprints(docs: DataFrame, n: int = 3, words: int = 1, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """(doc_id, code binary) for each row; null and empty texts have code zero."""
    def run(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0),
                "code": [fingerprint(t, n, words) for t in batch.column(1).to_pylist()]}

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(text).alias("text"))
    return map_rows(rows, "doc_id long, code binary", run)


def bands(words: int, tables: int) -> list[tuple[int, int]]:
    """Pairs of byte positions whose 16 bits route a code, ``tables`` times over all bytes."""
    size = 8 * words
    return [(i, (i + 1 + 16 * t) % size) for t in range(tables) for i in range(0, size, 2)]


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code (n, w) in Gray order, as words again."""
    rank, carry = np.empty_like(codes), np.zeros(len(codes), np.uint64)
    for j in range(codes.shape[1]):
        x = codes[:, j].copy()
        for s in (1, 2, 4, 8, 16, 32):
            x ^= x >> np.uint64(s)
        x ^= np.uint64(0) - carry  # an odd number of bits above turns all below
        rank[:, j], carry = x, x & np.uint64(1)
    return rank


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a[i] and b[i]; label[x] is the smallest member of x's set."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


class GrayIndex:
    """Index over codes (n, w) that are sorted by (group, Gray rank)."""

    def __init__(self, codes: np.ndarray, group: np.ndarray):
        self.codes = codes
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        self.sizes = np.diff(np.r_[first, len(codes)])
        #: per level: first row of each node, its pattern, its shared bits, its first child
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.group_first = first
        width, below = FANOUT, None
        while True:
            per = -(-self.sizes // width)
            node_first = np.repeat(np.cumsum(per) - per, per)
            start = np.repeat(first, per) + (np.arange(per.sum()) - node_first) * width
            both = np.bitwise_and.reduceat(codes, start, axis=0)
            shared = ~(both ^ np.bitwise_or.reduceat(codes, start, axis=0))
            child = start if below is None else np.searchsorted(below, start)
            self.levels.append((start, both, shared, child))
            if per.max() <= FANOUT:
                self.per = per
                break
            below, width = start, width * FANOUT

    def pairs(self, bits: int, step: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows i < j of one group whose codes differ in at most ``bits`` bits."""
        n = len(self.codes)
        root = np.cumsum(self.per) - self.per
        group = np.repeat(np.arange(len(self.sizes)), self.sizes)
        most = self.sizes.max()
        step = max(step, (1 << 20) // max(int(most), 1))
        for at in range(0, n, step):
            q = np.arange(at, min(at + step, n))
            count = self.per[group[q]]
            node = np.repeat(root[group[q]] - np.cumsum(count) + count, count) + np.arange(
                count.sum())
            q = np.repeat(q, count)
            found = np.zeros(len(q), np.int16)
            known = np.zeros((1, self.codes.shape[1]), np.uint64)
            for level in range(len(self.levels) - 1, -1, -1):
                start, pattern, shared, child = self.levels[level]
                last = np.r_[start[1:], n] - 1
                own = shared[node] & ~known
                found = found + popcount((self.codes[q] ^ pattern[node]) & own)
                keep = (found <= bits) & (last[node] > q)
                q, node, found = q[keep], node[keep], found[keep]
                if not len(q):
                    break
                end = np.r_[child[1:], n if not level else len(self.levels[level - 1][0])]
                count = end[node] - child[node]
                known = np.repeat(shared[node], count, axis=0)
                nxt = np.repeat(child[node] - np.cumsum(count) + count, count) + np.arange(
                    count.sum())
                q, node, found = np.repeat(q, count), nxt, np.repeat(found, count)
            if len(q):
                keep = node > q
                q, node, found, known = q[keep], node[keep], found[keep], known[keep]
                found = found + popcount((self.codes[q] ^ self.codes[node]) & ~known)
                keep = found <= bits
                yield q[keep], node[keep]


def _linked(codes: np.ndarray, node: np.ndarray, group: np.ndarray, bits: int) -> dict:
    """Edges that join the linked codes of each group, at most one fewer than its codes."""
    size = np.bincount(group)
    many = size[group] > 1
    codes, node, group = codes[many], node[many], group[many]
    if not len(codes):
        return {"u": np.empty(0, np.int64), "v": np.empty(0, np.int64)}
    rank = gray_rank(codes)
    order = np.lexsort([*(rank[:, j] for j in range(rank.shape[1] - 1, -1, -1)), group])
    codes, node, group = codes[order], node[order], group[order]
    label = np.arange(len(codes))
    for a, b in GrayIndex(codes, group).pairs(bits):
        merge(label, a, b)
    joined = np.flatnonzero(label != np.arange(len(codes)))
    return {"u": node[joined], "v": node[label[joined]]}


def links(codes: DataFrame, bits: int, words: int, tables: int = 1) -> DataFrame:
    """(u, v): edges that connect all ``node`` whose distinct ``code`` are linked.

    With 16-bit bands, ``bits`` < 4 and one word no link is missed: three differing bits leave
    one of four bands equal. With more words the bands find likely pairs. A band group of over
    TILE codes is cut into cells of two salts each, so that no task holds it whole and every
    two of its codes still meet.
    """
    at = bands(words, tables)
    keys = F.array(*[F.concat(F.expr(f"substring(code, {i + 1}, 1)"),
                              F.expr(f"substring(code, {j + 1}, 1)")) for i, j in at])
    routed = codes.select("node", "code", F.posexplode(keys).alias("band", "key"))
    hot = (routed.groupBy("band", "key").count().where(F.col("count") > TILE)
           .select("band", "key", F.ceil(F.col("count") / TILE).alias("salts")))
    hot = materialise(hot, "hot-bands")
    cells = routed.join(hot, ["band", "key"], "left")
    salt = F.pmod(F.xxhash64("code"), F.coalesce("salts", F.lit(1)))
    cells = cells.withColumn("salt", salt).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
    cells = cells.select("node", "code", F.concat(
        "key", F.format_string("%d:%d:%d", "band", F.least("salt", "other"),
                               F.greatest("salt", "other")).cast("binary")).alias("cell"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def flush(whole: bool) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            cell = table.column("cell").to_pylist()
            new = np.fromiter((i == 0 or c != cell[i - 1] for i, c in enumerate(cell)), bool,
                              len(cell))
            end = len(cell) if whole else int(np.flatnonzero(new)[-1])
            held[:] = table.slice(end).to_batches()
            if end:
                raw = b"".join(table.column("code").to_pylist()[:end])
                code = np.frombuffer(raw, ">u8").astype(np.uint64).reshape(-1, words)
                node = table.column("node").to_numpy()[:end]
                yield pa.RecordBatch.from_pydict(
                    _linked(code, node, np.cumsum(new[:end]) - 1, bits))

        for batch in batches:
            held.append(batch)
            rows = sum(b.num_rows for b in held)
            if rows >= ROWS:
                yield from flush(False)
        if sum(b.num_rows for b in held):
            yield from flush(True)

    dealt = cells.repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, n: int = 3, bits: int = 3, words: int = 1,
                    tables: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``.

    Equal fingerprints are one node from the start. Null and empty texts have fingerprint zero
    and link like any other. Rows with a null id are kept; component_id is null where no member
    has an id. Repeated rows and ids, ties and an empty table need no care.
    """
    marked = materialise(fingerprints(docs, n, words, doc_id, text), "fingerprints")
    own = F.coalesce(F.min("doc_id"), F.lit(NO_ID) + F.pmod(F.xxhash64("code"), F.lit(NO_ID)))
    codes = materialise(marked.groupBy("code").agg(own.alias("node")), "codes")
    found = components(links(codes, bits, words, tables))
    rooted = codes.join(found, "node", "left").select(
        "code", F.coalesce("root", "node").alias("component_id"))
    rooted = materialise(rooted, "rooted")
    return marked.join(rooted, "code", "left").select(
        "doc_id", F.lower(F.hex("code")).alias("fingerprint"),
        F.when(F.col("component_id") < NO_ID, F.col("component_id")).alias("component_id"))


def without_near_copies(docs: DataFrame, n: int = 3, bits: int = 3, doc_id: str = "doc_id",
                        text: str = "text") -> DataFrame:
    """One row of each group of linked fingerprints stays as it is, with all its columns.

    It is the row with the smallest id, null last, then with the smallest hash of its text and of
    the whole row. Groups are built on fingerprints alone, so rows that share an id but no text
    join nothing. Null and empty texts have fingerprint zero and are one group.
    """
    key = ["id", "text_key", "row_key"]
    rows = docs.select(F.struct("*").alias("whole"), F.col(doc_id).cast("long").alias("id"),
                       F.xxhash64(text_bytes(text)).alias("text_key"),
                       F.xxhash64(*docs.columns).alias("row_key"), text_bytes(text).alias("text"))

    def run(batch: pa.RecordBatch) -> dict:
        return {k: batch.column(i) for i, k in enumerate(key)} | {
            "code": [fingerprint(t, n) for t in batch.column(3).to_pylist()]}

    marked = map_rows(rows.select(*key, "text"),
                      "id long, text_key long, row_key long, code binary", run)
    kinds = materialise(marked.groupBy("code", *key).agg(F.count(F.lit(1)).alias("n")), "kinds")
    first = kinds.groupBy("code").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), *key, "n")).alias("best"))
    # a fingerprint of 64 bits is its own number
    first = materialise(first.withColumn(
        "node", F.conv(F.hex("code"), 16, -10).cast("long")), "codes")
    found = components(links(first.select("node", "code"), bits, 1))
    best = first.join(found, "node", "left").groupBy(
        F.coalesce("root", "node").alias("root")).agg(F.min("best").alias("best"))
    stay = materialise(best.select(*[F.col(f"best.{k}").alias(f"its_{k}") for k in [*key, "n"]]),
                       "stay")
    kept = rows.join(stay, F.col("id").eqNullSafe(F.col("its_id")) & (
        F.col("text_key") == F.col("its_text_key")) & (F.col("row_key") == F.col("its_row_key")))
    once = kept.where("its_n = 1").select("whole.*")
    again = kept.where("its_n > 1").dropDuplicates(["its_id", "its_text_key", "its_row_key"])
    return once.unionByName(again.select("whole.*"))
