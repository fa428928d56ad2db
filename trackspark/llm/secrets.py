"""Secret scans: fixed patterns, and novelty under a dictionary-primed compressor."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackspark.llm.common import map_rows

KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(
    r"""(?a:((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+))""")
_KEYWORD = re.compile(r"(?ai:password|passwd|secret|token|api_?key)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 and more is what [0-9a-f]+ takes whole
#: A string that could be a key (a shorter one stays below LEAST_BYTES even when it is random), and
#: words that make what follows them sensitive.
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{10,}={0,2}")
_DIGIT = re.compile(r"[0-9]")
#: Words in capitals or joined by capitals; they are measured in small letters too.
_WORDS = re.compile(r"(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,}+|[+/_-])++=*")
_SENSITIVE = re.compile(
    r"(?ai:passw|passwd|pwd|secret|token|api_?key|access|auth|bearer|credential|private|"
    r"signature|session|key)")
#: Characters before a candidate that make its context, around it that prime the compressor,
#: and of a candidate that are measured at once.
CONTEXT, AROUND, PIECE = 48, 1024, 1 << 16
#: Marginal bytes from which a candidate is new, and those per character: hex digits carry 0.5,
#: random small letters 0.6, base64 0.75. Without a digit it may be a word of its language, of which
#: half take 0.5 and nearly all below 0.65 where their length gives LEAST_BYTES.
LEAST_BYTES, NOVEL, NOVEL_LETTERS = 12, 0.5, 0.65
#: Identifiers of program code.
IDENTIFIERS = (
    "access_token api_key apikey application array async attribute authorization await base64 "
    "bearer boolean bucket buffer callback certificate class client client_id client_secret "
    "config configuration connection const container content context controller cookie "
    "credential database default delete description document element encoding endpoint "
    "environment exception expires export factory filename format function generator handler "
    "header hostname identifier implements import index instance integer interface iterator "
    "javascript json language length listener local location manager message metadata method "
    "module namespace null object option output override package parameter parent password path "
    "permission private process property protected provider public python query refresh_token "
    "register repository request require resource response return schema secret secret_key "
    "security selector self serialize server service session session_id settings signature "
    "source static status string struct system template thread throws timestamp token "
    "transaction undefined username validate value variable version void warning web_token "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0123456789abcdef "
    "<?xml version= https://www. http:// .com/ .org/ index.html utf-8 Lorem ipsum ")


class Novelty:
    """Marginal compressed bytes of a string behind its surroundings."""

    def __init__(self, identifiers: str = IDENTIFIERS):
        raw = zstandard.ZstdCompressionDict(
            identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(level=3)
        self._size = zstandard.ZstdCompressor(
            level=3, dict_data=raw, write_content_size=False, write_dict_id=False)

    def added(self, before: str, value: str, after: str) -> int:
        """Bytes that ``value`` adds to the compressed surroundings."""
        around, added = (before + " " + after + " ").encode(), 0
        base = len(self._size.compress(around))
        for at in range(0, len(value), PIECE):
            added += len(self._size.compress(around + value[at:at + PIECE].encode())) - base
        return added


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, matches that fail their length left out."""
    found = []
    if _KEYWORD.search(text):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text)
                  if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)
                  if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return found


def surroundings(text: str, a: int, b: int) -> tuple[str, str]:
    """AROUND characters on each side of text[a:b], further copies of that string blanked.

    Otherwise a key that is written twice would explain itself. The cut lies beyond copies that
    the window would cut, so that no part of one stays.
    """
    value, blank = text[a:b], " " * (b - a)
    before = text[max(0, a - AROUND - len(value)):a].replace(value, blank)
    after = text[b:b + AROUND + len(value)].replace(value, blank)
    return before[-AROUND:], after[:AROUND]


def novel_spans(text: str, novelty: Novelty) -> list[tuple[int, int, str]]:
    """Candidates in a sensitive context that neither identifiers nor surroundings explain.

    Each occurrence is measured against surroundings without the others, so all are reported.
    """
    found = []
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        if not _SENSITIVE.search(text, max(0, a - CONTEXT), a):
            continue
        before, after = surroundings(text, a, b)
        added, rate = novelty.added(before, m[0], after), NOVEL
        if not _DIGIT.search(m[0]):
            rate = NOVEL_LETTERS
            if _WORDS.fullmatch(m[0]):
                added = min(added, novelty.added(before, m[0].lower(), after))
        if added >= max(LEAST_BYTES, rate * (b - a)):
            found.append((a, b, "novel"))
    return found


def _joined(spans: list[tuple[int, int, str]]) -> str:
    spans = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_novel, base_sha256, spans) for each row of ``docs``.

    Offsets are code points, the end exclusive. Null and empty texts have no spans. Row-wise, so
    repeated rows and ids need no care.
    """
    def run(batch: pa.RecordBatch) -> dict:
        novelty = Novelty()
        out = {k: [] for k in ("n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans")}
        for value in batch.column(1).to_pylist():
            base = base_spans(value or "")
            new = novel_spans(value or "", novelty)
            for kind in KINDS:
                out[f"n_{kind}"].append(sum(s[2] == kind for s in base + new))
            out["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
            out["spans"].append(_joined(base + new))
        return {"doc_id": batch.column(0)} | out

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.col(text).cast("string").alias("text"))
    return map_rows(rows, "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, "
                          "base_sha256 string, spans string", run)
