"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Each rule looks at one statistic of a text and votes good, bad or not at all. Nobody says how
often a rule is right: the votes of all documents are counted by pattern, and a two-class
latent model is fitted to the counts, which gives each rule a chance to find junk and a chance
to pass clean text. A document is kept by the posterior probability of being clean, so one
failed rule does not drop it and no rule need pass.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackspark.llm.common import map_rows, materialise, text_bytes

# ---- Fixed values: the base checks -------------------------------------------------------
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words

#: A document is kept from this posterior probability on.
KEEP_FROM = 0.5
ROUNDS = 200
#: Doubt that one bad vote leaves before the first round.
START = 0.4
#: Votes each rule is given before the data, right and wrong: a rule knows one kind of junk only,
#: so it misses most of it, but passes nearly all clean text.
PRIOR_FINDS, PRIOR_PASSES = (3.0, 7.0), (49.0, 1.0)

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
         "n_ended", "n_types", "n_upper", "n_letters", "n_mark_ends", "n_bare")
BASE = STATS[:5]

_SPACES = [0x20, *range(0x09, 0x0E)]
_UPPER, _LOWER = slice(0x41, 0x5B), slice(0x61, 0x7B)
_ENDS = (b".", b"!", b"?", b'"', b":", b";")
#: Words that end in two marks or more, and words without a letter.
_MARK_ENDS = re.compile(rb"[!-/:-@[-`{-~]{2}(?=[\x20\x09-\x0D]|\Z)")
_BARE = re.compile(rb"(?:(?<=[\x20\x09-\x0D])|(?<![\0-\xFF]))[!-@[-`{-~]+(?=[\x20\x09-\x0D]|\Z)")


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window which the text holds twice or more."""
    if len(words) < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    pairs = np.unique(ids[:-2] * len(seen) + ids[1:-1], return_inverse=True)[1]
    _, at, count = np.unique(pairs * len(seen) + ids[2:], return_inverse=True, return_counts=True)
    hit = np.zeros(len(words), bool)
    first = np.flatnonzero(count[at] > 1)
    for k in range(3):
        hit[first + k] = True
    return int(hit.sum())


def statistics(text: bytes) -> tuple[int, ...]:
    """The values of STATS for a whole text in UTF-8."""
    words = text.split()  # ASCII white space, as asked for
    chars = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    points = len(text) - int(chars[0x80:0xC0].sum())
    lines, seen, again, ended = 0, set(), 0, 0
    for line in text.split(b"\n"):
        if not (bare := line.strip()):
            continue
        lines += 1
        again += line in seen
        seen.add(line)
        ended += bare.endswith(_ENDS)
    # a letter beyond ASCII starts with a byte from 0xC3 on
    letters = int(chars[_UPPER].sum() + chars[_LOWER].sum() + chars[0xC3:].sum())
    return (len(words), points - int(chars[_SPACES].sum()), int(chars[list(SYMBOLS)].sum()), again,
            repeated_words(words), lines, ended, len(set(words)), int(chars[_UPPER].sum()),
            letters, len(_MARK_ENDS.findall(text)), len(_BARE.findall(text)))


@dataclass(frozen=True)
class Rule:
    """Votes good where ``value`` lies in ``good``, bad where it lies outside ``fair``.

    Between the two, and where ``asked`` does not hold, it abstains.
    """

    name: str
    value: Column
    good: tuple[float, float]
    fair: tuple[float, float]
    asked: Column

    def vote(self) -> Column:
        v = self.value
        return (F.when(~F.coalesce(self.asked, F.lit(False)), 0)
                .when(v.between(*self.good), 1)
                .when(~v.between(*self.fair), -1).otherwise(0))


def rules() -> list[Rule]:
    """Eleven rules, none of which knows a language."""
    def share(part: str, whole: str) -> Column:
        return F.col(part) / F.col(whole)

    words, enough = F.col("n_words") > 0, F.col("n_words") >= 20
    letters, lines = F.col("n_letters") >= 20, F.col("n_lines") >= 4
    most = float("inf")
    return [
        Rule("long enough", F.col("n_words"), (LEAST_WORDS, most), (20, most), F.lit(True)),
        Rule("word length", share("word_chars", "n_words"), (3, 9), (2.5, 12), words),
        Rule("few symbols", share("n_symbols", "n_words"), (0, 0.02), (0, 0.1), words),
        Rule("few equal lines", share("n_dup_lines", "n_lines"), (0, 0.1), (0, 0.3), lines),
        Rule("few repeats", share("n_repeat_words", "n_words"), (0, 0.1), (0, 0.3), enough),
        Rule("ended lines", share("n_ended", "n_lines"), (0.5, 1), (0.2, 1), F.col("n_lines") > 0),
        Rule("many words", share("n_types", "n_words"), (0.3, 1), (0.1, 1),
             enough & (F.col("n_words") <= 2000)),
        Rule("small letters", share("n_upper", "n_letters"), (0, 0.15), (0, 0.4), letters),
        Rule("letters", share("n_letters", "word_chars"), (0.85, 1), (0.75, 1), words),
        Rule("plain ends", share("n_mark_ends", "n_words"), (0, 0.05), (0, 0.2), words),
        Rule("worded", share("n_bare", "n_words"), (0, 0.05), (0, 0.2), words),
    ]


@dataclass(frozen=True)
class Model:
    """``clean``: share of clean documents. Per rule: P(bad vote | junk), P(good vote | clean)."""

    clean: float
    finds: tuple[float, ...]
    passes: tuple[float, ...]

    def log_odds(self, votes: list[Column]) -> Column:
        """Of being clean, by the votes; an abstention says nothing."""
        return reduce(add, (
            F.when(v == 1, float(np.log(p / (1 - f)))).when(v == -1, float(np.log((1 - p) / f)))
            .otherwise(0.0) for v, f, p in zip(votes, self.finds, self.passes, strict=True)),
            F.lit(float(np.log(self.clean / (1 - self.clean)))))


def fit(votes: np.ndarray, count: np.ndarray) -> Model:
    """Expectation-maximisation over vote patterns (k, rules) that occur ``count`` times each.

    Rules vote bad only far outside the usual, so it starts from documents without a bad vote as
    clean and takes each bad vote as a doubt; the classes cannot change places then, and junk of
    several kinds, which rarely fails the same rules, is one class. A rule that fails many
    documents no other rule doubts loses its weight in the rounds. Without any document the prior
    stays.
    """
    good, bad = votes == 1, votes == -1
    clean = START ** (1 + bad.sum(1))
    clean = np.where(bad.any(1), clean, 1 - START / 10)
    for _ in range(ROUNDS):
        is_clean, is_junk = count * clean, count * (1 - clean)
        passes = (good.T @ is_clean + PRIOR_PASSES[0]) / (
            (good | bad).T @ is_clean + sum(PRIOR_PASSES))
        finds = (bad.T @ is_junk + PRIOR_FINDS[0]) / (
            (good | bad).T @ is_junk + sum(PRIOR_FINDS))
        part = (is_clean.sum() + 1) / (count.sum() + 2)
        odds = (np.log(part / (1 - part)) + good @ np.log(passes / (1 - finds))
                + bad @ np.log((1 - passes) / finds))
        new = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        moved = np.abs(new - clean).max(initial=0.0)
        clean = new
        if moved < 1e-9:
            break
    return Model(float(part), tuple(finds.tolist()), tuple(passes.tolist()))


def text_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, STATS) for each row; null texts have no words."""
    def run(batch: pa.RecordBatch) -> dict:
        rows = [statistics(t) for t in batch.column(1).to_pylist()]
        found = np.array(rows, np.int64).reshape(-1, len(STATS))
        return {"doc_id": batch.column(0)} | {k: found[:, i] for i, k in enumerate(STATS)}

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(text).alias("text"))
    return map_rows(rows, "doc_id long, " + ", ".join(f"{k} long" for k in STATS), run)


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
           keep_from: float = KEEP_FROM) -> DataFrame:
    """(doc_id, base statistics, base_failed, kept, probability), one row per row of ``docs``.

    The vote patterns of all documents are counted; their table has at most 3 to the power of
    the number of rules rows, which is what the driver fits. Null, empty and white texts have
    no words and fail. Repeated rows and null ids count as any row; an empty table gives none.
    """
    stats = materialise(text_statistics(docs, doc_id, text), "rule-statistics")
    votes = [rule.vote().alias(f"v{i}") for i, rule in enumerate(rules())]
    names = [f"v{i}" for i in range(len(votes))]
    counts = stats.select(*votes).groupBy(*names).count().collect()
    table = np.array([tuple(r) for r in counts], np.int64).reshape(-1, len(names) + 1)
    model = fit(table[:, :-1], table[:, -1])
    odds = model.log_odds([rule.vote() for rule in rules()])
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return stats.select("doc_id", *BASE, failed.alias("base_failed"),
                        (1 / (1 + F.exp(-odds))).alias("probability")).select(
        "doc_id", *BASE, "base_failed",
        (~F.col("base_failed") & (F.col("probability") >= keep_from)).alias("kept"),
        "probability")
