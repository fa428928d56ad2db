"""Toxicity: a lexicon trie met with Levenshtein automata, and the context of each hit."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackspark.llm import ridge
from trackspark.llm.common import crc_part, map_rows, materialise

#: Bound of the labelled sample that the lexicon is learned from, per class. The lexicon has no other.
SAMPLE = 20_000
#: A term occurs in so many different toxic texts at least, so much rather there (log odds), and so
#: many standard deviations more often than in the others.
LEAST, LEAST_ODDS, LEAST_SIGMA = 5, 2.0, 4.0
#: States of the automata that are kept at once.
STATES = 50_000
#: Letters of a stem, written with a star behind; a word that has this share of a stem's toxic
#: texts stands for it.
STEMS, STANDS_FOR = (5, 6, 7, 8), 0.8
#: What a misspelling counts, and log odds below which a near word is a word of its own.
MISSPELLED, OWN_WORD = 0.9, 1.0
#: Words around a hit that are its context, and of a window whose hits are counted.
CONTEXT, WINDOW = 6, 40
THRESHOLD = 0.5
#: Words that report speech.
REPORTS = frozenset("said says called calls wrote writes quote quoted quotes word term phrase "
                    "insult slur dit écrit mot citation sagte schrieb wort zitat dijo palabra "
                    "cita".split())
FEATURES = ("abuse", "strongest", "quoted", "density", "window", "any")
#: Weights of hits are divided by this, and their sum counts up to so much.
STRONG, MOST = 6.0, 4.0
_WORD = re.compile(r"[^\W_]+")
_QUOTES = '"“”„«»‘’\''


def edits(term: str) -> int:
    """Edits within which a word is a misspelling of ``term``."""
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class FuzzyLexicon:
    """The trie of a lexicon met with the Levenshtein automata of its terms.

    A state is a set of (trie node, edits so far). States and moves are made when a word first
    needs them and kept, so that scanning is one table look-up per character; most words die in
    the empty state after a few. A term that ends with a star is a stem: its node accepts any word
    that goes on after it, so a state that has met a stem keeps it, as a negative node, to the end
    of the word. ``exact`` terms allow no edits.
    """

    def __init__(self, terms: Iterable[str], own_words: Iterable[str] = (),
                 exact: Iterable[str] = ()):
        terms = set(terms)
        self.own_words = set(own_words) - terms
        self.edits = {t: edits(t.rstrip("*")) for t in terms} | dict.fromkeys(terms & {*exact}, 0)
        self.children: list[dict[str, int]] = [{}]
        self.ends: dict[int, str] = {}
        self.stems: dict[int, str] = {}
        self.slack = [0]  # the most edits that any term below a node allows
        for term in sorted(terms):
            node, most = 0, self.edits[term]
            self.slack[0] = max(self.slack[0], most)
            for c in term.rstrip("*"):
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.slack.append(0)
                node = self.children[node][c]
                self.slack[node] = max(self.slack[node], most)
            (self.stems if term.endswith("*") else self.ends)[node] = term
        self.alphabet = {c for kids in self.children for c in kids}
        self._clear()

    def _clear(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.dead = self._state({})
        self.start = self._state({0: 0})

    def _state(self, found: dict[int, int]) -> int:
        """The state of the least edits per node, terms' skipped letters included."""
        todo = list(found.items())
        while todo:
            node, e = todo.pop()
            if node < 0 or found.get(node, e) < e:
                continue
            for child in self.children[node].values():
                if e + 1 <= self.slack[child] and found.get(child, 99) > e + 1:
                    found[child] = e + 1
                    todo.append((child, e + 1))
        key = frozenset(found.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
        return self.states[key]

    def _move(self, state: int, c: str) -> int:
        found: dict[int, int] = {}

        def reach(node: int, e: int) -> None:
            if (node < 0 or e <= self.slack[node]) and found.get(node, 99) > e:
                found[node] = e

        for node, e in self.sets[state]:
            if node < 0:
                reach(node, e)
                continue
            if node in self.stems and e <= self.edits[self.stems[node]]:
                reach(-node, e)
            reach(node, e + 1)
            for letter, child in self.children[node].items():
                reach(child, e + (letter != c))
        return self._state(found)

    def matches(self, word: str) -> list[tuple[int, str]]:
        """Edits and name of every term that is near enough; own words match nothing."""
        if word in self.own_words:
            return []
        if len(self.sets) > STATES:
            self._clear()
        state, alphabet, moves, dead = self.start, self.alphabet, self.moves, self.dead
        for c in word:
            if c not in alphabet:
                c = ""
            after = moves[state].get(c)
            if after is None:
                after = moves[state][c] = self._move(state, c)
            if after == dead:
                return []
            state = after
        near = ((e, self.stems[-n] if n < 0 else self.ends.get(n)) for n, e in self.sets[state])
        return [(e, term) for e, term in near if term is not None and e <= self.edits[term]]

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term and its edits: of equals a whole term, the longest stem, by name."""
        near = self.matches(word)
        if not near:
            return None
        e, _, _, term = min((e, t.endswith("*"), -len(t) if t.endswith("*") else 0, t)
                            for e, t in near)
        return term, e


def hits(text: str, lexicon: FuzzyLexicon, known: dict[str, tuple[str, int] | None]
         ) -> tuple[list[tuple[int, int, str, int, bool]], int]:
    """((start, end, term, edits, quoted) of each hit, number of words) of a whole text."""
    low = text.lower()
    if len(low) != len(text):  # some capitals are longer in lower case
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    words = _WORD.findall(low)
    wanted = set()
    for w in set(words):
        if w not in known:
            known[w] = lexicon.match(w)
        if known[w] is not None:
            wanted.add(w)
    if not wanted:
        return [], len(words)
    found, spans = [], [m.span() for m in _WORD.finditer(low)]
    for i, w in enumerate(words):
        if w in wanted:
            a, b = max(0, i - CONTEXT), min(len(words), i + CONTEXT + 1)
            left, right = low[spans[a][0]:spans[i][0]], low[spans[i][1]:spans[b - 1][1] + 1]
            marks = any(q in left for q in _QUOTES) and any(q in right for q in _QUOTES)
            report = not REPORTS.isdisjoint(words[max(0, i - CONTEXT):i])
            found.append((*spans[i], *known[w], marks or report))
    return found, len(words)


def features_of(found: list[tuple[int, int, str, int, bool]], places: int,
                weights: dict[str, float]) -> list[float]:
    each = [weights[h[2]] / STRONG * (MISSPELLED if h[3] else 1.0) for h in found]
    open_ = [w for w, h in zip(each, found, strict=True) if not h[4]]
    quoted = sum(w for w, h in zip(each, found, strict=True) if h[4])
    near, first, inside = 0.0, 0, 0.0
    for i, h in enumerate(found):
        inside += each[i]
        while h[0] - found[first][0] > WINDOW * 6:
            inside -= each[first]
            first += 1
        near = max(near, inside)
    abuse = sum(open_)
    return [min(abuse, MOST) / MOST, max(open_, default=0.0), min(quoted, MOST) / MOST,
            min(1.0, 20 * abuse / (places + 1)), min(near, MOST) / MOST, float(abuse > 0)]


def scan(docs: DataFrame, terms: dict[str, float], own_words: list[str], doc_id: str = "doc_id",
         text: str = "text", exact: Iterable[str] = ()) -> DataFrame:
    """(doc_id, f, spans) for each row: its FEATURES and its hits as start:end:term:edits:quoted."""
    def run(batch: pa.RecordBatch) -> dict:
        lexicon, known = FuzzyLexicon(terms, own_words, exact), {}
        rows, spans = [], []
        for value in batch.column(1).to_pylist():
            if len(known) > 1 << 19:
                known.clear()
            found, places = hits(value or "", lexicon, known)
            rows.append(features_of(found, places, terms))
            spans.append([":".join(map(str, (*h[:4], int(h[4])))) for h in found])
        return {"doc_id": batch.column(0), "f": pa.array(rows, pa.list_(pa.float64())),
                "spans": pa.array(spans, pa.list_(pa.string()))}

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.col(text).cast("string").alias("text"))
    return map_rows(rows, "doc_id long, f array<double>, spans array<string>", run)


def _odds(toxic: int, clean: int):
    return (F.log((F.col("t") + 0.5) / float(toxic + 1))
            - F.log((F.col("n") + 0.5) / float(clean + 1)))


def _stems_of(words: str, k: int):
    longer = F.filter(words, lambda w: F.length(w) > k)
    return F.transform(longer, lambda w: F.concat(F.substring(w, 1, k), F.lit("*")))


def _pruned(found: dict[str, tuple[int, int, float]]) -> dict[str, float]:
    """Weights of the terms from (toxic texts, clean texts, log odds) of each candidate.

    A stem goes where one word stands for it. A term under a stem has a weight of its own only if it
    is significantly more toxic than that stem; otherwise a longer stem goes, and a word stays, so
    that its misspellings are found, with the weight of the stem, which rests on more texts.
    """
    best: dict[str, int] = {}  # per stem, the most toxic texts of a word that begins with it
    for w, (t, _, _) in found.items():
        if not w.endswith("*"):
            for k in STEMS:
                if len(w) >= k:
                    best[w[:k]] = max(best.get(w[:k], 0), t)
    terms: dict[str, float] = {}
    for w in sorted(found, key=lambda w: (not w.endswith("*"), len(w), w)):
        t, n, odds = found[w]
        letters, stem = w.rstrip("*"), w.endswith("*")
        if stem and best.get(letters, 0) >= STANDS_FOR * t:
            continue
        over = [letters[:k] + "*" for k in STEMS if k <= len(letters) - stem
                and letters[:k] + "*" in terms]
        if over:
            many, few, _ = found[over[-1]]
            p = (many + 0.5) / (many + few + 1)
            if t - (t + n) * p <= LEAST_SIGMA * ((t + n) * p * (1 - p)) ** 0.5:
                if stem:
                    continue
                odds = terms[over[-1]]
        terms[w] = float(odds)
    return dict(sorted(terms.items()))


def learn_lexicon(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text"
                  ) -> tuple[dict[str, float], list[str], list[str]]:
    """(terms that mark toxic documents with their log odds, clean words near them, exact terms).

    Terms are words of any length, or stems of some letters with any end; all that are significant.
    Only documents that are not held out count, copies once, by distinct word and stem: a sample of
    about SAMPLE labelled ids of each class, those with the smallest hashes; that list is small
    enough to broadcast, and it bounds the lexicon. Words near a term that the sample does not
    hold are judged by those it holds once: if these are not as toxic as a term is, it allows no edits.
    """
    known = ridge.one_label(labels, "toxic").where(crc_part("doc_id", 5) != 0).select(
        F.col("doc_id").alias("_id"), F.col("y").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return {}, [], []
    share = F.when(F.col("toxic") == 1, SAMPLE / sizes[1]).otherwise(SAMPLE / sizes[0])
    part = F.pmod(F.xxhash64("_id"), F.lit(1 << 32)) / float(1 << 32)
    sample = known.where(part < share)
    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), text).join(
        F.broadcast(sample), "_id").select(
        "toxic", F.lower(F.coalesce(F.col(text), F.lit(""))).alias("low"))
    rows = materialise(rows.groupBy(F.xxhash64("low").alias("copy")).agg(
        F.max("toxic").alias("toxic"), F.first("low").alias("low")), "labelled")
    total = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = total.get(1, 0), total.get(0, 0)
    words = F.array_distinct(F.regexp_extract_all(
        F.col("low"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    stems = [_stems_of("words", k) for k in STEMS]
    counts = materialise(
        rows.select("toxic", words.alias("words"))
        .select("toxic", F.explode(F.array_distinct(F.concat("words", *stems))).alias("word"))
        .groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("n")),
        "word-counts")
    odds = _odds(toxic, clean)
    usual = (F.col("n") + 0.5) * (toxic / (clean + 1))
    best = counts.where((F.col("t") >= LEAST) & (odds >= LEAST_ODDS)
                        & (F.col("t") - usual > LEAST_SIGMA * F.sqrt(usual + 1)))
    terms = _pruned({r["word"]: (r["t"], r["n"], r["odds"]) for r in
                     best.select("word", "t", "n", odds.alias("odds")).collect()})

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = FuzzyLexicon(terms)
        for batch in batches:
            found = [lexicon.matches(w) for w in batch.column(0).to_pylist()]
            found = [[] if any(e == 0 for e, _ in near) else [t for _, t in near]
                     for near in found]
            yield batch.append_column("terms", pa.array(found, pa.list_(pa.string()))).filter(
                pa.array([bool(near) for near in found]))

    others = counts.where(~F.col("word").endswith("*"))
    others = materialise(others.select("word", "t", "n").mapInArrow(
        near, "word string, t long, n long, terms array<string>"), "near-words")
    once = others.where(F.col("t") + F.col("n") == 1).select(
        F.explode("terms").alias("term"), "t", "n").groupBy("term").agg(
        F.sum("t").alias("t"), F.sum("n").alias("n"))
    exact = sorted(r["term"] for r in
                   once.where((F.col("n") > 0) & (odds < LEAST_ODDS)).select("term").collect())
    own = others.where(odds < OWN_WORD).where(
        F.size(F.array_except("terms", F.lit(exact) if exact else F.array())) > 0)
    return terms, sorted(r["word"] for r in own.select("word").collect()), exact


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``.

    Hits in a quotation or after a word that reports speech count apart from others; how much
    each kind says is learned. Null and empty texts have no hits; without labels the lexicon is
    empty and all scores are near one half. Ids with labels of both kinds teach nothing.
    """
    terms, own_words, exact = learn_lexicon(docs, labels, doc_id, text)
    rows = scan(docs, terms, own_words, doc_id, text, exact).select(
        "doc_id", "f", (crc_part("doc_id", 5) == 0).alias("held_out"))
    rows = materialise(rows, "hits")
    width = len(FEATURES)
    return ridge.learned(rows, labels, "toxic", width, np.asarray, width, 1e-3, THRESHOLD)
