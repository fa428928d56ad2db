"""Quality rules, phrases and tokenizer alignment against brute force, on awkward rows."""

import collections
import hashlib
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackspark.llm import align, phrases, rules

SF = "/root/testdata/sf0.001"
WORDS = ["".join(random.Random(i).choices("abcdefgh", k=2 + i % 6)) for i in range(60)]
CLASHES = {"h": 1, "f": 2, "grp": 3, "word": "w", "words": "v", "row": 4, "key": 5, "rare": 6,
           "n_words": 7, "kept": "k"}


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", ".\n", "  "])
                    for _ in range(n))


def texts():
    out = [prose(i, 40 + 11 * i) for i in range(40)]
    return out + [out[3], out[3], None, "", " \n ", "a", "Ab\tCD", "x" * 4000, "ÉÀ ß İ ẞ b.c;d",
                  "one line twice\none line twice\none line twice", prose(5, 9000),
                  "a\x0bb\x0cc\rd\x85e f", "w " * 300, "### *** !! " * 40]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None][i % 3]) for i, t in enumerate(texts())]
    rows += [(None, "without an id, twice", None)] * 2 + [rows[1]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return df.withColumns({k: F.lit(v) for k, v in CLASHES.items()}).repartition(4).cache()


@pytest.fixture(scope="module")
def given():
    """All documents of the smallest given table."""
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    return f"{SF}/documents.parquet"


# ---- quality rules -----------------------------------------------------------------------

def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = collections.Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, repeated = len(words), len(hit)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), repeated, n < 50 or 100 * repeated > 50 * n)


def test_base_statistics_equal_brute_force(spark, docs, given):
    for df in (docs, spark.read.parquet(given)):
        want = sorted((str(r.doc_id), *base(r.text)) for r in df.collect())
        rows = rules.judged(df).collect()
        assert sorted((str(r[0]), *r[1:7]) for r in rows) == want
        assert not any(r.kept and r.base_failed for r in rows)
    empty = rules.judged(docs.where("false"))
    assert empty.count() == 0 and empty.columns[-2:] == ["kept", "probability"]


def test_fit_finds_accuracies_of_independent_rules():
    rng = np.random.default_rng(3)
    clean = rng.random(60_000) < 0.8
    passes, finds = [0.99, 0.97, 0.95, 0.98, 0.9], [0.8, 0.7, 0.75, 0.6, 0.9]
    votes = np.stack([np.where(rng.random(len(clean)) < np.where(clean, p, 1 - f), 1, -1)
                      for p, f in zip(passes, finds, strict=True)], 1)
    votes[rng.random(votes.shape) < 0.2] = 0
    kind, count = np.unique(votes, axis=0, return_counts=True)
    model = rules.fit(kind, count)
    assert model.clean == pytest.approx(0.8, abs=0.02)
    assert model.passes == pytest.approx(passes, abs=0.03)
    assert model.finds == pytest.approx(finds, abs=0.06)


def test_posterior_is_that_of_the_model(spark, docs):
    """The column of log odds against the same sum in plain Python, for each document."""
    model = rules.Model(0.9, tuple(0.5 + 0.04 * i for i in range(11)), (0.97,) * 11)
    votes = [r.vote().alias(f"v{i}") for i, r in enumerate(rules.rules())]
    stats = rules.text_statistics(docs)
    rows = stats.select(*votes, model.log_odds([r.vote() for r in rules.rules()]).alias("odds"))
    for r in rows.collect():
        want = np.log(9.0)
        for v, f, p in zip(r[:11], model.finds, model.passes, strict=True):
            want += {1: np.log(p / (1 - f)), -1: np.log((1 - p) / f), 0: 0.0}[v]
        assert r.odds == pytest.approx(want)


def test_one_failed_rule_does_not_drop_and_junk_goes(spark, given):
    df = spark.read.parquet(given)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = rules.judged(df).where("not base_failed").join(labels, "doc_id").collect()
    right = sum(r.kept == (r.quality == 1) for r in rows)
    assert right >= 0.97 * len(rows) > 20


# ---- phrases -----------------------------------------------------------------------------

def mined(rows, least, depth, top):
    n, f = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = (text or "").encode().lower().decode()
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, depth + 1):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i:i + m])] += 1
    often = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    covered = {(lang, g[i:i + m]) for (lang, g), a in often.items() for m in range(2, len(g))
               for i in range(len(g) - m + 1) if a >= f[lang, g[i:i + m]]}
    out = collections.defaultdict(list)
    for (lang, g), a in often.items():
        if (lang, g) not in covered:
            cuts = [(1000 * a * n[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k)
                    for k in range(1, len(g))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -score)
                  for lang, found in out.items()
                  for i, (score, a, p, left, right) in enumerate(sorted(found)[:top]))


@pytest.mark.parametrize("budget", [1 << 20, 200, 3])
def test_phrases_equal_brute_force(spark, docs, budget):
    """A small budget lengthens prefixes up to whole suffixes and packs many groups."""
    line = "the very common line stands, once more the very common line\n"
    df = docs.unionByName(docs.where("doc_id < 30").withColumn("text", F.concat(
        F.lit(line), "text")))
    want = mined([(r.lang, r.text) for r in df.collect()], 8, 5, 40)
    got = phrases.collocations(df, least=8, top=40, budget=budget)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 50
    assert phrases.collocations(df.where("false"), budget=budget).count() == 0
    assert phrases.collocations(df.select(
        "doc_id", F.lit(None).cast("string").alias("text"), "lang")).count() == 0


def test_long_texts_are_read_in_blocks(monkeypatch):
    texts_ = [prose(1, 500).encode(), b"a b", b"", b"x" * 300]
    ids, known = phrases.numbered([b"en"] * 4, texts_)
    monkeypatch.setattr(phrases, "BLOCK", 20)
    again, same = phrases.numbered([b"en"] * 4, texts_)
    assert ids.tolist() == again.tolist() and known == same


def test_scores_pass_64_bits(spark):
    f = spark.sql("select 9000000000000000000L a, 9000000000000000000L b")
    got = f.select(phrases._big("a") * phrases._big("b")).first()[0]
    assert int(got) == 81 * 10 ** 36


def test_packed_groups_stay_near_the_budget():
    sizes = np.random.default_rng(2).integers(0, 400, 2048)
    groups = phrases._packed(sizes, 20_000)
    load = np.bincount(groups, sizes)
    assert len(load) == -(-sizes.sum() // 20_000) and load.max() <= 20_400


# ---- alignment ---------------------------------------------------------------------------

ODD = ["  lead  two  ", "a▁b", "<|endoftext|> x <0x41> it's 's", "tab\tand\nline \n x", "▁", " ",
       "日本語 テスト 😀 é́", "a\x00b c\x1cd \x85 q", "nb 　 wide", "don't  stop   now    "]


@pytest.fixture(scope="module")
def pair():
    if not os.path.isdir(align.TOKENIZERS):
        pytest.skip("tokenizer files not present")
    files = [open(f"{align.TOKENIZERS}/{f}", "rb").read() for f in (align.FILE_A, align.FILE_B)]
    return align.Pair(*files)


def side_by_side(pair, text):
    """Tokens, groups and links of a text that is encoded whole; None without tokens."""
    if not text:
        return None
    a = pair.a.encode(" " + text, add_special_tokens=False).ids
    b = pair.b.encode(text)
    own = (" " + text).encode()
    if (b"".join(pair.bytes_a[x] for x in a) != own
            or b"".join(pair.bytes_b[x] for x in b) != own):
        return None
    ends = [np.cumsum([len(t[x]) for x in ids]).tolist()
            for t, ids in ((pair.bytes_a, a), (pair.bytes_b, b))]
    groups, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        k, m = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
        groups.append((a[i:k], b[j:m]))
        i, j = k, m
    return len(a), len(b), groups, [(x[-1], y[-1]) for x, y in groups]


def compared(rows):
    count = collections.Counter(link for _, x in rows if x for link in x[3])
    best = collections.Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    for i, x in rows:
        if x is None:
            yield str(i), 0, 0, 0, 0, 0, 0, ""
            continue
        said = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in x[2])
        yield (str(i), x[0], x[1], len(x[2]), len(x[3]),
               sum(count[p] == best[p[1]] for p in x[3]), sum(count[p] for p in x[3]),
               hashlib.sha256(said.encode()).hexdigest())


@pytest.mark.parametrize("most", [align.MOST_PAIRS, 300, 0])
def test_alignment_equals_brute_force(spark, docs, given, pair, monkeypatch, most):
    """With all, some and none of the pair counts sent to the tasks."""
    monkeypatch.setattr(align, "MOST_PAIRS", most)
    odd = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(ODD)],
                                "doc_id long, text string")
    df = docs.unionByName(odd, allowMissingColumns=True).unionByName(
        spark.read.parquet(given).where("doc_id < 60"), allowMissingColumns=True)
    want = sorted(compared([(r.doc_id, side_by_side(pair, r.text)) for r in df.collect()]))
    got = sorted((str(r[0]), *r[1:]) for r in align.alignment(df).collect())
    assert got == want and sum(w[1] == 0 for w in want) >= 4
    assert align.alignment(df.where("false")).count() == 0


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 64, 10_000])
def test_pieces_find_each_shared_end_once(piece):
    rng = np.random.default_rng(piece)
    for _ in range(40):
        a, b = (np.flatnonzero(rng.random(200) < p) for p in rng.random(2))
        got = align.shared_ends(a, b, piece)
        assert a[got[:, 0]].tolist() == b[got[:, 1]].tolist() == np.intersect1d(a, b).tolist()
        cuts = align.merge_path(a, b, piece)
        assert (np.diff(cuts.sum(1)) <= piece).all() and cuts[-1].tolist() == [len(a), len(b)]


def test_parts_encode_as_the_whole_text(pair):
    assert pair.divisible and pair.parts("a b  c d\te") == ["a", "b  c", "d\te"]
    for text in [*ODD, *[t for t in texts() if t]]:
        one = align.aligned(pair, pair.parts(text), piece=50)
        ids = pair.a.encode(" " + text, add_special_tokens=False).ids
        if (one.n_a >= 0).all():
            assert one.ids[0].tolist() == ids and one.ids[1].tolist() == pair.b.encode(text)
