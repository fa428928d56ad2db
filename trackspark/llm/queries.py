"""Registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trackspark.llm import (
    align,
    decontaminate,
    language,
    mixing,
    phrases,
    quality,
    rules,
    secrets,
    sharding,
    simhash,
    suffixes,
    topk,
    toxicity,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(_table(spark, sf_dir, "embeddings"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicated(_table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language(_table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(_table(spark, sf_dir, "documents"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_topk": op2_topk,
    "op3_sharding": op3_sharding,
    "op4_secrets": op4_secrets,
    "op5_quality": op5_quality,
    "op6_decontamination": op6_decontamination,
    "op7_suffixes": op7_suffixes,
    "op8_toxicity": op8_toxicity,
    "op9_language": op9_language,
    "op10_mixing": op10_mixing,
    "op11_quality_rules": op11_quality_rules,
    "op12_phrases": op12_phrases,
    "op13_alignment": op13_alignment,
}

_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BREAK, _PLAIN = r"[.,;:!?\x0A-\x0D]", r"[^\x20\x09]+"
_LOW = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
        "'abcdefghijklmnopqrstuvwxyz')")

ORACLE: dict[str, str] = {
    "op2_topk": """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as x
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(
    list_zip(q.x, c.x), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0)
select query_id, cast(rank as int) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank
      from scored)
where rank <= 5
""",
    "op6_decontamination": f"""
with item_words as (
  select cast(item_id as varchar) as item, regexp_extract_all({_LOW}, '{_WORD}') as ws
  from benchmark),
item_windows as (
  select item, list_slice(ws, i, i + 9) as win
  from (select item, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) as i
        from item_words where len(ws) > 0)),
wins as (
  select win, len(win) as w, list(distinct item) filter (where item is not null) as items
  from item_windows group by win),
doc_words as (
  select row_number() over () as r, doc_id, regexp_extract_all({_LOW}, '{_WORD}') as ws
  from documents),
places as (
  select r, ws, w, unnest(range(1, len(ws) - w + 2)) as s
  from doc_words, (select distinct w from wins) where len(ws) >= w),
found as (
  select p.r, p.s, p.w, wins.items
  from (select r, s, w, list_slice(ws, s, s + w - 1) as win from places) p
  join wins on p.win = wins.win),
hits as (
  select r, count(distinct pos) as n_hit
  from (select r, unnest(range(s, s + w)) as pos from found) group by r),
ids as (
  select r, list_sort(list(distinct item)) as ids
  from (select r, unnest(items) as item from found) group by r)
select d.doc_id, cast(len(d.ws) as bigint) as n_words, coalesce(h.n_hit, 0) as n_hit,
       cast(coalesce(len(i.ids), 0) as bigint) as n_items,
       sha256(coalesce(array_to_string(i.ids, ','), '')) as items_sha256,
       coalesce(h.n_hit, 0) > 0 as contaminated
from doc_words d left join hits h on d.r = h.r left join ids i on d.r = i.r
""",
    "op12_phrases": f"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_LOW}, '{_BREAK}')) as piece
  from documents),
words as (select lang, regexp_extract_all(piece, '{_PLAIN}') as ws from pieces),
total as (select lang, cast(sum(len(ws)) as bigint) as n from words group by lang),
grams as (
  select lang, m, list_slice(ws, i, i + m - 1) as g
  from (select lang, ws, m, unnest(range(1, len(ws) - m + 2)) as i
        from words, (values (1), (2), (3), (4), (5)) t(m) where len(ws) >= m)),
f as (select lang, m, g, count(*) as f from grams group by lang, m, g having count(*) >= 100),
cuts as (
  select p.lang, p.m, p.g, p.f as a, k, x.f as l, y.f as r, n,
         cast((1000::hugeint * p.f * n) // (x.f::hugeint * y.f) as bigint) as score
  from (select *, unnest(range(1, m)) as k from f where m > 1) p
  join total using (lang)
  join f x on x.lang = p.lang and x.g = list_slice(p.g, 1, p.k)
  join f y on y.lang = p.lang and y.g = list_slice(p.g, p.k + 1, p.m)),
best as (
  select * from cuts qualify row_number() over (partition by lang, g order by score, k) = 1),
inside as (
  select lang, list_slice(g, i, i + w - 1) as g, max(f) as longer
  from (select lang, g, f, w, unnest(range(1, m - w + 2)) as i
        from f, (values (2), (3), (4)) t(w) where m > w) group by all)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank,
       phrase, a, l, r, n, score
from (select b.*, array_to_string(b.g, ' ') as phrase from best b
      left join inside i on i.lang = b.lang and i.g = b.g where coalesce(longer, 0) < a)
qualify rank <= 2000
""",
}
