"""Benchmark decontamination as a prefix-filtered set join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trackspark.functions.once import computed_once
from trackspark.llm.common import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words before A-Z is lowered; lowering turns them into runs of digits, a-z and non-ASCII.
#: Letters one by one: Java looks them up in one table, while it asks each range in turn.
WORD = rf"[0123456789{UPPER}{LOWER}\x80-\x{{10FFFF}}]+"
#: Bytes of a benchmark side up to which it is broadcast; a larger one is shuffled.
SMALL_SIDE = 64 << 20


def words(column: str) -> Column:
    return F.regexp_extract_all(F.coalesce(F.col(column).cast("string"), F.lit("")),
                                F.lit(WORD), F.lit(0))


def _token() -> Column:
    # never null, and behind an outer generator: no filter that evaluates the words twice
    return F.coalesce(F.lower("word"), F.lit(""))


def _is_small(df: DataFrame, text: str) -> bool:
    """Whether the measured bytes of ``df`` allow a broadcast."""
    size = df.agg(F.sum(F.octet_length(text) + F.lit(100))).first()[0] or 0
    return size <= SMALL_SIDE


def windows(items: DataFrame, n: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(window, w, tokens, items): the distinct windows of ``n`` words over all items.

    An item of fewer words, but not none, is one window. Items without an id have windows too,
    but are not listed.
    """
    lowered = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, LOWER)
    rows = computed_once(items.withColumn("_low", lowered), [], item=F.col(item_id).cast("string"),
                         all_words=words("_low"))
    size = F.size("all_words")
    rows = rows.where(size > 0).select("item", F.explode(F.transform(
        F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1))),
        lambda i: F.slice("all_words", i, n))).alias("tokens"))
    return rows.groupBy("tokens").agg(F.collect_set("item").alias("items")).select(
        F.concat_ws(" ", "tokens").alias("window"), F.size("tokens").alias("w"), "tokens", "items")


def _prefixes(docs: DataFrame, wins: DataFrame, text: str) -> DataFrame:
    """(token, offset, window, w, items): the rarest token of each window and its place.

    All tokens of a window must occur, so a prefix of one token is enough. Rarity is the count
    over all documents; ties go to the smaller token and the first place.
    """
    each = wins.select("window", F.posexplode("tokens").alias("offset", "token"))
    # a token is compared in full lower case, which only adds candidates
    each = each.withColumn("token", F.lower("token"))
    vocabulary = materialise(each.select("token").distinct(), "benchmark-words")
    seen = docs.select(F.explode_outer(words(text)).alias("word")).select(_token().alias("token"))
    if _is_small(vocabulary, "token"):
        seen = seen.join(F.broadcast(vocabulary), "token")
    # beyond that words are counted within each task before they are shuffled
    counts = seen.groupBy("token").agg(F.count(F.lit(1)).alias("freq"))
    ranked = each.join(counts, "token", "left").groupBy("window").agg(
        F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "token", "offset")).alias("p"))
    ranked = ranked.where("p.freq > 0")  # a token that no document has ends its windows here
    return wins.join(ranked, "window").select(
        F.col("p.token").alias("token"), F.col("p.offset").alias("offset"), "window", "w", "items")


def occurrences(docs: DataFrame, items: DataFrame, n: int = 10, keys: tuple[str, ...] = ("doc_id",),
                text: str = "text", item_id: str = "item_id",
                item_text: str = "text") -> DataFrame:
    """(keys..., start, w, items): each place of a document where a window stands word for word."""
    wins = materialise(windows(items, n, item_id, item_text), "windows")
    prefixes = materialise(_prefixes(docs, wins, text), "prefixes")
    tokens = docs.select(*keys, words(text).alias("ws"))
    tokens = tokens.select(*keys, "ws", F.posexplode_outer("ws").alias("pos", "word"))
    tokens = tokens.withColumn("token", _token()).withColumn("n_words", F.size("ws"))
    if _is_small(prefixes, "window"):
        prefixes, first = F.broadcast(prefixes), F.lit(0)
    else:
        # a shuffled word takes along the words that a window around it can hold, not the text
        first = F.greatest(F.col("pos") - (n - 1), F.lit(0))
        tokens = tokens.withColumn("ws", F.slice("ws", first + 1, 2 * n - 1))
    start = F.col("pos") - F.col("offset")
    # positional and length bounds first: the window must lie within the document
    found = tokens.join(prefixes, "token").where(
        (start >= 0) & (start + F.col("w") <= F.col("n_words")))
    near = F.slice("ws", start - first + 1, F.col("w"))
    same = F.translate(F.concat_ws(" ", near), UPPER, LOWER)
    return found.where(same == F.col("window")).select(*keys, start.alias("start"), "w", "items")


def contamination(docs: DataFrame, items: DataFrame, n: int = 10, doc_id: str = "doc_id",
                  text: str = "text", item_id: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one row per row of ``docs``.

    A word inside any occurrence of a window is hit. Null and empty texts have no words; an
    empty benchmark leaves all clean. Rows that repeat id and text get equal results. Documents
    are told apart by id and text hash, so a null or repeated id mixes nothing.
    """
    return contamination_by_key(docs, items, n, doc_id, text, item_id, item_text).drop("text_key")


def contamination_by_key(docs: DataFrame, items: DataFrame, n: int = 10, doc_id: str = "doc_id",
                         text: str = "text", item_id: str = "item_id",
                         item_text: str = "text") -> DataFrame:
    """contamination() with the text_key that tells rows of one id, or of none, apart."""
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                        F.xxhash64(F.col(text)).alias("text_key"))
    keys = ("doc_id", "text_key")
    found = occurrences(keyed, items, n, keys, "text", item_id, item_text).distinct()
    order = W.partitionBy(*keys).orderBy("start", "w")
    covered = F.max(F.col("start") + F.col("w")).over(
        order.rowsBetween(W.unboundedPreceding, -1))
    found = found.withColumn("new", F.greatest(F.lit(0), F.col("start") + F.col("w") - F.greatest(
        F.col("start"), F.coalesce(covered, F.lit(0)))))
    hits = found.groupBy(*keys).agg(
        F.sum("new").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("ids"))
    base = keyed.select(*keys, F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD))
                        .cast("long").alias("n_words"))
    hits = hits.withColumnsRenamed({k: f"h_{k}" for k in keys})
    on = (F.col("text_key") == F.col("h_text_key")) & F.col("doc_id").eqNullSafe(F.col("h_doc_id"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return base.join(hits, on, "left").select(
        *keys, "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))
