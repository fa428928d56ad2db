"""Possession metadata: parsed rows, half offsets, begin/end pairing, merged intervals.

Input rows are (match_id, file_player, half, line_no, fields): one line of one player's file,
fields trimmed and blanks removed, ``half`` 0 for files without a half folder. One file may hold
a large share of all rows, so ordered steps use ``prefix_scan`` over line buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackspark.config import MATCH, MatchConfig
from trackspark.functions.names import resolve_player
from trackspark.functions.once import computed_once
from trackspark.functions.times import row_times
from trackspark.operators.scan import Prefix, prefix_scan

FILE = ["match_id", "file_player", "half"]
_WHITE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"  # white space of latin-1 text
LINES_PER_BUCKET = 1 << 18
SECONDS_PER_BUCKET = 60.0


def clean_fields(values: Column) -> Column:
    """Fields without outer white space; missing and blank ones left out."""
    trimmed = F.transform(values, lambda v: F.btrim(v, F.lit(_WHITE)))
    return F.filter(trimmed, lambda v: v.isNotNull() & (v != ""))


def event_kind(text: Column) -> Column:
    """``begin``, ``end`` or null; begin words are looked for first."""
    low = F.lower(text)
    return (
        F.when(low.contains("begin") | low.contains("start"), "begin")
        .when(low.contains("end") | low.contains("stop"), "end")
    )


def parse_rows(rows: DataFrame) -> DataFrame:
    """Event text, kind and times of every row.

    The result feeds several branches; write it first (``session.materialise``).
    """
    first = F.get("fields", F.lit(0))
    text = F.when(first.rlike(r"^\d+$"), F.get("fields", F.lit(1))).otherwise(
        F.concat_ws(" ", "fields"))
    parsed = computed_once(
        rows, [*FILE, "line_no"], n_fields=F.size("fields"), event_text=text,
        times=row_times(F.col("fields")))
    return parsed.withColumns({
        "kind": event_kind(F.col("event_text")), "raw_time": F.get("times", F.lit(0))})


def half_offsets(parsed: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    """Offset of second-half files per match: 0 when their times are already absolute."""
    earliest = F.min(F.when(F.col("half") == 2, F.array_min("times")))
    limit = cfg.metadata_half_offset_s - cfg.metadata_absolute_slack_s
    found = parsed.groupBy("match_id").agg(earliest.alias("earliest"))
    return found.withColumn(
        "half_offset",
        F.when(F.col("earliest") >= limit, F.lit(0.0)).otherwise(F.lit(cfg.metadata_half_offset_s)))


def scan_rows(parsed: DataFrame) -> DataFrame:
    """Rows with an event and a time, each with the time and the begin/end row before it."""
    rows = parsed.where((F.col("n_fields") >= 3) & F.col("raw_time").isNotNull())
    mark = F.when(F.col("kind").isNotNull(), F.struct("kind", "raw_time", "line_no"))
    bucket = F.floor(F.col("line_no") / LINES_PER_BUCKET)
    return prefix_scan(rows, FILE, "line_no", bucket, [
        Prefix("prev_raw", F.col("raw_time"), "last"), Prefix("prev_mark", mark, "last")])


def timed_rows(parsed: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    """Rows that carry an event and a time, with the offset that puts them on the match clock.

    In a file with offset 0 the clock may start again for the second half: from the first row
    whose time goes back on, the half offset is added. What holds for a whole file (player,
    offset, line of the restart) is found once per file and joined to its rows.
    """
    rows = scan_rows(parsed)
    went_back = F.col("raw_time") < F.coalesce("prev_raw", F.lit(-1.0))
    files = rows.groupBy(*FILE).agg(
        F.min(F.when(went_back, F.col("line_no"))).alias("restart_line"))
    files = files.join(half_offsets(parsed, cfg).select("match_id", "half_offset"), "match_id")
    files = files.withColumns({
        "player": resolve_player(F.col("file_player")),
        "base": F.when(F.col("half") == 2, F.col("half_offset")).otherwise(F.lit(0.0))})
    rows = rows.join(files, FILE)

    def offset(line: Column) -> Column:
        after = (F.col("base") == 0.0) & (line >= F.col("restart_line"))
        return F.when(after, F.lit(cfg.metadata_half_offset_s)).otherwise(F.col("base"))

    before = F.when(F.col("prev_mark").isNotNull(), F.struct(
        F.col("prev_mark.kind").alias("kind"),
        (F.col("prev_mark.raw_time") + offset(F.col("prev_mark.line_no"))).alias("second")))
    return rows.select(
        *FILE, "player", "line_no", "event_text", "kind", "times", "raw_time",
        offset(F.col("line_no")).alias("offset_s"), before.alias("prev"))


def candidate_intervals(timed: DataFrame) -> DataFrame:
    """All intervals the rows describe, valid or not.

    An End closes the begin row directly before it; a later Begin replaces an open one; a stray
    End says nothing. Rows that are neither give an interval when they hold two times.
    """
    rows = timed.withColumn("second", F.col("raw_time") + F.col("offset_s"))
    closed = (F.col("kind") == "end") & (F.col("prev.kind") == "begin")
    listed = F.col("kind").isNull() & (F.size("times") >= 2)
    start = F.when(closed, F.col("prev.second")).otherwise(
        F.get("times", F.lit(0)) + F.col("offset_s"))
    end = F.when(closed, F.col("second")).otherwise(F.get("times", F.lit(1)) + F.col("offset_s"))
    return rows.where(closed | listed).select(
        "match_id", "player", "half", "line_no",
        start.alias("start_s"), end.alias("end_s"))


def possession_intervals(timed: DataFrame) -> DataFrame:
    """Valid intervals; empty and backward ones are dropped."""
    return candidate_intervals(timed).where(F.col("end_s") > F.col("start_s"))


def quality_report(timed: DataFrame) -> DataFrame:
    """Per file: valid and invalid intervals, and the begin left open at its end (if any)."""
    intervals = candidate_intervals(timed).withColumn("ok", F.col("end_s") > F.col("start_s"))
    counts = intervals.groupBy("match_id", "player", "half").agg(
        F.count_if(F.col("ok")).alias("n_intervals"),
        F.count_if(~F.col("ok")).alias("n_invalid"))
    marks = timed.where(F.col("kind").isNotNull()).groupBy("match_id", "player", "half").agg(
        F.max_by(F.struct("kind", (F.col("raw_time") + F.col("offset_s")).alias("second")),
                 F.col("line_no")).alias("m"))
    open_begin = marks.where(F.col("m.kind") == "begin").select(
        "match_id", "player", "half", F.col("m.second").alias("open_begin_s"))
    return counts.join(open_begin, ["match_id", "player", "half"], "full").select(
        "match_id", "player", "half",
        F.coalesce("n_intervals", F.lit(0)).alias("n_intervals"),
        F.coalesce("n_invalid", F.lit(0)).alias("n_invalid"), "open_begin_s")


def _islands(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Union of overlapping or touching intervals inside each key (gaps and islands)."""
    w = Window.partitionBy(*keys).orderBy("start_s", "end_s")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("end_s").over(before)
    opens = F.when(reach.isNull() | (F.col("start_s") > reach), F.col("start_s"))
    marked = intervals.withColumn("opens", opens)
    island = F.last("opens", ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return marked.withColumn("island", island).groupBy(*keys, "island").agg(
        F.max("end_s").alias("end_s")).select(*keys, F.col("island").alias("start_s"), "end_s")


def merge_intervals(intervals: DataFrame) -> DataFrame:
    """Union of overlapping or touching intervals per player.

    First equal starts are reduced on the map side, then each (player, minute) is merged on its
    own. What is left per player is disjoint inside every minute, so its number is bounded by
    match length over time resolution, and the last pass over whole players is small.
    """
    key = ["match_id", "player"]
    longest = intervals.where(F.col("end_s") > F.col("start_s")).groupBy(*key, "start_s").agg(
        F.max("end_s").alias("end_s"))
    minute = F.floor(F.col("start_s") / SECONDS_PER_BUCKET)
    local = _islands(longest.withColumn("minute", minute), [*key, "minute"]).drop("minute")
    return _islands(local, key)


def metadata_counts(merged: DataFrame) -> DataFrame:
    return merged.groupBy("match_id").agg(
        F.count("*").alias("n_intervals"), F.count_distinct("player").alias("n_players"))


def name_resolution(rows: DataFrame) -> DataFrame:
    """Spelling -> roster name, once per distinct spelling."""
    return rows.select("match_id", "file_player").distinct().withColumn(
        "player", resolve_player(F.col("file_player")))
