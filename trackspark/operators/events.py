"""Match events (shots, interruptions) and when they fall due."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackspark.config import EVENT_PREFIXES, MATCH, MatchConfig
from trackspark.functions.once import computed_once
from trackspark.functions.text import event_message
from trackspark.functions.times import match_event_second
from trackspark.operators.ticks import next_tick


def match_events(lines: DataFrame, cfg: MatchConfig = MATCH) -> DataFrame:
    """Events from raw lines (match_id, folder, half, line).

    A line needs three fields, a numeric id and a readable time; footers drop out.
    """
    offset = F.when(F.col("half") == 2, F.lit(cfg.metadata_half_offset_s)).otherwise(F.lit(0.0))
    prefix = F.coalesce(*[F.when(F.col("folder") == f, F.lit(p))
                          for f, p in EVENT_PREFIXES.items()])
    known = lines.where(F.col("folder").isin(*EVENT_PREFIXES))
    split = computed_once(known, ["match_id", "folder", "half"],
                          parts=F.split(F.trim("line"), ";"))
    numbered = split.where(
        (F.size("parts") >= 3) & F.get("parts", F.lit(0)).rlike(r"^\d+$"))
    timed = computed_once(
        numbered, ["match_id", "half"], kind=prefix, subject=F.get("parts", F.lit(1)),
        pieces=F.split(F.get("parts", F.lit(2)), ":"))
    found = computed_once(timed, ["match_id", "kind", "subject"],
                          second=match_event_second(F.col("pieces"), offset))
    return found.where(F.col("second").isNotNull()).select(
        "match_id", "second", "kind", "subject",
        event_message(F.col("kind"), F.col("subject")).alias("msg"))


def due_events(events: DataFrame, ticks: DataFrame) -> DataFrame:
    """Each event at the first tick that has reached it; later events are not yet due."""
    return next_tick(events, ticks, F.col("second")).select(
        "match_id", "t", "second", "kind", "subject", "msg")
