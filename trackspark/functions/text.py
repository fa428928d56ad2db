"""Text forms of times, durations, names and messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trackspark.functions.numbers import round_half_even


def clock_text(second: Column) -> Column:
    """``MM:SS`` of a match second, ``-`` when unknown."""
    whole = second.cast("bigint")
    text = F.format_string("%02d:%02d", F.floor(whole / 60), whole % 60)
    return F.when(second.isNull(), F.lit("-")).otherwise(text)


def duration_text(seconds: Column) -> Column:
    """``Nm Ss`` from one minute on, else seconds with one digit."""
    minutes = F.floor(seconds / 60)
    rest = round_half_even(seconds % F.lit(60.0), 0).cast("bigint")
    long_form = F.format_string("%dm %ds", minutes, rest)
    short_form = F.format_string("%.1f seconds", round_half_even(seconds, 1))
    return F.when(seconds >= 60, long_form).otherwise(short_form)


def short_label(name: Column) -> Column:
    """``First Last`` -> ``F. Last``; one-word names stay."""
    parts = F.split(F.trim(name), r"\s+")
    label = F.concat(F.substring(F.get(parts, F.lit(0)), 1, 1), F.lit(". "),
                     F.element_at(parts, -1))
    return F.when(F.size(parts) == 1, name).otherwise(label)


def event_message(prefix: Column, subject: Column) -> Column:
    return F.concat(prefix, F.lit(": "), subject)
