"""Parsers for the time texts of metadata files. Bad text gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHOLE = r"^\s*[+-]?\d+\s*$"
_REAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _whole(text: Column) -> Column:
    # as a double, so that no multiple of it can overflow
    return F.when(text.rlike(_WHOLE), text.try_cast("bigint").cast("double"))


def _real(text: Column) -> Column:
    return F.when(text.rlike(_REAL), text.try_cast("double"))


def _clock(parts: Column) -> Column:
    hours, minutes, seconds = (F.get(parts, F.lit(i)) for i in range(3))
    return _whole(hours) * 3600 + _whole(minutes) * 60 + _real(seconds)


def match_event_second(parts: Column, offset: Column) -> Column:
    """``HH:MM:SS.s`` pieces plus the offset; a lone ``0`` is the offset itself."""
    return (
        F.when(F.size(parts) == 3, _clock(parts) + offset)
        .when((F.size(parts) == 1) & (F.get(parts, F.lit(0)) == "0"), offset)
    )


def time_parts(text: Column) -> Column:
    """Pieces between colons, with a decimal point whatever was written."""
    return F.split(F.replace(F.trim(text), F.lit(","), F.lit(".")), ":")


def parts_second(parts: Column) -> Column:
    """``HH:MM:SS`` or ``MM:SS`` pieces in seconds; a lone ``0`` is zero."""
    return (
        F.when(F.size(parts) == 3, _clock(parts))
        .when((F.size(parts) == 1) & (F.get(parts, F.lit(0)) == "0"), F.lit(0.0))
        .when(F.size(parts) == 2,
              _whole(F.get(parts, F.lit(0))) * 60 + _real(F.get(parts, F.lit(1))))
    )


def row_times(fields: Column) -> Column:
    """All times of one metadata row; the first two fields of a numbered row are skipped."""
    numbered = (F.size(fields) >= 3) & F.get(fields, F.lit(0)).rlike(r"^\d+$")
    candidates = F.when(numbered, F.slice(fields, F.lit(3), F.greatest(F.size(fields), F.lit(3)))
                        ).otherwise(fields)
    timed = F.filter(candidates, lambda v: v.contains(":") | (v == "0"))
    # split in a step of its own, so that it runs once per value
    seconds = F.transform(F.transform(timed, time_parts), parts_second)
    return F.filter(seconds, lambda t: t.isNotNull())


def possession_second(text: Column) -> Column:
    """Seconds of one possession time text with point or comma."""
    return parts_second(time_parts(text))
