"""Player names across spelling variants."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from trackspark.config import PLAYERS


def _accent_table() -> tuple[str, str]:
    """Accented letter -> base letter, by Unicode decomposition of the Latin blocks."""
    source, target = "", ""
    for code in range(0xC0, 0x250):
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code))
                       if not unicodedata.combining(c))
        if len(base) == 1 and base != chr(code):
            source, target = source + chr(code), target + base
    return source, target


_ACCENTED, _PLAIN = _accent_table()


def squeeze(name: Column) -> Column:
    """Outer blanks removed, inner runs of blanks made one."""
    return F.trim(F.regexp_replace(name, r"(?U)\s+", " "))


def _fold(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def _strip(text: Column) -> Column:
    return F.regexp_replace(F.translate(text, _ACCENTED, _PLAIN), r"\p{M}", "")


def name_variants(name: Column) -> Column:
    """Distinct spellings: folded, with umlauts written out, and both without accents."""
    raw = _fold(squeeze(name))
    spelled = raw
    for umlaut, letters in (("ä", "ae"), ("ö", "oe"), ("ü", "ue")):
        spelled = F.replace(spelled, F.lit(umlaut), F.lit(letters))
    return F.array_distinct(F.array(raw, spelled, _strip(raw), _strip(spelled)))


def resolve_player(name: Column, players: tuple = PLAYERS) -> Column:
    """Roster name behind a spelling, else the squeezed input.

    The roster is a literal map inside the expression, so resolving a column needs no join. The
    one-element array binds it, so that a row makes it once and not for each spelling.
    """
    roster = F.array(*[F.lit(p[0]) for p in players])
    entries = F.flatten(F.transform(
        roster, lambda p: F.transform(name_variants(p), lambda v: F.struct(v, p))))
    lookup = F.map_from_entries(entries)
    variants = name_variants(name)
    hits = F.flatten(F.transform(F.array(lookup), lambda known: F.filter(
        F.transform(variants, lambda v: F.try_element_at(known, v)), lambda p: p.isNotNull())))
    return F.coalesce(F.get(hits, F.lit(0)), squeeze(name))
