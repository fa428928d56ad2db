"""Small dimension tables. All are inline relations, so Catalyst knows their exact size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackspark.config import (
    BALL_SIDS,
    MATCH,
    OFFICIALS,
    PLAYERS,
    MatchConfig,
)


def _literal(value: object) -> str:
    if value is None:
        return "null"
    if isinstance(value, str):
        return "'" + value.replace("'", "\\'") + "'"
    if isinstance(value, float):
        return f"{value!r}D"
    return str(value)


def inline_table(spark: SparkSession, rows: list[tuple], columns: dict[str, str]) -> DataFrame:
    """A table held in the plan itself; ``columns`` maps names to SQL types."""
    values = ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)
    names = ", ".join(columns)
    casts = ", ".join(f"cast({n} as {t}) as {n}" for n, t in columns.items())
    return spark.sql(f"select {casts} from values {values} as t({names})")


def sensor_rows() -> list[tuple]:
    """(sid, entity, type, team, role, kind, roster_order, sensor_order) of every sensor."""
    rows: list[tuple] = []
    people = [(n, "player", t, r, f, e) for n, t, r, f, e in PLAYERS]
    people += [(n, "referee", None, r, f, e) for n, r, f, e in OFFICIALS]
    for order, (name, kind, team, role, feet, extra) in enumerate(people):
        rows += [(s, name, kind, team, role, "feet", order, i) for i, s in enumerate(feet)]
        rows += [(s, name, kind, team, role, "extra", order, i) for i, s in enumerate(extra)]
    rows += [(s, f"Ball {s}", "ball", None, None, "feet", len(people) + i, 0)
             for i, s in enumerate(BALL_SIDS)]
    return rows


def sensor_dim(spark: SparkSession) -> DataFrame:
    return inline_table(spark, sensor_rows(), {
        "sid": "int", "entity": "string", "type": "string", "team": "string", "role": "string",
        "kind": "string", "roster_order": "int", "sensor_order": "int"})


def player_dim(spark: SparkSession) -> DataFrame:
    rows = [(n, t, r, i) for i, (n, t, r, _, _) in enumerate(PLAYERS)]
    return inline_table(spark, rows, {"player": "string", "team": "string", "role": "string",
                                      "roster_order": "int"})


def selection_dim(spark: SparkSession) -> DataFrame:
    """Heatmap focus -> sensor ids: everybody in a team, each team, each player."""
    rows = []
    for name, team, _, feet, extra in PLAYERS:
        rows += [(label, s) for label in ("All", team, name) for s in feet + extra]
    return inline_table(spark, sorted(set(rows)), {"selection": "string", "sid": "int"})


def match_clock(spark: SparkSession, match_ids: list, cfg: MatchConfig = MATCH) -> DataFrame:
    """(match_id, half, start_ts, end_ts, offset_s) with the default clock for each match."""
    halves = ((1, cfg.first_half_start_ts, cfg.first_half_end_ts, 0.0),
              (2, cfg.second_half_start_ts, cfg.second_half_end_ts, cfg.second_half_offset_s))
    kind = "string" if match_ids and isinstance(match_ids[0], str) else "int"
    return inline_table(spark, [(m, *h) for m in match_ids for h in halves], {
        "match_id": kind, "half": "int", "start_ts": "bigint", "end_ts": "bigint",
        "offset_s": "double"})
