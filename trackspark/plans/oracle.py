"""Independent SQL (DuckDB) for the registered queries, over the same parquet tables."""

from __future__ import annotations

import re

from trackspark.config import (
    BALL_SIDS,
    BALL_SIDS_BY_HALF,
    EVENT_PREFIXES,
    MATCH,
    PLAYERS,
    TEAM_A,
    TEAM_B,
)
from trackspark.dims import sensor_rows
from trackspark.plans.fixtures import CLOCK_SHIFT, MATCH_OF, MATCHES, SENSOR_IDS, SPELLINGS


def _values(rows: list[tuple], columns: str) -> str:
    def lit(v: object) -> str:
        if v is None:
            return "null"
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows)
    return f"select * from (values {body}) v({columns})"


_H = "((event_id*2654435761)%4294967296)"
_IDS = ",".join(map(str, SENSOR_IDS))
_BALLS = ",".join(map(str, BALL_SIDS))
_HALF_START = (f"case when half = 1 then {MATCH.first_half_start_ts} "
               f"else {MATCH.second_half_start_ts} end")
_MS = f"((ts - {_HALF_START}) // 1000000000)"
_FIRST = f"ts between {MATCH.first_half_start_ts} and {MATCH.first_half_end_ts}"
_SECOND = f"ts between {MATCH.second_half_start_ts} and {MATCH.second_half_end_ts}"


def _time_text(ms: str, mark: str) -> str:
    return (f"concat(lpad(cast({ms} // 3600000 as varchar),2,'0'),':',"
            f"lpad(cast({ms} // 60000 % 60 as varchar),2,'0'),':',"
            f"lpad(cast({ms} // 1000 % 60 as varchar),2,'0'),'{mark}',"
            f"lpad(cast({ms} % 1000 as varchar),3,'0'))")


def _parse(text: str) -> str:
    clock = (f"cast(split_part({text},':',1) as double)*3600"
             f" + cast(split_part({text},':',2) as double)*60"
             f" + cast(replace(split_part({text},':',3),',','.') as double)")
    return f"case when {text} is not null then {clock} end"


def _zone(speed: str) -> str:
    return (f"case when {speed} > 24 then 'Sprint' when {speed} > 14 then 'High-Speed Run' "
            f"when {speed} > 11 then 'Low-Speed Run' when {speed} > 1 then 'Trot' "
            "else 'Standing' end")


def _one_digit(x: str) -> str:
    return f"cast(printf('%.1f', {x}) as double)"


def _clock_text(s: str) -> str:
    return (f"case when {s} is null then '-' else "
            f"printf('%02d:%02d', cast(floor({s}) as bigint)//60, cast(floor({s}) as bigint)%60) "
            "end")


_ALLOWED = " or ".join(
    f"(h.current_half = {h} and s.sid in ({','.join(map(str, sids))}))"
    for h, sids in BALL_SIDS_BY_HALF.items())
_LAST = MATCH.last_tick
_MINUTE = f"((tick % 60 = 0 and tick > 0) or tick = {_LAST})"

_SHAPE = """
  select t.tick, tm.team, count(p.entity) as visible_players,
    coalesce(avg(p.speed_kmh),0) as avg_speed, coalesce(max(p.speed_kmh),0) as max_speed,
    coalesce((max(p.y)-min(p.y))/1000.0::double,0) as width_m,
    coalesce((max(p.x)-min(p.x))/1000.0::double,0) as depth_m,
    coalesce(avg(sqrt((p.x-p.cx)*(p.x-p.cx)+(p.y-p.cy)*(p.y-p.cy))/1000.0::double),0)
      as compactness_m,
    count(*) filter (p.speed_kmh > 14) as high_speed_players
  from tick_info t cross join (values ('Team A'),('Team B')) tm(team)
  left join (select *, avg(x) over (partition by tick, team) as cx,
                    avg(y) over (partition by tick, team) as cy from players) p
    on p.tick = t.tick and p.team = tm.team
  group by t.tick, tm.team"""

CTES: dict[str, str] = {
    "raw_samples": f"""
  select event_id, sid, ts, x, y, z,
    v_abs * case when sid in ({_BALLS}) then 4 else 1 end as v_abs, a_abs, user_id, event_type
  from (select event_id, user_id, event_type,
      cast(list_extract([{_IDS}], cast(({_H} >> 16) % 42 as int) + 1) as int) as sid,
      10720000000000000 + (epoch_us(ts) - 1704067200000000) * 1620 as ts,
      cast(case when event_id % 97 = 0 then null else {_H} % 140001 - 70000 end as int) as x,
      cast((event_id*7919 + user_id*104729) % 67001 - 33500 as int) as y,
      cast(event_id % 2000 as int) as z,
      cast(round(value*100) as bigint) * 1000 as v_abs, (event_id % 5000) * 1000 as a_abs
    from events)""",
    "clean_base": f"""
  select *, case when {_FIRST} then 1 else 2 end as half,
    case when {_FIRST} then (ts - {MATCH.first_half_start_ts})/1000000000000
      else 1804.0::double + (ts - {MATCH.second_half_start_ts})/1000000000000 end as ms,
    v_abs*0.000001::double*3.6::double as speed_kmh
  from raw_samples where {_FIRST} or {_SECOND}""",
    "valid_base": """
  select event_id, sid, ts, x::double as x, y::double as y, z::double as z, half, ms,
    coalesce(speed_kmh, 0) as speed_kmh
  from clean_base where x between -68000 and 68000 and y between -32500 and 32500""",
    "sensors": _values(sensor_rows(), "sid, entity, type, team, role, kind, roster_order, pos"),
    "roster": _values([(n, t, r, i) for i, (n, t, r, _, _) in enumerate(PLAYERS)],
                      "player, team, role, roster_order"),
    "files": _values([(i, SPELLINGS.get(p[0], p[0]), p[0]) for i, p in enumerate(PLAYERS)],
                     "player_ord, file_player, player"),
    "zoned": f"""
  select *, {_zone('speed_kmh')} as intensity, speed_kmh/3.6::double*0.005::double as metres
  from valid_base where sid not in ({_BALLS})""",
    "stats": """
  select sid, intensity, cast(floor(ms/60) as bigint)*60 as window_start_s,
    sum(metres) as distance_1m, count(*) as ping_count, count(*)*0.005::double as time_1m
  from zoned group by all""",
    "stats_latest": """
  select * from stats
  qualify row_number() over (partition by sid, intensity order by window_start_s desc) = 1""",
    "latest": """
  select * from valid_base
  qualify row_number() over (partition by sid order by ts desc, event_id desc) = 1""",
    "latest_used": """
  select l.*, s.entity, s.type, s.team, s.role, s.roster_order from latest l join sensors s
  using (sid)
  qualify (s.kind = 'feet') = bool_or(s.kind = 'feet') over (partition by s.entity)""",
    "player_rows": f"""
  select e.*, coalesce(d.distance,0) as distance, coalesce(d.sprint,0) as sprint_distance,
    coalesce(d.fast,0) as high_speed_distance, coalesce(d.active,0) as active_time
  from (select entity as player, team, role, roster_order, avg(speed_kmh) as speed_kmh
        from latest_used where type = 'player' group by all) e
  left join (select u.entity as player, sum(distance_1m) as distance,
      sum(distance_1m) filter (intensity = 'Sprint') as sprint,
      sum(distance_1m) filter (intensity = 'High-Speed Run') as fast, sum(time_1m) as active
    from latest_used u join stats_latest using (sid) where type = 'player' group by all) d
  using (player)""",
    "per_second": """
  select sid, intensity, cast(floor(ms) as int) as second, sum(metres) as metres,
    count(*) as pings
  from zoned group by all""",
    "per_tick": """
  select *, cast(floor(ms) as int) as sample_tick from valid_base
  qualify row_number() over (partition by sid, sample_tick order by ts desc, event_id desc) = 1""",
    "snap": f"""
  select g.tick, p.* from (
    select s.sid, cast(t.tick as int) as tick from (select distinct sid from valid_base) s
    cross join range(0, {_LAST + 1}) t(tick)) g
  asof join per_tick p on g.sid = p.sid and g.tick >= p.sample_tick""",
    "tick_info": """
  select tick, max(half) as current_half, max(ms) as current_second, count(*) as raw_sensors
  from snap group by tick""",
    "used": """
  select p.*, s.entity, s.type, s.team, s.role, s.roster_order, s.pos
  from snap p join sensors s using (sid)
  qualify (s.kind = 'feet') = bool_or(s.kind = 'feet') over (partition by p.tick, s.entity)""",
    "ents": """
  select tick, entity, type, team, role, roster_order, avg(x) as x, avg(y) as y, max(ts) as ts,
    max(ms) as ms, string_agg(sid::varchar, ',' order by pos) as sids,
    avg(speed_kmh) as speed_kmh
  from used group by all""",
    "players": "select * from ents where type = 'player'",
    "active": f"""
  select tick, sid, entity, x, y, ts, speed_kmh from (
    select s.*, ({_ALLOWED}) as allowed,
      bool_or({_ALLOWED}) over (partition by s.tick) as any_allowed
    from used s join tick_info h using (tick) where s.type = 'ball')
  where allowed or not any_allowed
  qualify row_number() over (partition by tick order by ts desc, speed_kmh desc, sid) = 1""",
    "newest_ball": """
  select tick, sid, entity, x, y, ts, speed_kmh from used where type = 'ball'
  qualify row_number() over (partition by tick order by ts desc, sid) = 1""",
    "near": """
  select p.tick, p.entity as player, p.team,
    sqrt((p.x-b.x)*(p.x-b.x)+(p.y-b.y)*(p.y-b.y))/1000.0::double as distance_m
  from players p join active b using (tick)
  qualify row_number() over (partition by p.tick order by distance_m, p.roster_order) = 1""",
    "near_newest": """
  select p.tick, p.entity as player, p.team,
    sqrt((p.x-b.x)*(p.x-b.x)+(p.y-b.y)*(p.y-b.y)) as distance_mm
  from players p join newest_ball b using (tick)
  qualify row_number() over (partition by p.tick order by distance_mm, p.roster_order) = 1""",
    "live": """
  select t.tick, n.player, n.distance_m,
    case when n.distance_m <= 3.0 then n.team else 'Neutral' end as team
  from tick_info t left join near n using (tick)""",
    "confidence": """
  select t.tick, case when distance_mm <= 5000 then player end as possessor,
    case when distance_mm <= 5000 then team else '' end as team,
    distance_mm/1000.0::double as distance_m,
    case when distance_mm <= 1500 then 'High' when distance_mm <= 3000 then 'Medium'
      when distance_mm <= 5000 then 'Low' when distance_mm is not null then 'Loose Ball'
      else 'Unavailable' end as confidence
  from tick_info t left join near_newest using (tick)""",
    "pressure": """
  select t.tick, tm.team, count(p.entity) as n
  from tick_info t cross join (values ('Team A'),('Team B')) tm(team)
  left join active b on b.tick = t.tick
  left join players p on p.tick = t.tick and p.team = tm.team
    and sqrt((p.x-b.x)*(p.x-b.x)+(p.y-b.y)*(p.y-b.y))/1000.0::double <= 5.0
  group by all""",
    "shape": _SHAPE,
    "momentum": f"""
  select tick, current_second,
    coalesce({_one_digit('a/nullif(a+b,0)*100')}, 50) as momentum_a,
    coalesce({_one_digit('b/nullif(a+b,0)*100')}, 50) as momentum_b
  from (select t.tick, t.current_second,
      case when l.team = 'Team A' then 35.0::double else 0.0::double end
        + coalesce(f*25.0::double, 0) + least(20.0::double, pa.n*5.0::double)
        + least(20.0::double, sa.high_speed_players*4.0::double) as a,
      case when l.team = 'Team B' then 35.0::double else 0.0::double end
        + coalesce((1.0::double-f)*25.0::double, 0) + least(20.0::double, pb.n*5.0::double)
        + least(20.0::double, sb.high_speed_players*4.0::double) as b
    from tick_info t join live l using (tick)
    left join (select tick, greatest(0.0::double,
        least(1.0::double, (x+68000.0::double)/136000.0::double)) as f from active) fb
      using (tick)
    join pressure pa on pa.tick = t.tick and pa.team = 'Team A'
    join pressure pb on pb.tick = t.tick and pb.team = 'Team B'
    join shape sa on sa.tick = t.tick and sa.team = 'Team A'
    join shape sb on sb.tick = t.tick and sb.team = 'Team B')""",
    "changed": """
  select *, row_number() over (order by tick) as n from (
    select *, lag(current_second) over (order by tick) as before_second from momentum)
  where before_second is distinct from current_second""",
    "smoothed": f"""
  select n, tick, current_second, momentum_a as a, momentum_b as b from changed where n = 1
  union all
  select c.n, c.tick, c.current_second, {_one_digit('(s.a*(1.0::double-0.15::double)+c.momentum_a*0.15::double)/((s.a*(1.0::double-0.15::double)+c.momentum_a*0.15::double)+(s.b*(1.0::double-0.15::double)+c.momentum_b*0.15::double))*100.0::double')},
    {_one_digit('(s.b*(1.0::double-0.15::double)+c.momentum_b*0.15::double)/((s.a*(1.0::double-0.15::double)+c.momentum_a*0.15::double)+(s.b*(1.0::double-0.15::double)+c.momentum_b*0.15::double))*100.0::double')}
  from smoothed s join changed c on c.n = s.n + 1""",
    "cells": f"""
  select sid,
    cast(floor(greatest(0, least(0.9999::double, (y+32500.0::double)/65000.0::double))*50) as int)
      as grid_row,
    cast(floor(greatest(0, least(0.9999::double, (x+68000.0::double)/136000.0::double))*80) as int)
      as grid_col, count(*) as n
  from valid_base where sid not in ({_BALLS}) group by all""",
    "kernel": """
  select cast(a.i as int) as dr, cast(b.i as int) as dc,
    exp(-(a.i*a.i+b.i*b.i)/8.0::double) as w
  from range(-5, 6) a(i) cross join range(-5, 6) b(i)
  where exp(-(a.i*a.i+b.i*b.i)/8.0::double) >= 0.01""",
    "smooth_cells": """
  select sid, grid_row+dr as grid_row, grid_col+dc as grid_col, sum(n*w) as value
  from cells cross join kernel
  where grid_row+dr between 0 and 49 and grid_col+dc between 0 and 79 group by all""",
    "selections": """
  select 'All' as selection, sid from sensors where type = 'player'
  union all select team, sid from sensors where type = 'player'
  union all select entity, sid from sensors where type = 'player'""",
    "selection_grid": """
  select selection, grid_row, grid_col, sum(value) as value
  from smooth_cells join selections using (sid) group by all""",
    "possession_text": f"""
  select cast(user_id % 16 as int) as player_ord, half, event_id as line_no,
    case event_type when 'signup' then 'Possession Begin' when 'purchase' then 'Possession End'
      when 'click' then 'Interval' else 'Note' end as event_text,
    {_time_text(_MS, ',')} as time_text,
    case when event_type = 'click' then
      {_time_text(f'({_MS} + (event_id % 20) * 1000)', ',')} end as end_text
  from clean_base""",
    "prows": f"""
  select f.player, f.file_player, p.*, {_parse('time_text')} as raw_time,
    {_parse('end_text')} as second_time,
    case event_text when 'Possession Begin' then 'begin' when 'Possession End' then 'end' end
      as kind
  from possession_text p join files f using (player_ord)""",
    "ptimed": """
  select *, raw_time + offset_s as second from (
    select r.*, case when half = 2 then o.off
      when r.line_no >= k.restart_line then 1800 else 0 end::double as offset_s
    from prows r
    cross join (select case when min(raw_time) >= 1740 then 0 else 1800 end as off
                from prows where half = 2) o
    left join (select player, half, min(line_no) as restart_line from (
        select *, lag(raw_time) over (partition by player, half order by line_no) as prev
        from prows) where raw_time < coalesce(prev, -1) group by all) k
      using (player, half))""",
    "pcandidates": """
  select player, half, line_no, prev_second as start_s, second as end_s from (
    select *, lag(kind) over w as prev_kind, lag(second) over w as prev_second
    from ptimed where kind is not null
    window w as (partition by player, half order by line_no))
  where kind = 'end' and prev_kind = 'begin'
  union all
  select player, half, line_no, second, second_time + offset_s from ptimed
  where kind is null and second_time is not null""",
    "pintervals": "select * from pcandidates where end_s > start_s",
    "pmerged": """
  select player, min(start_s) as start_s, max(end_s) as end_s from (
    select *, sum(opens) over (partition by player order by start_s, end_s, line_no) as island
    from (select *, case when start_s <= max(end_s) over (partition by player
        order by start_s, end_s, line_no rows between unbounded preceding and 1 preceding)
        then 0 else 1 end as opens from pintervals))
  group by player, island""",
    "edges": """
  select start_s as t from pmerged union select end_s from pmerged""",
    "timeline": """
  select l as left_s, r as right_s, player from (
    select t as l, lead(t) over (order by t) as r from edges) g
  join pmerged p on p.start_s <= g.l and p.end_s >= g.r
  join roster using (player)
  qualify row_number() over (partition by l order by p.start_s desc, roster_order) = 1""",
    "minutes": f"""
  select t::double as t from range(60, {_LAST}, 60) m(t) union all select {_LAST}::double""",
    "ball_time": """
  select m.t, l.player, sum(least(l.right_s, m.t) - l.left_s) as seconds
  from minutes m join timeline l on l.left_s < m.t group by all""",
    "ball_time_60": """
  select m.t, l.player,
    sum(least(l.right_s, m.t) - greatest(l.left_s, greatest(0, m.t-60))) as seconds
  from minutes m join timeline l on l.left_s < m.t and l.right_s > greatest(0, m.t-60)
  group by all""",
    "event_rows": f"""
  select k.prefix as kind, e.subject, case when half = 2 then 1800 else 0 end
      + ({_parse("(case when time_text <> 'n/a' then time_text end)")}) as second
  from (select half, case when user_id % 2 = 0 then 'Shot on Goal' else 'Game Interruption' end
        as folder, concat('Player ', cast(user_id % 16 as varchar)) as subject,
      case when event_id % 50 = 0 then 'n/a' else {_time_text(_MS, '.')} end as time_text
    from clean_base where event_type = 'error') e
  join ({_values(list(EVENT_PREFIXES.items()), 'folder, prefix')}) k using (folder)
  where time_text <> 'n/a'""",
}


def _needed(sql: str) -> list[str]:
    """Names of the CTEs a text uses, dependencies first."""
    found: list[str] = []

    def visit(text: str, inside: str | None) -> None:
        words = set(re.findall(r"[a-z_0-9]+", text))
        for name in CTES:
            if name in words and name != inside and name not in found:
                visit(CTES[name], name)
                if name not in found:
                    found.append(name)

    visit(sql, None)
    return found


def _sql(body: str) -> str:
    names = _needed(body)
    if not names:
        return body
    head = "with recursive " if "smoothed" in names else "with "
    return head + ",\n".join(f"{n} as ({CTES[n]})" for n in names) + "\n" + body


def _two(name: str) -> str:
    return f"cast(printf('%.2f', {name}) as double)"


def _team_rows(source: str, low: str) -> str:
    return f"""
  select m.t, tm.team, case tm.team
      when '{TEAM_A}' then coalesce(s.a,0) when '{TEAM_B}' then coalesce(s.b,0)
      else greatest(0, m.t - {low} - coalesce(s.a,0) - coalesce(s.b,0)) end as seconds
  from minutes m cross join (values ('{TEAM_A}'),('{TEAM_B}'),('Loose Ball')) tm(team)
  left join (select t, sum(seconds) filter (team = '{TEAM_A}') as a,
      sum(seconds) filter (team = '{TEAM_B}') as b
    from {source} left join roster using (player) group by t) s on s.t = m.t"""


_CLEAN = """select event_id, sid, ts, x, y, z, v_abs, a_abs, half, round(ms,9) as "matchSecond",
  round(x/1000.0::double,9) as x_m, round(y/1000.0::double,9) as y_m,
  round(z/1000.0::double,9) as z_m, round(v_abs*0.000001::double,9) as speed_m_s,
  round(speed_kmh,9) as speed_kmh, round(a_abs*0.000001::double,9) as acceleration_m_s2
  from clean_base"""
_POSITION = """sid, ts, x, y, z, half, round(ms,9) as "matchSecond",
  round(speed_kmh,9) as speed_kmh"""
_ROLLING = """select 1 as match_id, sid, intensity, second,
  round(sum(metres) over w, 6) as distance,
  round(cast(sum(pings) over w as bigint)*0.005::double, 6) as time_s
  from per_second window w as (partition by sid, intensity order by second
    range between 59 preceding and current row)"""
_STATS = """select 1 as match_id, sid, intensity, window_start_s,
  round(distance_1m,6) as distance_1m, ping_count, round(time_1m,6) as time_1m from stats"""
_LATEST = f"select 1 as match_id, {_POSITION} from latest"
_CELLS = "select 1 as match_id, sid, grid_row, grid_col, n from cells"
_EVENT = "kind, subject, kind || ': ' || subject as msg"

BODIES: dict[str, str] = {
    "raw_csv_roundtrip": """select sid, ts, x, y, z, v_abs, a_abs, cast(0 as int) as vx,
  cast(0 as int) as vy, cast(0 as int) as vz, cast(0 as int) as ax, cast(0 as int) as ay,
  cast(0 as int) as az from raw_samples""",
    "clean_samples": f"""select 1 as match_id, * exclude (v_abs, a_abs) from ({_CLEAN})""",
    "clean_csv_roundtrip": f"select 1 as match_id, * exclude (event_id) from ({_CLEAN})",
    "chunk_row_counts": """select 1 as match_id, cast(floor(ms) as int) as "chunkId",
  count(*) as n_rows from clean_base group by all""",
    "chunk_range_scan": """select 1 as match_id, cast(floor(ms) as int) as "chunkId", sid, ts, x, y, half,
  round(ms,9) as "matchSecond" from clean_base where floor(ms) >= 1804""",
    "valid_positions": f"select 1 as match_id, {_POSITION} from valid_base",
    "non_ball_positions": f"""select 1 as match_id, sid, ts, x, y from valid_base
  where sid not in ({_BALLS})""",
    "intensity_zone_counts": """select 1 as match_id, sid, intensity, count(*) as n_samples
  from zoned group by all""",
    "running_stats_1m": _STATS,
    "running_stats_latest": """select 1 as match_id, sid, intensity, window_start_s,
  round(distance_1m,6) as distance_1m, round(time_1m,6) as time_1m from stats_latest""",
    "rolling_stats_60s": _ROLLING,
    "player_rolling_stats": f"""select 1 as match_id, player, team, role,
  round(speed_kmh,6) as speed_kmh, {_zone('speed_kmh')} as intensity,
  round(distance,6) as distance, round(sprint_distance,6) as sprint_distance,
  round(high_speed_distance,6) as high_speed_distance, round(active_time,6) as active_time
  from player_rows""",
    "team_rolling_stats": """select 1 as match_id, tm.team,
  round(coalesce(sum(distance),0),6) as distance,
  round(coalesce(sum(sprint_distance),0),6) as sprint_distance,
  round(coalesce(sum(high_speed_distance),0),6) as high_speed_distance,
  round(coalesce(sum(active_time),0),6) as active_time
  from (values ('Team A'),('Team B')) tm(team) left join player_rows p using (team)
  group by all""",
    "top_sprinters": """select 1 as match_id, cast(rank as int) as rank, player, team,
  sprint_distance from (
    select *, row_number() over (order by sprint_distance desc, roster_order) as rank
    from (select player, team, roster_order, round(sprint_distance,6) as sprint_distance
          from player_rows) where sprint_distance > 0) where rank <= 8""",
    "player_minute_zones": """select 1 as match_id, entity as player, team, window_start_s,
  intensity, round(sum(distance_1m),6) as distance, round(sum(time_1m),6) as time_s,
  cast(sum(ping_count) as bigint) as pings
  from stats join sensors using (sid) where type = 'player' group by all""",
    "latest_position_per_sensor": _LATEST,
    "current_match_state": """select 1 as match_id, round(max(ms),9) as "currentMatchSecond",
  max(half) as current_half from latest""",
    "sensor_snapshot": """select 1 as match_id, tick, sid, ts, x, y, half,
  round(ms,9) as "matchSecond", round(speed_kmh,9) as speed_kmh from snap""",
    "sensor_snapshot_at": f"""select 1 as match_id, t, sid, ts, x, y, round(ms,9) as "matchSecond"
  from (select g.t + 0.5::double as t, v.* from range(30, {_LAST + 1}, 30) g(t)
    join valid_base v on v.ms <= g.t + 0.5)
  qualify row_number() over (partition by t, sid order by ts desc, event_id desc) = 1""",
    "entity_positions": """select 1 as match_id, tick, entity,
  case when entity like '% %' and type <> 'ball'
    then left(entity,1) || '. ' || split_part(entity,' ',2)
    when type = 'ball' then 'B. ' || split_part(entity,' ',2) else entity end as label,
  type, team, role, round(x,9) as x, round(y,9) as y, ts, round(ms,9) as "matchSecond", sids,
  round(speed_kmh,9) as speed_kmh from ents""",
    "pitch_coordinates": """select 1 as match_id, tick,
  case when entity like '% %' then left(entity,1) || '. ' || split_part(entity,' ',2)
    else entity end as label,
  round(y*2.0::double-6000.0::double,6) as pitch_x, round(x-31000.0::double,6) as pitch_y
  from ents""",
    "trail_last5": """select 1 as match_id, tick, trail_index,
  case when trail_index < n then round(trail_index/n*0.7::double,9) end as fade, entity, type,
  round(x,9) as x, round(y,9) as y
  from ents join (select tick, row_number() over (order by tick) as trail_index,
      count(*) over () as n
    from (select distinct cast(floor(ms) as int) as tick from valid_base
          order by tick desc limit 5)) using (tick)""",
    "kpi_per_tick": f"""select 1 as match_id, t.tick, v.visible_objects, t.raw_sensors,
  {_clock_text('t.current_second')} as match_time, t.current_half, v.visible_players,
  round(b.speed_kmh,9) as ball_speed_kmh, l.team as possession_team
  from tick_info t join live l using (tick) left join active b using (tick)
  join (select tick, count(*) as visible_objects,
      count(*) filter (type = 'player') as visible_players from ents group by tick) v
    using (tick)""",
    "active_ball": """select 1 as match_id, tick, sid, entity as ball, x, y, ts,
  round(speed_kmh,9) as speed_kmh from active""",
    "latest_ball": """select 1 as match_id, tick, sid, entity as ball, x, y, ts,
  round(speed_kmh,9) as speed_kmh from newest_ball""",
    "nearest_player": """select 1 as match_id, tick, player, team,
  round(distance_m,9) as distance_m from near""",
    "live_possession": """select 1 as match_id, tick, player, team,
  round(distance_m,9) as distance_m from live""",
    "possession_confidence": """select 1 as match_id, tick, possessor, team,
  round(distance_m,9) as distance_m, confidence from confidence""",
    "pressure_index": """select 1 as match_id, tick, team, n as players_near_ball
  from pressure""",
    "team_shape": """select 1 as match_id, tick, team, visible_players,
  round(avg_speed,9) as avg_speed, round(max_speed,9) as max_speed, round(width_m,9) as width_m,
  round(depth_m,9) as depth_m, round(compactness_m,9) as compactness_m, high_speed_players
  from shape""",
    "momentum_raw": "select 1 as match_id, tick, momentum_a, momentum_b from momentum",
    "momentum_smoothed": """select 1 as match_id, tick, round(current_second,9) as current_second,
  a as momentum_a, b as momentum_b from smoothed""",
    "statistics_history": f"""select 1 as match_id, tick, round(current_second,9) as match_second,
  {_clock_text('current_second')} as time, pa.n as pressure_a, pb.n as pressure_b,
  a as momentum_a, b as momentum_b,
  cast(printf('%.2f', sa.compactness_m) as double) as compactness_a,
  cast(printf('%.2f', sb.compactness_m) as double) as compactness_b
  from (select * from smoothed order by tick desc limit 300)
  join (select tick, n from pressure where team = 'Team A') pa using (tick)
  join (select tick, n from pressure where team = 'Team B') pb using (tick)
  join (select tick, compactness_m from shape where team = 'Team A') sa using (tick)
  join (select tick, compactness_m from shape where team = 'Team B') sb using (tick)""",
    "anomalies": """select 1 as match_id, tick, kind, subject, round(value,9) as value from (
  select tick, 'player_speed' as kind, entity as subject, speed_kmh as value from players
    where speed_kmh > 40
  union all select tick, 'ball_speed', entity, speed_kmh from ents
    where type = 'ball' and speed_kmh > 180
  union all select t.tick, 'few_visible', 'team players', count(p.entity)::double
    from tick_info t left join players p using (tick) group by t.tick having count(p.entity) < 12
  union all select tick, 'loose_ball', player, distance_m from live
    where team = 'Neutral' and distance_m is not null)""",
    "fastest_players_topk": f"""select 1 as match_id, tick, cast(rank as int) as rank, player, team,
  round(speed_kmh,9) as speed_kmh, {_zone('speed_kmh')} as intensity from (
    select tick, entity as player, team, speed_kmh,
      row_number() over (partition by tick order by speed_kmh desc, roster_order) as rank
    from players where {_MINUTE}) where rank <= 8""",
    "fastest_player": """select 1 as match_id, tick, entity as player, team,
  round(speed_kmh,9) as speed_kmh from players
  qualify row_number() over (partition by tick order by speed_kmh desc, roster_order) = 1""",
    "heatmap_cells": _CELLS,
    "heatmap_smooth": """select 1 as match_id, sid, grid_row, grid_col, round(value,6) as value
  from smooth_cells""",
    "heatmap_grid_array": """select 1 as match_id, s.sid, cast(r.i as int) as grid_row,
  cast(c.i as int) as grid_col, coalesce(round(g.value,6),0) as value
  from (select distinct sid from cells) s cross join range(0,50) r(i) cross join range(0,80) c(i)
  left join smooth_cells g on g.sid = s.sid and g.grid_row = r.i and g.grid_col = c.i""",
    "heatmap_by_selection": """select 1 as match_id, selection, grid_row, grid_col,
  round(value,6) as value from selection_grid""",
    "heatmap_zmax": """select 1 as match_id, selection, round(greatest(1, value),6) as zmax from (
    select selection, value, row_number() over (partition by selection order by value) as rn,
      count(*) over (partition by selection) as n from selection_grid where value > 0)
  where rn = cast(floor((n-1)*0.95::double) as bigint) + 1""",
    "heatmap_cell_centres": """select 1 as match_id, grid_row, grid_col,
  round(cx,6) as centre_x, round(cy,6) as centre_y, round(cy*2.0::double,6) as display_x,
  round(cx-31000.0::double,6) as display_y
  from (select distinct grid_row, grid_col, -65000.0::double+(grid_col+0.5::double)*1625 as cx,
    -34000.0::double+(grid_row+0.5::double)*1360 as cy from cells)""",
    "possession_rows_parsed": """select 1 as match_id, file_player, half, line_no, event_text,
  kind, cast(case when second_time is null then 1 else 2 end as int) as n_times,
  round(raw_time,6) as raw_time, round(second_time,6) as second_time from prows""",
    "possession_half_offset": """select 1 as match_id, file_player, half, offset_s,
  min(line_no) as first_line, count(*) as n_rows from ptimed group by all""",
    "possession_intervals": """select 1 as match_id, player, half, line_no,
  round(start_s,6) as start_s, round(end_s,6) as end_s from pintervals""",
    "possession_merged": """select 1 as match_id, player, round(start_s,6) as start_s,
  round(end_s,6) as end_s from pmerged""",
    "possession_quality_report": """select 1 as match_id, player, half,
  coalesce(n_intervals,0) as n_intervals, coalesce(n_invalid,0) as n_invalid,
  round(open_begin_s,6) as open_begin_s
  from (select player, half, count(*) filter (end_s > start_s) as n_intervals,
      count(*) filter (end_s <= start_s) as n_invalid from pcandidates group by all) c
  full join (select player, half, second as open_begin_s from (
      select * from ptimed where kind is not null
      qualify row_number() over (partition by player, half order by line_no desc) = 1)
    where kind = 'begin') o using (player, half)""",
    "possession_metadata_counts": """select 1 as match_id, count(*) as n_intervals,
  count(distinct player) as n_players from pmerged""",
    "player_name_resolution": "select distinct 1 as match_id, file_player, player from prows",
    "current_possessors": f"""select 1 as match_id, t, player, round(start_s,6) as start_s from (
    select s.t::double as t, player, start_s from range(0, {_LAST + 1}) s(t)
    join pmerged on start_s <= s.t and s.t < end_s)
  qualify rank() over (partition by t order by start_s desc) = 1""",
    "possession_timeline": """select 1 as match_id, round(left_s,6) as left_s,
  round(right_s,6) as right_s, player from timeline""",
    "time_on_ball_match": """select 1 as match_id, t, player, round(seconds,6) as seconds
  from ball_time where seconds > 1e-9""",
    "time_on_ball_60s": """select 1 as match_id, t, player, round(seconds,6) as seconds
  from ball_time_60 where seconds > 1e-9""",
    "time_on_ball_topk": """select 1 as match_id, t, cast(rank as int) as rank, player, team, seconds,
  case when seconds >= 60 then
    printf('%dm %ds', cast(floor(seconds/60) as bigint),
      cast(cast(printf('%.0f', seconds % 60) as double) as bigint))
    else printf('%.1f seconds', seconds) end as duration
  from (select t, player, round(seconds,6) as seconds,
      row_number() over (partition by t order by round(seconds,6) desc, player) as rank
    from ball_time where seconds > 1e-9) join roster using (player) where rank <= 10""",
    "team_possession_match": f"""select 1 as match_id, t, team, round(seconds,6) as seconds
  from ({_team_rows('ball_time', '0')})""",
    "team_possession_60s": f"""select 1 as match_id, t, team, round(seconds,6) as seconds
  from ({_team_rows('ball_time_60', 'greatest(0, m.t-60)')})""",
    "possession_share": f"""select 1 as match_id, t, team, seconds,
  round(seconds/sum(seconds) over (partition by t),9) as share
  from (select t, team, round(seconds,6) as seconds
    from ({_team_rows('ball_time', '0')})) where seconds > 0""",
    "possession_agreement": f"""select 1 as match_id, t, coalesce(n,0) as n_official,
  case when n = 1 then official end as official, possessor,
  case when coalesce(n,0) <> 1 then 'no verdict' when possessor = official then 'agree'
    when possessor is not null then 'differ' else 'no verdict' end as verdict
  from (select tick::double as t, possessor from confidence where {_MINUTE}) c
  full join (select t, count(*) as n, min(player) as official from (
      select m.t, player, rank() over (partition by m.t order by start_s desc) as r
      from minutes m join pmerged on start_s <= m.t and m.t < end_s) where r = 1 group by t) o
    using (t)""",
    "match_events": f"""select 1 as match_id, round(second,6) as second, {_EVENT}
  from event_rows""",
    "due_events_per_tick": f"""select 1 as match_id, greatest(0, ceil(second))::double as t,
  round(second,6) as second, {_EVENT} from event_rows where ceil(second) <= {_LAST}""",
    "json_state_roundtrip": """select 1 as match_id,
  (select round(max(ms),6) from latest) as current_second,
  l.sid, ts, x, y, z, half, round(ms,6) as "matchSecond", round(speed_kmh,6) as speed_kmh,
  h.heat, d.distance, d.time_s from latest l
  left join (select sid, round(sum(value),4) as heat from smooth_cells group by sid) h using (sid)
  left join (select sid, round(sum(distance_1m),6) as distance, round(sum(time_1m),6) as time_s
    from stats_latest group by sid) d using (sid)""",
    "stream_running_stats_1m": _STATS,
    "stream_running_stats_chunks": _STATS,
    "stream_resumed_chunks": _STATS,
    "stream_live_stats": _STATS,
    "stream_live_heatmap": _CELLS,
    "stream_late_rows": """select 1 as match_id, sid, intensity, window_start_s,
  round(sum(metres),6) as distance_1m, count(*) as ping_count,
  round(count(*) * 0.005::double,6) as time_1m
  from (select *, max(newest) over (order by batch range between unbounded preceding
      and 2 preceding) as seen
    from (select *, dense_rank() over (order by step) as batch,
        max(floor(ms * 1000)) over (partition by step) as newest
      from (select *, floor(ms / 60)::bigint * 60 as window_start_s,
          floor((floor(ms) + case when event_id % 7 = 0 then 180 else 0 end) / 450) as step
        from zoned)))
  where seen is null or (window_start_s + 60) * 1000 > seen - 5000 group by all""",
    "stream_rolling_stats_60s": _ROLLING,
    "stream_latest_positions": _LATEST,
    "stream_heatmap_cells": _CELLS,
    "stream_momentum": """select 1 as match_id, tick, round(current_second,9) as current_second,
  a as momentum_a, b as momentum_b from smoothed""",
    "stream_due_events": f"""select 1 as match_id,
  (select round(max(ms),6) from valid_base) as t, round(second,6) as second, {_EVENT}
  from event_rows where second <= (select max(ms) from valid_base)""",
}


def _per_match(body: str) -> str:
    """A statement for one match over each match of the league in turn."""
    of = MATCH_OF.replace(" div ", " // ")
    parts = []
    for m in range(1, MATCHES + 1):
        sql = _sql(body).replace("from events)", f"from events where {of} = {m})")
        sql = sql.replace("select 1 as match_id", f"select {m} as match_id")
        parts.append(f"select * from ({sql.replace('SHIFT', str((m - 1) * CLOCK_SHIFT))})")
    return "\nunion all\n".join(parts)


LEAGUE = {
    "league_samples": """select 1 as match_id, event_id, sid, ts + SHIFT as ts, x, y, half,
  round(ms,9) as "matchSecond", round(speed_kmh,9) as speed_kmh from clean_base""",
    "league_running_stats": _STATS,
    "league_momentum": BODIES["momentum_smoothed"],
    "league_history": BODIES["statistics_history"],
    "league_player_table": f"""select 1 as match_id, player, team, role,
  {_two("speed_kmh")} as speed_kmh, {_zone('speed_kmh')} as intensity,
  {_two("distance")} as distance, {_two("sprint_distance")} as sprint_distance,
  {_two("high_speed_distance")} as high_speed_distance, {_two("active_time")} as active_time
  from player_rows""",
}


def oracle_sql() -> dict[str, str]:
    files = {"possession_files_merged": "possession_merged", "match_event_files": "match_events"}
    bodies = BODIES | {name: BODIES[same] for name, same in files.items()}
    return ({name: _sql(body) for name, body in bodies.items()}
            | {name: _per_match(body) for name, body in LEAGUE.items()})
