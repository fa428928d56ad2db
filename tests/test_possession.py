"""Metadata parsing, interval building and possession against plain-Python brute force."""

import random

import pytest
from pyspark.sql import functions as F

from trackspark.config import PLAYERS
from trackspark.dims import player_dim
from trackspark.functions.names import resolve_player
from trackspark.functions.text import clock_text, duration_text, short_label
from trackspark.functions.times import match_event_second, possession_second
from trackspark.operators import events, metadata, possession
from trackspark.operators.scan import Prefix, prefix_scan
from trackspark.session import materialise
from trackspark.sources.readers import read_event_files, read_possession_files

A1, A2, B1 = PLAYERS[0][0], PLAYERS[1][0], PLAYERS[8][0]


def rows(spark, lines, half=1, player=A1):
    data = [(1, player, half, i, [f for f in line.split(";") if f]) for i, line in enumerate(lines)]
    return spark.createDataFrame(
        data, "match_id int, file_player string, half int, line_no bigint, fields array<string>")


def intervals_of(df):
    timed = metadata.timed_rows(metadata.parse_rows(df))
    return sorted((r.start_s, r.end_s) for r in metadata.possession_intervals(timed).collect())


def one(spark, expression, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize("text, want", [
    ("00:01:02.5", 62.5), ("00:01:02,5", 62.5), ("01:02,25", 62.25), ("0", 0.0), ("", None),
    ("  ", None), ("1:2:3:4", None), ("aa:10", None), ("00:1.5:10", None), ("5", None),
    (" 01:00:00 ", 3600.0)])
def test_possession_time(spark, text, want):
    assert one(spark, possession_second, text) == want


@pytest.mark.parametrize("text, want", [
    ("00:01:02.5", 1862.5), ("0", 1800.0), ("01:02", None), ("00:01:02,5", None), ("n/a", None)])
def test_event_time(spark, text, want):
    assert one(spark, lambda c: match_event_second(F.split(c, ":"), F.lit(1800.0)), text) == want


@pytest.mark.parametrize("text, want", [
    ("Possession Begin", "begin"), ("START", "begin"), ("start and end", "begin"),
    ("Defender", "end"), ("stopped", "end"), ("Interval", None)])
def test_event_kind(spark, text, want):
    assert one(spark, metadata.event_kind, text) == want


@pytest.mark.parametrize("name, want", [
    ("Ben Müller", "Ben Mueller"), ("ben mueller", "Ben Mueller"), ("  Ben   Mueller ", "Ben Mueller"),
    ("Léon Krapf", "Leon Krapf"), ("Kevin Bär", "Kevin Baer"), ("Somebody  Else", "Somebody Else"),
    ("Bén Mueller", "Ben Mueller"), ("Unknown Groß", "Unknown Groß")])
def test_names(spark, name, want):
    assert one(spark, resolve_player, name) == want


def test_text_forms(spark):
    assert one(spark, clock_text, 61.9, "double") == "01:01"
    assert one(spark, clock_text, None, "double") == "-"
    assert one(spark, duration_text, 59.94, "double") == "59.9 seconds"
    assert one(spark, duration_text, 125.5, "double") == "2m 6s"
    assert one(spark, short_label, "Anna Maria Lee") == "A. Lee"
    assert one(spark, short_label, "Referee") == "Referee"


def test_pairing_rules(spark):
    lines = ["1;Begin;00:00:01", "2;Begin;00:00:03", "3;End;00:00:05", "4;End;00:00:09",
             "5;Begin;00:00:20", "6;End;00:00:20", "7;Hold;00:00:30;00:00:34",
             "8;Hold;00:00:40;00:00:40", "9;Note;00:00:50", "Total;12", "10;Begin;00:01:00"]
    assert intervals_of(rows(spark, lines)) == [(3.0, 5.0), (30.0, 34.0)]
    timed = metadata.timed_rows(metadata.parse_rows(rows(spark, lines)))
    report = metadata.quality_report(timed).first()
    assert (report.n_intervals, report.n_invalid, report.open_begin_s) == (2, 2, 60.0)


def test_clock_restart_inside_a_flat_file(spark):
    lines = ["1;Begin;00:29:00", "2;End;00:29:10", "3;Begin;00:00:05", "4;End;00:00:15"]
    assert intervals_of(rows(spark, lines, half=0)) == [(1740.0, 1750.0), (1805.0, 1815.0)]


@pytest.mark.parametrize("first, shift", [("00:28:59.9", 1800.0), ("00:29:00", 0.0)])
def test_second_half_offset_is_inferred(spark, first, shift):
    lines = [f"1;Begin;{first}", "2;End;00:40:00"]
    start = 1739.9 if shift else 1740.0
    got = intervals_of(rows(spark, lines, half=2))
    assert got == [(pytest.approx(start + shift), 2400.0 + shift)]


def brute_pairing(lines):
    out, begin = [], None
    for kind, second in lines:
        if kind == "Begin":
            begin = second
        elif begin is not None:
            if second > begin:
                out.append((float(begin), float(second)))
            begin = None
    return sorted(out)


def test_pairing_over_many_buckets_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(metadata, "LINES_PER_BUCKET", 7)
    rng, second, lines = random.Random(11), 0, []
    for _ in range(300):
        second += rng.randrange(0, 4)
        lines.append((rng.choice(["Begin", "End"]), second))
    text = [f"{i};{k};{s // 60:02d}:{s % 60:02d}" for i, (k, s) in enumerate(lines)]
    assert intervals_of(rows(spark, text)) == brute_pairing(lines)


def test_prefix_scan_equals_plain_window(spark):
    rng = random.Random(2)
    data = [(k, i, rng.choice([None, rng.randrange(50)])) for k in "ab" for i in range(60)]
    df = spark.createDataFrame(data, "k string, o bigint, v int")
    out = prefix_scan(df, ["k"], "o", F.floor(F.col("o") / 9), [
        Prefix("last_v", F.col("v"), "last"), Prefix("max_v", F.col("v"), "max", True),
        Prefix("sum_v", F.col("v").cast("double"), "sum", True)]).collect()
    for r in out:
        before = [v for k, i, v in data if k == r.k and i < r.o and v is not None]
        upto = [v for k, i, v in data if k == r.k and i <= r.o and v is not None]
        assert r.last_v == (before[-1] if before else None)
        assert r.max_v == (max(upto) if upto else None)
        assert r.sum_v == float(sum(upto))


def intervals(spark, data):
    return spark.createDataFrame(
        [(1, p, float(s), float(e)) for p, s, e in data],
        "match_id int, player string, start_s double, end_s double")


def test_merge_touching_nested_and_far(spark):
    data = [(A1, 0, 10), (A1, 10, 12), (A1, 3, 5), (A1, 13, 14), (A1, 59, 61), (A1, 60, 200),
            (B1, 1, 2), (A1, 130, 140), (A1, 300, 300)]
    merged = metadata.merge_intervals(intervals(spark, data))
    got = sorted((r.player, r.start_s, r.end_s) for r in merged.collect())
    assert got == sorted([(B1, 1.0, 2.0), (A1, 0.0, 12.0), (A1, 13.0, 14.0), (A1, 59.0, 200.0)])
    again = metadata.merge_intervals(merged)
    assert sorted((r.player, r.start_s, r.end_s) for r in again.collect()) == got
    counts = metadata.metadata_counts(merged).first()
    assert (counts.n_intervals, counts.n_players) == (4, 2)


def random_merged(spark, seed):
    rng = random.Random(seed)
    data = []
    for p in (A1, A2, B1, "Stranger"):
        t = 0.0
        for _ in range(12):
            t += rng.choice([0.5, 1, 7, 20, 45])
            length = rng.choice([0.5, 2, 9, 70])
            data.append((p, t, t + length))
            t += length + 0.25
    return data, intervals(spark, data)


def brute_state(data, now, window):
    low = 0.0 if window is None else max(0.0, now - window)
    holders = [(s, p) for p, s, e in data if s <= now < e]
    top = max((s for s, _ in holders), default=None)
    current = sorted(p for s, p in holders if s == top)
    clipped = [(p, max(s, low), min(e, now), s) for p, s, e in data if min(e, now) > max(s, low)]
    edges = sorted({low, now} | {c[1] for c in clipped} | {c[2] for c in clipped})
    order = {p[0]: i for i, p in enumerate(PLAYERS)}
    held = {}
    for left, right in zip(edges, edges[1:]):
        mid = (left + right) / 2
        active = [(s, -order.get(p, 99), p) for p, a, b, s in clipped if a <= mid < b]
        if active:
            p = max(active)[2]
            held[p] = held.get(p, 0.0) + right - left
    return current, held, now - low


@pytest.mark.parametrize("window", [None, 60.0])
def test_possession_state_equals_brute_force(spark, window):
    data, merged = random_merged(spark, 4)
    times = [0.0, 0.5, 30.0, 60.0, 61.25, 119.5, 240.0, 333.3, 500.0]
    ticks = spark.createDataFrame([(1, t) for t in times], "match_id int, t double")
    players = player_dim(spark)
    timeline = materialise(possession.possession_timeline(merged, players), "tl")
    seconds = possession.time_on_ball(timeline, ticks, window)
    got = {(r.t, r.player): r.seconds for r in seconds.collect()}
    teams = {(r.t, r.team): r.seconds for r in possession.team_possession(
        seconds, ticks, players, window).collect()}
    current = {}
    for r in possession.current_possessors(merged, ticks).collect():
        current.setdefault(r.t, []).append(r.player)
    for t in times:
        holders, held, duration = brute_state(data, t, window)
        assert sorted(current.get(t, [])) == holders
        assert {p: s for (u, p), s in got.items() if u == t} == pytest.approx(held)
        a = held.get(A1, 0) + held.get(A2, 0)
        b = held.get(B1, 0)
        assert teams[(t, "Team A")] == pytest.approx(a)
        assert teams[(t, "Loose Ball")] == pytest.approx(max(0, duration - a - b))
    share = possession.possession_share(possession.team_possession(seconds, ticks, players, window))
    for r in share.groupBy("t").agg(F.sum("share").alias("s"), F.min("seconds").alias("m")).collect():
        assert r.s == pytest.approx(1.0) and r.m > 0


def test_intervals_of_any_length_equal_brute_force(spark):
    """One interval of 1e12 seconds and more beside normal ones, and probes far apart."""
    data, _ = random_merged(spark, 11)
    data += [(A1, 5e3, 5e3 + 1e12), (B1, 1e4, 3.6e12), (A2, 7e3, 7e3 + 60 * 4096), (B1, 2e3, 2.5e3)]
    merged = intervals(spark, data)
    times = [0.0, 61.25, 333.3, 2.2e3, 5e3, 6e3, 7e3, 7060.0, 123456.75, 252760.0, 252759.5, 1e6,
             5e11, 1e12, 1e12 + 4999.0, 1e12 + 5000.0, 3e12, 3.6e12, 1e13]
    ticks = spark.createDataFrame([(1, t) for t in times], "match_id int, t double")
    timeline = materialise(possession.possession_timeline(merged, player_dim(spark)), "tl")
    current = {}
    for r in possession.current_possessors(merged, ticks).collect():
        current.setdefault(r.t, []).append(r.player)
    for window in (None, 60.0):
        got = {(r.t, r.player): r.seconds for r in possession.time_on_ball(
            timeline, ticks, window).collect()}
        for t in times:
            holders, held, _ = brute_state(data, t, window)
            assert sorted(current.get(t, [])) == holders
            assert {p: s for (u, p), s in got.items() if u == t} == pytest.approx(held)
    assert timeline.count() < 2 * len(data)


@pytest.mark.parametrize("lo, hi", [(0, 1), (-7, 9), (5, 6), (3, 1000), (-1024, 1024), (7, 1 << 40)])
def test_nodes_cover_each_bucket_once(spark, lo, hi):
    merged = intervals(spark, [(A1, lo - 0.5, hi + 0.5)])
    nodes = possession._nodes(merged, 1.0).collect()
    spans = sorted((r.node << r.level, (r.node + 1) << r.level) for r in nodes)
    assert spans[0][0] == lo and spans[-1][1] == hi
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert len(spans) <= 2 * (hi - lo).bit_length()


def test_timeline_segments_do_not_overlap(spark):
    _, merged = random_merged(spark, 9)
    segments = sorted((r.left_s, r.right_s) for r in possession.possession_timeline(
        merged, player_dim(spark)).collect())
    assert all(a[1] <= b[0] for a, b in zip(segments, segments[1:]))
    assert all(lo < hi for lo, hi in segments)


def test_two_players_with_one_start(spark):
    merged = intervals(spark, [(B1, 5, 9), (A1, 5, 8)])
    ticks = spark.createDataFrame([(1, 5.0), (1, 8.0), (1, 9.0)], "match_id int, t double")
    current = sorted((r.t, r.player) for r in possession.current_possessors(merged, ticks).collect())
    assert current == sorted([(5.0, A1), (5.0, B1), (8.0, B1)])
    line = {(r.left_s, r.player) for r in possession.possession_timeline(
        merged, player_dim(spark)).collect()}
    assert line == {(5.0, A1), (8.0, B1)}


def test_agreement(spark):
    official = spark.createDataFrame(
        [(1, 1.0, A1, 0.0), (1, 2.0, A1, 0.0), (1, 3.0, A1, 0.0), (1, 3.0, B1, 0.0), (1, 5.0, A1, 0.0)],
        "match_id int, t double, player string, start_s double")
    estimate = spark.createDataFrame(
        [(1, 1, A1), (1, 2, B1), (1, 3, A1), (1, 4, A1), (1, 5, None)],
        "match_id int, tick int, possessor string")
    got = {r.t: r.verdict for r in possession.possession_agreement(official, estimate).collect()}
    assert got == {1.0: "agree", 2.0: "differ", 3.0: "no verdict", 4.0: "no verdict",
                   5.0: "no verdict"}


def test_possession_files(spark, tmp_path):
    base = tmp_path / "Ball Possession"
    for half, lines in (("1st Half", "1;Begin;00:00:01,5\r\n2;End;00:00:03\r\n\r\nStatistics;;\r\n"),
                        ("2nd Half", "1;Begin;00:00:10\n2;End;00:00:12\n")):
        (base / half).mkdir(parents=True)
        (base / half / "Ben Müller.csv").write_bytes(lines.encode("latin-1"))
    (base / "2nd Half" / "Leon Krapf.csv").write_bytes(
        '7;"Ballbesitz; ""lang"" Hold é";0;00:00:04\n'.encode("latin-1"))
    (base / "2nd Half" / "A+B 100%.csv").write_text("1;Begin;00:00:01\n2;End;00:00:02\n")
    (base / "stray.csv").write_text("1;Begin;00:00:01\n2;End;00:00:02\n")
    found = read_possession_files(spark, str(base))
    quoted = found.where("file_player = 'Leon Krapf'").first().fields
    assert quoted == ["7", 'Ballbesitz; "lang" Hold é', "0", "00:00:04"]
    timed = metadata.timed_rows(metadata.parse_rows(found))
    got = sorted((r.player, r.start_s, r.end_s) for r in metadata.possession_intervals(timed).collect())
    assert got == [("A+B 100%", 1801.0, 1802.0), ("Ben Mueller", 1.5, 3.0), ("Ben Mueller", 1810.0, 1812.0),
                   ("Leon Krapf", 1800.0, 1804.0)]


def test_possession_files_of_two_matches(spark, tmp_path):
    text = "1;Begin;00:00:01\n2;End;00:00:03\n"
    for folder in ("match_id=7/2nd Half", "match_id=8", "match_id=8/1st Half old"):
        (tmp_path / "1st Half export" / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / "1st Half export" / folder / "Ben Müller.csv").write_text(text)
    (tmp_path / "1st Half export" / "match_id=7" / "Leon Krapf.csv").write_text(text)
    found = read_possession_files(spark, str(tmp_path))
    got = sorted((r.match_id, r.file_player, r.half) for r in found.collect())
    assert got == [(7, "Ben Müller", 2)] * 2 + [(8, "Ben Müller", 0)] * 4


def test_flat_possession_folder_keeps_line_order(spark, tmp_path):
    lines = [f"{i};{'Begin' if i % 2 == 0 else 'End'};{i // 60:02d}:{i % 60:02d}" for i in range(2000)]
    (tmp_path / "Leon Krapf.csv").write_text("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # several splits per file
    try:
        found = read_possession_files(spark, str(tmp_path))
        numbered = found.orderBy("line_no").collect()
        assert numbered[-1].line_no > 4096  # later splits start at their byte offset
        order = [r.fields[0] for r in numbered]
        assert order == [str(i) for i in range(2000)]
        assert intervals_of(found) == [(float(i), float(i + 1)) for i in range(0, 2000, 2)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_match_event_files_and_due_ticks(spark, tmp_path):
    shots, stops = tmp_path / "Shot on Goal", tmp_path / "Game Interruption"
    shots.mkdir()
    stops.mkdir()
    (shots / "1st Half.csv").write_text("1;Leon Krapf;00:00:10.5\nx;y;00:00:01\n2;short\nSum;2;2\n")
    (shots / "2nd Half.csv").write_text("1;Kevin Bär;00:00:01\n", encoding="latin-1")
    (stops / "1st Half.csv").write_text("1;Begin;0\n")
    out = events.match_events(read_event_files(spark, str(tmp_path)))
    got = sorted((r.second, r.msg) for r in out.collect())
    assert got == [(0.0, "Match Control: Begin"), (10.5, "Shot by: Leon Krapf"),
                   (1801.0, "Shot by: Kevin Bär")]
    ticks = spark.createDataFrame([(1, 3.0), (1, 10.4), (1, 900.0), (1, 1800.5)],
                                  "match_id int, t double")
    due = sorted((r.t, r.second) for r in events.due_events(out, ticks).collect())
    assert due == [(3.0, 0.0), (900.0, 10.5)]
