"""Extra time, texts beyond the range of a number."""

import os

from pyspark.sql import functions as F

from trackspark import session
from trackspark.functions import times
from trackspark.operators import snapshot
from trackspark.operators.ticks import minute_ticks
from trackspark.plans import fixtures

SF_DIR = "/root/testdata/sf0.01"


def test_overflow_of_a_time_text_is_no_error(spark):
    df = spark.createDataFrame(
        [("9223372036854775807:00:00",), ("99999999999999999999:00:00",), ("01:02:03,5",)],
        "t string")
    got = [r[0] for r in df.select(times.possession_second(F.col("t"))).collect()]
    assert got == [9223372036854775807 * 3600.0, None, 3723.5]


def test_extra_time_is_carried_to_the_newest_sample(spark):
    schema = ("match_id int, sid int, ts long, x int, y int, z int, half int, "
              "matchSecond double, speed_kmh double")
    rows = [(1, 13, 1, 0, 0, 0, 2, 3590.5, 1.0), (1, 13, 2, 7, 0, 0, 2, 3650.5, 1.0),
            (1, 14, 3, 1, 0, 0, 2, 3700.0, 1.0), (2, 13, 1, 5, 0, 0, 1, 99.0, 1.0)]
    got = snapshot.snapshot(spark.createDataFrame(rows, schema)).collect()
    ticks = {}
    for r in got:
        ticks.setdefault((r.match_id, r.sid), []).append((r.tick, r.x))
    first = sorted(ticks[1, 13])
    assert first == [(t, 0) for t in range(3590, 3650)] + [(t, 7) for t in range(3650, 3701)]
    assert ticks[1, 14] == [(3700, 1)]
    assert sorted(t for t, _ in ticks[2, 13]) == list(range(99, 3598))


def test_wanted_ticks_equal_the_cut_of_all(spark):
    positions = fixtures.positions(spark, SF_DIR)
    every = snapshot.snapshot(positions, fixtures.TIE).where(
        "tick % 60 = 0 and tick > 0 or tick = 3597")
    some = snapshot.snapshot(positions, fixtures.TIE, every=60)
    columns = ["match_id", "sid", "tick", "ts", "x"]
    assert sorted(some.select(*columns).collect()) == sorted(every.select(*columns).collect())


def test_minute_ticks_of_matches_of_different_length(spark):
    matches = spark.createDataFrame([(1, 130), (2, 50)], "match_id int, last_tick int")
    got = sorted((r.match_id, r.t) for r in minute_ticks(matches).collect())
    assert got == [(1, 60.0), (1, 120.0), (1, 130.0), (2, 50.0)]


def test_run_folder_takes_its_tables_along(spark):
    with session.run_folder(spark) as outer:
        with session.run_folder(spark) as inner:
            assert inner.startswith(outer)
            kept = session.materialise(spark.range(5), "numbers")
            assert kept.count() == 5 and all(inner in f for f in kept.inputFiles())
        assert not os.path.exists(inner)
        assert session.materialise(spark.range(3), "numbers").count() == 3
        assert os.path.exists(outer)
    assert not os.path.exists(outer)
    assert not session.work_dir(spark, "later").startswith(outer)
