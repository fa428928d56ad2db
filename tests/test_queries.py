"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import math
import os

import pytest

import __spark_entry__ as entry_point
from trackspark.plans import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = entry_point.queries(), entry_point.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{SF_DIR}/{file}'")
    return con


def plain(value):
    if value is None:
        return "~"
    if isinstance(value, float):
        return "~" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, int):
        return repr(float(value))
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def test_each_query_has_sql():
    assert set(ORACLE) <= set(QUERIES)
    assert set(catalog.QUERIES) <= set(ORACLE)


def test_entry_has_rows(spark):
    df = entry_point.entry(spark)
    assert df.columns[:2] == ["match_id", "player"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    want = duck.execute(ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert table(got.columns, got.collect()) == table(names, want.fetchall())
