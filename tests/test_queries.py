"""Every query with SQL gives what DuckDB gives, on the smallest data."""

import datetime as dt
import glob
import math
import os

import pytest

import __spark_entry__ as entry

DATA = os.environ.get("TEST_DATA", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for path in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return v if v is None or isinstance(v, (int, bool)) else str(v)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", sorted(n for n in ORACLES if not n.startswith("jn15")))
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    sql = duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(sql.columns)
    at = [sql.columns.index(c) for c in columns]
    key = lambda r: [(x is None, str(type(x)), str(x)) for x in r]
    assert sorted([tuple(plain(r[c]) for c in columns) for r in df.collect()], key=key) == sorted([tuple(plain(r[i]) for i in at) for r in sql.fetchall()], key=key)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in ORACLES and n[1].isdigit() and not n.startswith(("p5_", "p8_", "p9_", "p10_"))))
def test_runs_with_a_stable_schema(spark, name):
    a, b = QUERIES[name](spark, DATA), QUERIES[name](spark, DATA)
    assert a.schema == b.schema and a.count() == b.count()


def test_entry(spark):
    if os.path.isdir("/root/testdata/sf0.001"):
        assert entry.entry(spark).count() > 0
