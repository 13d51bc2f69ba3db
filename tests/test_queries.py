"""Every query with SQL against DuckDB on the small tables; every other one runs."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

CORE = [n for n in entry.core.QUERIES if n in entry.core.ORACLE_SQL]


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return connection


def same(rows_a, rows_b):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    return sorted(rows_a, key=key) == sorted(rows_b, key=key)


@pytest.mark.parametrize("name", CORE)
def test_against_sql(spark, folder, duck, name):
    df = entry.core.QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    cursor = duck.execute(entry.core.ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = [tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()]
    assert same(got, expected)


@pytest.mark.parametrize("name", [n for n in entry.core.QUERIES if n not in entry.core.ORACLE_SQL])
def test_others_run(spark, folder, name):
    assert entry.core.QUERIES[name](spark, folder).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables")
    assert entry.entry(spark).limit(1).count() == 1
