"""Every query that has SQL gives the rows that DuckDB gives on the same tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in sorted(DATA.glob("*.parquet")):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    return f"{value:.9g}" if isinstance(value, (int, float)) and not isinstance(value, int) else str(value)


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in records)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    want = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(want.columns, want.fetchall())


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
