"""Every query with an SQL twin gives the same rows on the smallest tables."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check import TABLES, rows_of  # noqa: E402

SF = entry.SMALL
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cursor = duck.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got == rows_of(columns, cursor.fetchall())


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
