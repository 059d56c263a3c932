"""Every registered query with SQL against DuckDB on the driver's smallest tables."""

from __future__ import annotations

import datetime
import math
import os

import pytest

import __spark_entry__ as entry
from fareflow import checks

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value))
    return str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(checks.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    got = checks.queries()[name](spark, SF)
    found = con.execute(checks.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert sorted(got.columns) == sorted(columns)
    assert normal(got.columns, map(tuple, got.collect())) == normal(columns, found.fetchall())
