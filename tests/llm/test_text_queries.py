"""Every registered text query: SQL where there is some, and its contract's columns."""

from __future__ import annotations

import os

import pytest

from fareflow.llm import queries
from tests.test_entry import normal

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    got = queries.QUERIES[name](spark, SF)
    found = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in found.description]
    assert sorted(got.columns) == sorted(columns)
    assert normal(got.columns, map(tuple, got.collect())) == normal(columns, found.fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
