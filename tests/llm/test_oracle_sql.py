"""Queries of the operators that SQL can express, against DuckDB on the smallest driver tables."""

import os

import duckdb
import pytest

from cartwheel.llm import queries
from cartwheel.sources.driver_tables import TABLES
from oracle_check import digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in res.description]
    expected = res.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert len(rows) == len(expected)
    assert digest(df.columns, rows) == digest(columns, expected)
