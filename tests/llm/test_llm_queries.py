"""Every query that SQL can express against its SQL in DuckDB, on the smallest whole tables."""

import os

import duckdb
import pytest

from docpipe.llm import queries

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "conversations", "benchmark", "labels")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def test_one_query_for_each_operator():
    assert [name.split("_")[0] for name in queries.queries()] == [f"op{n}" for n in range(1, 14)]
    assert set(queries.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    got = queries.queries()[name](spark, SF_DIR)
    want = duck.sql(queries.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = [want.columns.index(c) for c in got.columns]
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    assert rows
    assert rows == sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=repr)
