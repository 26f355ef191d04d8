"""Every registered query against its SQL in DuckDB, on the smallest whole tables."""

import os

import duckdb
import pytest

from workload import oracle, queries

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "conversations", "embeddings", "labels")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(queries.all_queries()) == set(oracle.all_oracles())


@pytest.mark.parametrize("name", list(queries.all_queries()))
def test_query_equals_sql(spark, duck, name):
    got = queries.all_queries()[name](spark, SF_DIR)
    want = duck.sql(oracle.all_oracles()[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = [want.columns.index(c) for c in got.columns]
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    assert rows
    assert rows == sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=repr)
