"""Queries of the corpus operators against their SQL twins in DuckDB."""

import os

import duckdb
import pytest

from jobsignals.llm.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["documents", "pages", "embeddings", "labels", "benchmark"]


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    expected = con.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    assert sorted(df.columns) == sorted(names)
    got, want = as_rows(df.columns, df.collect()), as_rows(names, expected.fetchall())
    assert len(got) > 0 and got == want
