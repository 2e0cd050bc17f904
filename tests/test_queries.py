"""Every registered query against its SQL twin in DuckDB."""

import datetime
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from jobsignals.plans.catalog import QUERIES
from jobsignals.plans.oracles import ORACLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["documents", "pages", "events"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    return value.isoformat() if isinstance(value, datetime.datetime) else value


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(plain(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    expected = duck.execute(entry_point.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    assert sorted(df.columns) == sorted(names)
    got, want = as_rows(df.columns, df.collect()), as_rows(names, expected.fetchall())
    assert len(got) == len(want) and len(got) > 0
    for g, w in zip(got, want):
        assert g == w


def test_entry(spark):
    rows = entry_point.entry(spark).collect()
    assert rows[0]["count"] >= rows[-1]["count"] and rows[0].asDict().keys() == {"Knowledge", "count"}
