"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from outcomelake.plans import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("events", "lineitem", "orders", "part")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return c


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    return repr(v + 0.0) if isinstance(v, float) else str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, SF_DIR)
    got = _rows(df.columns, df.collect())
    if name not in oracle_sql():
        assert got
        return
    want = con.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert got == _rows(want.columns, want.fetchall())


def test_contract(spark):
    assert set(oracle_sql()) <= set(queries())
    assert entry(spark).columns == ["player", "n_bets", "win_rate", "total_won_usd", "score"]
