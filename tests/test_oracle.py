"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.oracle_check import TABLES, rows_of

from .conftest import SMOKE

SQL = {n: sql for n, sql in oracle_sql().items() if n.startswith("q_")}
# The queries of the training-data subpackage have tests of their own.
NAMES = sorted(n for n in queries() if n.startswith("q_"))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SMOKE}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


def test_entry_runs(spark):
    df = entry(spark)
    assert df.limit(5).count() > 0
    assert "market_value_local" in df.columns


def test_every_query_has_oracle():
    assert set(NAMES) == set(SQL)


#: Checks that find nothing in the stand-ins; each has a variant on broken input that must find something.
EMPTY = {"q_gaps", "q_overlaps", "q_one_current", "q_interval_order", "q_reconcile_range"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SMOKE)
    s_rows = [tuple(r) for r in df.collect()]
    assert s_rows or name in EMPTY
    cur = con.execute(SQL[name])
    o_cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(o_cols)
    assert rows_of(df.columns, s_rows) == rows_of(o_cols, cur.fetchall())


DEFECTS = [n for n in NAMES if n.startswith("q_inject_")]


def test_all_ten_defects_registered():
    assert len(DEFECTS) == 10


@pytest.mark.parametrize("name", DEFECTS)
def test_each_defect_trips_its_check(spark, name):
    assert queries()[name](spark, SMOKE).limit(1).count() == 1
