"""Driver contract and SQL-oracle agreement on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from tessera.sources.tables import TABLES  # noqa: E402
from tools.oracle_check import _digest  # noqa: E402

SF001 = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "total_commission" in df.columns


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sp = E.queries()[name](spark, SF001).toPandas()
    dd = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(dd.columns)
    assert len(sp) == len(dd)
    assert _digest(sp)[0] == _digest(dd)[0]
