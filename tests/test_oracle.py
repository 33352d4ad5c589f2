"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from cartpulse.plans.catalog import ALL_QUERIES
from cartpulse.sources.tables import TABLES
from conftest import SF_SMALL
import importlib.util

_spec = importlib.util.spec_from_file_location(
    "check_oracle", os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools", "check_oracle.py"))
check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(ALL_QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    orows = cur.fetchall()
    assert len(rows) == len(orows)
    assert check.digest(df.columns, rows)[0] == check.digest(ocols, orows)[0]


def test_every_query_has_an_oracle():
    assert set(ALL_QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["day", "hour", "today", "yesterday"]
    assert df.count() == 24 * df.select("day").distinct().count() > 0
