"""Every core query with SQL agrees with DuckDB on the same files; the others run."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from docstrata.plans import queries as core


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in glob.glob(f"{data}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as from '{f}'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 5)
    return v if isinstance(v, int | bool) else str(v)


@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_agrees(spark, duck, data, name):
    df = core.queries()[name](spark, data)
    cols = sorted(df.columns)
    got = sorted(repr([plain(v) for v in r]) for r in df.select(*cols).collect())
    want = sorted(repr([plain(v) for v in r]) for r in duck.sql(f"select {', '.join(cols)} from ({core.oracle_sql()[name]})").fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(core.queries()) - set(core.oracle_sql())))
def test_runs(spark, data, name):
    assert core.queries()[name](spark, data).count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() == 1
