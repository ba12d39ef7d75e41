"""Every registered query against its DuckDB oracle on the smallest test data."""

import datetime as dt
import math
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_mod  # noqa: E402
from orderlake.oracles import ORACLES  # noqa: E402
from orderlake.registry import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "events"]


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "∅"
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return str(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0 and len(df.columns) == 10


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLES) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = entry_mod.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry_mod.oracle_sql()[key])
    ocols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _bag(df.columns, rows) == _bag(ocols, res.fetchall())
