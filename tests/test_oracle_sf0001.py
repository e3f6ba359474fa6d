"""Every query with oracle SQL, compared with DuckDB on sf0.001 (exact floats)."""

import math
import os

import pytest

import __spark_entry__ as entry_mod
from oracles import ORACLES
from conftest import SF_SMALL

TABLES = ("part", "orders", "lineitem")  # the tables behind the star schema


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (1, repr(v + 0.0))
    if isinstance(v, bool):
        return (1, str(int(v)))
    return (1, str(v))


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, key):
    df = entry_mod.queries()[key](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    rel = duck.sql(entry_mod.oracle_sql()[key])
    want = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(got) == len(want)
    assert _canon(df.columns, got) == _canon(rel.columns, want)
