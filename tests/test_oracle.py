"""Every key with oracle SQL matches DuckDB at sf0.001 (rows-only keys must run)."""

import hashlib
import math
import os

import pytest

import __spark_entry__ as entry
from pintime.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["nation", "customer", "supplier", "orders", "lineitem"]
SLOW = {"train_predict", "validation_mae", "feature_importance", "batch_score", "train_predict_boosted",
        "boosting_curve"}


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(set(QUERIES) - SLOW))
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(key)
    if sql is None:
        return
    res = duck.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert df.count() == 430
