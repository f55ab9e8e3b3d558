"""The driver contract: entry(), queries() and oracle_sql() agree at sf0.001."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, (float, decimal.Decimal)):
        v = float(v)
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "total_events" in df.columns


def test_every_library_query_has_an_oracle():
    assert set(E.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert canon(df.columns, rows) == canon(ocols, cur.fetchall())
