"""Every registered query against its DuckDB oracle (sf0.001, order-insensitive)."""

import datetime as dt
import decimal
from collections import Counter

import duckdb
import pytest

from conftest import SF_SMALL
import __spark_entry__ as entry
from landfall.plans.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canon(v):
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return repr(v)


def bag(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(canon(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF_SMALL)
    got, cols = df.collect(), df.columns
    res = duck.execute(entry.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(got) == len(want)
    assert bag(got, cols) == bag(want, ocols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["n_name", "o_year", "line_count", "sum_qty", "revenue"]
