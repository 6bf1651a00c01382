"""Loads through a side table and one transaction, on a stand-in whose tasks write twice."""

import datetime as dt

import duckdb
import pandas as pd
import pytest

from landfall.sources import jdbc
from landfall.sources.jdbc import JdbcSource, clean_query, load_table_once, snapshot_query

TARGET = JdbcSource("db", url="jdbc:x:y")


@pytest.fixture()
def db(spark, monkeypatch):
    """Stands in for the target: statements run on in-memory tables, the rows of two tasks arrive twice, those of ``lost`` never."""
    con, lost = duckdb.connect(), set()
    con.execute("create table t (K bigint, v varchar)")
    con.execute(jdbc.LOADS_TABLE_DDL)

    def extract(spark, source, query, **kw):
        got = con.execute(clean_query(query))
        names = ", ".join(f"`{d[0]}` string" for d in got.description)
        return spark.createDataFrame([tuple(map(str, r)) for r in got.fetchall()], names)

    def load(df, target, table, mode, **kw):
        assert mode == "overwrite"
        tasks = df.rdd.glom().collect()
        rows = [tuple(r) for task in tasks + tasks[:2] for r in task if r["k"] not in lost]
        con.execute(f"create or replace table {table} (k bigint, v varchar, {jdbc.ROW} bigint)")
        if rows:
            sent = pd.DataFrame(rows, columns=["k", "v", "n"]).astype({"k": "Int64"})  # noqa: F841
            con.execute(f"insert into {table} select k, v, n from sent")

    def in_one_transaction(spark, target, statements, properties=None):
        con.begin()
        try:
            for sql, expected in statements:
                done = con.execute(sql).fetchall()
                jdbc.check_changed(sql, done[0][0] if done else 0, expected)
            con.commit()
        except BaseException:
            con.rollback()
            raise

    for fake in (extract, load, in_one_transaction):
        monkeypatch.setattr(jdbc, fake.__name__, fake)
    return con, lost


def rows(spark, low, high, tag="a"):
    return spark.range(low, high, numPartitions=4).selectExpr("id as k", f"concat('{tag}', id % 3) as v")


def held(con):
    return sorted(con.execute("select K, v from t").fetchall(), key=str)


def test_rows_of_repeated_tasks_arrive_once(spark, store, db):
    con, _ = db
    twice = rows(spark, 0, 10).union(rows(spark, 0, 10))  # equal rows of the data itself stay
    done = load_table_once(store, twice, TARGET, "t")
    assert done.rows_written == 20
    assert held(con) == sorted([(k, f"a{k % 3}") for k in range(10)] * 2, key=str)
    assert con.execute("select count(*) from information_schema.tables where table_name = 't_load'").fetchone() == (0,)
    log = store.audit("db_jdbc.t").collect()
    assert [(r["status"], r["mode"], r["rows_written"]) for r in log] == [(1, "jdbc_append", 20)]


def test_missing_rows_leave_the_target_as_it_was(spark, store, db):
    con, lost = db
    load_table_once(store, rows(spark, 0, 5), TARGET, "t")
    before = held(con)
    lost.add(7)
    for mode, kw in (("append", {}), ("overwrite", {}), ("upsert", {"keys": ["k"]})):
        with pytest.raises(RuntimeError, match="rows changed"):
            load_table_once(store, rows(spark, 3, 9), TARGET, "t", mode, load_key="x", **kw)
    assert held(con) == before
    assert con.execute("select count(*) from landfall_loads").fetchone() == (0,)
    assert sorted(r["status"] for r in store.audit("db_jdbc.t").collect()) == [0, 0, 0, 1]


def test_overwrite_and_upsert(spark, store, db):
    con, _ = db
    load_table_once(store, rows(spark, 0, 5), TARGET, "t")
    load_table_once(store, rows(spark, 0, 3, "b"), TARGET, "t", "overwrite")
    assert held(con) == [(0, "b0"), (1, "b1"), (2, "b2")]
    changes = rows(spark, 2, 4, "c").unionAll(spark.sql("select 2L, 'd9'")).unionAll(spark.sql("select cast(null as bigint), 'n'"))
    load_table_once(store, changes, TARGET, "t", "upsert", keys=["k"], order=["-v"])
    assert held(con) == sorted([(0, "b0"), (1, "b1"), (2, "d9"), (3, "c0"), (None, "n")], key=str)
    load_table_once(store, rows(spark, 0, 0), TARGET, "t", "overwrite")
    assert held(con) == []


def test_a_named_load_is_taken_once(spark, store, db):
    con, _ = db
    assert load_table_once(store, rows(spark, 0, 5), TARGET, "t", load_key="day 1").rows_written == 5
    assert load_table_once(store, rows(spark, 0, 5), TARGET, "t", load_key="day 1") is None
    assert load_table_once(store, rows(spark, 5, 8), TARGET, "t", load_key="o'day").rows_written == 3
    assert len(held(con)) == 8


def test_modes_and_columns_are_checked(spark, store, db):
    for mode, kw in (("upsert", {}), ("append", {"keys": ["k"]}), ("merge", {})):
        with pytest.raises(ValueError, match="mode"):
            load_table_once(store, rows(spark, 0, 1), TARGET, "t", mode, **kw)
    with pytest.raises(ValueError, match="not in the target"):
        load_table_once(store, rows(spark, 0, 1).withColumn("extra", jdbc.F.lit(1)), TARGET, "t")


def test_names_are_quoted_as_the_dialect_does(spark):
    assert jdbc.quote(spark, JdbcSource("m", url="jdbc:mysql://h/d"), "a b") == "`a b`"
    assert jdbc.quote(spark, JdbcSource("p", url="jdbc:postgresql://h/d"), "a b") == '"a b"'


def test_rows_of_one_moment(spark, monkeypatch):
    """A row that moves to another stride after the moment was taken is not read twice, and is read by the next increment."""
    moment = dt.datetime(2024, 1, 1, 12, 0, 0, 250000)
    spark.sql(
        "select id as k, timestamp_ntz'2024-01-01 12:00:00.25' - make_dt_interval(0, 0, 0, id) as changed from range(10) "
        "union all select 99, null"
    ).createOrReplaceTempView("moving")
    seen = []

    def extract(spark, source, query, **kw):
        seen.append((query, kw))
        return spark.sql(clean_query(query))

    monkeypatch.setattr(jdbc, "extract", extract)
    query = snapshot_query(spark, TARGET, "select * from moving;", "changed")
    assert str(moment) in query
    spark.sql("select * from moving where k <> 3 union all select 8, timestamp_ntz'2024-01-01 12:00:01'").createOrReplaceTempView("later")
    got = sorted(r.k for r in spark.sql(query.replace("moving", "later")).collect())
    assert got == [0, 1, 2, 4, 5, 6, 7, 8, 9, 99]  # 3 became 8 and comes with the next increment, the old 8 is there once
    spark.sql("select * from moving where 1 = 0").createOrReplaceTempView("moving_none")
    assert snapshot_query(spark, TARGET, "select * from moving_none", "changed") == "select * from moving_none"
    TARGET.extract(spark, "select * from moving", "k", changed_at="changed")
    assert all("changed <=" in q for q, _ in seen[-2:]) and seen[-1][1]["partitioning"].upper == 99
