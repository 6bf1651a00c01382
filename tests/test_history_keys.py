"""Surrogate keys, dimension histories and facts as of their time."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from landfall.operators.history import as_of, close_and_open, hot_slices, validity
from landfall.operators.upsert import merge_latest
from landfall.sources.incremental import load_increment
from landfall.operators.staging import spread
from landfall.tables.keymap import UNKNOWN, extend_key_map, number_rows, with_surrogate

KEYS = ["source", "code"]


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def customers(spark, rows):
    return spark.createDataFrame(rows, "source string, code string, x int")


def test_numbers_are_stable_and_given_once(spark, store):
    first = customers(spark, [("a", "k1", 1), ("a", "k2", 2), ("b", "k1", 3), ("a", "k1", 4), (None, "k9", 5)])
    extend_key_map(store, first, "dwh.m", KEYS)
    before = {(r.source, r.code): r.sk for r in store.read("dwh.m").collect()}
    assert sorted(before.values()) == [1, 2, 3]
    assert extend_key_map(store, first, "dwh.m", KEYS) is None
    more = first.union(customers(spark, [("c", "k0", 1), ("a", "k0", 1)]))
    extend_key_map(store, more, "dwh.m", KEYS)
    after = {(r.source, r.code): r.sk for r in store.read("dwh.m").collect()}
    assert {k: after[k] for k in before} == before
    assert sorted(after.values()) == [1, 2, 3, 4, 5]
    got = with_surrogate(first.union(customers(spark, [("z", "z", 6)])), store.read("dwh.m"), KEYS)
    assert {(r.x, r.sk) for r in got.collect()} >= {(5, UNKNOWN), (6, UNKNOWN), (1, before["a", "k1"]), (4, before["a", "k1"])}
    assert got.count() == 6


def test_empty_map(spark, store):
    extend_key_map(store, customers(spark, []), "dwh.m", KEYS)
    assert store.read("dwh.m").count() == 0
    extend_key_map(store, customers(spark, [("a", "x", 1)]), "dwh.m", KEYS)
    assert store.read("dwh.m").first().sk == 1


def test_numbering_has_no_single_task(spark):
    rows = spark.range(3000).select((F.col("id") * 7 % 3001).alias("id"))
    numbered = number_rows(rows, ["id"], 10, "n")
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    got = sorted((r.id, r.n) for r in numbered.collect())
    assert [n for _, n in got] == list(range(11, 3011))


CHANGES = "k int, t timestamp_ntz, a string, b int"


def changes(spark, rows):
    return spark.createDataFrame([(k, None if t is None else day(t), a, b) for k, t, a, b in rows], CHANGES)


ROWS = [
    (1, 0, "x", 1), (1, 5, "x", 1), (1, 9, "y", 1), (1, 9, "z", 1), (2, 3, None, None), (2, 4, None, 2),
    (None, 1, "n", 1), (3, None, "n", 1),
]


def intervals(df):
    days = lambda t: None if t is None else (t - day(0)).days
    return {(r.k, r.a, r.b, days(r.valid_from), days(r.valid_to)) for r in df.collect()}


def test_validity(spark):
    got = intervals(validity(changes(spark, ROWS), ["k"], "t", ["a", "b"]))
    assert got == {(1, "x", 1, 0, 9), (1, "z", 1, 9, None), (2, None, None, 3, 4), (2, None, 2, 4, None)}


def test_late_change_between_equal_ones_splits_an_interval(spark):
    log = changes(spark, ROWS)
    late = changes(spark, [(1, 2, "w", 1), (5, 1, "v", 1)])
    history = validity(log, ["k"], "t", ["a", "b"])
    got = close_and_open(history, log.union(late), late, ["k"], "t", ["a", "b"])
    assert intervals(got) == intervals(validity(log.union(late), ["k"], "t", ["a", "b"]))
    assert (1, "x", 1, 5, 9) in intervals(got) and (1, "w", 1, 2, 5) in intervals(got)


@pytest.mark.parametrize("rows_per_slice", [10, 1_000_000])
def test_as_of_equals_a_range_join(spark, rows_per_slice):
    log = spark.range(600).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 20).cast("int").alias("k"),
        (F.lit(day(0)).cast("timestamp_ntz") + F.make_interval(hours=(F.col("id") * 37 % 500).cast("int"))).alias("t"),
        (F.col("id") % 7).cast("string").alias("a"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 11).cast("int").alias("b"),
    )
    history = validity(log, ["k"], "t", ["a", "b"])
    facts = spark.range(2000).select(
        "id",
        F.when(F.col("id") % 50 == 1, None).when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 25).cast("int").alias("k"),
        F.when(F.col("id") % 60 != 2, F.lit(day(0)).cast("timestamp_ntz") + F.make_interval(hours=(F.col("id") * 91 % 520 - 5).cast("int"))).alias("at"),
    )
    if rows_per_slice == 10:
        cuts = hot_slices(facts.filter("k is not null"), ["k"], "at", 10).collect()
        assert max(len(r["_cuts"]) for r in cuts) > 20
    got = as_of(facts, history, ["k"], "at", ["a", "b"], rows_per_slice)
    h = history.withColumnRenamed("k", "hk")
    valid = (F.col("at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("at") < F.col("valid_to")))
    want = facts.join(h, (F.col("k") == F.col("hk")) & valid, "left").drop("hk", "valid_to")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.select(*got.columns).collect()), key=repr)
    assert got.filter("valid_from is not null").count() > 1000


def test_as_of_refuses_clashing_names(spark):
    history = validity(changes(spark, ROWS), ["k"], "t", ["a", "b"])
    with pytest.raises(ValueError):
        as_of(history.select("k", "a", F.col("valid_from").alias("at")), history, ["k"], "at", ["a", "b"])


def test_rows_without_keys_are_loaded_once(spark, store):
    rows = spark.createDataFrame([(None, day(1), "n"), (None, day(1), "n"), (1, day(2), "x")], "k int, t timestamp_ntz, a string")
    for _ in range(3):
        load_increment(store, rows, "s.t", keys=["k"], column="t", lookback=dt.timedelta(days=9), merge="upsert")
        assert store.read("s.t").count() == 3
    plan = merge_latest(rows, rows, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "Cartesian" not in plan


def test_one_partition_with_a_broadcast_join_is_spread(spark):
    narrow = spark.range(100).coalesce(1).join(F.broadcast(spark.range(5)), "id", "left")
    assert spread(narrow).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(100).groupBy("id").count()
    assert spread(wide) is wide
