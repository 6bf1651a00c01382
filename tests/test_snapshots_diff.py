"""Snapshot loads, row differences and content checks."""

import pytest
from pyspark.sql import functions as F

from landfall.operators.diff import content_check, content_differences, row_differences
from landfall.operators.fingerprint import bucket_of, bucket_sums, row_hash
from landfall.tables import snapshots
from landfall.tables.snapshots import BUCKET, changes_table, load_snapshot, read_snapshot, sums_table

SCHEMA = "k int, a string, b double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def kinds(df):
    key = F.coalesce("new.k", "old.k")
    return sorted(map(tuple, df.select(key, "kind", "copies", F.array_join("changed", ",")).collect()), key=repr)


OLD = [(1, "x", 1.0), (2, "y", None), (3, "z", 3.0), (None, "n", 1.0), (None, "n", 1.0), (7, "p", 1.0), (7, "q", 1.0)]
NEW = [(1, "x", 1.0), (2, None, 2.0), (4, "w", 4.0), (None, "n", 1.0), (None, "m", 1.0), (7, "p", 1.0), (7, "r", 1.0), (7, "r", 1.0)]
WANT = [
    (2, "changed", 1, "a,b"), (3, "deleted", 1, ""), (4, "inserted", 1, ""),
    (7, "deleted", 1, ""), (7, "inserted", 2, ""),
    (None, "deleted", 1, ""), (None, "inserted", 1, ""),
]


def test_row_differences(spark):
    assert kinds(row_differences(frame(spark, OLD), frame(spark, NEW), ["k"])) == sorted(WANT, key=repr)
    assert row_differences(frame(spark, OLD), frame(spark, OLD[::-1]), ["k"]).count() == 0
    assert kinds(row_differences(frame(spark, []), frame(spark, OLD[:1]), ["k"])) == [(1, "inserted", 1, "")]


def test_a_null_is_no_value_and_keeps_its_place(spark):
    rows = spark.createDataFrame([("a", None), (None, "a"), ("a", ""), ("", "a"), (None, None)], "a string, b string")
    assert rows.select(row_hash("a", "b").alias("h")).distinct().count() == 5


def test_snapshot_loads_report_three_kinds(spark, store):
    unique = lambda rows: [r for r in rows if r[0] not in (None, 7)]
    load_snapshot(store, frame(spark, unique(OLD)), "s.t", ["k"], buckets=8)
    assert store.read(changes_table("s.t")).count() == 0
    load_snapshot(store, frame(spark, unique(NEW)), "s.t", ["k"], buckets=8)
    assert kinds(store.read(changes_table("s.t"))) == [w for w in WANT if w[0] in (2, 3, 4)]
    assert sorted(map(tuple, read_snapshot(store, "s.t").collect()), key=repr) == sorted(unique(NEW), key=repr)
    assert load_snapshot(store, frame(spark, unique(NEW)[::-1]), "s.t", ["k"], buckets=8) is None


def test_odd_rows_and_an_emptied_table(spark, store):
    for rows in (OLD, NEW, [], OLD):
        load_snapshot(store, frame(spark, rows), "s.t", ["k"], buckets=4)
        assert sorted(map(tuple, read_snapshot(store, "s.t").collect()), key=repr) == sorted(rows, key=repr)
        assert load_snapshot(store, frame(spark, rows), "s.t", ["k"], buckets=4) is None


def test_equal_buckets_are_not_read(spark, store):
    rows = spark.range(4000).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("a"), F.lit(1.0).alias("b"))
    load_snapshot(store, rows, "s.t", ["k"], buckets=50)
    changed = rows.withColumn("a", F.when(F.col("k") == 17, "y").otherwise(F.col("a")))
    load = load_snapshot(store, changed, "s.t", ["k"], buckets=50)
    bucket = rows.filter("k = 17").select(bucket_of(["k"], 50)).first()[0]
    assert store.replaced_values("s.t", load.load_id) == [str(bucket)]
    assert load.rows_written < 200
    old = store.read("s.t").filter(F.col(BUCKET).cast("string").isin([str(bucket)]))
    assert f"{BUCKET}" in old._jdf.queryExecution().executedPlan().toString().split("PartitionFilters:")[1].split("]")[0]


def test_a_run_lost_before_its_report_is_caught_up(spark, store, monkeypatch):
    load_snapshot(store, frame(spark, OLD[:3]), "s.t", ["k"], buckets=4)

    def lost(*args, **kw):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        calls = iter([None])
        real = snapshots.report_changes
        m.setattr(snapshots, "report_changes", lambda *a, **k: real(*a, **k) if next(calls, 1) is None else lost())
        with pytest.raises(RuntimeError):
            load_snapshot(store, frame(spark, NEW[:3]), "s.t", ["k"], buckets=4)
    assert store.read(changes_table("s.t")).count() == 0
    load_snapshot(store, frame(spark, NEW[:3]), "s.t", ["k"], buckets=4)
    assert kinds(store.read(changes_table("s.t"))) == [w for w in WANT if w[0] in (2, 3, 4)]
    assert store.exists(sums_table("s.t"))


def test_content_check_finds_one_cell_of_equal_counts(spark):
    rows = [(i, f"a{i}", float(i)) for i in range(500)]
    other = [(i, a if i != 123 else "changed", b) for i, a, b in rows]
    found = content_check(frame(spark, rows), frame(spark, other), ["k"], buckets=16).collect()
    assert [(r.column_name, r.rows_left == r.rows_right) for r in found] == [("a", True)]
    cells = content_differences(frame(spark, rows), frame(spark, other), ["k"], buckets=16).collect()
    assert [tuple(c) for c in cells] == [(123, "changed", 1, "a", "a123", "changed")]
    swapped = [(0, "a1", 0.0), (1, "a0", 1.0), *rows[2:]]
    got = content_differences(frame(spark, rows), frame(spark, swapped), ["k"], buckets=16)
    assert {(r.k, r.right_value) for r in got.collect()} == {(0, "a1"), (1, "a0")}
    assert content_differences(frame(spark, rows), frame(spark, rows[::-1]), ["k"]).count() == 0


def test_sums_merge_in_any_order(spark):
    a, b = frame(spark, OLD), frame(spark, OLD[::-1]).repartition(3)
    sums = lambda df: sorted(map(tuple, bucket_sums(df, ["k"], 4, {"row": ["a", "b"]}).collect()))
    assert sums(a) == sums(b)
