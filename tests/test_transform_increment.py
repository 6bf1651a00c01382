"""Incremental transforms: exactly the new versions are read, typed and merged."""

import re

import pytest
from pyspark.sql import functions as F

from landfall.operators.typed import ColumnSpec
from landfall.plans.layers import (
    TableRule,
    accepted,
    rejects,
    run_pipeline,
    transform_increment,
    transform_table,
    transformed_table,
    type_increment,
    typed_table,
)
from landfall.sources.catalog import staging_table

RULE = TableRule(
    "t", (ColumnSpec("k", "int"), ColumnSpec("v", "int"), ColumnSpec("p", "string")), keys=("k",), order=("-v",)
)
BY_P = TableRule("t", RULE.specs, RULE.keys, RULE.order, partition="p")
STG, TYPED, TF = staging_table("s", "t"), typed_table("s", "t"), transformed_table("s", "t")


def staged(spark, rows):
    return spark.createDataFrame(rows, "k string, v string, p string")


LOADS = [
    [("1", "1", "a"), ("2", "1", "b"), ("x", "1", "a"), (None, "5", "a")],
    [("1", "2", "b"), ("3", "1", "a"), (None, "5", "a"), ("2", "1", "a")],
    [("1", "1", "c"), ("4", "q", "b"), ("3", "1", "b")],
]


def contents(df):
    return sorted(map(tuple, df.select("k", "v", "p").collect()), key=repr)


def load_ids_read(df):
    return set(re.findall(r"load_id=([0-9TZ]+-[0-9]+-[0-9a-f]+)", " ".join(df.inputFiles())))


@pytest.mark.parametrize("rule", [RULE, BY_P])
def test_increments_give_the_table_of_a_full_run(spark, store, rule):
    other = type(store)(spark, store.root + "-full")
    for rows in LOADS:
        store.append(staged(spark, rows), STG)
        other.append(staged(spark, rows), STG)
        assert transform_increment(store, "s", rule)
        transform_table(other, "s", rule)
        assert contents(store.read(TF)) == contents(other.read(TF))
        bad = lambda st: sorted(map(tuple, rejects(st, "s", rule).collect()), key=repr)
        assert bad(store) == bad(other)
    assert transform_increment(store, "s", rule) == []


def test_second_run_reads_only_new_versions(spark, store):
    first = store.append(staged(spark, LOADS[0]), STG)
    transform_increment(store, "s", RULE)
    second = store.append(staged(spark, LOADS[1]), STG)
    assert store.unconsumed(STG, TYPED) == ([second.load_id], False)
    assert load_ids_read(store.read_versions(STG, [second.load_id])) == {second.load_id}
    typed = type_increment(store, "s", RULE)
    assert typed.rows_written == len(LOADS[1])
    assert store.consumed(TYPED) == {STG: second.load_id}
    assert store.unconsumed(TYPED, TF) == ([typed.load_id], False)
    assert load_ids_read(accepted(store, "s", "t", [typed.load_id])) == {typed.load_id}
    assert first.load_id not in store.unconsumed(STG, TYPED)[0]


def test_a_run_that_failed_between_its_jobs_goes_on(spark, store):
    store.append(staged(spark, LOADS[0]), STG)
    transform_increment(store, "s", RULE)
    store.append(staged(spark, LOADS[1]), STG)
    type_increment(store, "s", RULE)  # and then the run is lost
    store.append(staged(spark, LOADS[2]), STG)
    assert [r.table for r in transform_increment(store, "s", RULE)] == [TYPED, TF]
    assert store.read(TYPED).count() == sum(map(len, LOADS))
    full = type(store)(spark, store.root + "-full")
    full.append(staged(spark, sum(LOADS, [])), STG)
    transform_table(full, "s", RULE)
    assert contents(store.read(TF)) == contents(full.read(TF))


def test_refresh_starts_anew_and_compaction_does_not(spark, store):
    store.append(staged(spark, LOADS[0]), STG)
    transform_increment(store, "s", RULE)
    store.compact(STG)
    assert store.unconsumed(STG, TYPED) == ([], False)
    new = store.append(staged(spark, LOADS[1]), STG)
    assert store.unconsumed(STG, TYPED) == ([new.load_id], False)
    transform_increment(store, "s", RULE)
    store.compact(TYPED)
    store.compact(TF)
    assert transform_increment(store, "s", RULE) == []
    store.refresh(staged(spark, LOADS[2]), STG)
    transform_increment(store, "s", RULE)
    assert contents(store.read(TF)) == [(1, 1, "c"), (3, 1, "b")]


def test_compaction_of_versions_not_yet_taken_in_is_read_whole(spark, store):
    store.append(staged(spark, LOADS[0]), STG)
    transform_increment(store, "s", RULE)
    store.append(staged(spark, LOADS[1]), STG)
    folded = store.compact(STG)
    assert store.unconsumed(STG, TYPED) == ([folded.load_id], True)


def test_partitioned_target_rewrites_only_touched_partitions(spark, store):
    store.append(staged(spark, LOADS[0]), STG)
    transform_increment(store, "s", BY_P)
    store.append(staged(spark, [("9", "1", "z")]), STG)
    load = transform_increment(store, "s", BY_P)[-1]
    assert store.replaced_values(TF, load.load_id) == ["z"] and load.rows_written == 1


def test_pipeline_by_increments(spark, store):
    store.append(staged(spark, LOADS[0]), STG)
    run = lambda: run_pipeline(spark, store, rules={"s": [RULE]}, layers=("tf",), increments=True)
    assert len(run()["tf"]) == 2 and run()["tf"] == []
    store.append(staged(spark, []), STG)
    run()
    assert store.read(TF).filter(F.col("k").isNull()).count() == 1


def test_a_fresh_merge_reads_the_target_once_and_each_half_of_the_changes_once(spark):
    from landfall.operators.upsert import merge_latest
    from landfall.session import scratch_dir

    def written(data):
        path = scratch_dir(spark, "fresh")
        spark.createDataFrame(data, "k int, ts int, v string").write.parquet(path)
        return spark.read.parquet(path)

    # Key 3 stands twice and has no change, key 4 twice with one; 5 ties with its change; null keys replace nothing.
    target = written([(1, 1, "a"), (2, 9, "a"), (3, 1, "a"), (3, 1, "b"), (4, 1, "a"), (4, 2, "a"), (5, 1, "b"), (None, 1, "a")])
    changes = written([(1, 2, "c"), (1, 3, "c"), (2, 1, "c"), (4, 0, "c"), (5, 1, "a"), (6, 1, "c"), (None, 1, "a")])
    merged = merge_latest(target, changes, ["k"], ["-ts"], fresh=True)
    got = sorted(map(tuple, merged.collect()), key=str)
    assert got == sorted(
        [(1, 3, "c"), (2, 9, "a"), (3, 1, "a"), (3, 1, "b"), (4, 2, "a"), (5, 1, "a"), (6, 1, "c"), (None, 1, "a"), (None, 1, "a")], key=str
    )
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 3


def test_published_changes_are_not_copied(spark, store, monkeypatch):
    import landfall.tables.store as tables

    changes = spark.createDataFrame([(1, 1), (2, 1)], "k int, ts int")
    store.upsert(changes, "t", ["k"], ["-ts"])
    monkeypatch.setattr(tables, "scratch_dir", lambda *a: (_ for _ in ()).throw(AssertionError("copied")))
    store.append(changes.withColumn("ts", F.col("ts") + 1), "c")
    store.upsert(store.read("c"), "t", ["k"], ["-ts"], fresh=True, published=True)
    assert sorted(map(tuple, store.read("t").collect())) == [(1, 2), (2, 2)]
