"""Rejects typed again under a changed rule: counts still add up, accepted rows are not read, the table is a full run's."""

from dataclasses import replace

import pytest

from landfall.operators.typed import ColumnSpec
from landfall.plans.layers import (
    TableRule,
    accepted,
    merge_increment,
    rejects,
    repair_rejects,
    transform_increment,
    transform_table,
    transformed_table,
    typed_table,
)
from landfall.sources.catalog import staging_table

RULE = TableRule("t", (ColumnSpec("k", "int", nullable=False), ColumnSpec("d", "timestamp"), ColumnSpec("v", "int", nullable=False)), ("k",), ("-d",))
WIDER = replace(RULE, specs=(RULE.specs[0], ColumnSpec("d", "timestamp", ("iso", "dd.MM.yyyy")), ColumnSpec("v", "int")))
ROWS = [("1", "2024-01-01", "5"), ("1", "02.01.2024", "6"), ("2", "03.01.2024", "x"), ("3", "2024-01-04", ""), ("4", "soon", None), (None, "2024-01-01", "1")]


def staged(store, spark, rows):
    store.append(spark.createDataFrame(rows, "k string, d string, v string"), staging_table("s", "t"), source="s", layer="stg")


def final(store):
    return sorted((r.k, str(r.d), r.v) for r in store.read(transformed_table("s", "t")).collect())


def test_repair_gives_the_table_of_a_full_run(spark, store):
    staged(store, spark, ROWS)
    transform_increment(store, "s", RULE)
    assert accepted(store, "s", "t").count() == 1
    made = repair_rejects(store, "s", WIDER)
    assert (made.metrics["rows"], made.metrics["rows_rejected"]) == (5, 3)  # of five rejects two are good now
    assert accepted(store, "s", "t").count() == 3
    left = {(r.k, r.column_name, r.raw_value, r.expected_type) for r in rejects(store, "s", WIDER).collect()}
    assert left == {(2, "v", "x", "int"), (4, "d", "soon", "timestamp"), (None, "k", None, "int not null")}
    assert store.read(typed_table("s", "t")).count() == len(ROWS)
    merge_increment(store, "s", WIDER)
    repaired = final(store)
    whole = type(store)(spark, store.root + "/whole")
    staged(whole, spark, ROWS)
    transform_table(whole, "s", WIDER)
    assert repaired == final(whole) == [(1, "2024-01-02 00:00:00", 6), (3, "2024-01-04 00:00:00", None)]
    assert repair_rejects(store, "s", WIDER) is None and merge_increment(store, "s", WIDER) is None


def test_rejects_of_increments_between_are_repaired_too(spark, store):
    staged(store, spark, ROWS[:3])
    transform_increment(store, "s", RULE)
    staged(store, spark, ROWS[3:])
    transform_increment(store, "s", WIDER)  # types the new rows by the new rule; the old rejects have not met it
    assert repair_rejects(store, "s", WIDER) is not None
    merge_increment(store, "s", WIDER)
    assert final(store) == [(1, "2024-01-02 00:00:00", 6), (3, "2024-01-04 00:00:00", None)]
    assert store.read(typed_table("s", "t")).count() == len(ROWS)


def test_repair_reads_no_accepted_rows(spark, store):
    staged(store, spark, ROWS)
    transform_increment(store, "s", RULE)
    repair_rejects(store, "s", WIDER)
    row = store.audit(typed_table("s", "t")).filter("mode = 'replace_partitions'").first()
    assert row.rows_read == 5 and row.rows_rejected == 3  # six rows were staged, one of them accepted


def test_no_rejects_and_changed_types(spark, store):
    staged(store, spark, ROWS[:1])
    transform_increment(store, "s", RULE)
    made = repair_rejects(store, "s", WIDER)
    assert made.metrics["rows"] == 0 and accepted(store, "s", "t").count() == 1
    wrong = replace(WIDER, specs=(ColumnSpec("k", "bigint"), *WIDER.specs[1:]))
    with pytest.raises(ValueError, match="full run"):
        repair_rejects(store, "s", wrong)
    assert accepted(store, "s", "t").count() == 1
