from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from landfall.operators.staging import stage, to_text
from landfall.operators.typed import ColumnSpec, REJECTED, accepted_rows, apply_types, reject_entries, split_typed
from landfall.plans import fixtures as fx


def test_blank_is_missing_not_rejected(spark):
    df = spark.createDataFrame([("1", ""), ("2", "x"), ("", "3")], "k string, v string")
    typed = apply_types(df, [ColumnSpec("k", "int", nullable=False), ColumnSpec("v", "int")])
    rows = {r["k"]: r for r in typed.collect()}
    assert rows[1][REJECTED] is False and rows[1]["v"] is None
    assert rows[2][REJECTED] is True
    assert rows[None][REJECTED] is True  # blank key is not allowed
    entries = reject_entries(typed, ["k"]).collect()
    assert sorted((e["column_name"], e["raw_value"], e["expected_type"]) for e in entries) == [
        ("k", "", "int not null"), ("v", "x", "int")]


def test_dirty_counts_match_fixture_rules(spark):
    # FIXTURES.md: at sf0.01, 57,694 accepted and 2,306 rejected rows.
    dirty = fx.dirty_lineitem(spark.read.parquet(f"{SF_MID}/lineitem.parquet"))
    typed = apply_types(dirty, fx.LINEITEM_RULE.specs)
    counts = typed.groupBy(REJECTED).count().collect()
    by = {r[REJECTED]: r["count"] for r in counts}
    assert by[False] == 57694 and by[True] == 2306
    per_column = {r["column_name"]: r["count"] for r in reject_entries(typed, ["l_orderkey"]).groupBy("column_name").count().collect()}
    assert per_column == {"l_quantity": 586, "l_extendedprice": 588, "l_partkey": 595, "l_shipdate": 573}


def test_round_trip_stage_then_type_returns_input(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    typed = apply_types(to_text(orders), fx.ORDERS_RULE.specs)
    back = accepted_rows(typed).select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("double"), "o_orderdate", "o_orderpriority")
    assert back.exceptAll(orders).count() == 0 and orders.exceptAll(back).count() == 0


def test_split_typed_sides_partition_the_input(spark):
    dirty = fx.dirty_lineitem(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet"))
    acc, rej = split_typed(dirty, fx.LINEITEM_RULE.specs, ["l_orderkey", "l_linenumber"])
    rejected_rows = rej.select("l_orderkey", "l_linenumber").distinct().count()
    assert acc.count() + rejected_rows <= dirty.count()
    assert acc.count() > 0 and rej.count() > 0


def test_stage_tags_source(spark):
    df = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    staged = stage(df, "s1")
    assert staged.columns[0] == "source"
    assert all(f.dataType.simpleString() == "string" for f in staged.schema.fields)
