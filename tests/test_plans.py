from conftest import SF_SMALL
from landfall.plans import queries as q


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_extract_filter_reaches_the_scan(spark):
    p = plan(q.extract_query(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderstatus), IsNotNull(o_totalprice), EqualTo(o_orderstatus,F)" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double" in p
    assert "o_orderpriority" not in p


def test_dedup_latest_has_partial_limit(spark):
    assert "WindowGroupLimit" in plan(q.dedup_latest(spark, SF_SMALL))


def test_dedup_exact_shuffles_fingerprints_not_text(spark):
    df = q.dedup_exact(spark, SF_SMALL)
    p = plan(df)
    assert "sha2" in p and "partial_min" in p
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


def test_orphans_anti_join_reads_only_keys(spark):
    p = plan(q.orphan_rows(spark, SF_SMALL))
    assert "LeftAnti" in p
    assert "ReadSchema: struct<o_orderkey:bigint>" in p


def test_small_dimensions_broadcast(spark):
    p = plan(q.dwh_report(spark, SF_SMALL))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_typed_sides_prune_partitions_and_columns(spark):
    from landfall.plans import fixtures as fx
    from landfall.plans.layers import accepted, rejects

    store = q._typed_dirty(spark, SF_SMALL, "plan-prune")
    acc = plan(accepted(store, "dirty", "lineitem"))
    rej = plan(rejects(store, "dirty", fx.LINEITEM_RULE))
    assert "PartitionFilters: [isnotnull(_rejected" in acc and "= false)]" in acc
    assert "_rejects" not in acc.split("ReadSchema")[1]
    assert "= true)]" in rej
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,_rejects:" in rej


LAZY = ["extract_query", "stage_as_text", "cast_int", "cast_decimal", "cast_boolean", "cast_timestamp",
        "dedup_exact", "dedup_latest", "dwh_report", "orphan_rows"]


def test_no_single_partition_exchange(spark):
    # A window without partitionBy (or a global sort) would pull every row into one task.
    for key in LAZY:
        p = plan(getattr(q, key)(spark, SF_SMALL))
        assert "SinglePartition" not in p, key
    assert "SinglePartition" not in plan(q._fact(spark, SF_SMALL))
