from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from landfall.operators.dedup import drop_exact, duplicate_groups, keep_first_copy, keep_latest


def test_keep_latest_one_row_per_key_and_idempotent(spark):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet")
    once = keep_latest(li, ["l_orderkey", "l_linenumber"], ["-l_shipdate"])
    assert once.count() == 45832
    twice = keep_latest(once, ["l_orderkey", "l_linenumber"], ["-l_shipdate"])
    assert once.exceptAll(twice).count() == 0


def test_keep_latest_is_deterministic_across_partitionings(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    a = keep_latest(li, ["l_orderkey", "l_linenumber"], ["-l_shipdate"])
    b = keep_latest(li.repartition(7, "l_partkey"), ["l_orderkey", "l_linenumber"], ["-l_shipdate"])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_keep_latest_picks_newest(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (1, 2, "c"), (2, 5, "d")], "k int, t int, v string")
    got = {r["k"]: r["v"] for r in keep_latest(df, ["k"], ["-t"]).collect()}
    assert got == {1: "b", 2: "d"}


def test_keep_latest_plans_partial_group_limit(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    plan = keep_latest(li, ["l_orderkey", "l_linenumber"], ["-l_shipdate"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_duplicate_groups_matches_distinct_text(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    groups = duplicate_groups(docs, "text", "doc_id")
    assert groups.count() == 927
    assert groups.agg(F.sum("copies")).first()[0] == docs.count()
    first = keep_first_copy(docs, "text", "doc_id")
    assert first.count() == 927 and first.select("text").distinct().count() == 927


def test_drop_exact(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert drop_exact(df).count() == 2
    assert drop_exact(drop_exact(df)).count() == 2


def test_keep_latest_of_a_table_of_keys_alone(spark):
    df = spark.sql("select * from values (1, 2), (1, 2), (1, 3), (null, 3), (null, 3) as t(a, b)")
    got = sorted(map(tuple, keep_latest(df, ["a", "b"], []).collect()), key=str)
    assert got == [(1, 2), (1, 3), (None, 3), (None, 3)]
