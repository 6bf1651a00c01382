"""Latest per key, complete increments, and versions that no clock can hide."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from landfall.functions.casts import parse_as, parse_timestamp
from landfall.operators.dedup import keep_latest
from landfall.operators.staging import spread
from landfall.plans.layers import run_pipeline
from landfall.session import shared_dir
from landfall.sources.catalog import Extract, stage_catalog
from landfall.sources.incremental import load_increment
from landfall.sources.jdbc import wrap_query
from landfall.sources.lake import ParquetSource


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def frame(spark, data, schema="k int, ts int, v string"):
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize("by", [None, "v"])
def test_older_change_loses_and_first_load_is_deduplicated(spark, store, by):
    store.upsert(frame(spark, [(1, 10, "a"), (1, 9, "a"), (2, 1, "a")]), "t", ["k"], ["-ts"], partition_column=by)
    store.upsert(frame(spark, [(1, 5, "a"), (2, 7, "a"), (3, 1, "b")]), "t", ["k"], ["-ts"], partition_column=by)
    assert rows(store.read("t"), "k", "ts") == [(1, 10), (2, 7), (3, 1)]


def test_key_that_moves_to_another_partition(spark, store):
    store.upsert(frame(spark, [(i, 0, "a") for i in range(4)]), "t", ["k"], partition_column="v")
    store.upsert(frame(spark, [(2, 1, "b")]), "t", ["k"], partition_column="v")
    assert rows(store.read("t"), "k", "v") == [(0, "a"), (1, "a"), (2, "b"), (3, "a")]


@pytest.mark.parametrize("kind,values", [("boolean", [True, False, None]), ("timestamp_ntz", [dt.datetime(2024, 1, 1, 0, 0, 0, 500000), dt.datetime(2024, 1, 1)])])
def test_partition_values_of_any_type(spark, store, kind, values):
    data = [(i, i, values[i % len(values)]) for i in range(10)]
    schema = f"k int, ts int, v {kind}"
    store.upsert(frame(spark, data, schema), "t", ["k"], partition_column="v")
    store.upsert(frame(spark, [(k, 100, v) for k, _, v in data[:4]], schema), "t", ["k"], partition_column="v")
    assert store.read("t").count() == 10
    assert store.read("t").filter("ts = 100").count() == 4


def test_null_keys_stay_apart(spark):
    df = frame(spark, [(None, 1, "a"), (None, 1, "a"), (1, 1, "a"), (1, 2, "b")])
    assert keep_latest(df, ["k"], ["-ts"]).count() == 3


def test_ties_and_null_marks_are_not_lost(spark, store):
    first = frame(spark, [(1, 1, "a"), (2, 2, "a")])
    every = frame(spark, [(1, 1, "a"), (2, 2, "a"), (3, 2, "a"), (4, None, "a"), (5, 3, "a")])
    kw = dict(keys=["k"], column="ts")
    load_increment(store, first, "t", **kw)
    for _ in range(2):
        load_increment(store, every, "t", **kw)
    assert [k for (k,) in rows(store.read("t"), "k")] == [1, 2, 3, 4, 5]


def test_mark_of_an_instant_survives_a_zone_change(spark, store):
    make = lambda n: spark.range(n).select(
        F.col("id").alias("k"), F.timestamp_seconds(F.col("id") * 3600).alias("ts")
    )
    kw = dict(keys=["k"], column="ts")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        load_increment(store, make(12), "t", **kw)
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        load_increment(store, make(24), "t", **kw)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert store.read("t").count() == 24


def test_plain_refresh_resets_the_mark_and_compaction_keeps_it(spark, store):
    kw = dict(keys=["k"], column="ts")
    every = frame(spark, [(i, i, "a") for i in range(10)])
    load_increment(store, every, "t", **kw)
    mark = store.high_water("t")
    store.compact("t")
    assert store.high_water("t") == mark
    store.refresh(every.limit(3), "t")
    load_increment(store, every, "t", **kw)
    assert store.read("t").count() == 10


def test_version_of_a_later_month_is_read(spark, store, monkeypatch):
    store.refresh(spark.range(5), "t")
    monkeypatch.setattr("landfall.tables.store.new_load_id", lambda: "20991201T000000000000Z-000000000000-x")
    store.refresh(spark.range(9), "t")
    assert store.read("t").count() == 9


def test_compaction_keeps_two_partition_columns(spark, store):
    store.refresh(frame(spark, [(1, 1, "a"), (2, 2, "b")]), "t", partition_by=["ts", "v"])
    store.compact("t")
    assert store.partition_columns("t") == ["ts", "v"]


def test_view_names_that_collide_fail(spark, store):
    store.refresh(spark.range(1), "a.b_c")
    store.refresh(spark.range(1), "a_b.c")
    with pytest.raises(ValueError):
        store.register_views()


def test_casts_of_offsets_bare_years_and_short_decimals(spark):
    texts = ["2024-01-01T00:00:00+05:00", "2024", "2024-1", "2024-01-01", "2024-01-01 10:11:12.5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_timestamp("t")).collect()]
    assert got == [None, None, None, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 10, 11, 12, 500000)]
    assert spark.range(1).select(parse_as(F.lit("12.5"), "decimal(5)")).first()[0] == 13


def test_spread_runs_no_shuffle_to_look(spark):
    grouped = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    ran = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("spread-test"))
    spark.sparkContext.setJobGroup("spread-test", "")
    try:
        assert spread(grouped) is grouped
        assert ran() == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_reads_open_one_scan_however_many_upserts(spark, store):
    store.upsert(frame(spark, [(i, 0, "abc"[i % 3]) for i in range(9)]), "t", ["k"], partition_column="v")
    for n in range(1, 7):
        store.upsert(frame(spark, [(n, n, "abc"[n % 3])]), "t", ["k"], partition_column="v")
    got = store.read("t")
    assert rows(got, "k", "ts") == [(i, i if 0 < i < 7 else 0) for i in range(9)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters" in plan
    version = F.regexp_extract("_metadata.file_path", "load_id=([^/]*)", 1)
    opened = {r[0] for r in got.select(version).distinct().collect()}
    ids = store.visible_load_ids("t")
    assert opened == set(ids[-3:])  # three partitions, the last three loads replaced them
    listed = {f.split("load_id=")[1].split("/")[0] for f in got.inputFiles()}
    assert listed <= {ids[0], *ids[-3:]}  # the full version's files are pruned by the filter


def test_append_after_a_partition_upsert(spark, store):
    store.upsert(frame(spark, [(1, 0, "a"), (2, 0, "b"), (3, 0, None)]), "t", ["k"], partition_column="v")
    store.upsert(frame(spark, [(3, 1, None)]), "t", ["k"], partition_column="v")
    store.append(frame(spark, [(4, 0, None), (5, 0, "b")]), "t")
    store.upsert(frame(spark, [(5, 1, "b")]), "t", ["k"], partition_column="v")
    assert rows(store.read("t"), "k", "ts") == [(1, 0), (2, 0), (3, 1), (4, 0), (5, 1)]
    store.compact("t")
    assert rows(store.read("t"), "k", "ts") == [(1, 0), (2, 0), (3, 1), (4, 0), (5, 1)]


@pytest.mark.parametrize("merge", ["insert_new", "upsert"])
def test_catalog_entry_loaded_by_increments_as_text(spark, store, merge):
    class Views:
        name = "s"

        def extract(self, spark, query):
            return spark.sql(query)

    entry = Extract("select * from growing", column="ts", keys=("k",), order=("-ts",), lookback=2, merge=merge,
                    count_late=True)
    run = lambda data: (
        frame(spark, data).createOrReplaceTempView("growing"),
        run_pipeline(spark, store, sources=[Views()], catalogs={"s": {"t": entry}}),
    )
    run([(1, 8, "a"), (2, 9, "a"), (2, 10, "b")])  # as text, 9 would be later than 10
    assert rows(store.read("s_stg.t"), "k", "ts", "v") == [("1", "8", "a"), ("2", "10", "b")]
    run([(1, 8, "z"), (2, 10, "b"), (3, 11, "c"), (4, 3, "late"), (5, None, "n")])
    first = "z" if merge == "upsert" else "a"
    got = [tuple(r) for r in store.read("s_stg.t").orderBy("k").collect()]
    assert got == [("1", "8", first), ("2", "10", "b"), ("3", "11", "c"), ("5", None, "n")]
    assert [r["rows_late"] for r in store.audit("s_stg.t").orderBy("load_id").collect()] == [None, 1]
    assert store.high_water("s_stg.t") == "11"


def test_failing_extract_of_an_increment_is_logged(spark, store):
    src = ParquetSource("s", {})
    entry = Extract("select * from no_such_table", column="ts", keys=("k",))
    with pytest.raises(Exception):
        stage_catalog(spark, store, src, {"t": entry})
    assert [r["status"] for r in store.audit("s_stg.t").collect()] == [0]
    with pytest.raises(ValueError):
        Extract("select 1", column="ts")


def test_text_increment_refuses_a_zoned_mark(spark, store):
    df = spark.range(3).select("id", F.timestamp_seconds("id").alias("ts"))
    with pytest.raises(ValueError):
        load_increment(store, df, "t", keys=["id"], column="ts", as_text=True)


def test_trailing_comment_ends_before_the_bracket():
    assert wrap_query("select * from t -- note") == "(select * from t -- note\n) q"


def test_no_shared_folder_off_local_mode():
    class Context:
        master = "yarn"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        conf = {}
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        shared_dir(Session())
