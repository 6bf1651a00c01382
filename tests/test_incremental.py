import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from landfall.plans import fixtures as fx
from landfall.session import scratch_dir
from landfall.sources.incremental import load_increment
from landfall.tables.store import TableStore


def test_late_rows_need_the_overlap(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for lookback, complete in ((None, False), (dt.timedelta(days=3), True)):
        store = TableStore(spark, scratch_dir(spark, "inc"))
        kw = dict(keys=["event_id"], column="ts", lookback=lookback)
        load_increment(store, fx.first_event_load(ev), "t.ev", **kw)
        load_increment(store, ev, "t.ev", **kw)
        got = store.read("t.ev")
        assert (got.count() == ev.count()) is complete
        assert got.select("event_id").distinct().count() == got.count()


@settings(max_examples=3, deadline=None)
@given(st.lists(st.integers(min_value=2, max_value=29), min_size=1, max_size=3, unique=True))
def test_increments_in_any_split_equal_full_load(spark, days):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    store = TableStore(spark, scratch_dir(spark, "inc-split"))
    kw = dict(keys=["event_id"], column="ts", lookback=dt.timedelta(days=1))
    for d in sorted(days):
        load_increment(store, ev.filter(F.col("ts") < F.lit(f"2024-01-{d:02d}").cast("timestamp_ntz")), "t.ev", **kw)
    load_increment(store, ev, "t.ev", **kw)
    got = store.read("t.ev")
    assert got.count() == ev.count() and got.exceptAll(ev).count() == 0


def test_upsert_merge_mode(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    store = TableStore(spark, scratch_dir(spark, "inc-up"))
    kw = dict(keys=["o_orderkey"], column="o_orderdate", merge="upsert", lookback=dt.timedelta(days=30))
    load_increment(store, o.filter("o_orderdate < '1996-01-01'"), "t.o", **kw)
    load_increment(store, o, "t.o", **kw)
    got = store.read("t.o")
    assert got.count() == o.count() and got.exceptAll(o).count() == 0


def test_upsert_increments_by_partition(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").withColumn("o_year", F.year("o_orderdate"))
    store = TableStore(spark, scratch_dir(spark, "inc-part"))
    kw = dict(keys=["o_orderkey"], column="o_orderdate", merge="upsert", lookback=dt.timedelta(days=30),
              partition_column="o_year")
    load_increment(store, o.filter("o_orderdate < '1997-01-01'"), "t.o", **kw)
    changed = o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, F.lit("Z")).otherwise(F.col("o_orderstatus")))
    load_increment(store, changed, "t.o", **kw)
    modes = [r["mode"] for r in store.audit("t.o").orderBy("load_id").collect()]
    assert modes == ["refresh", "replace_partitions"]
    got = store.read("t.o")
    # Rows at or after the overlap bound carry the change; all rows are present once.
    assert got.count() == o.count()
    assert got.select("o_orderkey").distinct().count() == o.count()
