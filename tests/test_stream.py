from pyspark.sql import functions as F

from conftest import SF_SMALL
from landfall.operators.typed import ColumnSpec
from landfall.plans.layers import TableRule, run_pipeline
from landfall.session import scratch_dir
from landfall.sources.lake import ParquetSource
from landfall.streaming.landing import Landing, batch_done, load_landed_files, stream_note
from landfall.tables.store import TableStore


def test_available_now_runs_take_only_new_files(spark):
    root = scratch_dir(spark, "stream-test")
    store = TableStore(spark, f"{root}/wh")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    kw = dict(checkpoint_dir=f"{root}/ck")
    ev.filter("ts < '2024-01-16'").write.parquet(f"{root}/landing", mode="append")
    assert load_landed_files(spark, store, f"{root}/landing", ev.schema, "s.ev", **kw) >= 1
    first = store.read("s.ev").count()
    assert first == ev.filter("ts < '2024-01-16'").count()
    assert load_landed_files(spark, store, f"{root}/landing", ev.schema, "s.ev", **kw) == 0
    assert store.read("s.ev").count() == first
    ev.filter("ts >= '2024-01-16'").write.parquet(f"{root}/landing", mode="append")
    load_landed_files(spark, store, f"{root}/landing", ev.schema, "s.ev", **kw)
    got = store.read("s.ev")
    assert got.count() == ev.count() and got.exceptAll(ev).count() == 0


def _landed(spark, root, name, low, high):
    spark.range(low, high).write.parquet(f"{root}/{name}", mode="append")


def _load(spark, store, root, name, ck):
    schema = spark.range(1).schema
    return load_landed_files(spark, store, f"{root}/{name}", schema, "s.t", checkpoint_dir=f"{root}/{ck}")


def _ids(store):
    return sorted(r.id for r in store.read("s.t").collect())


def test_two_folders_feed_one_table(spark):
    root = scratch_dir(spark, "stream-two")
    store = TableStore(spark, f"{root}/wh")
    _landed(spark, root, "a", 0, 10)
    _landed(spark, root, "b", 10, 20)
    _load(spark, store, root, "a", "ck-a")
    _load(spark, store, root, "b", "ck-b")
    assert _ids(store) == list(range(20))


def test_lost_checkpoint_neither_doubles_nor_hides(spark):
    root = scratch_dir(spark, "stream-reset")
    store = TableStore(spark, f"{root}/wh")
    _landed(spark, root, "a", 0, 10)
    _load(spark, store, root, "a", "ck1")
    _landed(spark, root, "a", 10, 20)
    _load(spark, store, root, "a", "ck2")
    assert _ids(store) == list(range(20))
    assert _load(spark, store, root, "a", "ck3") == 0


def test_replay_after_compaction_in_a_later_month(spark, monkeypatch):
    root = scratch_dir(spark, "stream-replay")
    store = TableStore(spark, f"{root}/wh")
    _landed(spark, root, "a", 0, 10)
    _load(spark, store, root, "a", "ck1")
    later = iter(f"20991{i}01T000000000000Z-{i:012d}-x" for i in range(1, 3))
    monkeypatch.setattr("landfall.tables.store.new_load_id", lambda: next(later))
    store.compact("s.t")
    monkeypatch.undo()
    _load(spark, store, root, "a", "ck2")
    assert _ids(store) == list(range(10))


def test_compact_after_folds_batches(spark):
    root = scratch_dir(spark, "stream-compact")
    store = TableStore(spark, f"{root}/wh")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for day in ("2024-01-10", "2024-01-20", "2024-02-01"):
        ev.filter(F.col("ts") < F.lit(day).cast("timestamp_ntz")).filter(
            F.col("ts") >= F.lit("2024-01-01").cast("timestamp_ntz")).limit(0).write.parquet(f"{root}/landing", mode="append")
    ev.write.parquet(f"{root}/landing", mode="append")
    load_landed_files(spark, store, f"{root}/landing", ev.schema, "s.ev", checkpoint_dir=f"{root}/ck",
                      max_files_per_trigger=1, compact_after=1)
    assert len(store.visible_load_ids("s.ev")) == 1
    got = store.read("s.ev")
    assert got.count() == ev.count() and got.exceptAll(ev).count() == 0


def test_a_batch_reads_neither_its_own_files_nor_the_whole_log(spark, monkeypatch):
    root = scratch_dir(spark, "stream-bounded")
    store = TableStore(spark, f"{root}/wh")
    _landed(spark, root, "a", 0, 10)
    _load(spark, store, root, "a", "ck1")
    whole = []
    monkeypatch.setattr(TableStore, "ok_comments", lambda self, table: whole.append(table))
    _landed(spark, root, "a", 10, 20)
    assert _load(spark, store, root, "a", "ck1") == 1
    assert _ids(store) == list(range(20)) and whole == []


def test_a_batch_of_before_its_commit_is_not_loaded_again(spark):
    root = scratch_dir(spark, "stream-again")
    store = TableStore(spark, f"{root}/wh")
    _landed(spark, root, "a", 0, 10)
    _load(spark, store, root, "a", "ck1")
    note = store.notes("s.t")
    (query_id,) = [n.removeprefix("#stream ") for n in note]
    assert note == {stream_note(query_id): "0"}
    assert batch_done(store, "s.t", query_id, 0) and not batch_done(store, "s.t", query_id, 1)
    store.compact("s.t")
    assert batch_done(store, "s.t", query_id, 0)
    store.refresh(store.read("s.t"), "s.t")  # forgets the note; the log does not
    assert batch_done(store, "s.t", query_id, 0) and not batch_done(store, "s.t", query_id, 1)


def test_landing_folder_in_the_layered_pipeline(spark):
    root = scratch_dir(spark, "stream-layers")
    store = TableStore(spark, f"{root}/wh")
    schema = spark.range(1).schema
    zone = Landing(f"{root}/zone", schema, f"{root}/ck")
    rule = TableRule("t", (ColumnSpec("id", "bigint", nullable=False),), ("id",))
    spark.createDataFrame([], schema).write.parquet(zone.path)

    def run():
        kw = dict(sources=[ParquetSource("z")], catalogs={"z": {"t": zone}}, rules={"z": [rule]}, increments=True)
        return run_pipeline(spark, store, **kw)

    run()
    assert store.read("z_tf.t").count() == 0 and store.read("z_stg.t").schema["id"].dataType.simpleString() == "string"
    _landed(spark, root, "zone", 0, 5)
    assert [r.rows_written for r in run()["tf"]] == [5, 5]
    _landed(spark, root, "zone", 3, 8)
    run()
    assert run()["tf"] == []  # nothing landed since
    assert sorted(r.id for r in store.read("z_tf.t").collect()) == list(range(8))
