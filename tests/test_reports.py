"""Reports kept by deltas equal recomputation and read only the changes."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from landfall.plans.reports import keep_report
from landfall.tables.snapshots import changes_table, load_snapshot, read_snapshot

def dimensions():
    return {"g": F.col("g"), "m": F.month("t")}


def frame(spark, rows):
    return spark.createDataFrame([(k, g, dt.datetime(2024, m, 1), x) for k, g, m, x in rows], "k int, g string, t timestamp_ntz, x double")


def load(store, spark, rows):
    load_snapshot(store, frame(spark, rows), "s.t", ["k"], buckets=4)
    return keep_report(store, "s.t", "dwh.r", dimensions(), ["x"])


def summed(rows):
    out = {}
    for _, g, m, x in rows:
        n, total = out.get((g, m), (0, Decimal(0)))
        out[g, m] = (n + 1, total + Decimal(str(x or 0)))
    return out


def report(store):
    return {(r.g, r.m): (r.row_count, r.sum_x) for r in store.read("dwh.r").collect()}


STATES = [
    [(1, "a", 1, 1.5), (2, "a", 1, 2.0), (3, "b", 2, None), (4, None, 2, 4.0), (None, "n", 3, 1.0), (None, "n", 3, 1.0)],
    [(1, "a", 1, 2.5), (2, "b", 1, 2.0), (4, None, 2, 4.0), (None, "n", 3, 1.0)],
    [],
    [(7, "z", 5, 0.25)],
]


def test_report_follows_updates_and_deletes(spark, store):
    for rows in STATES:
        load(store, spark, rows)
        assert report(store) == summed(rows)
    assert load(store, spark, STATES[-1]) is None


def test_only_the_changes_are_read(spark, store, monkeypatch):
    load(store, spark, STATES[0])
    load_snapshot(store, frame(spark, STATES[1]), "s.t", ["k"], buckets=4)
    new, whole = store.unconsumed(changes_table("s.t"), "dwh.r")
    assert len(new) == 1 and not whole
    read = []
    for name in ("read", "read_versions"):
        real = getattr(store, name)
        monkeypatch.setattr(store, name, lambda t, *a, real=real, **k: (read.append(t), real(t, *a, **k))[1])
    keep_report(store, "s.t", "dwh.r", dimensions(), ["x"])
    assert "s.t" not in read and set(read) == {"dwh.r", changes_table("s.t")}
    assert report(store) == summed(STATES[1])


def test_a_lost_run_and_a_compaction_count_once(spark, store):
    load(store, spark, STATES[0])
    load_snapshot(store, frame(spark, STATES[1]), "s.t", ["k"], buckets=4)  # and then the run is lost
    load(store, spark, STATES[3])
    assert report(store) == summed(STATES[3])
    store.compact("dwh.r")
    store.compact(changes_table("s.t"))
    assert keep_report(store, "s.t", "dwh.r", dimensions(), ["x"]) is None
    load(store, spark, STATES[0])
    assert report(store) == summed(STATES[0]) and read_snapshot(store, "s.t").count() == len(STATES[0])
