"""Increments of a source that marks no changes: snapshots compared by checksums.

The loaded table is stored by buckets of its key, with a checksum of each
bucket beside it. A new snapshot is read once for its checksums; only rows of
buckets that differ are read again, on both sides. They replace those buckets,
and what differs row by row (inserted, changed and deleted rows) goes to
``<table>_changes``.

The changes are made from the table's own versions, and their audit row notes
the version they were made from: a run that fails between the two is caught up
by the next one, and no change is reported twice. Checksums are taken from the
published version; if they are lost, buckets are compared once more and found
equal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.operators.diff import row_differences, unequal_sums
from landfall.operators.fingerprint import bucket_of, bucket_sums
from landfall.session import scratch_dir
from landfall.tables.store import LoadResult, TableStore, partition_in

BUCKET = "_bucket"


def changes_table(table: str) -> str:
    return f"{table}_changes"


def sums_table(table: str) -> str:
    return f"{table}_sums"


def load_snapshot(
    store: TableStore,
    snapshot: DataFrame,
    table: str,
    keys: Sequence[str],
    *,
    buckets: int = 1024,
    source: str | None = None,
    layer: str = "stg",
) -> LoadResult | None:
    """Bring ``table`` to the state of ``snapshot``; None if it was so already.

    ``buckets`` is fixed by the first load. The driver holds the numbers of the
    differing buckets, never rows.
    """
    keys, logged = list(keys), dict(source=source, layer=layer)
    if BUCKET in snapshot.columns:
        raise ValueError(f"{BUCKET} is a column of the stored table")
    dealt = snapshot.withColumn(BUCKET, bucket_of(keys, buckets))
    if not store.exists(table):
        first = store.publish(dealt, table, "refresh", partition_by=[BUCKET], **logged)
        nothing = row_differences(snapshot.limit(0), snapshot.limit(0), keys)
        store.append(nothing, changes_table(table), consumed={table: first.load_id}, **logged)
        _store_sums(store, table, keys, buckets, None, logged)
        return first
    report_changes(store, table, keys, source=source, layer=layer)  # of a run that ended before it did
    known = store.read(sums_table(table)).filter(F.col("buckets") == buckets).drop("buckets")
    now = bucket_sums(snapshot, keys, buckets, {"row": sorted(c for c in snapshot.columns if c not in keys)})
    at = [r["bucket"] for r in unequal_sums(known, now).select("bucket").collect()]
    if not at:
        return None
    path = scratch_dir(store.spark, "snapshot")  # read once more, and once only, as the source may go on
    dealt.filter(F.col(BUCKET).isin(at)).write.parquet(path)
    rows = store.spark.read.schema(dealt.schema).parquet(path)
    load = store.publish(
        rows, table, "replace_partitions", partition_by=[BUCKET], replaces=[str(b) for b in at], **logged
    )
    report_changes(store, table, keys, source=source, layer=layer)
    _store_sums(store, table, keys, buckets, at, logged)
    return load


def read_snapshot(store: TableStore, table: str) -> DataFrame:
    return store.read(table).drop(BUCKET)


def report_changes(
    store: TableStore, table: str, keys: Sequence[str], *, source: str | None = None, layer: str = "stg"
) -> list[LoadResult]:
    """Append the differences that each version of ``table`` made and that were not reported yet."""
    ids, _ = store.unconsumed(table, changes_table(table))
    visible, loads = store.visible_load_ids(table), []
    for load_id in ids:
        at = visible.index(load_id)
        if at == 0:  # a full version: its difference to what it replaced is not kept
            continue
        touched = store.replaced_values(table, load_id)
        old = store.read_versions(table, visible[:at]).filter(partition_in(BUCKET, touched)).drop(BUCKET)
        new = store.read_versions(table, [load_id]).drop(BUCKET)
        loads.append(
            store.append(
                row_differences(old, new, keys), changes_table(table), source=source, layer=layer, consumed={table: load_id}
            )
        )
    return loads


def _store_sums(store: TableStore, table: str, keys: Sequence[str], buckets: int, at: list | None, logged: dict) -> None:
    rows = store.read(table)
    if at is not None:
        rows = rows.filter(partition_in(BUCKET, [str(b) for b in at]))
    columns = sorted(c for c in rows.columns if c not in (*keys, BUCKET))
    sums = bucket_sums(rows.drop(BUCKET), keys, buckets, {"row": columns}).withColumn("buckets", F.lit(buckets))
    if at is None:
        store.refresh(sums, sums_table(table), **logged)
        return
    # Buckets that lost all rows have no sums any more.
    others = store.read(sums_table(table)).filter(~F.col("bucket").isin(at))
    store.publish(others.unionByName(sums), sums_table(table), "upsert", **logged)
