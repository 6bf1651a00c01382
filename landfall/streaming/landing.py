"""Incremental load from a landing folder with Structured Streaming.

Files dropped into a landing folder are picked up by a file stream with
``trigger(availableNow=True)``: each run processes everything new since the
last run, in bounded micro-batches, then stops, so a scheduler can start it
like a batch job. The stream's checkpoint remembers which files were taken.

Each micro-batch is published as an ``append`` version through
:class:`TableStore`. ``foreachBatch`` is at-least-once: after a crash between
the write and the checkpoint commit a batch is replayed. The audit row of a
batch notes the checkpoint's own query id with the batch id, and a batch that
is noted, or whose row is anywhere in the log, is skipped. Before a batch its
files are noted in ``<table>_files``; files that a logged batch of another
checkpoint noted are passed over, so a lost checkpoint neither doubles old files
nor hides new ones, and several folders can feed one table.

A checkpoint takes each file once by itself, so files are looked up among those of
other checkpoints only, which are gathered once a run; ``<table>_files`` is
partitioned by checkpoint. A batch then reads neither its own checkpoint's files
nor the whole log. A file written anew under its name after the stream has
forgotten it (``maxFileAge``) is new data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.operators.staging import to_text
from landfall.session import scratch_dir
from landfall.tables.store import LoadResult, TableStore


FILE = "_landed_file"


QUERY = "_stream"


@dataclass(frozen=True)
class Landing:
    """A catalog entry that is a landing folder: what landed since the last run is appended to its staging table."""

    path: str
    schema: T.StructType
    checkpoint_dir: str
    fmt: str = "parquet"
    max_files_per_trigger: int | None = None
    compact_after: int | None = None


def batch_marker(query_id: str, batch_id: int) -> str:
    return f"stream {query_id} batch {batch_id}"


def stream_note(query_id: str) -> str:
    """Name under which a table notes the last batch of a checkpoint it holds."""
    return f"#stream {query_id}"


def files_table(table: str) -> str:
    return f"{table}_files"


def batch_done(store: TableStore, table: str, query_id: str, batch_id: int) -> bool:
    """Whether the batch is in the table; the whole log is read only where the visible versions note nothing of its checkpoint."""
    noted = store.notes(table).get(stream_note(query_id))
    if noted is not None:
        return batch_id <= int(noted)
    marker = batch_marker(query_id, batch_id)
    return not store.ok_comments(table).filter(F.col("comment") == marker).isEmpty()


def files_of_others(spark: SparkSession, store: TableStore, table: str, query_id: str) -> DataFrame | None:
    """Files that logged batches of other checkpoints have noted, as a written table; None if there are none."""
    if not store.exists(files_table(table)):
        return None
    others = store.read(files_table(table)).filter(F.col(QUERY) != query_id)
    if others.isEmpty():
        return None
    path = scratch_dir(spark, "landed")
    logged = others.join(store.ok_comments(table), "comment", "left_semi")
    logged.select(FILE).distinct().write.parquet(path)
    return spark.read.parquet(path)


def load_landed_files(
    spark: SparkSession, store: TableStore, landing_dir: str, schema: T.StructType, table: str, **kw
) -> int:
    """:func:`land_files`; returns the number of batches published."""
    return len(land_files(spark, store, landing_dir, schema, table, **kw))


def land_files(
    spark: SparkSession,
    store: TableStore,
    landing_dir: str,
    schema: T.StructType,
    table: str,
    *,
    checkpoint_dir: str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    source: str | None = None,
    compact_after: int | None = None,
    as_text: bool = False,
) -> list[LoadResult]:
    """Load what has landed since the last run; returns the loads, one per batch.

    With ``compact_after``, a run that leaves more than that many visible
    versions folds them into one (reads then open one version, not one per
    batch), of the table and of its files. ``as_text`` lands all columns as text.
    """
    published: list[LoadResult] = []
    known: list[DataFrame | None] = []  # gathered by the first batch of the run

    def publish_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        query_id = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        if batch_done(store, table, query_id, batch_id):
            return
        if not known:
            known.append(files_of_others(session, store, table, query_id))
        fresh = batch if known[0] is None else batch.join(known[0], FILE, "left_anti")
        marker = batch_marker(query_id, batch_id)
        files = fresh.select(FILE, F.lit(marker).alias("comment"), F.lit(query_id).alias(QUERY)).distinct()
        kw = dict(source=source, layer="stg")
        if store.append(files, files_table(table), partition_by=[QUERY], **kw).rows_written:
            rows = fresh.drop(FILE)
            note = {stream_note(query_id): str(batch_id)}
            published.append(
                store.publish(to_text(rows) if as_text else rows, table, "append", comment=marker, consumed=note, **kw)
            )

    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    query = (
        reader.load(landing_dir)
        .withColumn(FILE, F.col("_metadata.file_path"))
        .writeStream.foreachBatch(publish_batch)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    if compact_after is not None:
        for name in (table, files_table(table)):
            if len(store.visible_load_ids(name)) > compact_after:
                store.compact(name, source=source, layer="stg")
    return published


def stage_landing(
    spark: SparkSession, store: TableStore, landing: Landing, table: str, *, source: str, as_text: bool = True
) -> list[LoadResult]:
    """What landed since the last run, in the staging ``table``; before anything has landed, an empty table."""
    loads = land_files(
        spark, store, landing.path, landing.schema, table, checkpoint_dir=landing.checkpoint_dir, fmt=landing.fmt,
        max_files_per_trigger=landing.max_files_per_trigger, compact_after=landing.compact_after, source=source,
        as_text=as_text,
    )
    if not store.exists(table):
        none = spark.createDataFrame([], landing.schema)
        loads.append(store.append(to_text(none) if as_text else none, table, source=source, layer="stg"))
    return loads
