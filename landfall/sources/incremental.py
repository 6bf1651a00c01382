"""Incremental loads by high-water mark, with an overlap for late rows.

A plain ``column > mark`` misses rows that arrive late with an older value.
Each increment therefore re-reads from ``mark - lookback``, the mark itself and
rows without a value included (the filter reaches the Parquet scan or the JDBC
query), and merges on the key:

* ``merge="insert_new"`` – for immutable rows (events): only the target's
  overlap window is read, the new keys are *appended*; nothing is rewritten.
* ``merge="upsert"`` – for rows that change: a new full version, latest row
  per key.

The mark is the max of the column observed during the write (no extra scan),
stored in the audit row as text, and never moves backwards.

Source rows older than ``mark - lookback`` are not read. With ``count_late``
those of them whose key the target lacks are counted into the audit row
(``rows_late``): a read of the key and mark columns of both sides.

With ``as_text`` the rows land as text, as in a staging table. The filter, the
order and the mark work on the source's types; text has no statistics for them,
so an ``insert_new`` increment then scans the whole target instead of its window.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.operators.dedup import keep_latest
from landfall.operators.staging import to_text
from landfall.operators.upsert import insert_new
from landfall.tables.store import LoadResult, TableStore

#: Before the microseconds since 1970 of a mark that is an instant.
INSTANT = "micros:"


def _lower_bound(mark: Column, lookback: dt.timedelta | int | float | None) -> Column:
    if not lookback:
        return mark
    if isinstance(lookback, dt.timedelta):
        seconds = lookback.days * 86400 + lookback.seconds + lookback.microseconds / 1e6
        return mark - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))
    return mark - F.lit(lookback)


def mark_text(value: Column, col_type: str) -> Column:
    """A mark as text; a zoned timestamp as its instant, so that session zones don't matter."""
    if col_type == "timestamp":
        return F.concat(F.lit(INSTANT), F.unix_micros(value).cast("string"))
    return value.cast("string")


def mark_value(mark: str, col_type: str) -> Column:
    if mark.startswith(INSTANT):
        return F.timestamp_micros(F.lit(int(mark.removeprefix(INSTANT)))).cast(col_type)
    return F.lit(mark).cast(col_type)


def since_filter(
    df: DataFrame, column: str, mark: str, lookback: dt.timedelta | int | float | None
) -> Column:
    """``column >= mark - lookback``, or unknown: rows at the mark or without one are merged by key."""
    col_type = df.schema[column].dataType.simpleString()
    return (F.col(column) >= _lower_bound(mark_value(mark, col_type), lookback)) | F.col(column).isNull()


def load_increment(
    store: TableStore,
    source_df: DataFrame,
    table: str,
    *,
    keys: Sequence[str],
    column: str,
    lookback: dt.timedelta | int | float | None = None,
    merge: str = "insert_new",
    order: Sequence[str] = (),
    source: str | None = None,
    layer: str = "stg",
    partition_column: str | None = None,
    as_text: bool = False,
    count_late: bool = False,
) -> LoadResult:
    """First call loads everything; later calls load rows past ``mark - lookback``.

    With ``partition_column`` the table is written partitioned by it, and an
    ``upsert`` increment rewrites only the partitions its rows touch. An
    ``upsert`` into text orders the rows of the increment, and these replace
    the staged ones: staged text has no order of its own.
    """
    if merge not in ("insert_new", "upsert"):
        raise ValueError("merge must be 'insert_new' or 'upsert'")
    part_by = [partition_column] if partition_column else []
    col_type = source_df.schema[column].dataType.simpleString()
    if as_text and col_type == "timestamp":
        raise ValueError(f"{column}: text loses the zone of a timestamp; make it timestamp_ntz in the extract")
    land = to_text if as_text else lambda df: df
    value = F.col(column).cast(col_type)  # of a landed row
    kw = dict(source=source, layer=layer, cluster_by=[value])
    mark = store.high_water(table)
    if mark is None:
        observe = {"high_water": mark_text(F.max(value), col_type)}
        first = land(keep_latest(source_df, keys, order))
        return store.publish(first, table, "refresh", observe=observe, partition_by=part_by, **kw)

    # greatest() skips NULL, so an empty increment keeps the old mark.
    kw["observe"] = {"high_water": mark_text(F.greatest(F.max(value), mark_value(mark, col_type)), col_type)}
    batch = source_df.filter(since_filter(source_df, column, mark, lookback))

    def current() -> DataFrame:  # in the types of the source
        df, types = store.read(table), {f.name: f.dataType for f in source_df.schema.fields}
        return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])

    if count_late:
        older = lambda df: df.filter(~since_filter(df, column, mark, lookback)).select(*keys)
        kw["counts"] = {"rows_late": older(source_df).join(older(current()), list(keys), "left_anti").count()}
    if merge == "insert_new":
        window = current()
        window = window.filter(since_filter(window, column, mark, lookback))
        return store.publish(land(insert_new(window, batch, keys, order)), table, "append", **kw)
    changes = land(keep_latest(batch, keys, order)) if as_text else batch
    return store.upsert(changes, table, keys, () if as_text else order, partition_column=partition_column, **kw)
