"""Catalog of extracts: one query per target table, per source.

A catalog is an ordered mapping ``table name → query text``, or
:class:`Extract` where a table is loaded by increments or read in parallel
strides of a key, or :class:`Landing` where its files land in a folder. It can be read
from a folder of ``*.sql`` files (stem = table name), always in sorted order
so that runs are repeatable. Query texts are small files read on the driver;
the data never is.
"""

from __future__ import annotations

import datetime as dt
import logging
import os
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from landfall.operators.staging import spread, stage
from landfall.sources.incremental import load_increment
from landfall.streaming.landing import Landing, stage_landing
from landfall.tables.store import LoadResult, TableStore

log = logging.getLogger(__name__)


class Source(Protocol):
    name: str

    def extract(self, spark: SparkSession, query: str, **options) -> DataFrame: ...


@dataclass(frozen=True)
class Extract:
    """One catalog entry. With ``column`` (its high-water column) and ``keys`` it is
    loaded by increments, see :func:`load_increment`; ``read_by`` is the column in
    whose strides a JDBC source reads it, ``changed_at`` its column of the last change,
    for strides of one moment (:func:`landfall.sources.jdbc.snapshot_query`)."""

    query: str
    column: str | None = None
    keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    lookback: dt.timedelta | int | float | None = None
    merge: str = "insert_new"
    count_late: bool = False
    read_by: str | None = None
    changed_at: str | None = None

    def __post_init__(self) -> None:
        if (self.column is None) != (not self.keys):
            raise ValueError("an increment needs a high-water column and keys")


def catalog_from_dir(directory: str) -> dict[str, str]:
    """Sorted ``{stem: text}`` of the ``*.sql`` files in ``directory`` (may be empty)."""
    out: dict[str, str] = {}
    for name in sorted(os.listdir(directory)):
        if name.endswith(".sql"):
            with open(os.path.join(directory, name), encoding="utf-8") as fh:
                out[name[: -len(".sql")]] = fh.read()
    if not out:
        log.warning("no .sql files in %s", directory)
    return out


def staging_table(source: str, table: str, layer: str = "stg") -> str:
    return f"{source}_{layer}.{table}"


def stage_catalog(
    spark: SparkSession,
    store: TableStore,
    source: Source,
    catalog: Mapping[str, str | Extract | Landing],
    *,
    mode: str = "refresh",
    as_text: bool = True,
    max_workers: int = 4,
) -> list[LoadResult]:
    """Extract every query and publish it as a staging table.

    Landing folders append what landed since the last run, a load for each batch.
    Each load writes its own audit row (status 1 with the observed row count,
    or status 0 with the error). Loads run as concurrent Spark jobs (at most
    ``max_workers``); a failure stops loads not yet started and is re-raised.
    """
    from landfall.plans.concurrency import run_all

    prepare = getattr(source, "register", None)
    if prepare is not None:
        prepare(spark)

    def load(table: str, entry: str | Extract | Landing) -> list[LoadResult]:
        if isinstance(entry, Landing):
            name = staging_table(source.name, table)
            return stage_landing(spark, store, entry, name, source=source.name, as_text=as_text)
        return [load_query(table, Extract(entry) if isinstance(entry, str) else entry)]

    def load_query(table: str, entry: Extract) -> LoadResult:
        options = {"registered": True} if prepare else {}
        if entry.read_by:
            options["partition_column"] = entry.read_by
        if entry.changed_at:
            options["changed_at"] = entry.changed_at
        name = staging_table(source.name, table)

        def extract() -> DataFrame:
            return source.extract(spark, entry.query, **options)

        if entry.column:
            try:
                rows = extract()
            except Exception as exc:
                store.log_failure(name, exc, source=source.name, layer="stg")
                raise
            return load_increment(
                store, rows, name, keys=entry.keys, column=entry.column, order=entry.order, lookback=entry.lookback,
                merge=entry.merge, source=source.name, as_text=as_text, count_late=entry.count_late,
            )

        def frame() -> DataFrame:
            df = spread(extract())
            return stage(df) if as_text else df

        return store.publish(frame, name, mode, source=source.name, layer="stg")

    loads = run_all([lambda t=t, e=e: load(t, e) for t, e in catalog.items()], max_workers)
    return [one for batches in loads for one in batches]
