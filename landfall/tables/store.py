"""Publishing tables so readers never see a half-finished load.

A table is a folder of versions, ``<root>/<table>/load_id=<id>/``. A load
writes a *new* version folder and, only once Spark has committed it, appends
an audit row with status 1. Readers take the versions the audit log makes
visible: the newest ``refresh``/``upsert`` version plus the ``append``
versions after it. A failed load appends a status 0 row and changes nothing
for readers; the previous version stays readable. Row counts come from an
``Observation`` on the write itself, so the data is scanned once.

A table written with one partition column can also take ``replace_partitions``
versions: they hold only the partitions a change set touched, and hide those
partitions in every earlier visible version. Rows of partitions that they add to
(``adds``) stand beside those of earlier versions. An upsert then rewrites only the
touched partitions instead of the whole table.

A load that is made from the versions of another table can note the newest of
them it has taken in (``consumed``) in its own audit row. The version and the
note become visible together, so each version is taken in exactly once:
``unconsumed`` gives those that came since.

``load_id`` sorts in time order; one job at a time may load a given table.
"""

from __future__ import annotations

import itertools
import json
import threading
import traceback
import uuid
from functools import reduce
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from landfall.operators.dedup import keep_latest
from landfall.operators.upsert import merge_latest
from landfall.session import scratch_dir
from landfall.tables.audit import STATUS_FAILED, STATUS_OK, append_audit, audit_row, fold_audit, logged_months, month_of, read_audit

# The load log's comment for a successful load, and the prefix
# of a failed load's comment (followed by the error and its traceback).
OK_COMMENT = "Table operation successful."
ERROR_PREFIX = "Error: "

MODES = ("refresh", "append", "upsert", "replace_partitions")
FULL_MODES = ("refresh", "upsert")

_counter = itertools.count()
_id_lock = threading.Lock()
_last_stamp = ""


def new_load_id() -> str:
    """Time-ordered and strictly increasing within the process, even if the
    wall clock steps back (the stamp never goes below the last one issued)."""
    global _last_stamp
    with _id_lock:
        stamp = max(datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%fZ"), _last_stamp)
        _last_stamp = stamp
        return f"{stamp}-{next(_counter):012d}-{uuid.uuid4().hex[:8]}"


class NoVisibleVersion(LookupError):
    pass


@dataclass
class LoadResult:
    table: str
    load_id: str
    status: int
    rows_written: int | None
    metrics: dict = field(default_factory=dict)
    error: str | None = None


class TableStore:
    """Versioned Parquet tables under one root, with the audit log at ``<root>/_audit``."""

    def __init__(self, spark: SparkSession, root: str, database: str = "warehouse"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database
        self.audit_path = f"{self.root}/_audit"

    # -- paths and log -------------------------------------------------
    def table_path(self, table: str) -> str:
        return f"{self.root}/" + table.replace(".", "/")

    def audit(self, table: str | None = None) -> DataFrame:
        return read_audit(self.spark, self.audit_path, table)

    def fold_log(self, table: str) -> list[str]:
        """Fold the past months of ``table``'s log, so that a read of it opens one file a month."""
        return fold_audit(self.spark, self.audit_path, table, month_of(new_load_id()))

    # -- writing -------------------------------------------------------
    def publish(
        self,
        data: DataFrame | Callable[[], DataFrame],
        table: str,
        mode: str = "refresh",
        *,
        source: str | None = None,
        layer: str | None = None,
        partition_by: Sequence[str] = (),
        gather: bool = True,
        cluster_by: Sequence[str] = (),
        observe: Mapping[str, Column] | None = None,
        counts: Mapping[str, int | None | Callable[[dict], int]] | None = None,
        high_water: str | None = None,
        consumed: Mapping[str, str] | None = None,
        replaces: Sequence | None = None,
        adds: Sequence = (),
        comment: str = OK_COMMENT,
        raise_on_error: bool = True,
    ) -> LoadResult:
        """Write ``data`` as a new version of ``table`` and log the load.

        ``observe`` adds aggregate metrics computed during the write (e.g.
        rejected rows, the max of a high-water column); metrics named like
        audit columns (``rows_read``, ``rows_rejected``, ``rows_duplicate``,
        ``rows_late``, ``high_water``) are stored there. ``counts`` gives such values known
        from earlier loads, or as functions of this load's metrics.
        ``consumed`` maps tables to
        the newest of their load ids that went into ``data``.
        ``gather`` shuffles rows of a partition value together, for few files;
        without it each task writes a file for each value it meets, which is
        better where the values are few. ``cluster_by`` sorts rows within each write task so Parquet row-group
        statistics let later filters on those columns skip data. ``data`` may
        be a callable so that SQL analysis errors are logged as failed loads.
        """
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        start = datetime.now(timezone.utc)
        load_id = new_load_id()
        path = f"{self.table_path(table)}/load_id={load_id}"
        logged = dict(table_name=table, source=source, load_id=load_id, layer=layer, mode=mode)
        partitions = None
        try:
            vis = self._visible(table) if mode in ("append", "replace_partitions") else []
            partition_by, partitions = self._layout(table, mode, partition_by, replaces, vis, adds)
            df = data() if callable(data) else data
            if mode == "append" and vis:
                self._check_append_schema(table, df, vis)
            if partition_by and gather:
                # Few files per partition value; hot values are split by size.
                df = df.hint("rebalance", *[F.col(c) for c in partition_by])
            obs = Observation(f"load_{load_id}")
            exprs = [F.count(F.lit(1)).alias("rows")]
            exprs += [c.alias(name) for name, c in (observe or {}).items()]
            observed = df.observe(obs, *exprs)
            if cluster_by:
                # Local sort, no shuffle: tight row-group min/max for later range filters.
                observed = observed.sortWithinPartitions(*cluster_by)
            writer = observed.write.mode("errorifexists")
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.parquet(path)
            metrics = dict(obs.get)
        except Exception as exc:
            self._log_failed(start, exc, **logged)
            if raise_on_error:
                raise
            return LoadResult(table, load_id, STATUS_FAILED, None, {}, str(exc))
        merged = {**metrics, **{k: (v(metrics) if callable(v) else v) for k, v in (counts or {}).items()}}
        hw = high_water if high_water is not None else merged.get("high_water")
        self._log(
            start,
            status=STATUS_OK,
            comment=comment,
            rows_read=_int(merged.get("rows_read", metrics["rows"])),
            rows_written=int(metrics["rows"]),
            rows_rejected=_int(merged.get("rows_rejected")),
            rows_duplicate=_int(merged.get("rows_duplicate")),
            rows_late=_int(merged.get("rows_late")),
            high_water=None if hw is None else str(hw),
            consumed=json.dumps(dict(consumed)) if consumed else None,
            partitions=partitions,
            schema_json=df.schema.json(),
            **logged,
        )
        return LoadResult(table, load_id, STATUS_OK, int(metrics["rows"]), merged)

    def _check_append_schema(self, table: str, df: DataFrame, vis: list) -> None:
        """An append must match the visible version column for column, or
        readers would get a mix of shapes; fail before anything is written."""
        current = self._read_visible(table, vis).schema
        got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
        want = [(f.name, f.dataType.simpleString()) for f in current.fields]
        if sorted(got) != sorted(want):
            raise ValueError(f"append to {table}: columns {got} do not match the table's {want}")

    def _layout(
        self, table: str, mode: str, partition_by: Sequence[str], replaces, vis: list, adds: Sequence = ()
    ) -> tuple[list[str], str | None]:
        """Partition columns for this version and the audit's ``partitions`` text."""
        partition_by = list(partition_by)
        if mode in ("append", "replace_partitions") and vis:
            # Every version of a table must share its partition layout.
            existing = list((vis[0][2] or {}).get("columns", []))
            if partition_by and partition_by != existing:
                raise ValueError(f"{table} is partitioned by {existing}, not {partition_by}")
            partition_by = existing
        if mode == "replace_partitions":
            if len(partition_by) != 1 or replaces is None:
                raise ValueError("replace_partitions needs one partition column and the replaced values")
            info = {"columns": partition_by, "column": partition_by[0], "values": list(replaces), "adds": list(adds)}
            return partition_by, json.dumps(info, default=str)
        if partition_by:
            info = {"columns": partition_by}
            if len(partition_by) == 1:
                info["column"] = partition_by[0]
            return partition_by, json.dumps(info)
        return partition_by, None

    def log_write(
        self,
        df: DataFrame,
        table: str,
        write: Callable[[DataFrame], None],
        mode: str,
        *,
        source: str | None = None,
        layer: str | None = None,
    ) -> LoadResult:
        """Let ``write`` send ``df`` to a target outside the store; count its rows on the way and log the load.

        ``mode`` is none of the store's own, so readers and views pass the row over.
        """
        if mode in MODES:
            raise ValueError(f"{mode!r} is a mode of the store's own tables")
        start = datetime.now(timezone.utc)
        load_id = new_load_id()
        logged = dict(table_name=table, source=source, load_id=load_id, layer=layer, mode=mode)
        try:
            obs = Observation(f"load_{load_id}")
            write(df.observe(obs, F.count(F.lit(1)).alias("rows")))
            rows = int(obs.get["rows"])
        except Exception as exc:
            self._log_failed(start, exc, **logged)
            raise
        self._log(
            start, status=STATUS_OK, comment=OK_COMMENT, rows_read=rows, rows_written=rows,
            schema_json=df.schema.json(), **logged,
        )
        return LoadResult(table, load_id, STATUS_OK, rows, {"rows": rows})

    def log_failure(self, table: str, exc: BaseException, mode: str = "append", *, source: str | None = None, layer: str | None = None) -> None:
        """Log a load of ``table`` that failed before it had anything to publish."""
        self._log_failed(
            datetime.now(timezone.utc), exc, table_name=table, source=source, load_id=new_load_id(), layer=layer, mode=mode
        )

    def _log_failed(self, start: datetime, exc: BaseException, **values) -> None:
        trace = "".join(traceback.format_exception(exc))
        self._log(start, status=STATUS_FAILED, comment=f"{ERROR_PREFIX}{exc}\n{trace}", **values)

    def _log(self, start: datetime, **values) -> None:
        end = datetime.now(timezone.utc)
        row = audit_row(database_name=self.database, start_time=start, end_time=end, **values)
        append_audit(self.spark, self.audit_path, row)

    def refresh(self, df: DataFrame, table: str, **kw) -> LoadResult:
        return self.publish(df, table, "refresh", **kw)

    def append(self, df: DataFrame, table: str, **kw) -> LoadResult:
        return self.publish(df, table, "append", **kw)

    # -- reading -------------------------------------------------------
    def _recent_ok_rows(self, table: str) -> list:
        """Successful audit rows of ``table`` back to its newest full version.

        Goes through the months that have log folders, newest first, and stops
        at the first that holds a full (refresh/upsert) version. Load ids sort
        in time order, so nothing older can be visible; the reader's clock
        plays no part.
        """
        cols = ["load_id", "mode", "partitions", "schema_json", "high_water", "comment", "consumed"]
        rows: list = []
        for month in logged_months(self.spark, self.audit_path, table):
            df = read_audit(self.spark, self.audit_path, table, month)
            own = (F.col("status") == STATUS_OK) & F.col("mode").isin(*MODES)
            rows += df.filter(own).select(*cols).collect()
            if any(r["mode"] in FULL_MODES for r in rows):
                break
        return rows

    def _visible(self, table: str) -> list[tuple[str, str, dict | None, str | None]]:
        """(load_id, mode, partitions, schema) of the newest full version and every later one."""
        rows = self._recent_ok_rows(table)
        loads = {r["load_id"]: (r["mode"], json.loads(r["partitions"]) if r["partitions"] else None,
                                r["schema_json"]) for r in rows}
        full = [i for i, (m, _, _) in loads.items() if m in FULL_MODES]
        start = max(full) if full else ""
        return [(i, *loads[i]) for i in sorted(loads) if i >= start]

    def visible_load_ids(self, table: str) -> list[str]:
        """Newest full version plus later ones (a list bounded by loads, not rows)."""
        return [i for i, *_ in self._visible(table)]

    def exists(self, table: str) -> bool:
        return bool(self.visible_load_ids(table))

    def tables(self) -> list[str]:
        """Names of the tables with at least one successful load (one row per table)."""
        ok = self.audit().filter((F.col("status") == STATUS_OK) & F.col("mode").isin(*MODES))
        return sorted(r[0] for r in ok.select("table_name").distinct().collect())

    def register_views(self, view_name: Callable[[str], str] = lambda t: t.replace(".", "_")) -> list[str]:
        """Every published table as a temporary view (``erp_a_stg.orders`` → ``erp_a_stg_orders``)."""
        names: list[str] = []
        for table in self.tables():
            if view_name(table) in names:
                raise ValueError(f"two published tables share the view name {view_name(table)!r}")
            self.read(table).createOrReplaceTempView(view_name(table))
            names.append(view_name(table))
        return names

    def partition_columns(self, table: str) -> list[str] | None:
        """Partition columns of the visible table ([] if unpartitioned, None if no version)."""
        vis = self._visible(table)
        if not vis:
            return None
        return list((vis[0][2] or {}).get("columns", []))

    def partition_column(self, table: str) -> str | None:
        """The single partition column of the visible table, if it has exactly one."""
        cols = self.partition_columns(table) or []
        return cols[0] if len(cols) == 1 else None

    def read(self, table: str, with_load_id: bool = False) -> DataFrame:
        vis = self._visible(table)
        if not vis:
            raise NoVisibleVersion(table)
        return self._read_visible(table, vis, with_load_id)

    def _read_visible(self, table: str, vis: list, with_load_id: bool = False) -> DataFrame:
        base = self.table_path(table)
        reader = self.spark.read.option("basePath", base)
        schema = vis[-1][3]
        if schema:
            # The written schema, so partition values keep their types (no
            # inference turning text like "2024-01-01" into a date) and no
            # footer has to be read to plan the scan.
            fields = StructType.fromJson(json.loads(schema)).fields
            reader = reader.schema(StructType(fields + [StructField("load_id", StringType())]))
        # Newest first: a partition is read from the newest version that replaced
        # it, so one scan opens only versions that still hold something.
        column = next((info["column"] for _, mode, info, _ in vis if mode == "replace_partitions"), None)
        live, conditions, replaced = [], [], set()
        for load_id, mode, info, _ in reversed(vis):
            here = F.col("load_id") == load_id
            if mode == "replace_partitions":
                own = [v for v in info["values"] if v not in replaced]
                held = own + [v for v in info.get("adds", []) if v not in replaced]
                replaced.update(own)
                if not held:
                    continue
                here &= partition_in(column, held)
            elif replaced:
                here &= ~partition_in(column, list(replaced))
            live.append(load_id)
            conditions.append(here)
        df = reader.parquet(*[f"{base}/load_id={i}" for i in reversed(live)])
        if column:
            df = df.filter(reduce(lambda a, b: a | b, conditions))
        return df if with_load_id else df.drop("load_id")

    def high_water(self, table: str) -> str | None:
        """High-water mark of the visible table: the newest one logged since its newest full version."""
        rows = self._recent_ok_rows(table)
        start = max((r["load_id"] for r in rows if r["mode"] in FULL_MODES), default="")
        marked = [r for r in rows if r["high_water"] is not None and r["load_id"] >= start]
        return max(marked, key=lambda r: r["load_id"])["high_water"] if marked else None

    # -- versions as a queue -------------------------------------------
    def consumed(self, table: str) -> dict[str, str]:
        """Of each table that loads of ``table`` were made from, the newest version taken in."""
        return {name: value for name, value in self.notes(table).items() if not name.startswith("#")}

    def notes(self, table: str) -> dict[str, str]:
        """All that loads of ``table`` noted: versions taken in, and notes of their own (``#name``)."""
        rows = self._recent_ok_rows(table)
        start = max((r["load_id"] for r in rows if r["mode"] in FULL_MODES), default="")
        out: dict[str, str] = {}
        for r in sorted(rows, key=lambda r: r["load_id"]):
            if r["load_id"] >= start and r["consumed"]:
                out.update(json.loads(r["consumed"]))
        return out

    def unconsumed(self, upstream: str, consumer: str) -> tuple[list[str], bool]:
        """Visible versions of ``upstream`` that no load of ``consumer`` has taken in, and whether they are all of it.

        They are all of it at the first time and when a newer full version
        replaced what was taken in; a compaction of versions already taken in
        is not new.
        """
        vis = self._visible(upstream)
        if not vis:
            raise NoVisibleVersion(upstream)
        ids = [i for i, *_ in vis]
        mark = self.consumed(consumer).get(upstream) if self.exists(consumer) else None
        if mark is None:
            return ids, True
        new = [i for i in ids if i > mark]
        if ids[0] <= mark:
            return new, False
        folded = next((r["consumed"] for r in self._recent_ok_rows(upstream) if r["load_id"] == ids[0]), None)
        if folded and json.loads(folded).get(upstream, "~") <= mark:
            return new[1:], False
        return ids, True

    def read_versions(self, table: str, load_ids: Sequence[str]) -> DataFrame:
        """Rows of some of the visible versions; only their files are opened."""
        chosen = set(load_ids)
        vis = [v for v in self._visible(table) if v[0] in chosen]
        if len(vis) != len(chosen):
            raise NoVisibleVersion(f"{table}: {sorted(chosen - {v[0] for v in vis})}")
        return self._read_visible(table, vis)

    def replaced_values(self, table: str, load_id: str) -> list:
        """Partition values (as text) that a ``replace_partitions`` version replaced."""
        info = next((info for i, _, info, _ in self._visible(table) if i == load_id), None)
        return list((info or {}).get("values", []))

    def ok_comments(self, table: str) -> DataFrame:
        """Comments of all successful loads of ``table``, however old."""
        return self.audit(table).filter(F.col("status") == STATUS_OK).select("comment")

    def compact(self, table: str, **kw) -> LoadResult:
        """Fold the visible versions (a refresh plus many appends) into one refresh; layout and marks stay."""
        current = self.read(table)
        kw.setdefault("consumed", {**self.notes(table), table: self.visible_load_ids(table)[-1]})
        kw.setdefault("partition_by", self.partition_columns(table) or [])
        kw.setdefault("high_water", self.high_water(table))
        return self.publish(current, table, "refresh", comment="compaction", **kw)

    def upsert(
        self,
        changes: DataFrame,
        table: str,
        keys: Sequence[str],
        order: Sequence[str] = (),
        partition_column: str | None = None,
        fresh: bool = False,
        published: bool = False,
        **kw,
    ) -> LoadResult:
        """Merge ``changes`` into the visible table by key; the latest row per key under ``order`` stays.

        ``fresh`` says that no row of ``changes`` was merged before
        (see :func:`merge_latest`).

        The change set is written once and merged from there, so a source that
        changes meanwhile can't be read in two states; ``published`` says that
        they are read from published versions, which never change, and need no
        copy. Without
        ``partition_column`` the whole table is rewritten as a new version.
        With it (and a table published with that one partition column) only
        the partitions the change set touches, or that hold one of its keys
        now, are read, merged and written, as a ``replace_partitions``
        version. The touched values are collected on the driver as text: one
        per partition, never per row.
        """
        part_by = [partition_column] if partition_column else []
        if not self.exists(table):
            return self.publish(
                lambda: keep_latest(changes, keys, order), table, "refresh", partition_by=part_by, **kw
            )
        if not published:
            path = scratch_dir(self.spark, "changes")
            changes.write.parquet(path)
            changes = self.spark.read.schema(changes.schema).parquet(path)
        if "high_water" not in (kw.get("observe") or {}):
            kw.setdefault("high_water", self.high_water(table))
        kw["consumed"] = {**self.notes(table), **(kw.get("consumed") or {})}
        current = self.read(table)
        if partition_column and self.partition_column(table) == partition_column:
            value = F.col(partition_column).cast("string")
            held = current.join(changes.select(*keys).distinct(), list(keys), "left_semi").select(value)
            touched = [r[0] for r in changes.select(value).union(held).distinct().collect()]
            current = current.filter(partition_in(partition_column, touched))
            return self.publish(
                lambda: merge_latest(current, changes, keys, order, fresh),
                table,
                "replace_partitions",
                partition_by=part_by,
                replaces=touched,
                **kw,
            )
        return self.publish(
            lambda: merge_latest(current, changes, keys, order, fresh), table, "upsert", partition_by=part_by, **kw
        )


def partition_in(column: str, values: Sequence) -> Column:
    """``column`` in ``values``, which Spark cast to text; NULL-aware."""
    text = [v for v in values if v is not None]
    cond = F.col(column).cast("string").isin(text) if text else F.lit(False)
    if any(v is None for v in values):
        cond = cond | F.col(column).isNull()
    return F.coalesce(cond, F.lit(False))


def _int(v) -> int | None:
    return None if v is None else int(v)
