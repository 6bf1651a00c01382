"""Layers: staging (text) → transformed (typed, clean) → final (marts).

Every layer reads only published tables of the layer before and publishes its
own, so a layer starts only from committed input, and the lineage between
layers is cut by the write.

Transformed layer, per table and source, in two jobs:

1. ``<src>_tf.<t>__typed`` – staged text typed in one projection and written
   once, partitioned by ``_rejected``. Accepted rows and rejects are both read
   back from it with partition pruning: the staged text is scanned once.
2. ``<src>_tf.<t>`` – accepted rows, latest per business key. Its audit row
   carries read = written + rejected + duplicate.

By increments (:func:`transform_increment`) both jobs take in only what came
since their last run: job 1 the staged versions that the typed table has not
consumed, job 2 the typed versions that the transformed table has not
consumed, merged by key. Each notes in the audit row of its own version what it
took in, so a run that fails between the two goes on where it stopped, and no
version is taken in twice.

When a rule is changed to accept more, :func:`repair_rejects` reads the rejects
alone and types their bad values again from the raw text that they keep. One
version replaces the rejects and adds the rows that are good now, which the
merge takes in like any other increment.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.operators.dedup import keep_latest
from landfall.operators.typed import (
    REJECTED,
    REJECTS,
    ColumnSpec,
    accepted_rows,
    apply_types,
    reject_entries,
    repair_types,
)
from landfall.plans.steps import Step, run_steps
from landfall.sources.catalog import Extract, Source, stage_catalog, staging_table
from landfall.streaming.landing import Landing
from landfall.tables.store import LoadResult, TableStore


@dataclass(frozen=True)
class TableRule:
    """How one staged table becomes a transformed table."""

    table: str
    specs: tuple[ColumnSpec, ...]
    keys: tuple[str, ...]
    order: tuple[str, ...] = ()
    #: Column by whose values the transformed table is stored; increments rewrite only those they touch.
    partition: str | None = None


#: Beside the tables taken in, the typed table notes the rule that all its rejects have met.
RULE_NOTE = "#rule"


def rule_version(rule: TableRule) -> str:
    return sha256(repr(rule.specs).encode()).hexdigest()[:16]


def typed_table(source: str, table: str) -> str:
    return f"{source}_tf.{table}__typed"


def transformed_table(source: str, table: str) -> str:
    return f"{source}_tf.{table}"


def _typed_load(store: TableStore, source: str, rule: TableRule, staged: DataFrame, mode: str, upto: str) -> LoadResult:
    typed = apply_types(staged, rule.specs)
    note = {staging_table(source, rule.table): upto}
    if mode == "refresh":  # rejects of earlier increments have not met this rule
        note[RULE_NOTE] = rule_version(rule)
    return store.publish(
        typed,
        typed_table(source, rule.table),
        mode,
        source=source,
        layer="tf",
        partition_by=[REJECTED],
        gather=False,  # two values: a shuffle of the whole table would buy nothing
        observe={
            "rows_rejected": F.sum(F.col(REJECTED).cast("long")),
            "reject_entries": F.sum(F.size(REJECTS).cast("long")),
        },
        consumed=note,
    )


def type_table(store: TableStore, source: str, rule: TableRule) -> LoadResult:
    staging = staging_table(source, rule.table)
    ids = store.visible_load_ids(staging)
    staged = store.read_versions(staging, ids) if ids else store.read(staging)
    return _typed_load(store, source, rule, staged, "refresh", ids[-1])


def type_increment(store: TableStore, source: str, rule: TableRule) -> LoadResult | None:
    """Type the staged versions that came since the last run; None if there are none."""
    staging, typed = staging_table(source, rule.table), typed_table(source, rule.table)
    ids, whole = store.unconsumed(staging, typed)
    if not ids:
        return None
    staged = store.read_versions(staging, ids)
    return _typed_load(store, source, rule, staged, "refresh" if whole else "append", ids[-1])


def _side(
    store: TableStore, source: str, table: str, rejected: bool, versions: Sequence[str] | None = None
) -> DataFrame:
    """One side of the typed table; the filter is on the partition column only,
    so Spark reads just that side's files. Partition values come back as text
    or boolean depending on type inference, so compare as text."""
    flag = F.col(REJECTED).cast("string") == F.lit("true" if rejected else "false")
    typed = typed_table(source, table)
    rows = store.read(typed) if versions is None else store.read_versions(typed, versions)
    return rows.filter(flag).withColumn(REJECTED, F.lit(rejected))


def accepted(store: TableStore, source: str, table: str, versions: Sequence[str] | None = None) -> DataFrame:
    return accepted_rows(_side(store, source, table, False, versions))


def rejects(store: TableStore, source: str, rule: TableRule) -> DataFrame:
    return reject_entries(_side(store, source, rule.table, True), rule.keys)


def repair_rejects(store: TableStore, source: str, rule: TableRule) -> LoadResult | None:
    """Type the rejects again under a changed ``rule``; None if all of them have met it.

    Neither staged text nor accepted rows are read. ``rows_read`` are the rejects
    of before, ``rows_rejected`` those that stay, so what was repaired is the
    difference. For rules that accept more than before: accepted rows keep their
    values. :func:`merge_increment` takes the repaired rows in.
    """
    table = typed_table(source, rule.table)
    if store.notes(table).get(RULE_NOTE) == rule_version(rule):
        return None
    bad = _side(store, source, rule.table, True)
    return store.publish(
        lambda: repair_types(bad, rule.specs),
        table,
        "replace_partitions",
        source=source,
        layer="tf",
        partition_by=[REJECTED],
        gather=False,
        replaces=["true"],
        adds=["false"],
        observe={
            "rows_rejected": F.coalesce(F.sum(F.col(REJECTED).cast("long")), F.lit(0)),
            "reject_entries": F.coalesce(F.sum(F.size(REJECTS).cast("long")), F.lit(0)),
        },
        consumed={RULE_NOTE: rule_version(rule)},
    )


def dedup_table(store: TableStore, source: str, rule: TableRule, typed: LoadResult) -> LoadResult:
    """Latest row per key of the accepted rows.

    Every count comes from a write's final stage, where Spark applies each
    task's metrics exactly once even when tasks are retried: rows read and
    rejected from the typed job, rows written from this one. The accepted
    rows are ``read - rejected``, so duplicates are ``accepted - written``.
    """
    read = int(typed.metrics["rows"])
    rejected = int(typed.metrics.get("rows_rejected") or 0)
    good = accepted(store, source, rule.table)
    return store.publish(
        keep_latest(good, rule.keys, rule.order),
        transformed_table(source, rule.table),
        "refresh",
        source=source,
        layer="tf",
        partition_by=[rule.partition] if rule.partition else [],
        consumed={typed_table(source, rule.table): typed.load_id},
        counts={
            "rows_read": read,
            "rows_rejected": rejected,
            "rows_duplicate": lambda m: read - rejected - int(m["rows"]),
        },
    )


def transform_table(store: TableStore, source: str, rule: TableRule) -> list[LoadResult]:
    typed = type_table(store, source, rule)
    return [typed, dedup_table(store, source, rule, typed)]


def merge_increment(store: TableStore, source: str, rule: TableRule) -> LoadResult | None:
    """Merge the typed versions that came since the last run into the transformed table; None if there are none.

    Ties fall as in a full run (:func:`merge_latest`, ``fresh``), so the table is
    the one a full run gives. The rows of a merge are counted by the typed load;
    ``rows_read`` is left out here, since the merged table is not its input.
    """
    typed, target = typed_table(source, rule.table), transformed_table(source, rule.table)
    ids, whole = store.unconsumed(typed, target)
    if not ids:
        return None
    kw = dict(source=source, layer="tf", consumed={typed: ids[-1]}, counts={"rows_read": None})
    good = accepted(store, source, rule.table, ids)
    if whole:
        part_by = [rule.partition] if rule.partition else []
        return store.publish(keep_latest(good, rule.keys, rule.order), target, "refresh", partition_by=part_by, **kw)
    return store.upsert(good, target, rule.keys, rule.order, partition_column=rule.partition, fresh=True, published=True, **kw)


def transform_increment(store: TableStore, source: str, rule: TableRule) -> list[LoadResult]:
    """The transformed table brought up to date from what was staged since; the loads this took (none if nothing came)."""
    loads = [type_increment(store, source, rule), merge_increment(store, source, rule)]
    return [x for x in loads if x is not None]


def transform_source(
    store: TableStore, source: str, rules: Sequence[TableRule], max_workers: int = 4, increments: bool = False
) -> list[LoadResult]:
    """Type and deduplicate every table of a source, whole or by increments; tables run as concurrent jobs."""
    from landfall.plans.concurrency import run_all

    one = transform_increment if increments else transform_table
    per_table = run_all([lambda r=r: one(store, source, r) for r in rules], max_workers)
    return [res for pair in per_table for res in pair]


def run_layer(
    spark: SparkSession,
    store: TableStore,
    layer: str,
    **kw,
) -> list[LoadResult]:
    """Run one layer (``"stg"``, ``"tf"`` or ``"dwh"``) on what the layer before published."""
    return run_pipeline(spark, store, layers=(layer,), **kw).get(layer, [])


def run_pipeline(
    spark: SparkSession,
    store: TableStore,
    *,
    sources: Sequence[Source] = (),
    catalogs: Mapping[str, Mapping[str, str | Extract | Landing]] | None = None,
    rules: Mapping[str, Sequence[TableRule]] | None = None,
    tf_steps: Mapping[str, Sequence[Step]] | None = None,
    dwh_steps: Sequence[Step] = (),
    final: Callable[[SparkSession, TableStore], list[LoadResult]] | None = None,
    layers: Sequence[str] = ("stg", "tf", "dwh"),
    increments: bool = False,
) -> dict[str, list[LoadResult]]:
    """Run the layers in order; a layer starts only if the one before succeeded.

    * ``stg``: every source's catalog of extracts, landed as text; in full, or by
      increments where the entry says so (:class:`Extract`), or what landed in a
      folder since the last run (:class:`Landing`).
    * ``tf``: per source, typing rules (:class:`TableRule`) and/or a folder of
      SQL steps (published as ``<source>_tf.<step>``). With ``increments`` the
      rules take in only what was staged since their last run.
    * ``dwh``: SQL steps (published as ``dwh.<step>``) and/or a ``final``
      callable.

    SQL steps see every published table as a temporary view named
    ``<schema>_<table>`` (``erp_a_stg.orders`` → ``erp_a_stg_orders``) and the
    steps before them by name. Start from any layer by leaving earlier ones
    out of ``layers``: the later layers then read what is already published.
    """
    out: dict[str, list[LoadResult]] = {}
    if "stg" in layers:
        out["stg"] = []
        for src in sources:
            out["stg"] += stage_catalog(spark, store, src, (catalogs or {})[src.name])
    if "tf" in layers:
        out["tf"] = []
        for src_name, src_rules in (rules or {}).items():
            out["tf"] += transform_source(store, src_name, src_rules, increments=increments)
        for src_name, steps in (tf_steps or {}).items():
            store.register_views()
            out["tf"] += run_steps(spark, store, steps, layer="tf", source=src_name, prefix=f"{src_name}_tf.")
    if "dwh" in layers:
        out["dwh"] = []
        if dwh_steps:
            store.register_views()
            out["dwh"] += run_steps(spark, store, dwh_steps, layer="dwh", prefix="dwh.")
        if final is not None:
            out["dwh"] += final(spark, store)
    return out
