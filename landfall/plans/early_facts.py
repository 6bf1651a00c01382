"""Early facts: lines that come before their dimensions are parked, and placed when these come.

The fact table holds both, apart by its partition column :data:`STATE`. A load
of lines appends what it could place and what it parked as one version. When
dimensions have got new rows since, :func:`place_parked` reads the parked rows
only, takes those whose missing key has come (a semi-join on the new keys),
joins these again, and publishes one version that replaces the parked
partition and adds what was placed. Placed lines are never read again, and a
line is at no moment lost or in both.

Which versions of the dimensions parked lines have met is noted in the audit
row of the version that took them in. A load of lines leaves the note as it is:
its lines may have met more, so they are tried once more than needed, never
once less.

Defined cases: a line whose key is NULL stays parked, as no row can come for
it; a line that misses several sides is parked for the first and then for the
next; sides have one row per key (a later row of a key that came already places
nothing anew).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.tables.store import LoadResult, TableStore

STATE = "_state"
PARKED, PLACED = "parked", "placed"
MISSING = "_missing"


@dataclass(frozen=True)
class Side:
    """A dimension: published table, its key, the column that refers to it (of the line or of a side before), what it adds."""

    table: str
    key: str
    refers: str
    adds: tuple[str, ...] = ()


def _joined(lines: DataFrame, sides: Sequence[Side], tables: Mapping[str, DataFrame]) -> DataFrame:
    """``lines`` with what the sides add, the first side they miss and their state."""
    out, missing = lines, F.lit(None).cast("string")
    for side in sides:
        rows = tables[side.table].select(
            F.col(side.key).alias(side.refers), *side.adds, F.lit(True).alias(f"_{side.table}")
        )
        out = out.join(rows, side.refers, "left")
    for side in reversed(sides):
        missing = F.when(F.col(f"`_{side.table}`").isNull(), side.table).otherwise(missing)
    state = F.when(F.col(MISSING).isNull(), F.lit(PLACED)).otherwise(F.lit(PARKED))
    adds, found = [], F.lit(True)
    for side in sides:  # what lies behind the first missing side is left open until the line is tried again
        found = found & F.col(f"`_{side.table}`").isNotNull()
        adds += [F.when(found, F.col(c)).alias(c) for c in side.adds]
    return out.select(*lines.columns, *adds, missing.alias(MISSING)).withColumn(STATE, state)


def load_lines(store: TableStore, fact: str, lines: DataFrame, sides: Sequence[Side], *, layer: str = "dwh") -> LoadResult:
    """Append ``lines``: placed where every side has their row, parked where not."""
    first = not store.exists(fact)
    seen = {s.table: store.visible_load_ids(s.table)[-1] for s in sides} if first else None
    tables = {s.table: store.read(s.table) for s in sides}
    return store.publish(
        lambda: _joined(lines, sides, tables),
        fact,
        "append",
        layer=layer,
        partition_by=[STATE],
        gather=False,
        consumed=seen,
        observe={"parked": F.sum(F.when(F.col(STATE) == PARKED, 1).otherwise(0))},
    )


def parked_lines(store: TableStore, fact: str) -> DataFrame:
    """Lines that wait for a dimension, with the table they miss."""
    return store.read(fact).filter(F.col(STATE) == PARKED).drop(STATE)


def placed_lines(store: TableStore, fact: str) -> DataFrame:
    return store.read(fact).filter(F.col(STATE) != PARKED).drop(STATE, MISSING)


def came_since(parked: DataFrame, sides: Sequence[Side], new_rows: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Parked lines whose missing key is in ``new_rows`` (by table), and the others."""
    wanted = F.lit(None).cast("string")
    for s in sides:
        wanted = F.when(F.col(MISSING) == s.table, F.col(s.refers).cast("string")).otherwise(wanted)
    keyed = parked.withColumn("_key", wanted)
    keys = reduce(
        DataFrame.union,
        [new_rows[s.table].select(F.lit(s.table).alias(MISSING), F.col(s.key).cast("string").alias("_key"))
         for s in sides if s.table in new_rows],
    )
    hit, rest = (keyed.join(keys, [MISSING, "_key"], how).select(*parked.columns) for how in ("left_semi", "left_anti"))
    return hit, rest


def place_parked(
    store: TableStore, fact: str, line_columns: Sequence[str], sides: Sequence[Side], *, layer: str = "dwh"
) -> LoadResult | None:
    """Place the parked lines whose dimension rows have come since; None if no dimension has new rows.

    ``line_columns`` are the columns that came with the lines; the others are joined anew.
    """
    new_ids = {s.table: store.unconsumed(s.table, fact)[0] for s in sides}
    new_ids = {t: ids for t, ids in new_ids.items() if ids}
    if not new_ids:
        return None
    # The versions of now, so that what comes while this runs is left for the next time.
    visible = {s.table: store.visible_load_ids(s.table) for s in sides}
    note = {**store.consumed(fact), **{t: ids[-1] for t, ids in new_ids.items()}}
    tables = {t: store.read_versions(t, [i for i in ids if i <= note[t]]) for t, ids in visible.items()}
    new_rows = {t: store.read_versions(t, ids) for t, ids in new_ids.items()}
    hit, rest = came_since(parked_lines(store, fact), sides, new_rows)

    def both() -> DataFrame:
        again = _joined(hit.select(*line_columns), sides, tables)
        return again.unionByName(rest.withColumn(STATE, F.lit(PARKED)).select(*again.columns))

    return store.publish(
        both,
        fact,
        "replace_partitions",
        layer=layer,
        partition_by=[STATE],
        gather=False,
        replaces=[PARKED],
        adds=[PLACED],
        consumed=note,
        observe={"parked": F.sum(F.when(F.col(STATE) == PARKED, 1).otherwise(0))},
    )
