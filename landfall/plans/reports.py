"""Reports kept by deltas: a stored aggregate follows its table from the changes alone.

A changed row leaves the report with its old values and enters it with its new
ones. Deltas are added up by group before they meet the stored report, so
neither the table nor its unchanged rows are read again. The report's audit row
notes the newest changes it holds; they and the note become visible together,
so each change counts once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.tables.snapshots import BUCKET, changes_table
from landfall.tables.store import LoadResult, TableStore

#: Rows of a group; a group without rows leaves the report.
ROWS = "row_count"
SUM_TYPE = "decimal(38,4)"


def signed_rows(changes: DataFrame) -> DataFrame:
    """Changes (kind, copies, changed, old, new) as rows with ``_sign``: old ones negative, new ones positive."""
    side = lambda name, sign: changes.filter(F.col(name).isNotNull()).select(
        f"{name}.*", (F.col("copies") * sign).alias("_sign")
    )
    return side("old", -1).unionByName(side("new", 1))


def deltas(rows: DataFrame, dimensions: Mapping[str, Column], measures: Sequence[str]) -> DataFrame:
    """Sums by group of rows that carry ``_sign``; a NULL measure counts as zero."""
    sums = [
        F.sum(F.coalesce(F.col(m).cast("decimal(18,4)"), F.lit(0).cast("decimal(18,4)")) * F.col("_sign")).cast(SUM_TYPE).alias(f"sum_{m}")
        for m in measures
    ]
    named = [c.alias(n) for n, c in dimensions.items()]
    return rows.groupBy(*named).agg(F.sum("_sign").cast("bigint").alias(ROWS), *sums)


def merged(report: DataFrame, change: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """``report`` with ``change`` added; groups that lost all rows are gone."""
    sums = [F.sum(c).cast(SUM_TYPE).alias(c) for c in report.columns if c not in (*dimensions, ROWS)]
    both = report.unionByName(change)
    added = both.groupBy(*dimensions).agg(F.sum(ROWS).cast("bigint").alias(ROWS), *sums)
    return added.filter(F.col(ROWS) != 0).select(*report.columns)


def keep_report(
    store: TableStore,
    table: str,
    report: str,
    dimensions: Mapping[str, Column],
    measures: Sequence[str],
    *,
    layer: str = "dwh",
) -> LoadResult | None:
    """Bring ``report`` up to date with the changes of ``table`` (a snapshot-loaded table); None if there are none.

    The first time, and when the changes were started anew, the report is made
    from the table, as it was when its last reported change was made.
    """
    changes = changes_table(table)
    ids, whole = store.unconsumed(changes, report)
    if not ids:
        return None
    note = {changes: ids[-1]}
    if whole:
        upto = store.consumed(changes)[table]
        held = [i for i in store.visible_load_ids(table) if i <= upto]
        rows = store.read_versions(table, held).drop(BUCKET).withColumn("_sign", F.lit(1).cast("bigint"))
        return store.publish(deltas(rows, dimensions, measures), report, "refresh", layer=layer, consumed=note)
    known, change = store.read(report), deltas(signed_rows(store.read_versions(changes, ids)), dimensions, measures)
    kept = {**store.consumed(report), **note}
    return store.publish(lambda: merged(known, change, list(dimensions)), report, "upsert", layer=layer, consumed=kept)
