"""Keyed upsert of a change set into a table (plain Parquet has no MERGE INTO).

``result = target ▷ changes  ∪  latest(changes)``: target rows whose key is
in the change set are replaced by the change set's latest row for that key.
With an order, a target row that is later than the change stays. The anti join
moves only the key columns of the change set; Spark broadcasts them if their
run-time size allows it, otherwise both sides are shuffled on the key. Keys are
unique in a keyed table, so the join has no hot key on the target side; rows
without a key are matched by a hash of all their columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.operators.dedup import keep_latest, order_spec
from landfall.operators.fingerprint import row_hash


def merge_latest(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    fresh: bool = False,
) -> DataFrame:
    """The latest row per key of both under ``order``; ties, and all of them without an order, go to the change.

    A NULL key is unknown, so such rows replace nothing: one is added if the
    target lacks an equal row, so that a change set read again adds nothing.

    ``fresh`` promises that the rows of ``changes`` were never merged before.
    Then every row with a NULL key is added, and ties are decided by the total
    order of :func:`keep_latest`: merging in parts gives the same table as
    :func:`keep_latest` of all rows at once. The target is then read and
    shuffled once, and the latest changes are made once.
    """
    keys = list(keys)
    changes = changes.select(*target.columns)
    known = changes.filter(~_unknown(keys))
    unkeyed = changes.filter(_unknown(keys))
    if not fresh:
        unkeyed = _absent(target.filter(_unknown(keys)), unkeyed)
    latest = keep_latest(known, keys, order)
    if fresh:
        return _contested(target, latest, keys, order).unionByName(unkeyed)
    change_keys = latest.select(*keys)
    kept = target.join(change_keys, keys, "left_anti").unionByName(unkeyed)
    if not order:
        return kept.unionByName(latest)
    contested = target.join(change_keys, keys, "left_semi")
    rivals = contested.withColumn("_change", F.lit(0)).unionByName(latest.withColumn("_change", F.lit(1)))
    return kept.unionByName(keep_latest(rivals, keys, [*order, "-_change"]).drop("_change"))


def _contested(target: DataFrame, latest: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Target rows whose key has no change, and the first row of each key that has one; ``latest`` holds one a key."""
    both = target.withColumn("_change", F.lit(0)).unionByName(latest.withColumn("_change", F.lit(1)))
    alone = both.withColumn("_alone", F.when(_unknown(keys), F.monotonically_increasing_id()))
    of_key = Window.partitionBy(*keys, "_alone")
    ranked = alone.withColumn("_rn", F.row_number().over(of_key.orderBy(*order_spec(target, keys, order))))
    changed = ranked.withColumn("_changed", F.max("_change").over(of_key))
    return changed.filter((F.col("_changed") == 0) | (F.col("_rn") == 1)).select(*target.columns)


def insert_new(
    target_window: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
) -> DataFrame:
    """Rows of ``batch`` whose key is absent from ``target_window``.

    For immutable rows (events): only the overlap window of the target has to
    be read, and the result is *appended*, so the target is never rewritten.
    Rows with a NULL key are known again only if all their columns are equal.
    """
    keys = list(keys)
    window = target_window.select(*batch.columns)
    known = keep_latest(batch.filter(~_unknown(keys)), keys, order)
    new = known.join(window.filter(~_unknown(keys)).select(*keys), keys, "left_anti")
    return new.unionByName(_absent(window.filter(_unknown(keys)), batch.filter(_unknown(keys))))


def _unknown(keys: Sequence[str]) -> Column:
    return reduce(lambda x, y: x | y, [F.col(k).isNull() for k in keys])


def _absent(there: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows that have no equal row in ``there``, as often as they come.

    They are matched by a hash of all columns (a row that only its hash shares
    is told apart by the columns), so rows without a key spread over all tasks.
    """
    columns = rows.columns
    digest = row_hash(*columns)
    left = rows.withColumn("_hash", digest).alias("b")
    right = there.select(*columns).distinct().withColumn("_hash", digest).alias("t")
    equal = [F.col(f"b.`{c}`").eqNullSafe(F.col(f"t.`{c}`")) for c in columns]
    match = reduce(lambda x, y: x & y, equal, F.col("b._hash") == F.col("t._hash"))
    return left.join(right, match, "left_anti").drop("_hash")
