"""Duplicate removal.

* :func:`drop_exact` – identical rows (or identical on a subset) collapse to one.
  Planned as a hash aggregate with a map-side partial step, so a value held by
  a third of all rows is reduced inside every map task before the shuffle.
* :func:`keep_latest` – one survivor per business key under a *total* order
  (the given order, then every other column), so the survivor never depends on
  partitioning or task timing. ``row_number() = 1`` is planned by Spark as a
  partial ``WindowGroupLimit`` before the shuffle and a final one after it: a
  hot key sends at most one row per map partition across the network.
* :func:`duplicate_groups` / :func:`keep_first_copy` – wide text values are
  grouped by a fixed-size SHA-256 fingerprint plus length, so the shuffle moves
  a fixed 32-byte hash and a length per row instead of the text.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def drop_exact(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def order_spec(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list[Column]:
    """Total order: ``order`` (a leading ``-`` means descending), then every
    other non-key column ascending; nulls last throughout."""
    cols: list[Column] = []
    named = set()
    for o in order:
        name = o[1:] if o.startswith("-") else o
        named.add(name)
        cols.append(F.col(name).desc_nulls_last() if o.startswith("-") else F.col(name).asc_nulls_last())
    rest = [c for c in df.columns if c not in keys and c not in named]
    cols += [F.col(c).asc_nulls_last() for c in rest]
    return cols or [F.col(keys[0])]  # a table of keys alone: rows of one key are equal


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per ``keys`` under :func:`order_spec` – deterministic survivor.

    A NULL key is unknown, not equal to another: such rows all pass through
    (each in a window of its own, so they form no hot group).
    """
    unknown = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    ordering = order_spec(df, keys, order)
    alone = df.withColumn("_alone", F.when(unknown, F.monotonically_increasing_id()))
    w = Window.partitionBy(*keys, "_alone").orderBy(*ordering)
    return alone.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn", "_alone")


def fingerprint(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.struct(F.unhex(F.sha2(c.cast("string"), 256)).alias("h"), F.length(c).alias("n"))


def duplicate_groups(df: DataFrame, value: str, id_col: str) -> DataFrame:
    """One row per distinct ``value``: the lowest ``id_col`` and the number of copies."""
    return (
        df.select(fingerprint(value).alias("_fp"), F.col(id_col))
        .groupBy("_fp")
        .agg(F.min(id_col).alias(id_col), F.count(F.lit(1)).alias("copies"))
        .drop("_fp")
    )


def keep_first_copy(df: DataFrame, value: str, id_col: str) -> DataFrame:
    """Whole rows of the lowest ``id_col`` of every distinct ``value``.

    The survivors are found on fingerprints (small shuffle, partial
    aggregation), then the wide rows are matched on their unique id: a semi
    join that moves each wide row once (ids are unique, so no key is hot),
    unless the survivor ids are small enough to broadcast. When only the
    survivor ids and copy counts are needed, :func:`duplicate_groups` never
    moves the wide values at all.
    """
    survivors = duplicate_groups(df, value, id_col).select(id_col)
    return df.join(survivors, id_col, "left_semi")
