"""Differences of two states of a table, row by row and without a change column.

Rows are compared as signed fingerprints: old rows count -1, new rows +1, and
what doesn't cancel differs. So repeated rows and rows without a key have a
defined result (they are inserted or deleted so many times), and the work is an
aggregation with partial sums, not a join: a key that many rows share is summed
in the map tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.operators.fingerprint import bucket_of, bucket_sums, fingerprint128
from landfall.session import scratch_dir

INSERTED, CHANGED, DELETED = "inserted", "changed", "deleted"


def _keyed(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_differences(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(kind, copies, changed, old, new): rows of ``new`` and ``old`` that have no equal row on the other side.

    A key with one row gone and one come is ``changed`` (``changed`` lists the
    columns); other rows are ``inserted`` or ``deleted``, ``copies`` times.
    ``old`` and ``new`` are structs of all columns.
    """
    columns = new.columns
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in columns])
    signed = lambda df, sign: df.select(
        *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)],
        fingerprint128(*columns).alias("_fp"), F.lit(sign).alias("_sign"), row.alias("_row"),
    )
    both = signed(old.select(*[F.col(f"`{c}`") for c in columns]), -1).unionByName(signed(new, 1))
    ks = [f"_k{i}" for i in range(len(keys))]
    net = both.groupBy(*ks, "_fp").agg(F.sum("_sign").alias("_net"), F.first("_row").alias("_row"))
    net = _written(net.filter("_net <> 0"), "differences")
    gone, came = F.col("_net") < 0, F.col("_net") > 0
    by_key = (
        net.filter(_keyed(ks))
        .groupBy(*ks)
        .agg(
            F.sum(F.when(gone, -F.col("_net")).otherwise(0)).alias("_gone"),
            F.sum(F.when(came, F.col("_net")).otherwise(0)).alias("_came"),
            F.first(F.when(gone, F.col("_row")), ignorenulls=True).alias("old"),
            F.first(F.when(came, F.col("_row")), ignorenulls=True).alias("new"),
        )
        .filter("_gone = 1 and _came = 1")
    )
    names = [F.when(~F.col(f"old.`{c}`").eqNullSafe(F.col(f"new.`{c}`")), F.lit(c)) for c in columns]
    changed = by_key.select(
        F.lit(CHANGED).alias("kind"), F.lit(1).cast("bigint").alias("copies"),
        F.array_compact(F.array(*names)).alias("changed"), "old", "new",
    )
    nothing = F.lit(None).cast(net.schema["_row"].dataType)
    others = net.join(by_key.select(*ks), ks, "left_anti").select(
        F.when(came, INSERTED).otherwise(DELETED).alias("kind"),
        F.abs("_net").cast("bigint").alias("copies"),
        F.array().cast("array<string>").alias("changed"),
        F.when(gone, F.col("_row")).otherwise(nothing).alias("old"),
        F.when(came, F.col("_row")).otherwise(nothing).alias("new"),
    )
    return changed.unionByName(others)


def unequal_sums(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left`` and ``right`` checksums by bucket, full outer, of the buckets in which any differs."""
    names = [c for c in left.columns if c != "bucket"]
    side = lambda df, tag: df.select("bucket", *[F.col(c).alias(f"{tag}_{c}") for c in names])
    joined = side(left, "left").join(side(right, "right"), "bucket", "full")
    same = reduce(lambda a, b: a & b, [F.col(f"left_{c}").eqNullSafe(F.col(f"right_{c}")) for c in names])
    return joined.filter(~same)


def content_check(left: DataFrame, right: DataFrame, keys: Sequence[str], buckets: int = 1024) -> DataFrame:
    """(bucket, column_name, rows_left, rows_right): the columns and buckets of keys in which contents differ.

    Checksums are order-free sums over (key, value), so two tables of equal
    counts that differ in one cell, or by values that changed places, are told
    apart. Each side is read once; a row for each bucket is compared.
    """
    others = [c for c in right.columns if c not in keys]
    parts = {f"c{i}": [c] for i, c in enumerate(others)} | {"key": []}
    sums = unequal_sums(bucket_sums(left, keys, buckets, parts), bucket_sums(right, keys, buckets, parts))
    differs = lambda part: ~reduce(
        lambda a, b: a & b, [F.col(f"left_{part}_{s}").eqNullSafe(F.col(f"right_{part}_{s}")) for s in (1, 2)]
    )
    found = [F.when(differs("key"), F.lit(",".join(keys)))]
    found += [F.when(differs(f"c{i}"), F.lit(c)) for i, c in enumerate(others)]
    zero = lambda c: F.coalesce(c, F.lit(0))
    return sums.select(
        "bucket",
        F.explode(F.array_compact(F.array(*found))).alias("column_name"),
        zero("left_rows").alias("rows_left"),
        zero("right_rows").alias("rows_right"),
    )


def content_differences(left: DataFrame, right: DataFrame, keys: Sequence[str], buckets: int = 1024) -> DataFrame:
    """One row per differing cell: the keys, kind, column_name, left_value, right_value (as text).

    Drill-down of :func:`content_check`: only rows of differing buckets, and of
    them only the keys and the differing columns, are compared. The driver
    holds the differing (bucket, column) pairs, no more than ``buckets`` times
    the columns. A row that one side lacks has one entry without a column.
    """
    found = content_check(left, right, keys, buckets).select("bucket", "column_name").collect()
    others = [c for c in right.columns if c not in keys]
    named = {r["column_name"] for r in found}
    columns = [*keys, *[c for c in others if c in named]]
    at = sorted({r["bucket"] for r in found})
    here = bucket_of(keys, buckets).isin(at) if at else F.lit(False)
    cut = lambda df: df.filter(here).select(*[F.col(f"`{c}`") for c in columns])
    rows = row_differences(cut(left), cut(right), keys)
    text = lambda side, c: F.col(f"{side}.`{c}`").cast("string")
    cell = lambda c: F.struct(
        F.lit(c).alias("name"), text("old", c).alias("left"), text("new", c).alias("right")
    )
    cells = [F.when(F.array_contains("changed", c), cell(c)) for c in columns if c not in keys]
    blank = F.array(F.struct(*[F.lit(None).cast("string").alias(n) for n in ("name", "left", "right")]))
    listed = F.array_compact(F.array(*cells)) if cells else blank
    whole = F.when(F.col("kind") == CHANGED, listed).otherwise(blank)
    key_of = [F.coalesce(F.col(f"new.`{k}`"), F.col(f"old.`{k}`")).alias(k) for k in keys]
    return rows.select(*key_of, "kind", "copies", F.explode(whole).alias("_cell")).select(
        *keys, "kind", "copies", F.col("_cell.name").alias("column_name"),
        F.col("_cell.left").alias("left_value"), F.col("_cell.right").alias("right_value"),
    )
