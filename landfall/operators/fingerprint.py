"""Fixed-size fingerprints of rows and order-free checksums of sets of rows.

A checksum adds the fingerprints of its rows, so it does not depend on their
order, can be computed in parts that are merged, and counts repeated rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(*columns: Column | str, seed: int = 0) -> Column:
    """64 bits of the columns' values; a NULL differs from every value and keeps its place."""
    cols = [F.col(f"`{c}`") if isinstance(c, str) else c for c in columns]
    # xxhash64 passes NULLs over, so their places are hashed beside the values.
    nulls = F.concat(*[F.when(c.isNull(), F.lit("0")).otherwise(F.lit("1")) for c in cols]) if cols else F.lit("")
    return F.xxhash64(F.lit(seed), nulls, *cols)


def fingerprint128(*columns: Column | str) -> Column:
    """Two independent 64-bit hashes of the columns' values."""
    return F.struct(row_hash(*columns, seed=1).alias("h1"), row_hash(*columns, seed=2).alias("h2"))


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a row by its key columns."""
    return F.pmod(row_hash(*keys, seed=3), F.lit(buckets)).cast("int")


def checksum(value: Column) -> Column:
    """Aggregate: the sum of 64-bit hashes, exact and independent of the order."""
    return F.sum(value.cast("decimal(20,0)")).cast("decimal(38,0)")


def bucket_sums(df: DataFrame, keys: Sequence[str], buckets: int, parts: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows and checksums by bucket: two sums (``<name>_1``, ``<name>_2``) for each named list of columns.

    One pass with partial aggregation; what is shuffled is a row for each
    bucket and task. Keys go into every sum, so values that change places
    between rows are seen.
    """
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for name, columns in parts.items():
        for seed in (1, 2):
            aggregates.append(checksum(row_hash(*keys, *columns, seed=seed)).alias(f"{name}_{seed}"))
    return df.groupBy(bucket_of(keys, buckets).alias("bucket")).agg(*aggregates)
