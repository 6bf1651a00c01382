"""Surrogate keys: a stable number for every business key of every source.

The map is a table of its own that only grows: business keys already in it keep
their numbers, new ones are numbered from the highest number on. They are cut
into ranges, counted by range, and numbered inside a range from the count of
the ranges before, so no task sees all of them; the order of the keys decides
the numbers, not the layout of the data.

The highest number is the map's high-water mark, so it is known without a
scan, and a version and its mark become visible together: a load that is lost
half-way leaves no number behind, and a repeated load gives none away.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.session import scratch_dir
from landfall.tables.store import LoadResult, TableStore

#: The number of rows whose business key is missing or not in the map.
UNKNOWN = 0


def _complete(keys: Sequence[str]):
    return reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])


def number_rows(rows: DataFrame, order: Sequence[str], start: int, name: str) -> DataFrame:
    """``rows`` with numbers from ``start + 1`` in the order of ``order`` (which tells them apart).

    The driver holds one count for each range, no more than the partitions of
    a shuffle.
    """
    spark, path = rows.sparkSession, scratch_dir(rows.sparkSession, "ranges")
    ranged = rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranged.write.parquet(path)  # read twice, ranged once
    ranged = spark.read.schema(ranged.schema).parquet(path)
    before, total = [], start
    for r in sorted(ranged.groupBy("_range").count().collect(), key=lambda r: r["_range"]):
        before.append((r["_range"], total))
        total += r["count"]
    schema = T.StructType([T.StructField("_range", T.IntegerType()), T.StructField("_before", T.LongType())])
    columns = ", ".join(f"`{c}`" for c in order)
    local = F.expr(f"row_number() over (partition by _range order by {columns})")
    return (
        ranged.withColumn("_local", local)
        .join(spark.createDataFrame(before, schema), "_range")
        .withColumn(name, F.col("_before") + F.col("_local"))
        .drop("_range", "_local", "_before")
    )


def extend_key_map(
    store: TableStore, rows: DataFrame, table: str, keys: Sequence[str], *, name: str = "sk", layer: str = "dwh"
) -> LoadResult | None:
    """Number the business keys of ``rows`` that the map ``table`` lacks; None if it has them all.

    Rows with a NULL in their key get no number (:func:`with_surrogate` gives
    them :data:`UNKNOWN`).
    """
    keys = list(keys)
    new = rows.select(*[F.col(f"`{k}`") for k in keys]).filter(_complete(keys)).distinct()
    known = store.exists(table)
    if known:
        new = new.join(store.read(table).select(*keys), keys, "left_anti")
    start = int(store.high_water(table) or UNKNOWN) if known else UNKNOWN
    numbered = number_rows(new, keys, start, name)
    if known and numbered.isEmpty():
        return None
    top = F.greatest(F.max(name), F.lit(start).cast("bigint"))
    return store.append(numbered, table, layer=layer, observe={"high_water": top})


def with_surrogate(rows: DataFrame, key_map: DataFrame, keys: Sequence[str], name: str = "sk", drop: bool = False) -> DataFrame:
    """``rows`` with their number; :data:`UNKNOWN` where the key is missing or not in the map.

    Rows without a whole key need no partner and take no part in the join, so
    they form no hot group.
    """
    keys = list(keys)
    numbers = key_map.select(*keys, F.col(name).cast("bigint").alias(name))
    found = rows.filter(_complete(keys)).join(numbers, keys, "left")
    lost = rows.filter(~_complete(keys)).withColumn(name, F.lit(None).cast("bigint"))
    out = found.unionByName(lost).withColumn(name, F.coalesce(F.col(name), F.lit(UNKNOWN).cast("bigint")))
    return out.drop(*keys) if drop else out
