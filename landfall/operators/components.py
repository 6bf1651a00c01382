"""Connected components by label joins: stars are moved to smaller centres until nothing changes.

Each round joins every node with its smallest neighbour twice, first for the
larger neighbours, then for the smaller ones, so that a chain shrinks by half
rather than by one. Rounds are written to the shared folder; the driver sees a
count and a checksum of the links. Minima are written before they are joined
with the links, so that a node with very many links is a join Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.session import scratch_dir


def written(df: DataFrame, label: str) -> DataFrame:
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component`` (the smallest node it reaches) for every node with a link.

    Direction, repetition and links of a node with itself don't matter; a link
    with a NULL end is none.
    """
    edges = written(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter((F.col(a) != F.col(b))).distinct(),
        "links",
    )
    state = None
    while True:
        mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        now = edges.agg(F.count("*").alias("n"), mark.alias("h")).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select("v", "v").distinct()
            )
        state = now
        both = edges.union(edges.select("v", "u"))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "minima")
        large = written(
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links"
        )
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "minima")
        moved = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = written(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
