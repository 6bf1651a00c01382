"""Staging: every column lands as text, so nothing can fail on the way in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_text(df: DataFrame) -> DataFrame:
    """All columns cast to string, names and order kept (one projection, no shuffle)."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def stage(df: DataFrame, source: str | None = None, source_column: str = "source") -> DataFrame:
    """Text staging, optionally tagged with the source system it came from."""
    text = to_text(df)
    if source is None:
        return text
    return text.select(F.lit(source).alias(source_column), *text.columns)


def union_sources(frames: dict[str, DataFrame], source_column: str = "source") -> DataFrame:
    """Staged frames of several sources as one table with a ``source`` column.

    ``unionByName`` is a narrow plan operator: partitions are concatenated,
    nothing is shuffled.
    """
    tagged = [stage(df, name, source_column) for name, df in frames.items()]
    out = tagged[0]
    for other in tagged[1:]:
        out = out.unionByName(other)
    return out


def spread(df: DataFrame) -> DataFrame:
    """Spread a narrow extract over the cluster before it is landed.

    A JDBC read without a partition column, or a file with one row group,
    arrives as a single partition, and every later narrow step (text
    staging, typing, the writes) would run in that one task. Such a frame is
    repartitioned round-robin to the default parallelism. A frame that has as
    many partitions, or whose rows pass a shuffle anyway, is returned
    unchanged; nothing is executed to find out.
    """
    try:
        partitions = _scan_partitions(df._jdf.queryExecution().executedPlan())
        parallelism = df.sparkSession.sparkContext.defaultParallelism
    except Exception:  # Spark Connect: no plan; leave partitioning to the server
        return df
    return df if partitions is None or partitions >= parallelism else df.repartition(parallelism)


def _scan_partitions(plan) -> int | None:
    """Partitions of the scans that the rows come from; None if they pass a shuffle.

    The other side of a broadcast join adds columns, not partitions, and its
    exchange moves no row of the result.
    """
    node = plan.getClass().getSimpleName()
    if node == "AdaptiveSparkPlanExec":
        return _scan_partitions(plan.executedPlan())
    if node == "BroadcastExchangeExec":
        return 0
    if node == "ShuffleExchangeExec":
        return None
    children = plan.children()
    if children.isEmpty():
        return plan.execute().getNumPartitions()
    below = [_scan_partitions(children.apply(i)) for i in range(children.size())]
    if None in below:
        return None
    return min(sum(below), plan.numPartitions()) if node == "CoalesceExec" else sum(below)
