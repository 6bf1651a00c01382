"""Merkle manifest of a dataset by slot pivots.

Every row is a leaf; the leaves of a group (a source, a shard) form a tree of
their own, whose root is one leaf of the tree of groups. A level is made by
one aggregate: conditional aggregates spread the children of a parent over
``fanout`` slot columns; the slot columns joined are hashed to the parent's
digest, and without the own slot column they are the siblings of a child. So a
level is a third of the one below, and the digests of a proof come from the
pivots that made them, by joins from the top down.

Places in a group are given without a task that holds the group: rows are cut
into ranges of (group, id), counted by range and group, and numbered inside a
range from the rows of the group in the ranges before.

Defined cases: a null group comes first; of a group, null ids come first, rows
with one id go by their digests, and equal rows by their places in the table;
a lone leaf is its group's root and has no sibling, as a lone group's root is
the root; an empty table gives an empty result; columns that are not named in
the leaf's digest are ignored; very long texts are hashed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import col, written

#: Paths from a node to the root: for each level the digests on its left and on its right, joined.
STEP = "struct<left:string,right:string>"


def record_digest(*values: Column) -> Column:
    """Digest of a row: each value as its length in bytes, a colon and the value, or ``-`` if it is null."""
    text = [v.cast("string") for v in values]
    parts = [
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text
    ]
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def siblings(path: Column) -> Column:
    """The digests of a path, level by level, from left to right, as one text."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0) in each ``group`` and ``n``, its rows; ``order`` is total within a group."""
    spark = rows.sparkSession
    ranged = written(
        spark, rows.repartitionByRange(group, *order).withColumn("part", F.spark_partition_id()), "ranges"
    )
    counts = ranged.groupBy(group, "part").agg(F.count("*").alias("here"))
    own = Window.partitionBy(group)  # a row for each range that holds rows of the group
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        group, "part", F.sum("here").over(own).alias("n"), F.coalesce(F.sum("here").over(before), F.lit(0)).alias("from")
    )
    local = F.row_number().over(Window.partitionBy(group, "part").orderBy(*order))
    placed = ranged.withColumn("local", local).join(counts, [group, "part"])
    return placed.withColumn("pos", F.col("from") + F.col("local") - 1).drop("local", "from", "part")


def _pivot(nodes: DataFrame, fanout: int) -> DataFrame:
    """Parents of the groups that still have several nodes; slot columns hold the children's ``node`` structs."""
    slot = F.col("pos") % fanout
    slots = [F.max(F.when(slot == i, F.col("node"))).alias(f"c{i}") for i in range(fanout)]
    parents = (
        nodes.filter("n > 1")
        .groupBy("grp", "n", F.expr(f"pos div {fanout}").alias("pos"))
        .agg(*slots)
        .withColumn("n", F.expr(f"(n + {fanout - 1}) div {fanout}"))
    )
    digest = F.sha2(F.concat(*[F.coalesce(F.col(f"c{i}.hash"), F.lit("")) for i in range(fanout)]), 256)
    return parents.withColumn("hash", digest)


def _children(parents: DataFrame, fanout: int, carried: list[str]) -> DataFrame:
    """The children of ``parents`` with their paths: the slots beside the own one, then the parent's path."""
    digest = [F.coalesce(F.col(f"c{i}.hash"), F.lit("")) for i in range(fanout)]
    none = F.lit("")
    kids = F.array(
        *[
            F.struct(
                (F.col("pos") * fanout + i).alias("pos"),
                F.col(f"c{i}").alias("node"),
                F.struct(
                    F.concat(none, *digest[:i]).alias("left"), F.concat(none, *digest[i + 1 :]).alias("right")
                ).alias("step"),
            )
            for i in range(fanout)
        ]
    )
    return (
        parents.select("grp", *carried, "path", F.explode(kids).alias("kid"))
        .filter("kid.node is not null")
        .select(
            "grp", *carried, F.col("kid.pos").alias("pos"), F.col("kid.node").alias("node"),
            F.concat(F.array("kid.step"), "path").alias("path"),
        )
    )


def _levels(leaves: DataFrame, fanout: int) -> list[DataFrame]:
    """The pivots from the leaves up; each is written, as it is read on the way up and on the way down."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels: list[DataFrame] = []
    while most > 1:
        below = leaves
        if levels:
            below = levels[-1].select("grp", "n", "pos", F.struct("hash").alias("node"))
        levels.append(written(leaves.sparkSession, _pivot(below, fanout), f"level-{len(levels)}"))
        most = -(-most // fanout)
    return levels


def _roots(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(grp, hash): the last node of every group."""
    tops = leaves.filter("n = 1").select("grp", F.col("node.hash").alias("hash"))
    for level in levels:
        tops = tops.union(level.filter("n = 1").select("grp", "hash"))
    return tops


def _paths(leaves: DataFrame, levels: list[DataFrame], base: DataFrame, fanout: int) -> DataFrame:
    """``leaves`` with the path to the top; ``base`` has (grp, path and more) of every group's root."""
    carried = [c for c in base.columns if c not in ("grp", "path")]
    below: DataFrame | None = None
    for level in reversed(levels):
        whole = level.filter("n = 1").drop("pos").join(base, "grp").withColumn("pos", F.lit(0).cast("bigint"))
        keep = ["grp", "pos", *[f"c{i}" for i in range(fanout)], *carried, "path"]
        parents = whole.select(*keep)
        if below is not None:
            inner = level.filter("n > 1").join(below.drop("node"), ["grp", "pos"])
            parents = parents.union(inner.select(*keep))
        below = _children(parents, fanout, carried)
    lone = leaves.filter("n = 1").join(base, "grp").select("grp", *carried, "pos", "node", "path")
    return lone if below is None else below.union(lone)


def prove(
    df: DataFrame, id_col: str, group_col: str, leaf: Column, presented: Column | None = None, fanout: int = 3
) -> DataFrame:
    """One row per row of ``df``: id, leaf, presented, subroot, root and path.

    ``leaf`` is the row's digest; ``presented`` that of the row as it is now,
    where it may have changed since (null: as it was). ``path`` has an entry
    for each level up to the root, with the sibling digests on both sides.
    """
    if fanout < 2:
        raise ValueError("a parent needs at least two slots")
    spark = df.sparkSession
    group = col(group_col).cast("string")
    rows = df.select(
        # Sorts as the group does, bytewise, with null first.
        F.coalesce(F.concat(F.lit("1"), group), F.lit("0")).alias("grp"),
        col(id_col).alias("id"),
        leaf.alias("hash"),
        (F.lit(None).cast("string") if presented is None else presented).alias("presented"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = written(spark, rows, "leaves")
    leaves = numbered(rows, "grp", ["id", "hash", "row"])
    leaves = leaves.select("grp", "n", "pos", F.struct("hash", "id", "presented").alias("node"))
    leaves = written(spark, leaves, "numbered")
    levels = _levels(leaves, fanout)
    tops = written(spark, _roots(leaves, levels), "subroots")

    groups = numbered(tops.select(F.lit("").alias("all"), "grp", "hash"), "all", ["grp"])
    groups = groups.select(F.col("all").alias("grp"), "n", "pos", F.struct("hash", F.col("grp").alias("of")).alias("node"))
    groups = written(spark, groups, "groups")
    over = _levels(groups, fanout)
    start = _roots(groups, over).select(
        "grp", F.col("hash").alias("root"), F.array().cast(f"array<{STEP}>").alias("path")
    )
    base = _paths(groups, over, start, fanout).select(
        F.col("node.of").alias("grp"), F.col("node.hash").alias("subroot"), "root", "path"
    )
    base = written(spark, base, "group-paths")
    return _paths(leaves, levels, base, fanout).select(
        "node.id", F.col("node.hash").alias("leaf"), "node.presented", "subroot", "root", "path"
    )
