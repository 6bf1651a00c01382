"""Embedding near-duplicates by a forest of random-projection trees.

A tree splits the vectors by random directions: a node's rows are cut at the
median of their projections, and the rows around the median go to both sides
(spill overlap), so that few close pairs are cut apart. Trees are fitted on
bounded hashed samples of a node's rows; then every row is routed. A node that
is still large gets a tree of its own in the next round. Every row lies in
leaves of several trees; vectors are compared within leaves, links are
verified in double precision on the original vectors and united to components.

Dense clusters would be cut by every median. A node whose sample shows one is
carved instead: rows within the cluster's reach of its centre make a leaf, all
but the cluster's inside go on, and no pair is lost. Rows within half the
threshold's angle of the centre (a ball) are linked with each other by the
triangle inequality; they are counted, not compared. Leaves beyond ``block``
rows are compared in pairs of blocks, whole; only rows outside the leaf's
largest ball need blocks in pairs, so a cluster that holds a third of all rows
costs its size, not its square.

A pair may share several leaves; it is compared and counted in the smallest of
them, so counts need no table of pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing, nor do vectors of unequal lengths; rows are
vectors of their own even if ids or whole rows repeat; a null id counts as
larger than any other (a component of null ids has a null id); an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.common import col, written
from landfall.llm.jaccard import components


@dataclass(frozen=True)
class Forest:
    """Rows a leaf should have, rows sampled to fit a node's tree and those of its smallest sampled leaf, share of
    a node's rows that spills to both sides, rows of a block and of a routing task, and the share of close pairs that
    all trees may miss, from which their number follows."""

    leaf: int = 512
    sample: int = 16384
    least: int = 24
    spill: float = 0.1
    block: int = 2048
    chunk: int = 8192
    missed: float = 0.002
    cut: float = 0.035
    seed: int = 5

    def trees(self, rows: int) -> int:
        """Enough trees for the depth: a split cuts a close pair apart with a chance of about ``cut``."""
        depth = max(0.0, math.log(max(rows, 1) / self.leaf) / -math.log(0.5 + self.spill / 2))
        lost = 1 - (1 - self.cut) ** depth
        return 1 if depth == 0 else max(3, math.ceil(math.log(self.missed) / math.log(max(lost, 1e-9))))


SPLIT, CARVE, LEAF, BALL = 0, 1, 2, 3
NODE = np.dtype([("kind", "<i4"), ("left", "<i4"), ("right", "<i4"), ("low", "<f8"), ("high", "<f8")])


class Tree:
    """Nodes and, for each, its direction or centre."""

    def __init__(self, nodes: np.ndarray, vectors: np.ndarray) -> None:
        self.nodes, self.vectors = nodes, vectors

    def pack(self) -> bytes:
        return np.int32(len(self.nodes)).tobytes() + self.nodes.tobytes() + self.vectors.astype("<f8").tobytes()

    @classmethod
    def unpack(cls, data: bytes) -> Tree:
        n = int(np.frombuffer(data, "<i4", 1)[0])
        nodes = np.frombuffer(data, NODE, n, 4)
        return cls(nodes, np.frombuffer(data, "<f8", offset=4 + nodes.nbytes).reshape(n, -1))

    def route(self, units: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, leaf, inside the leaf's ball) of every place of every row."""
        found, half = [], _half(threshold)
        stack = [(0, np.arange(len(units)))]
        while stack:
            at, rows = stack.pop()
            if not len(rows):
                continue
            node = self.nodes[at]
            kind = node["kind"]
            if kind == LEAF:
                found.append((rows, at, np.zeros(len(rows), bool)))
                continue
            p = units[rows] @ self.vectors[at]
            if kind == BALL:
                found.append((rows, at, p >= half))
            else:
                # Split: below the upper and above the lower bound. Carve: not inside, and near.
                stack += [(int(node["left"]), rows[p <= node["high"]]), (int(node["right"]), rows[p >= node["low"]])]
        if not found:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0, bool)
        return (
            np.concatenate([r for r, _, _ in found]),
            np.concatenate([np.full(len(r), at) for r, at, _ in found]),
            np.concatenate([b for _, _, b in found]),
        )


def _half(threshold: float) -> float:
    """Cosine of half the threshold's angle, a little more, so that two such rows surely link."""
    return math.cos(math.acos(threshold) / 2) + 1e-7


def fit(units: np.ndarray, stop: int, threshold: float, how: Forest, seed: int) -> Tree:
    """A tree over the sampled unit vectors; nodes of at most ``stop`` of them are leaves."""
    rng = np.random.default_rng(seed)
    angle = math.acos(threshold)
    inner, reach = threshold, math.cos(min(2 * angle, math.pi)) - 1e-9
    kinds: list[tuple] = []
    vectors: list[np.ndarray] = []
    zero = np.zeros(units.shape[1])

    def dense(x: np.ndarray) -> np.ndarray | None:
        """The centre of a cluster that holds a tenth of the rows and stands apart from the others."""
        best, most = None, 0
        for p in x[rng.integers(len(x), size=32)]:
            close = x[x @ p >= threshold]
            if len(close) > max(most, len(x) // 10):
                mean = close.mean(0)
                best, most = mean / np.linalg.norm(mean), len(close)
        if best is None:
            return None
        c = x @ best
        inside, shell = np.count_nonzero(c > inner), np.count_nonzero((c <= inner) & (c >= reach))
        return best if inside > len(x) // 10 and shell <= inside // 2 else None

    stack = [(np.arange(len(units)), -1, "")]
    while stack:
        rows, parent, side = stack.pop()
        at = len(kinds)
        if parent >= 0:
            kinds[parent][side] = at
        x = units[rows]
        node = {"kind": LEAF, "left": -1, "right": -1, "low": 0.0, "high": 0.0}
        kinds.append(node)
        vectors.append(zero)
        if side == "right" and kinds[parent]["kind"] == CARVE:
            node["kind"], vectors[at] = BALL, vectors[parent]
            continue
        # A tight node is one cluster: its rows have to be compared, and splits would only cut pairs apart.
        if len(rows) <= stop or float(np.square(x.mean(0)).sum()) > 0.8:
            continue
        centre = dense(x)
        if centre is not None:
            c = x @ centre
            node |= {"kind": CARVE, "low": reach, "high": inner}
            vectors[at] = centre
            stack += [(rows[c <= inner], at, "left"), (rows[c >= reach], at, "right")]
            continue
        direction = rng.standard_normal(units.shape[1])
        p = x @ direction
        low, high = np.quantile(p, [0.5 - how.spill / 2, 0.5 + how.spill / 2])
        left, right = rows[p <= high], rows[p >= low]
        if max(len(left), len(right)) > 0.9 * len(rows):
            continue
        node |= {"kind": SPLIT, "low": float(low), "high": float(high)}
        vectors[at] = direction
        stack += [(left, at, "left"), (right, at, "right")]
    nodes = np.array([tuple(k[f] for f in NODE.names) for k in kinds], NODE)
    return Tree(nodes, np.array(vectors))


def _matrix(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(values), -1)


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)  # so that no square overflows
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def _fit(threshold: float, how: Forest):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        node, rows = key[0].as_py(), table.column("rows")[0].as_py()
        stop = max(how.least, math.ceil(len(table) * how.leaf / rows))
        tree = fit(unit(_matrix(table.column("vector"))), stop, threshold, how, (node ^ how.seed) & 0x7FFFFFFF)
        return pa.table({"node": pa.array([node], pa.int64()), "tree": pa.array([tree.pack()], pa.binary())})

    return run


def _mixed(node: int, leaf: np.ndarray) -> np.ndarray:
    """A 64-bit name of each leaf of a node's tree."""
    x = (leaf.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(node & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


def _route(threshold: float):
    def run(key: tuple, rows: pa.Table, trees: pa.Table) -> pa.Table:
        node = key[0].as_py()
        if not len(rows):
            at = ball = final = np.zeros(0, bool)
            leaf = np.zeros(0, np.int64)
            at = np.zeros(0, np.int64)
        else:
            tree = Tree.unpack(trees.column("tree")[0].as_py())
            at, places, ball = tree.route(unit(_matrix(rows.column("vector"))), threshold)
            leaf = _mixed(node, places)
            # What is a leaf because it is dense stays one, as does a tree that could not split.
            final = (tree.nodes["kind"][places] == BALL) | (len(tree.nodes) == 1)
        return pa.table(
            {
                "row": rows.column("row").take(pa.array(at)),
                "node": pa.array(leaf, pa.int64()),
                "vector": rows.column("vector").take(pa.array(at)),
                "ball": pa.array(ball, pa.bool_()),
                "final": pa.array(final, pa.bool_()),
            }
        )

    return run


def grow(vectors: DataFrame, threshold: float, how: Forest) -> DataFrame:
    """(row, node, ball): the leaves of each of ``vectors`` (row, size, vector), and whether it lies in a leaf's ball."""
    spark = vectors.sparkSession
    n_trees = how.trees(vectors.count())
    planted = vectors.withColumn("tree", F.explode(F.sequence(F.lit(1), F.lit(n_trees))))
    no = F.lit(False)
    open_ = planted.select("row", "vector", no.alias("ball"), no.alias("final"), F.xxhash64("size", "tree").alias("node"))
    kind = vectors.schema["vector"].dataType
    schema = T.StructType(
        [
            T.StructField("row", T.LongType()),
            T.StructField("node", T.LongType()),
            T.StructField("vector", kind),
            T.StructField("ball", T.BooleanType()),
            T.StructField("final", T.BooleanType()),
        ]
    )
    leaves: list[DataFrame] = []
    while True:
        sizes = open_.groupBy("node").agg(F.count("*").alias("rows"), F.max("final").alias("done"))
        sizes = written(spark, sizes, "nodes")
        large = sizes.filter((F.col("rows") > 2 * how.leaf) & ~F.col("done")).select("node", "rows")
        if large.isEmpty():
            return _union([*leaves, open_.select("row", "node", "ball")])
        small = sizes.join(large, "node", "left_anti").select("node")
        leaves.append(written(spark, open_.join(small, "node").select("row", "node", "ball"), "leaves"))
        rows = open_.join(large, "node")
        # A row is in a node's sample by its hash, so the sample is bounded in the mean and spread evenly.
        chance = F.pmod(F.xxhash64("row", "node"), F.lit(1 << 30)) / float(1 << 30)
        sampled = rows.filter(chance < how.sample / F.col("rows")).select("node", "rows", "vector")
        trees = sampled.groupBy("node").applyInArrow(_fit(threshold, how), "node bigint, tree binary")
        trees = written(spark, trees, "trees")
        pieces = F.ceil(F.col("rows") / how.chunk).cast("int")
        dealt = rows.withColumn("piece", F.pmod(F.xxhash64("row"), pieces).cast("int"))
        copies = trees.join(large, "node").withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
        routed = (
            dealt.select("node", "piece", "row", "vector")
            .groupBy("node", "piece")
            .cogroup(copies.select("node", "piece", "tree").groupBy("node", "piece"))
            .applyInArrow(_route(threshold), schema)
        )
        open_ = written(spark, routed, "routed")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# -- comparing within leaves --------------------------------------------------


def _first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest name that rows of ``a`` and ``b`` have in common (rows sorted, padded with distinct values)."""
    best = np.full(len(a), np.iinfo(np.int64).max)
    for i in range(a.shape[1]):
        hit = (b == a[:, i, None]).any(1)
        best = np.where(hit, np.minimum(best, a[:, i]), best)
    return best


def _padded(lists: list[np.ndarray], filler: int) -> np.ndarray:
    out = np.full((len(lists), max(map(len, lists))), filler, np.int64)
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row pair; the sum's order doesn't depend on the pair's place."""
    return np.einsum("ij,ij->i", a, b)


def compare(
    units: np.ndarray, sides: np.ndarray, settled: np.ndarray, balls: np.ndarray, nodes: list[np.ndarray], leaf: int,
    threshold: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of one task that link: not of one ball, of different sides if there are two, in their smallest leaf."""
    a_side = np.flatnonzero(~settled & (sides == 0))
    b_side = np.arange(len(units)) if not sides.any() else np.flatnonzero(sides == 1)
    left, right = [], []
    for at in range(0, len(a_side), 512):
        rows = a_side[at : at + 512]
        x, y = np.nonzero(units[rows] @ units[b_side].T >= threshold - 1e-9)
        x, y = rows[x], b_side[y]
        # Of two rows that both seek, the pair comes up twice.
        once = (x != y) & ((x < y) | settled[y] | (sides[x] != sides[y]))
        apart = (balls[x] != balls[y]) | (balls[x] == -1)
        x, y = x[once & apart], y[once & apart]
        good = cosines(units[x], units[y]) >= threshold
        left.append(x[good])
        right.append(y[good])
    x, y = (np.concatenate(p) if p else np.zeros(0, int) for p in (left, right))
    if len(x):
        a, b = _padded(nodes, -1), _padded(nodes, -2)
        own = np.concatenate(
            [_first_shared(a[x[i : i + 65536]], b[y[i : i + 65536]]) == leaf for i in range(0, len(x), 65536)]
        )
        x, y = x[own], y[own]
    return x, y


def _stars(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest row of each row's component under the pairs."""
    parent = list(range(n))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in zip(x.tolist(), y.tolist(), strict=True):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(n)])


def _compare(threshold: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        leaf = key[0].as_py()
        rows = table.column("row").to_numpy()
        order = np.argsort(rows, kind="stable")
        table, rows = table.take(pa.array(order)), rows[order]
        sides = (table.column("side").to_numpy() != key[1].as_py()).astype(int)
        nodes = [np.array(x) for x in table.column("nodes").to_pylist()]
        settled = table.column("settled").to_numpy(zero_copy_only=False)
        balls = table.column("ball_of").to_numpy()
        x, y = compare(unit(_matrix(table.column("vector"))), sides, settled, balls, nodes, leaf, threshold)
        counts = np.bincount(x, minlength=len(rows)) + np.bincount(y, minlength=len(rows))
        roots = _stars(len(rows), x, y)
        hit = counts > 0
        return pa.table(
            {
                "row": pa.array(rows[hit], pa.int64()),
                "links": pa.array(counts[hit], pa.int64()),
                "star": pa.array(rows[roots][hit], pa.int64()),
            }
        )

    return run


def _compared(members: DataFrame, vectors: DataFrame, threshold: float, how: Forest) -> tuple[DataFrame, DataFrame]:
    """(links counted and stars by row of each task: row, links, star; rows of balls: row, ball_of)."""
    spark = vectors.sparkSession
    places = members.groupBy("row").agg(
        F.sort_array(F.collect_set("node")).alias("nodes"),  # no more than the trees and their spill
        F.min(F.when(F.col("ball"), F.col("node"))).alias("ball_of"),
    )
    places = written(spark, places, "places")
    in_leaf = places.select("row", "ball_of", F.explode("nodes").alias("node"))
    of_ball = in_leaf.groupBy("node", "ball_of").agg(F.count("*").alias("rows"))
    # A leaf's largest ball needs no pairs of its own; the other rows are compared with it and among themselves.
    blocks = lambda n: F.ceil(n / how.block).cast("int")
    leaves = of_ball.groupBy("node").agg(
        F.sum("rows").alias("all"),
        F.max(F.when(F.col("ball_of").isNotNull(), F.struct("rows", "ball_of"))).alias("top"),
    )
    seeking = F.col("all") - F.coalesce("top.rows", F.lit(0))
    leaves = leaves.filter((seeking > 0) & (F.col("all") > 1)).select(
        "node",
        F.col("top.ball_of").alias("top"),
        # One block takes all while they fit.
        F.when(F.col("all") <= how.block, 1).otherwise(blocks(seeking)).alias("open"),
        F.when(F.col("all") <= how.block, 0).otherwise(blocks(F.coalesce("top.rows", F.lit(0)))).alias("closed"),
    )
    leaves = written(spark, leaves, "tasks")
    settled = F.col("ball_of").eqNullSafe(F.col("top")) & F.col("top").isNotNull()
    hashed = F.xxhash64("row", "node")
    place = (
        F.when(~settled | (F.col("closed") == 0), F.pmod(hashed, F.col("open")))
        .otherwise(F.col("open") + F.pmod(hashed, F.greatest("closed", F.lit(1))))
        .cast("int")
    )
    last = F.col("open") + F.col("closed") - 1
    partners = F.when(F.col("side") < F.col("open"), F.sequence(F.lit(0), last)).otherwise(
        F.sequence(F.lit(0), F.col("open") - 1)
    )
    tasks = (
        in_leaf.join(leaves, "node")
        .withColumn("settled", settled)
        .withColumn("side", place)
        .withColumn("other", F.explode(partners))
        .select(
            "row", "node", "settled", "side",
            F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"),
        )
    )
    known = places.select("row", "nodes", F.coalesce("ball_of", F.lit(-1)).alias("ball_of")).join(
        vectors.select("row", "vector"), "row"
    )
    links = (
        tasks.join(known, "row")
        .groupBy("node", "low", "high")
        .applyInArrow(_compare(threshold), "row bigint, links bigint, star bigint")
    )
    return written(spark, links, "links"), places.filter("ball_of is not null").select("row", "ball_of")


def near_duplicates(
    df: DataFrame, id_col: str, vector_col: str, threshold: float = 0.95, how: Forest = Forest()
) -> DataFrame:
    """One row per row of ``df``: vec_id, n_links, component_id, kept (it is its component's smallest id)."""
    if not 0 < threshold < 1:
        raise ValueError("the threshold lies in (0, 1)")
    spark = df.sparkSession
    kind = df.schema[next(c for c in df.columns if c.lower() == vector_col.lower())].dataType
    if not isinstance(kind, T.ArrayType):
        raise ValueError(f"{vector_col} holds no arrays")
    plain = kind.elementType if isinstance(kind.elementType, T.FloatType) else T.DoubleType()
    x = col(vector_col).cast(T.ArrayType(plain))
    fine = F.coalesce(
        ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists(x, lambda v: v != 0),
        F.lit(False),
    )
    rows = df.select(
        F.monotonically_increasing_id().alias("row"), col(id_col).alias("id"), F.when(fine, x).alias("vector")
    )
    rows = written(spark, rows, "rows")
    vectors = rows.filter("vector is not null").select("row", F.size("vector").alias("size"), "vector")
    members = grow(vectors, threshold, how)
    links, balls = _compared(members, vectors, threshold, how)

    sizes = balls.groupBy("ball_of").agg(F.count("*").alias("rows"), F.min("row").alias("star"))
    sizes = written(spark, sizes, "balls")
    in_ball = balls.join(sizes, "ball_of").select("row", (F.col("rows") - 1).alias("links"), "star")
    in_ball = written(spark, in_ball, "in-balls")
    linked = links.unionByName(in_ball)
    counts = written(spark, linked.groupBy("row").agg(F.sum("links").alias("n_links")), "counts")
    roots = components(spark, linked.select(F.col("row").alias("a"), F.col("star").alias("b")))
    placed = (
        rows.select("row", "id")
        .join(counts, "row", "left")
        .join(roots.withColumnRenamed("node", "row"), "row", "left")
        .select("id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), "root")
    )
    placed = written(spark, placed, "placed")
    least = placed.filter("root is not null").groupBy("root").agg(F.min("id").alias("component_id"))
    least = written(spark, least, "least")
    inside = placed.filter("root is not null").join(least, "root").select("id", "n_links", "component_id")
    alone = placed.filter("root is null").select("id", "n_links", F.col("id").alias("component_id"))
    return inside.union(alone).select(
        F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
