"""Near-duplicate vectors against all pairs, with tiny nodes so that every round, ball and block occurs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID

from landfall.llm import forest
from landfall.llm.forest import Forest

TINY = Forest(leaf=24, sample=400, least=8, block=40, chunk=64, missed=1e-4)
SCHEMA = "vec_id bigint, embedding array<double>, row bigint, node int, links string, ball_of bigint"


def plain(ids, vectors, threshold):
    """(id, links, component) of every row; None takes no part."""
    good = [i for i, v in enumerate(vectors) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    unit = {i: np.array(vectors[i]) / np.linalg.norm(vectors[i]) for i in good}
    near = {i: [j for j in good if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in good}
    out, seen = {}, {}
    for i in range(len(ids)):
        if i not in seen:
            todo, group = [i], set()
            while todo:
                x = todo.pop()
                if x not in group:
                    group.add(x)
                    todo += near.get(x, [])
            known = [ids[x] for x in group if ids[x] is not None]
            seen |= dict.fromkeys(group, min(known) if known else None)
        out[i] = (ids[i], len(near.get(i, [])), seen[i])
    return sorted(out.values(), key=repr)


def run(spark, ids, vectors, threshold=0.95, how=TINY):
    df = spark.createDataFrame([(i, v, 0, 0, "x", 1) for i, v in zip(ids, vectors, strict=True)], SCHEMA)
    rows = forest.near_duplicates(df.repartition(3), "vec_id", "embedding", threshold, how).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in rows), key=repr)


def cluster(rng, n, centre, noise):
    return centre + rng.standard_normal((n, len(centre))) * noise


def shuffled(rng, parts):
    v = np.concatenate(parts)
    return rng.permutation(v).tolist()


@pytest.mark.parametrize("noise", [0.01, 0.08])
def test_clusters_larger_than_leaves_and_blocks(spark, noise):
    """A ball of more rows than leaf and block, and one too wide to be a ball, keep every link."""
    rng = np.random.default_rng(3)
    base = rng.standard_normal((300, 16))
    parts = [base, cluster(rng, 150, base[0], noise * 3), *(cluster(rng, 3, b, 0.1) for b in base[1:40])]
    v = shuffled(rng, parts)
    ids = [int(x) for x in rng.permutation(len(v))]
    got, want = run(spark, ids, v), plain(ids, v, 0.95)
    links = sum(w[1] for w in want)
    assert links > 5000 and all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert sum(g[1] for g in got) >= 0.99 * links
    assert np.mean([g == w for g, w in zip(got, want, strict=True)]) > 0.97


def test_half_of_the_rows_are_equal(spark):
    rng = np.random.default_rng(4)
    hot = rng.standard_normal(8)
    v = shuffled(rng, [np.tile(hot, (200, 1)), np.tile(hot * 1e200, (2, 1)), rng.standard_normal((200, 8))])
    ids = list(range(len(v)))
    got = run(spark, ids, v)
    want = plain(ids, [(np.array(x) / np.abs(x).max()).tolist() for x in v], 0.95)
    assert sum(g != w for g, w in zip(got, want, strict=True)) <= 4


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = [[1.0, 0.0], [1.0, 0.01], [2.0, 0.0], None, [], [0.0, 0.0], [nan, 1.0], [1.0, inf], [1.0, None], [1.0, 0.0, 0.0], [0.0, 1.0]]
    ids = [5, 3, 3, 1, 2, 4, 6, 7, 8, 9, None]
    v += [[1.0, 0.0]]
    ids += [5]
    want = plain(ids, v, 0.95)
    assert run(spark, ids, v) == want
    assert (5, 3, 3) in want and (9, 0, 9) in want


def test_empty_table_and_bad_threshold(spark):
    assert run(spark, [], []) == []
    with pytest.raises(ValueError):
        run(spark, [1], [[1.0]], 1.5)


def test_trees_route_close_pairs_together():
    """Routing repeats what the fit decided, and a carved node loses no pair."""
    rng = np.random.default_rng(1)
    x = forest.unit(np.concatenate([rng.standard_normal((300, 16)), cluster(rng, 100, rng.standard_normal(16), 0.02)]))
    tree = forest.fit(x, 24, 0.95, TINY, 7)
    same = forest.Tree.unpack(tree.pack())
    assert (same.nodes == tree.nodes).all() and (same.vectors == tree.vectors).all()
    assert forest.BALL in tree.nodes["kind"]
    rows, leaves, balls = same.route(x, 0.95)
    assert set(rows) == set(range(400))
    for leaf in set(leaves[balls]):
        inside = rows[(leaves == leaf) & balls]
        assert (x[inside] @ x[inside].T).min() >= 0.95
    assert np.bincount(rows).max() <= 2 ** 4


def test_number_of_trees_follows_the_depth():
    how = Forest()
    assert how.trees(0) == how.trees(512) == 1
    assert 3 <= how.trees(50_000) <= how.trees(10**9) <= 12


def test_recall_on_all_pairs_of_the_table(spark):
    df = spark.read.parquet(f"{SF_MID}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    noisy = df.withColumn("embedding", F.transform("embedding", lambda x: x + (F.rand(5) - 0.5) * 0.08))
    both = df.union(noisy.select((F.col("vec_id") + 10_000).alias("vec_id"), "embedding")).collect()
    ids, v = [r.vec_id for r in both], [list(r.embedding) for r in both]
    got, want = run(spark, ids, v), plain(ids, v, 0.95)
    links = sum(w[1] for w in want)
    assert links > 500 and sum(g[1] for g in got) >= 0.98 * links
