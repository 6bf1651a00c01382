"""Merkle manifest against a plain recursive version, proofs, and odd input."""

import hashlib

import pytest
from pyspark.sql import functions as F

from landfall.llm import merkle

H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()
SCHEMA = "doc_id bigint, source string, text string, path string, pos int, grp string, n int, hash string"


def plain_tree(digests, fanout):
    """(root, siblings of each leaf, level by level)."""
    level, paths, at = list(digests), [[] for _ in digests], list(range(len(digests)))
    while len(level) > 1:
        for i, p in enumerate(at):
            run = range(p // fanout * fanout, min(len(level), p // fanout * fanout + fanout))
            paths[i].append(("".join(level[j] for j in run if j < p), "".join(level[j] for j in run if j > p)))
            at[i] = p // fanout
        level = [H(*level[i : i + fanout]) for i in range(0, len(level), fanout)]
    return level[0], paths


def plain_manifest(rows, fanout):
    """rows: (id, group, digest) -> sorted (id, digest, subroot, root, path)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    order = lambda r: (r[0] is not None, r[0] or 0, r[2])
    trees = {g: (sorted(groups[g], key=order), *plain_tree([r[2] for r in sorted(groups[g], key=order)], fanout)) for g in names}
    root, above = plain_tree([trees[g][1] for g in names], fanout)
    out = []
    for g, up in zip(names, above):
        members, subroot, paths = trees[g]
        out += [(i, h, subroot, root, tuple(p + up)) for (i, _, h), p in zip(members, paths)]
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 7, "y", 1, "z") for r in rows], SCHEMA)


def digest(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


ROWS = [(i, "abc"[i % 3 if i < 60 else 0], f"text é\n{i}") for i in range(100)]
ODD = [(1, None, "x"), (1, None, "x"), (None, None, None), (None, "a", ""), (2, "", "long " * 100_000), (2, "", None), (3, "ß", "t"), (3, "Z", "t")]


@pytest.mark.parametrize("rows, fanout", [(ROWS, 3), (ROWS, 2), (ROWS + ODD, 5), (ODD, 3), (ODD[:1], 3), (ROWS[:3], 3)])
def test_proofs_equal_a_plain_tree(spark, rows, fanout):
    leaf = merkle.record_digest(F.col("doc_id"), F.col("source"), F.col("text"))
    got = merkle.prove(frame(spark, rows), "doc_id", "source", leaf, fanout=fanout)
    got = got.withColumn("folded", merkle.fold(F.col("leaf"), F.col("path")))
    got = got.withColumn("proof", merkle.siblings(F.col("path"))).collect()
    want = plain_manifest([(r[0], r[1], digest(r)) for r in rows], fanout)
    assert sorted(((r.id, r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.path)) for r in got), key=repr) == [
        (*w[:4], tuple(w[4])) for w in want
    ]
    assert all(r.folded == r.root for r in got)
    assert all(r.proof == "".join(a + b for a, b in ((s.left, s.right) for s in r.path)) for r in got)


def test_changed_rows_do_not_verify(spark):
    df = frame(spark, ROWS)
    leaf = lambda text: merkle.record_digest(F.col("doc_id"), F.col("source"), text)
    now = F.when(F.col("doc_id") % 10 == 0, leaf(F.concat("text", F.lit("!"))))
    got = merkle.prove(df, "doc_id", "source", leaf(F.col("text")), now)
    ok = merkle.fold(F.coalesce("presented", "leaf"), F.col("path")) == F.col("root")
    assert {r.id for r in got.filter(~ok).collect()} == set(range(0, 100, 10))


def test_empty_table(spark):
    got = merkle.prove(frame(spark, ROWS).limit(0), "doc_id", "source", merkle.record_digest(F.col("text")))
    assert got.count() == 0 and got.columns == ["id", "leaf", "presented", "subroot", "root", "path"]


def test_large_group_is_numbered_in_ranges(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("grp"),
        (5000 - F.col("id")).alias("id"),
    )
    got = merkle.numbered(rows, "grp", ["id"]).collect()
    hot = sorted((r.id, r.pos, r.n) for r in got if r.grp == "hot")
    assert [x[1] for x in hot] == list(range(len(hot))) and {x[2] for x in hot} == {len(hot)}
    assert all(r.pos == 0 and r.n == 1 for r in got if r.grp != "hot")
