"""Exact duplicates: full byte strings in Patricia tries, one owner per text.

Texts are equal when their UTF-8 bytes are identical after lower-casing A-Z.
Rows are partitioned by byte length and one byte of a content hash, and a task
inserts the full strings of its partitions into one compressed radix trie,
whose nodes branch where texts part. Terminal nodes hold the owning row and the
number of copies.

Memory: a trie has a byte budget. Between two partitions of the sorted input a
trie over half of it is written out whole, as its texts are complete. If a
partition alone passes the budget, the heaviest subtrees that hold no closed
node leave the trie: what they hold, and every later row below them, goes to a
table in the shared folder, marked with its subtree. The next round takes each
subtree by itself, in a trie of its own with the same budget. A subtree is cut
below the first branching node, so it holds fewer texts than its trie and the
rounds end. A single text must fit in memory.

Skew: each map batch first collapses its own equal texts into one row with a
count, so a text that makes up a third of all rows reaches its owner as one
row per batch. The way back from owners to members is a join that carries
fixed-size rows only and whose hot keys Spark may split.

Defined cases: null text counts as empty; empty texts equal each other; a
null id loses against any id; of rows with the same id and text one stays;
an empty table gives an empty result; other columns, whatever their names,
are carried (``drop_copies``) or ignored (``duplicate_classes``).
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.common import col, written

#: Bytes that a task's trie may take, its rows included.
TRIE_BYTES = 128 << 20
#: A node beside its label and its row: a list, a dict and their entries.
NODE_BYTES = 400
#: Rows and bytes of a batch that a task hands out.
OUT_ROWS, OUT_BYTES = 2000, 8 << 20


class PatriciaTrie:
    """A compressed radix trie over byte strings; each terminal keeps one value.

    A node is [edge label, children by first byte, value]. A closed node has no
    children (None) and its value names the subtree that left the trie there.
    ``size`` estimates the bytes held; who sets a value adds its bytes.
    """

    __slots__ = ("root", "size")

    def __init__(self) -> None:
        self.root: list = [b"", {}, None]
        self.size = 0

    def entry(self, key: bytes) -> list:
        """The terminal node of ``key``, made if missing, or the closed node on its way."""
        node, at = self.root, 0
        while at < len(key) and node[1] is not None:
            child = node[1].get(key[at])
            if child is None:
                child = node[1][key[at]] = [key[at:], {}, None]
                self.size += NODE_BYTES + len(key) - at
                return child
            label = child[0]
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            shared = len(os.path.commonprefix([label, key[at : at + len(label)]]))
            split = node[1][key[at]] = [label[:shared], {label[shared]: child}, None]
            child[0] = label[shared:]
            self.size += NODE_BYTES
            node, at = split, at + shared
        return node

    def terminals(self) -> Iterator[tuple[bytes, object]]:
        return _terminals(self.root, b"")

    def close(self, target: int) -> Iterator[tuple[int, Iterator[tuple[bytes, object]]]]:
        """Cut the heaviest subtrees until ``size`` is at most ``target``: (name, terminals) of each.

        A subtree lies below the first branching node and holds no closed node,
        so a string leaves by the same name however often the trie is cut.
        """
        nodes: list[tuple[list, int]] = [(self.root, -1)]
        for i, (node, _) in enumerate(nodes):
            nodes.extend((c, i) for c in (node[1] or {}).values())
        weight = [NODE_BYTES + len(n[0]) + (n[2].bytes if isinstance(n[2], _Owner) else 0) for n, _ in nodes]
        free = [n[1] is not None for n, _ in nodes]
        for i in range(len(nodes) - 1, 0, -1):
            up = nodes[i][1]
            weight[up] += weight[i]
            free[up] = free[up] and free[i]
        at, stem = 0, self.root
        while True:
            free[at] = False
            if stem[1] is None or len(stem[1]) != 1 or stem[2] is not None:
                break
            at, stem = next((j, n) for j, (n, up) in enumerate(nodes) if up == at)
        heads = [i for i in range(1, len(nodes)) if free[i] and not free[nodes[i][1]]]
        for i in sorted(heads, key=weight.__getitem__, reverse=True):
            if self.size <= target:
                return
            parts, j = [], i
            while j >= 0:
                parts.append(nodes[j][0][0])
                j = nodes[j][1]
            path, node = b"".join(reversed(parts)), nodes[i][0]
            name = int.from_bytes(hashlib.sha256(path).digest()[:8], "big", signed=True)
            below = [b"", node[1], node[2]]
            node[1:] = [None, name]
            self.size -= weight[i] - NODE_BYTES - len(node[0])
            yield name, _terminals(below, path)


def _terminals(node: list, path: bytes) -> Iterator[tuple[bytes, object]]:
    stack = [(path, node)]
    while stack:
        path, node = stack.pop()
        if node[1] is None:
            continue
        path += node[0]
        if node[2] is not None:
            yield path, node[2]
        stack.extend((path, c) for c in node[1].values())


class _Owner:
    """What a terminal keeps: the best row so far (a batch of one row) and the copies."""

    __slots__ = ("rank", "row", "copies", "digest")

    def __init__(self, rank: tuple, row: pa.RecordBatch, copies: int, digest: bytes) -> None:
        self.rank, self.row, self.copies, self.digest = rank, row, copies, digest

    @property
    def bytes(self) -> int:
        return NODE_BYTES + self.row.nbytes


def _collapse(keep: str):
    """Map side: one row per distinct text of a batch, with its best id and count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties = batch.column("id").to_pylist(), batch.column("tie").to_pylist()
            best: dict[bytes, list] = {}
            for i, text in enumerate(batch.column("text").to_pylist()):
                body = (text or "").encode().lower()
                rank = _rank(ids[i], ties[i], keep)
                got = best.get(body)
                if got is None:
                    best[body] = [rank, i, 1]
                else:
                    got[2] += 1
                    if rank > got[0]:
                        got[0], got[1] = rank, i
            digests = [hashlib.sha256(b).digest() for b in best]
            rows = batch.take(pa.array([v[1] for v in best.values()], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([len(b) for b in best], pa.int64()),
                    pa.array([d[0] for d in digests], pa.int64()),
                    pa.array([0] * len(digests), pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array([v[2] for v in best.values()], pa.int64()),
                    *rows.columns,
                ],
                names=["length", "prefix", "subtree", "digest", "copies", *rows.schema.names],
            )

    return run


def _rank(ident, tie, keep: str) -> tuple:
    """Ordering in which the greatest row stays."""
    if ident is None:
        return (0, 0, tie)
    return (1, ident if keep == "largest" else _Reversed(ident), tie)


class _Reversed:
    __slots__ = ("v",)

    def __init__(self, v) -> None:
        self.v = v

    def __eq__(self, other) -> bool:
        return self.v == other.v

    def __lt__(self, other) -> bool:
        return other.v < self.v

    def __gt__(self, other) -> bool:
        return other.v > self.v


def _own(keep: str, with_text: bool, budget: int):
    """Reduce side: tries over the rows of one task, sorted by partition (or subtree)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, current = PatriciaTrie(), None
        out = _Out(with_text)
        for batch in batches:
            parts = list(zip(*(batch.column(c).to_pylist() for c in ("length", "prefix", "subtree"))))
            ids, ties = batch.column("id").to_pylist(), batch.column("tie").to_pylist()
            digests, copies = batch.column("digest").to_pylist(), batch.column("copies").to_pylist()
            rows = batch.select([c for c in ("id", "tie", "rest", "text") if c in batch.schema.names and (with_text or c != "text")])
            for i, text in enumerate(batch.column("text").to_pylist()):
                # All rows of a subtree belong together, whatever their lengths.
                part = parts[i] if not parts[i][2] else parts[i][2]
                if part != current:
                    current = part
                    if trie.size > budget // 2:
                        yield from out.complete(trie)
                        trie = PatriciaTrie()
                key = (text or "").encode().lower()
                node, rank = trie.entry(key), _rank(ids[i], ties[i], keep)
                if node[1] is None:
                    row = rows.take(pa.array([i], pa.int64()))
                    yield from out.add(_Owner(rank, row, copies[i], digests[i]), node[2], key)
                    continue
                if node[2] is None:
                    node[2] = _Owner(rank, rows.take(pa.array([i], pa.int64())), copies[i], digests[i])
                    trie.size += node[2].bytes
                else:
                    node[2].copies += copies[i]
                    if rank > node[2].rank:
                        trie.size -= node[2].bytes
                        node[2].rank, node[2].row = rank, rows.take(pa.array([i], pa.int64()))
                        trie.size += node[2].bytes
                if trie.size > budget:
                    for name, left in trie.close(budget // 2):
                        for path, owner in left:
                            yield from out.add(owner, name, path)
        yield from out.complete(trie)
        yield from out.flush()

    return run


class _Out:
    """Owners on their way out: complete ones, and those of a subtree that goes to the next round."""

    def __init__(self, with_text: bool) -> None:
        self.with_text, self.held, self.bytes = with_text, [], 0

    def add(self, owner: _Owner, subtree: int | None, key: bytes) -> Iterator[pa.RecordBatch]:
        self.held.append((owner, subtree, None if subtree is None else key))
        self.bytes += owner.row.nbytes + (0 if subtree is None else len(key))
        if len(self.held) >= OUT_ROWS or self.bytes >= OUT_BYTES:
            yield from self.flush()

    def complete(self, trie: PatriciaTrie) -> Iterator[pa.RecordBatch]:
        digests = set()
        for _, owner in trie.terminals():
            if owner.digest in digests:
                raise ValueError("two different texts share a SHA-256 digest")
            digests.add(owner.digest)
            yield from self.add(owner, None, b"")

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        rows = pa.Table.from_batches([o.row for o, _, _ in self.held]).combine_chunks().to_batches()[0]
        names, keys = [n for _, n, _ in self.held], [k for _, _, k in self.held]
        columns = {c: rows.column(c) for c in rows.schema.names}
        if not self.with_text:
            columns["text"] = pa.array([None if k is None else k.decode() for k in keys], pa.string())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([0 if k is None else len(k) for k in keys], pa.int64()),
                pa.array([0] * len(keys), pa.int64()),
                pa.array([0 if n is None else n or 1 for n in names], pa.int64()),
                pa.array([n is not None for n in names], pa.bool_()),
                pa.array([o.digest for o, _, _ in self.held], pa.binary()),
                pa.array([o.copies for o, _, _ in self.held], pa.int64()),
                *columns.values(),
            ],
            names=["length", "prefix", "subtree", "open", "digest", "copies", *columns],
        )
        self.held, self.bytes = [], 0


def _owned(rows: DataFrame, keep: str, with_text: bool, budget: int) -> DataFrame:
    """digest, group_size and the columns of ``rows`` of each text's owner (``text`` only with ``with_text``)."""
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep is 'largest' or 'smallest', not {keep!r}")
    places = [T.StructField(c, T.LongType()) for c in ("length", "prefix", "subtree")]
    known = [T.StructField("digest", T.BinaryType()), T.StructField("copies", T.LongType())]
    before = T.StructType([*places, *known, *rows.schema.fields])
    carried = [T.StructField(f.name, f.dataType) for f in rows.schema.fields]  # text is left out of complete rows
    after = T.StructType([*places, T.StructField("open", T.BooleanType()), *known, *carried])
    by = ["length", "prefix"]
    todo, found = rows.mapInArrow(_collapse(keep), before), []
    while True:
        tries = todo.repartition(*by).sortWithinPartitions(*by).mapInArrow(_own(keep, with_text, budget), after)
        made = written(rows.sparkSession, tries, "tries")
        found.append(made.filter("not open"))
        todo, by = made.filter("open").drop("open"), ["subtree"]
        if todo.isEmpty():
            break
    return reduce(DataFrame.union, found).withColumnRenamed("copies", "group_size").drop("open", *by, "length", "prefix")


def drop_copies(
    df: DataFrame, id_col: str, text_col: str, keep: str = "largest", budget: int = TRIE_BYTES
) -> DataFrame:
    """The rows of ``df`` that stay: of equal texts the one with the largest (smallest) id.

    All columns are kept as they are. Of rows with the same id and text, the
    one whose other columns hash highest stays.
    """
    others = [c for c in df.columns if c != text_col]
    rest = F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(others)])
    rows = df.select(
        col(id_col).alias("id"),
        F.xxhash64(*[col(c) for c in others]).alias("tie"),
        rest.alias("rest"),
        col(text_col).alias("text"),
    )
    at = {c: f"rest.c{i}" for i, c in enumerate(others)}
    return _owned(rows, keep, True, budget).select(
        *[F.col(at[c]).alias(c) if c in at else F.col("text").alias(c) for c in df.columns]
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bodies = ((t or "").encode().lower() for t in batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array([hashlib.sha256(b).digest() for b in bodies], pa.binary())],
            names=["id", "digest"],
        )


def duplicate_classes(
    df: DataFrame, id_col: str, text_col: str, keep: str = "largest", budget: int = TRIE_BYTES
) -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = df.select(col(id_col).alias("id"), F.lit(0).cast("bigint").alias("tie"), col(text_col).alias("text"))
    owners = _owned(rows, keep, False, budget).select("digest", "group_size", F.col("id").alias("keep_id"))
    # Repeated (id, text) rows are counted here and dealt out again below, so that exactly one of them is kept.
    members = (
        rows.select("id", "text")
        .mapInArrow(_digests, T.StructType([rows.schema["id"], T.StructField("digest", T.BinaryType())]))
        .groupBy("id", "digest")
        .agg(F.count("*").alias("n"))
    )
    return (
        members.join(owners, "digest")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
        .select(
            F.col("id").alias("doc_id"),
            "keep_id",
            "group_size",
            (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )
