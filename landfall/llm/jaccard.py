"""Similarity join on word shingles: signature trees over prefix-filter groups.

A document's set holds its distinct k-word shingles (64-bit hashes) after
lower-casing A-Z. Two sets link when their Jaccard similarity reaches the
threshold. The join is exact on the hashes; it returns connected components.
The words' hashes depend on a random key of the call, so no texts can be written
whose shingles share hashes; by chance two do with a probability of 2^-64.

1. Shingles are counted into a sketch of fixed size. What a bucket holds beyond
   the usual gives every task the same order of tokens, rare ones first.
2. Under one order, two linked sets share a token within their first
   n - ceil(t*n) + 1, and after the first one they share, enough tokens are left
   in both. Rows (token, size, place in its set's order, set) are sorted by token
   and size; a set goes to the owners of the sets before it that sizes and places
   let it link with, or owns those that follow. Near copies have nearly the same
   owners, so a set is sent to few owners, not to as many as it has tokens.
   Identical sets are one node.
3. An owner's sets meet in one task, or, when they are many, in tasks for pairs
   of hashed blocks. First only their token bitmaps are sent. A signature tree
   over those of one width holds, per node, the OR of its members' bitmaps, the
   range of sizes and the most tokens lost to shared bits; a dual traversal drops
   node pairs whose largest possible overlap is too small. What it leaves makes
   teams of sets; a team found by several owners counts once. Its sets are sent
   once more, with all their tokens: the same traversal then compares them
   exactly and passes over pairs already connected. Links leave as stars, never
   as all pairs. A bitmap of fixed size over the ids of those sets keeps nearly
   all other texts out of the shuffle that fetches theirs.
4. Components: smallest label over links with pointer jumping, each round
   written to the shared folder.

Defined cases: null or blank text has an empty set and no links; fewer than k
words give one shingle of them all; repeated rows share a component; a null id
is never a component's id while the component has another; an empty table
gives an empty result; other columns are ignored or (``drop_near_copies``)
kept.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.common import col, fresh, written

SKETCH_BITS = 20
SKETCH_PARTS = 256
#: An owner's sets are split into blocks of about so many sets and bytes.
BLOCK_SETS = 1024
BLOCK_BYTES = 32 << 20
FANOUT = 8
#: Up to so many rows of a token with sizes that could link are compared one by one.
WINDOW = 64
#: A place in a set's prefix is known to one of so many parts.
LEVELS = 8
FILTER_BITS = 23
#: Rows that a Python worker unpacks at once.
PIECE_ROWS = 512
WORD_CACHE = 400_000


class _Words(dict):
    """64-bit hashes of words under a key, remembered up to a bound."""

    def __init__(self, key: bytes) -> None:
        self.key = key

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        digest = blake2b(word, digest_size=8, key=self.key).digest()
        h = self[word] = int.from_bytes(digest, "little")
        return h


_words = _Words(b"")


def _words_of(key: bytes) -> _Words:
    """The worker's words under ``key``; those of another call are dropped."""
    global _words
    if _words.key != key:
        _words = _Words(key)
    return _words


_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(32)


def shingle_set(text: str | None, k: int, key: bytes) -> np.ndarray:
    """The sorted distinct hashes of a text's k-word shingles under ``key``."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_words_of(key).__getitem__, words), np.uint64, len(words))
    k = min(k, len(h))
    acc = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        acc = (acc ^ h[j : j + len(acc)]) * _MULT
        acc ^= acc >> _SHIFT
        acc *= _MIX
    acc ^= acc >> _SHIFT
    return np.unique(acc)


def prefix_length(n: int, num: int, den: int) -> int:
    return n - -(-num * n // den) + 1


def _set_id(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of PIECE_ROWS, so that few texts and sets are unpacked at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, PIECE_ROWS):
            yield batch.slice(at, PIECE_ROWS)


# -- sketch -------------------------------------------------------------------


def _count(k: int, key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(1 << SKETCH_BITS, np.int64), False
        for batch in _pieces(batches):
            for text in batch.column("text").to_pylist():
                np.add.at(counts, (shingle_set(text, k, key) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
                seen = True
        if seen:
            parts = np.split(counts, SKETCH_PARTS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(SKETCH_PARTS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
                names=["part", "counts"],
            )

    return run


def _total(key: tuple, table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c.as_py(), np.int64) for c in table.column("counts"))
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def frequency_classes(docs: DataFrame, k: int, key: bytes) -> np.ndarray:
    """For each sketch bucket the log2 of what its shingles' count over all documents exceeds the usual by.

    With more shingles than buckets, most counts are the usual one and its noise.
    """
    kind = "part int, counts binary"
    sums = (
        docs.mapInArrow(_count(k, key), kind)
        .withColumn("salt", F.spark_partition_id() % 64)
        .groupBy("part", "salt")
        .applyInArrow(_total, kind)
        .groupBy("part")
        .applyInArrow(_total, kind)
    )
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    width = len(counts) // SKETCH_PARTS
    for row in sums.collect():  # SKETCH_PARTS rows of fixed size
        counts[row["part"] * width : (row["part"] + 1) * width] = np.frombuffer(row["counts"], np.int64)
    usual = float(np.median(counts))
    return np.log2(np.maximum(counts - usual - 3 * usual**0.5, 0) + 1).astype(np.uint8)


# -- members and prefixes -----------------------------------------------------


def _members(k: int, num: int, den: int, classes: np.ndarray, key: bytes):
    """Per row its set's id and size; with a set's first row in a task, its prefix and bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[bytes] = set()
        for batch in _pieces(batches):
            ids, sizes, prefixes, bits = [], [], [], []
            for text in batch.column("text").to_pylist():
                tokens = shingle_set(text, k, key)
                ident = _set_id(tokens)
                ids.append(ident)
                sizes.append(len(tokens))
                if not len(tokens) or ident in told:
                    prefixes.append([])
                    bits.append(None)
                    continue
                if len(told) > 200_000:
                    told.clear()
                told.add(ident)
                rank = classes[(tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                order = np.lexsort((tokens, rank))[: prefix_length(len(tokens), num, den)]
                prefixes.append(tokens[order].view(np.int64))
                bits.append(bitmap(tokens))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(ids, pa.binary()),
                    pa.array([int.from_bytes(i[:8], "little", signed=True) for i in ids], pa.int64()),
                    pa.array(sizes, pa.int32()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                    pa.array(bits, pa.binary()),
                ],
                names=["id", "sid", "key", "size", "prefix", "bits"],
            )

    return run


def _owners(num: int, den: int):
    """Rows sorted by (token, size, key) to (owner, key, size) rows of sets that could link.

    ``place`` is LEVELS times the size and, below that, the token's place in the
    prefix. At the first token two sets share, no more than the tokens from there
    on are common: both must have enough left for the threshold.
    """

    def left(size: int, level: int) -> int:
        prefix = prefix_length(size, num, den)
        return size + (-level * prefix // LEVELS)  # minus the least place of the level

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = last = wide = None
        window: list[list] = []  # [key, size, tokens left, owner, whether it was sent there]
        both = num + den
        for batch in batches:
            tokens = batch.column("token").to_numpy()
            # Rows whose neighbours have other tokens can't meet any.
            near = np.ones(len(tokens), bool)
            if len(tokens) > 2:
                near[1:-1] = (tokens[1:-1] == tokens[:-2]) | (tokens[1:-1] == tokens[2:])
            places = batch.column("place").to_numpy()[near].tolist()
            keys = batch.column("key").to_numpy()[near].tolist()
            out = []
            for t, place, key in zip(tokens[near].tolist(), places, keys, strict=True):
                if t != token:
                    token, window, wide, last = t, [], None, None
                elif key == last:
                    continue
                last = key
                n = place // LEVELS
                if window and den * window[0][1] < num * n:
                    window = [x for x in window if den * x[1] >= num * n]
                if not window:
                    wide = None
                if wide is None and len(window) >= WINDOW:
                    wide = window[0][3]
                    for x in window:
                        out.append((wide, x[0], x[1]))
                if wide is not None:  # too many to compare: all go to one owner while sizes follow closely
                    out.append((wide, key, n))
                    window = [[key, n, n, wide, True]]
                    continue
                rest = left(n, place % LEVELS)
                row = [key, n, rest, key, False]
                for x in window:
                    least = num * (x[1] + n)
                    if both * rest >= least and both * x[2] >= least:
                        if not x[4]:
                            out.append((x[3], x[0], x[1]))
                            x[4] = True
                        out.append((x[3], key, n))
                        if not row[4]:
                            row[3], row[4] = x[3], True
                window.append(row)
            if out:
                cols = zip(*dict.fromkeys(out), strict=True)
                kinds = (pa.int64(), pa.int64(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(cols, kinds, strict=True)], names=["owner", "key", "size"]
                )

    return run


# -- signature tree -----------------------------------------------------------


class _Node:
    __slots__ = ("bits", "low", "high", "lost", "children", "docs", "one")

    def __init__(self, children: list, docs: list[int]) -> None:
        self.children, self.docs, self.one = children, docs, False


def bitmap_width(size: int) -> int:
    """The power of two at or above twice the size, from 256 to 32768."""
    return min(1 << 15, max(256, 1 << (2 * size - 1).bit_length()))


def bitmap(tokens: np.ndarray) -> bytes:
    """Bit i is set if some token is i modulo the width."""
    flags = np.zeros(bitmap_width(len(tokens)), np.uint8)
    flags[(tokens & np.uint64(len(flags) - 1)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def _folded(bits: bytes, width: int) -> int:
    """A bitmap at a smaller width."""
    n, value = len(bits) * 8, int.from_bytes(bits, "little")
    while n > width:
        n //= 2
        value = value >> n | value & ((1 << n) - 1)
    return value


def build_tree(bits: dict[int, int], sizes: list[int], order: list[int]) -> _Node:
    """Bottom up: documents in ``order`` in leaves of FANOUT, nodes of FANOUT above them."""
    level = []
    for at in range(0, len(order), FANOUT):
        node = _Node([], order[at : at + FANOUT])
        node.bits = 0
        for d in node.docs:
            node.bits |= bits[d]
        node.low, node.high = min(sizes[d] for d in node.docs), max(sizes[d] for d in node.docs)
        node.lost = max(sizes[d] - bits[d].bit_count() for d in node.docs)
        level.append(node)
    while len(level) > 1:
        above = []
        for at in range(0, len(level), FANOUT):
            node = _Node(level[at : at + FANOUT], [])
            node.bits = 0
            for c in node.children:
                node.bits |= c.bits
            node.low, node.high = min(c.low for c in node.children), max(c.high for c in node.children)
            node.lost = max(c.lost for c in node.children)
            above.append(node)
        level = above
    return level[0]


class _Join:
    """Dual traversal of signature trees, one for each width of bitmaps; ``pair`` sees what it can't rule out.

    Sets whose bitmaps differ in width are compared at the smaller of the two,
    not at the smallest of all, where larger sets would fill every bit.
    """

    def __init__(self, bitmaps: list[bytes], sizes: list[int], num: int, den: int, sides: list[int] | None) -> None:
        self.bitmaps, self.sizes, self.num, self.den, self.sides = bitmaps, sizes, num, den, sides
        self.bits: dict[int, int] = {}

    def possible(self, low_a: int, high_a: int, low_b: int, high_b: int, overlap: int) -> bool:
        num, den = self.num, self.den
        return (
            den * high_a >= num * low_b
            and den * high_b >= num * low_a
            and (den + num) * overlap >= num * (low_a + low_b)
        )

    def decided(self, a: _Node, b: _Node) -> bool:
        """Whether no pair of the two nodes' sets needs a look any more."""
        raise NotImplementedError

    def pair(self, x: int, y: int) -> None:
        raise NotImplementedError

    def settled(self, x: int, y: int) -> bool:
        raise NotImplementedError

    def _compare(self, x: int, y: int) -> None:
        if self.sides is not None and self.sides[x] == self.sides[y] or self.settled(x, y):
            return
        bits, sizes = self.bits, self.sizes
        lost = min(sizes[x] - bits[x].bit_count(), sizes[y] - bits[y].bit_count())
        if self.possible(sizes[x], sizes[x], sizes[y], sizes[y], (bits[x] & bits[y]).bit_count() + lost):
            self.pair(x, y)

    def run(self) -> None:
        sizes, widths = self.sizes, {}
        for i, n in enumerate(sizes):
            if n:
                widths.setdefault(len(self.bitmaps[i]) * 8, []).append(i)
        for width in sorted(widths):
            here = widths[width]
            own = {i: int.from_bytes(self.bitmaps[i], "little") for i in here}
            if len(here) > 1:
                self.bits = own
                root = self._tree(here)
                self._meet(root, root)
            most = self.den * max(sizes[i] for i in here)
            for wider in sorted(w for w in widths if w > width):
                far = [i for i in widths[wider] if most >= self.num * sizes[i]]
                if not far:
                    continue
                least = self.num * min(sizes[i] for i in far)
                close = [i for i in here if self.den * sizes[i] >= least]
                self.bits = {i: own[i] for i in close} | {i: _folded(self.bitmaps[i], width) for i in far}
                self._meet(self._tree(close), self._tree(far))

    def _tree(self, sets: list[int]) -> _Node:
        # Neighbours in this order are alike: near copies have most low bits in common.
        low, bits = (1 << 64) - 1, self.bits
        order = sorted(sets, key=lambda i: (bits[i] & -bits[i], self.sizes[i], bits[i] & low))
        return build_tree(bits, self.sizes, order)

    def _meet(self, one: _Node, two: _Node) -> None:
        stack = [(one, two)]
        while stack:
            a, b = stack.pop()
            if a is b:
                for i, c in enumerate(a.children):
                    stack.extend((c, e) for e in a.children[i + 1 :])
                stack.extend((c, c) for c in a.children)  # popped first: neighbours meet before far pairs
                for i, x in enumerate(a.docs):
                    for y in a.docs[i + 1 :]:
                        self._compare(x, y)
                continue
            overlap = (a.bits & b.bits).bit_count() + min(a.lost, b.lost)
            if not self.possible(a.low, a.high, b.low, b.high, overlap) or self.decided(a, b):
                continue
            if not a.children and not b.children:
                for x in a.docs:
                    for y in b.docs:
                        self._compare(x, y)
            elif a.children and (not b.children or a.high - a.low >= b.high - b.low):
                stack.extend((c, b) for c in a.children)
            else:
                stack.extend((a, c) for c in b.children)


class _Teams(_Join):
    """A forest over the sets: what ``pair`` sees is in one tree."""

    def __init__(self, *args) -> None:
        super().__init__(*args)
        self.parent = list(range(len(self.sizes)))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def settled(self, x: int, y: int) -> bool:
        return self.find(x) == self.find(y)

    def pair(self, x: int, y: int) -> None:
        rx, ry = self.find(x), self.find(y)
        self.parent[max(rx, ry)] = min(rx, ry)

    def decided(self, a: _Node, b: _Node) -> bool:
        one = self._root(a)
        return one >= 0 and one == self._root(b)

    def _root(self, node: _Node) -> int:
        """The root of all the node's sets, or -1."""
        if node.one:
            while node.children:
                node = node.children[0]
            return self.find(node.docs[0])
        roots = {self._root(c) for c in node.children} if node.children else {self.find(d) for d in node.docs}
        if len(roots) != 1 or -1 in roots:
            return -1
        node.one = True
        return roots.pop()


class _Links(_Teams):
    """Exact links."""

    def __init__(self, sets: list[np.ndarray], *args) -> None:
        super().__init__([bitmap(s) if len(s) else b"" for s in sets], [len(s) for s in sets], *args)
        self.sets = sets

    def pair(self, x: int, y: int) -> None:
        both = np.concatenate([self.sets[x], self.sets[y]])
        both.sort(kind="stable")
        shared = int(np.count_nonzero(both[1:] == both[:-1]))
        if self.den * shared >= self.num * (len(both) - shared):
            super().pair(x, y)


def tree_links(sets: list[np.ndarray], num: int, den: int, sides: list[int] | None = None) -> list[int]:
    """A root for each set: sets that links connect have the same one.

    With ``sides``, only sets of different sides are compared.
    """
    join = _Links(sets, num, den, sides)
    join.run()
    return [join.find(x) for x in range(len(sets))]


def tree_teams(
    bits: list[bytes], sizes: list[int], num: int, den: int, sides: list[int] | None = None
) -> list[list[int]]:
    """Sets that bitmaps and sizes may let link, directly or by others, each team in order."""
    join = _Teams(bits, sizes, num, den, sides)
    join.run()
    teams: dict[int, list[int]] = {}
    for x in range(len(sizes)):
        teams.setdefault(join.find(x), []).append(x)
    return [t for t in teams.values() if len(t) > 1]


def _tokens(k: int, key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            sets = [shingle_set(t, k, key) for t in batch.column("text").to_pylist()]
            # An id may have several texts: only the one with this set counts.
            right = [_set_id(s) == sid for s, sid in zip(sets, batch.column("sid").to_pylist(), strict=True)]
            keep = pa.array(right, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("sid").filter(keep),
                    batch.column("teams").filter(keep),
                    pa.array([s.tobytes() for s, r in zip(sets, right, strict=True) if r], pa.binary()),
                ],
                names=["sid", "teams", "tokens"],
            )

    return run


TASK = ("owner", "low", "high")


def _by_task(
    batches: Iterator[pa.RecordBatch], names: tuple[str, ...], columns: tuple[str, ...], solve, join
) -> Iterator[pa.RecordBatch]:
    """Rows sorted by task (``names``): each task's distinct sets go to ``solve`` as lists of columns; ``join`` makes batches."""
    task, rows = None, {}
    for batch in _pieces(batches):
        out = []
        keys = zip(*[batch.column(c).to_pylist() for c in names], strict=True)
        for key, *row in zip(keys, *[batch.column(c).to_pylist() for c in columns], strict=True):
            if key != task:
                out += solve(task, *zip(*rows.values(), strict=True)) if rows else []
                task, rows = key, {}
            rows.setdefault(row[0], row)
        yield join(out)
    if rows:
        yield join(solve(task, *zip(*rows.values(), strict=True)))


def _survivors(num: int, den: int):
    """(team, side, sid) of sets that keep a possible partner; a team's number is a hash of what it holds."""

    def solve(task, sids, sides, sizes, bits):
        split = task[1] != task[2]
        out = []
        for team in tree_teams(list(bits), list(sizes), num, den, sides if split else None):
            rows = sorted((sids[i], int(sides[i] == task[2]) if split else -1) for i in team)
            number = xxhash.xxh3_64_intdigest(b"".join(sid + bytes([side + 1]) for sid, side in rows)) - (1 << 63)
            out += [(number, side, sid) for sid, side in rows]
        return out

    def join(rows):
        kinds = (pa.int64(), pa.int32(), pa.binary())
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(cols, kinds, strict=True)], names=["team", "side", "sid"]
        )

    return lambda batches: _by_task(batches, TASK, ("sid", "side", "size", "bits"), solve, join)


def _links(num: int, den: int):
    """Links (a, b) as stars around each team's roots."""

    def solve(team, sids, sides, tokens):
        sets = [np.frombuffer(t, np.uint64) for t in tokens]
        roots = tree_links(sets, num, den, sides if sides[0] >= 0 else None)
        return [(sids[i], sids[r]) for i, r in enumerate(roots) if i != r]

    def join(links):
        return pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in links], pa.binary()) for i in (0, 1)], names=["a", "b"]
        )

    return lambda batches: _by_task(batches, ("team",), ("sid", "side", "tokens"), solve, join)


# -- texts of some ids --------------------------------------------------------


def _spot(ident: str):
    return F.xxhash64(ident).bitwiseAND((1 << FILTER_BITS) - 1)


def filled(ids: DataFrame) -> np.ndarray:
    """Bytes of a bitmap of fixed size in which the spots of ``ids`` (id) are set."""
    words = (
        ids.select(_spot("id").alias("spot"))
        .groupBy(F.shiftright("spot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 as int))")).alias("mask"))
        .toArrow()  # no more rows than the bitmap has words
    )
    bitmap = np.zeros(1 << FILTER_BITS - 6, np.int64)
    bitmap[words.column("word").to_numpy()] = words.column("mask").to_numpy()
    return bitmap.view(np.uint8)


def _at_spots(bitmap: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spot = batch.column("spot").to_numpy()
            keep = bitmap[spot >> 3] >> (spot & 7).astype(np.uint8) & 1
            yield batch.select(["id", "text"]).filter(pa.array(keep.astype(bool)))

    return run


# -- components ---------------------------------------------------------------


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, root) for every end of ``links`` (a, b); root is the component's smallest node."""
    links = links.filter(F.col("a") != F.col("b"))
    both = links.union(links.select("b", "a")).toDF("node", "other").distinct()
    edges = written(spark, both, "links")
    start = edges.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("root"))
    labels = written(spark, start, "labels")
    while True:
        heard = edges.join(labels.toDF("other", "root"), "other").select("node", "root").union(labels)
        nearest = written(spark, heard.groupBy("node").agg(F.min("root").alias("root")), "labels")
        jump = nearest.toDF("root", "further")
        stepped = nearest.join(jump, "root").select("node", F.least("root", "further").alias("root"))
        before, labels = labels, written(spark, stepped, "labels")
        changed = before.toDF("node", "was").join(labels, "node").filter(F.col("was") != F.col("root"))
        if changed.isEmpty():
            return labels


# -- operator -----------------------------------------------------------------


def shingle_links(
    df: DataFrame, id_col: str, text_col: str, k: int = 5, num: int = 80, den: int = 100
) -> tuple[DataFrame, DataFrame]:
    """(members: id, sid, size; labels: node, root) of the similarity join of ``df``.

    Sets link when den * intersection >= num * union.
    """
    if not 0 < num <= den or k < 1:
        raise ValueError("the threshold num/den lies in (0, 1], and a shingle has at least one word")
    spark = df.sparkSession
    docs = df.select(col(id_col).alias("id"), col(text_col).alias("text"))
    key = secrets.token_bytes(16)
    classes = frequency_classes(docs.select("text"), k, key)
    fields = [
        docs.schema["id"],
        T.StructField("sid", T.BinaryType()),
        T.StructField("key", T.LongType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("prefix", T.ArrayType(T.LongType())),
        T.StructField("bits", T.BinaryType()),
    ]
    members = written(spark, docs.mapInArrow(_members(k, num, den, classes, key), T.StructType(fields)), "members")

    # Tokens meet by a set's 64-bit key; the joins below bring the full ids back.
    meetings = (
        members.select("key", "size", F.size("prefix").alias("length"), F.posexplode("prefix").alias("at", "token"))
        .select("key", F.expr(f"size * {LEVELS} + cast(at * {LEVELS}L div length as int)").alias("place"), "token")
        .repartition("token")
        .sortWithinPartitions("token", F.expr(f"place div {LEVELS}"), "key")
        .select("token", "place", "key")
        .mapInArrow(_owners(num, den), "owner bigint, key bigint, size int")
        .distinct()
    )
    meetings = written(spark, meetings, "meetings")
    load = meetings.groupBy("owner").agg(F.count("*").alias("sets"), F.sum("size").alias("tokens"))
    load = written(spark, load, "load")  # so that both sides of the join below are shuffled for it, and skew is split
    blocks = F.greatest(
        F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("tokens") * 8 / BLOCK_BYTES), F.lit(1)
    ).cast("int")
    tasks = (
        meetings.join(load.select("owner", blocks.alias("blocks")), "owner")
        .withColumn("side", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "owner", "key", "side", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high")
        )
    )
    bitmaps = (
        members.filter("bits is not null")
        .groupBy("sid")
        .agg(F.first("key").alias("key"), F.first("size").alias("size"), F.first("bits").alias("bits"))
    )
    plans = (
        tasks.join(bitmaps, "key")
        .repartition(*TASK)
        .sortWithinPartitions(*TASK)
        .select(*TASK, "sid", "side", "size", "bits")
        .mapInArrow(_survivors(num, den), "team bigint, side int, sid binary")
        .groupBy("sid")
        .agg(F.collect_set(F.struct("team", "side")).alias("teams"))  # no more than its prefix and blocks
    )
    told = written(spark, members.groupBy("sid").agg(F.min("id").alias("id")).join(plans, "sid"), "told")
    asked = docs.select("id", "text", _spot("id").alias("spot")).mapInArrow(
        _at_spots(filled(told)), T.StructType([docs.schema["id"], docs.schema["text"]])
    )
    known = F.col("told.id").eqNullSafe(F.col("docs.id"))
    links = (
        asked.alias("docs")
        .join(told.alias("told").hint("merge"), known)  # a broadcast would put two Python steps, each with its worker, in one task
        .select("text", "sid", "teams")
        .mapInArrow(_tokens(k, key), "sid binary, teams array<struct<team:bigint,side:int>>, tokens binary")
        .select("sid", "tokens", F.inline("teams"))
        .repartition("team")
        .sortWithinPartitions("team")
        .select("team", "sid", "side", "tokens")
        .mapInArrow(_links(num, den), "a binary, b binary")
    )
    return members.select("id", "sid", "size"), components(spark, links)


def near_duplicate_classes(
    df: DataFrame, id_col: str, text_col: str, k: int = 5, num: int = 80, den: int = 100
) -> DataFrame:
    """One row per row of ``df``: doc_id, n_shingles, component_id (its component's smallest id)."""
    members, labels = shingle_links(df, id_col, text_col, k, num, den)
    spark = df.sparkSession
    node = F.coalesce("root", "sid")
    placed = members.join(labels.withColumnRenamed("node", "sid"), "sid", "left").select(
        "id", "size", node.alias("component")
    )
    placed = written(spark, placed, "placed")
    linked = F.col("size") > 0
    least = written(
        spark, placed.filter(linked).groupBy("component").agg(F.min("id").alias("component_id")), "least"
    )
    own = placed.filter(~linked).select("id", "size", F.col("id").alias("component_id"))
    return (
        placed.filter(linked)
        .join(least, "component")
        .select("id", "size", "component_id")
        .union(own)
        .select(F.col("id").alias("doc_id"), F.col("size").cast("bigint").alias("n_shingles"), "component_id")
    )


def drop_near_copies(
    df: DataFrame, id_col: str, text_col: str, k: int = 5, num: int = 80, den: int = 100
) -> DataFrame:
    """The rows of ``df`` of which one per component stays: that with the smallest id.

    A null id comes last; of rows with one id, that whose columns hash lowest
    stays. Rows with empty sets all stay.
    """
    spark = df.sparkSession
    row = fresh(df, "row")
    ident = F.struct(col(id_col).isNull().alias("missing"), col(id_col).alias("id"), F.xxhash64(*[col(c) for c in df.columns]).alias("hash"))
    keyed = df.withColumn(row, ident)
    members, labels = shingle_links(keyed, row, text_col, k, num, den)
    placed = written(
        spark,
        members.filter("size > 0")
        .join(labels.withColumnRenamed("node", "sid"), "sid", "left")
        .select("id", F.coalesce("root", "sid").alias("component")),
        "placed",
    )
    stays = written(spark, placed.groupBy("component").agg(F.min("id").alias("stays")), "stays")
    goes = placed.join(stays, "component").filter(F.col("id") != F.col("stays")).select(F.col("id").alias(row))
    repeats = written(spark, placed.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1"), "repeats")
    if repeats.isEmpty():
        return keyed.join(goes, row, "left_anti").select(*[col(c) for c in df.columns])
    again = repeats.select(F.col("id").alias(row))
    once = keyed.join(again, row, "left_semi").join(goes, row, "left_anti").dropDuplicates([row])
    rest = keyed.join(goes.union(again), row, "left_anti")
    return rest.union(once).select(*[col(c) for c in df.columns])
