"""Packing of tokenised documents into fixed windows by minimum bin slack.

Each task tokenises its documents and buffers them up to a bounded number of
tokens. A document gives as many full windows as it can; its remaining length
(under one window) goes into a histogram. A window is then seeded with the
largest remaining length, and a bitset subset-sum dynamic programme over the
other lengths and their counts finds the multiset that fills it closest to
capacity; the counts are read back from the bitsets. A multiset is used as
often as its counts allow, so a buffer needs about as many programmes as it
has distinct lengths. Slack that no multiset fills is taken by cutting one
document; what is left over moves on to the next buffer. At the end of a task
the last open window is cut at powers of two, which need no padding.

Nothing is shuffled and no group is collected: hot keys and copies don't
matter, and a retried task gives the same windows again.

Defined cases: null text counts as empty (its only id is the separator);
repeated rows are packed as often as they come; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from landfall.llm.common import col

WINDOW = 2048
#: Tokens that a task buffers before it plans windows (4 bytes each).
BUFFER_TOKENS = 1 << 23


def best_fill(counts: dict[int, int], space: int) -> dict[int, int]:
    """The multiset of available lengths whose sum is nearest to ``space`` from below."""
    bits, goal, steps = 1, 1 << space, []
    mask = (goal << 1) - 1
    for length, count in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        left = min(count, space // length) if length <= space else 0
        chunk = 1
        while left:
            take = min(chunk, left)
            more = bits | (bits << (length * take) & mask)
            if more != bits:
                steps.append((bits, length, take))
                bits = more
            left, chunk = left - take, chunk * 2
        if bits & goal:
            break
    total, use = bits.bit_length() - 1, {}
    for before, length, take in reversed(steps):
        if not before >> total & 1:
            use[length] = use.get(length, 0) + take
            total -= length * take
    return use


def windows(counts: dict[int, int], capacity: int) -> Iterator[tuple[dict[int, int], int, int, int]]:
    """(lengths used, length cut or 0, tokens taken from it, windows made so); uses up ``counts``.

    All windows are full, except that the last may be short (made once). A cut
    length returns to ``counts`` shortened.
    """
    while counts:
        seed = max(counts)
        rest = dict(counts)
        rest[seed] -= 1
        if not rest[seed]:
            del rest[seed]
        use = best_fill(rest, capacity - seed)
        use[seed] = use.get(seed, 0) + 1
        slack = capacity - sum(x * n for x, n in use.items())
        cut = 0
        if slack:
            spare = {x: n - use.get(x, 0) for x, n in counts.items() if n > use.get(x, 0)}
            cut = max(spare, key=lambda x: (spare[x], -x), default=0)
        times = min(counts[x] // (n + (x == cut)) for x, n in use.items())
        if cut and cut not in use:
            times = min(times, counts[cut])
        if slack and not cut:
            times = 1
        for x, n in [*use.items(), *([(cut, 1)] if cut else [])]:
            counts[x] -= n * times
            if not counts[x]:
                del counts[x]
        if cut:
            counts[cut - slack] = counts.get(cut - slack, 0) + times
        yield use, cut, slack if cut else 0, times


@lru_cache(maxsize=2)
def _load(path: str) -> tuple[Tokenizer, tiktoken.Encoding, list[str]]:
    """The tokenizer, a fast equal of it for plain text, and its special strings."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = [x["content"] for x in spec["added_tokens"]]
    ranks = {bytes(byte[c] for c in tok): i for tok, i in spec["model"]["vocab"].items() if tok not in special}
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    fast = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return Tokenizer.from_file(path), fast, special


def token_ids(path: str, text: str) -> list[int]:
    """Ids by the tokenizer file, without special tokens added.

    Strings of special tokens in a text keep the meaning that the tokenizer
    gives them, so such texts go through it; others through the fast equal.
    """
    tokenizer, fast, special = _load(path)
    if any(s in text for s in special):
        return tokenizer.encode(text, add_special_tokens=False).ids
    return fast.encode_ordinary(text)


class _Packer:
    """Buffered documents of one task, and the pieces that windows take from them."""

    def __init__(self, capacity: int, base: int) -> None:
        self.capacity, self.sequence = capacity, base
        self.by_length: dict[int, deque] = {}
        self.buffered = 0
        self.out: list[tuple] = []

    def add(self, slot: list) -> None:
        """slot: [document's row, ids, next id to place]."""
        total = len(slot[1])
        while total - slot[2] >= self.capacity:
            self._piece(slot, self.capacity, 0)
            self.sequence += 1
        self._wait(slot)

    def _wait(self, slot: list) -> None:
        left = len(slot[1]) - slot[2]
        if left:
            self.by_length.setdefault(left, deque()).append(slot)
            self.buffered += left

    def _piece(self, slot: list, length: int, offset: int) -> None:
        self.out.append((slot[0], slot[2], length, slot[1][slot[2] : slot[2] + length], len(slot[1]), self.sequence, offset))
        slot[2] += length

    def _take(self, length: int) -> list:
        queue = self.by_length[length]
        slot = queue.popleft()
        if not queue:
            del self.by_length[length]
        self.buffered -= length
        return slot

    def plan(self, last: bool) -> None:
        """Fill windows; what would leave one short waits for more unless this is the end."""
        counts = {x: len(q) for x, q in self.by_length.items()}
        for use, cut, part, times in windows(counts, self.capacity):
            full = sum(x * n for x, n in use.items()) + part == self.capacity
            if not full and not last:
                return
            for _ in range(times):
                members = [(self._take(x), x) for x, n in use.items() for _ in range(n)]
                if not full:
                    self._powers(members)
                    continue
                offset = 0
                for slot, x in members:
                    self._piece(slot, x, offset)
                    offset += x
                if cut:
                    slot = self._take(cut)
                    self._piece(slot, part, offset)
                    self._wait(slot)
                self.sequence += 1

    def _powers(self, members: list[tuple[list, int]]) -> None:
        """The last, short window as sequences of power-of-two lengths."""
        left = sum(x for _, x in members)
        room, offset = 1 << (left.bit_length() - 1), 0
        for slot, x in members:
            while x:
                n = min(x, room - offset)
                self._piece(slot, n, offset)
                x, left, offset = x - n, left - n, offset + n
                if offset == room:
                    self.sequence, offset = self.sequence + 1, 0
                    room = 1 << (left.bit_length() - 1) if left else 0


def _pack(path: str, separator: int, capacity: int, buffer_tokens: int, kind: pa.DataType):
    schema = pa.schema(
        [
            ("id", kind),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids", pa.binary()),
            ("doc_tokens", pa.int64()),
            ("sequence_id", pa.int64()),
            ("offset", pa.int64()),
        ]
    )

    def flush(packer: _Packer) -> Iterator[pa.RecordBatch]:
        while packer.out:
            part, packer.out = packer.out[:20_000], packer.out[20_000:]
            cols = list(zip(*part, strict=True))
            cols[3] = [x.tobytes() for x in cols[3]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(capacity, TaskContext.get().partitionId() << 40)
        for batch in batches:
            ids = batch.column("id").to_pylist()
            for ident, text in zip(ids, batch.column("text").to_pylist(), strict=True):
                packer.add([ident, np.asarray([*token_ids(path, text or ""), separator], "<u4"), 0])
                if packer.buffered >= buffer_tokens or len(packer.out) >= 20_000:
                    if packer.buffered >= buffer_tokens:
                        packer.plan(last=False)
                    yield from flush(packer)
        packer.plan(last=True)
        yield from flush(packer)

    return run


def pack_documents(
    df: DataFrame,
    id_col: str,
    text_col: str,
    tokenizer_path: str,
    separator: int = 1,
    window: int = WINDOW,
    buffer_tokens: int = BUFFER_TOKENS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers;
    pieces of one ``sequence_id`` in the order of ``offset`` are the sequence.
    """
    docs = df.select(col(id_col).alias("id"), col(text_col).alias("text"))
    longs = ["start", "length", "doc_tokens", "sequence_id", "offset"]
    out = T.StructType(
        [
            docs.schema["id"],
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            *[T.StructField(n, T.LongType()) for n in longs[2:]],
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(docs.schema["id"].dataType)
    packed = docs.mapInArrow(_pack(tokenizer_path, separator, window, buffer_tokens, kind), out)
    return packed.select(F.col("id").alias("doc_id"), "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
