"""Cross-tokenizer alignment by products of token incidence matrices.

Two tokenizers cut the same bytes. A tokenizer's incidence matrix has a row for
each token and a column for each byte, in compressed sparse rows. The product
A·Bᵀ, made row by row (each entry of a row of A adds a row of Bᵀ), has an
entry for each pair of tokens that share bytes: the overlap links. Where both
cut at the same byte a group ends; the incidence of tokens and groups gives, by
the same product, the links of tokens that share a group.

The corpus-wide count of an id pair is the number of documents that hold it
linked. Documents are taken in blocks: a block stores its distinct pairs once,
each document refers to them by place, and only the pairs of blocks meet, to be
added up by pair and sent back to their blocks. So neither the table of pairs
nor a document's links pass through the driver or one task.

Defined cases: null or empty texts, and texts that a tokenizer does not give
back byte by byte, have no tokens: counts are zero and the digest of the groups
is empty; strings of special tokens are plain text; repeated rows are documents
of their own; an empty table gives an empty result; other columns are ignored;
a very long text is a block of its own, multiplied piece by piece between
bytes where both tokenizers cut.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from landfall.llm.common import col, written

#: Bytes of text in a block of documents, and of a piece that is multiplied at once.
BLOCK_BYTES = 16 << 20
PIECE_BYTES = 1 << 20


# -- sparse matrices ----------------------------------------------------------


@dataclass(frozen=True)
class Rows:
    """A 0/1 matrix in compressed sparse rows: row i holds columns ``columns[starts[i]:starts[i + 1]]``."""

    starts: np.ndarray
    columns: np.ndarray
    width: int

    def __len__(self) -> int:
        return len(self.starts) - 1

    def transposed(self) -> Rows:
        order = np.argsort(self.columns, kind="stable")
        rows = np.repeat(np.arange(len(self)), np.diff(self.starts))
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Rows(starts, rows[order], len(self))


def byte_incidence(lengths: np.ndarray) -> Rows:
    """Tokens by bytes: each token covers the next ``lengths`` bytes."""
    starts = np.concatenate([[0], np.cumsum(lengths)])
    return Rows(starts, np.arange(starts[-1]), int(starts[-1]))


def byte_incidence_transposed(lengths: np.ndarray) -> Rows:
    """Bytes by tokens, written down at once, as every byte has one token."""
    total = int(lengths.sum())
    return Rows(np.arange(total + 1), np.repeat(np.arange(len(lengths)), lengths), len(lengths))


def product(a: Rows, b: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) of the nonzero entries of ``a`` times ``b``, row by row, columns ascending."""
    lengths = np.diff(b.starts)[a.columns]
    total = int(lengths.sum())
    # The rows of b that each entry of a adds, one behind the other.
    before = np.cumsum(lengths) - lengths
    taken = b.columns[np.repeat(b.starts[a.columns] - before, lengths) + np.arange(total)]
    keys = np.repeat(np.repeat(np.arange(len(a)), np.diff(a.starts)), lengths) * b.width + taken
    if total and (np.diff(keys) < 0).any():
        keys.sort(kind="stable")
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    values = np.diff(first, append=total)
    return keys[first] // max(b.width, 1), keys[first] % max(b.width, 1), values


def entries(a: Rows, b: Rows) -> np.ndarray:
    """How many entries of ``b`` are added for each entry of ``a``, without making them."""
    return np.diff(b.starts)[a.columns]


# -- tokens of one text -------------------------------------------------------


@dataclass(frozen=True)
class Aligned:
    """Tokens of two tokenizers over the same bytes."""

    a: np.ndarray
    b: np.ndarray
    a_lengths: np.ndarray
    b_lengths: np.ndarray

    def ends(self) -> np.ndarray:
        """Bytes at which tokens of both end."""
        return np.intersect1d(np.cumsum(self.a_lengths), np.cumsum(self.b_lengths), assume_unique=True)

    def links(self, piece: int = PIECE_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in a, place in b, bytes shared) of all overlapping tokens."""
        ends, a_ends, b_ends = self.ends(), np.cumsum(self.a_lengths), np.cumsum(self.b_lengths)
        out, a_from, b_from, byte = [], 0, 0, 0
        while byte < (ends[-1] if len(ends) else 0):
            # The last shared end within the piece, or the next one.
            at = max(np.searchsorted(ends, byte + piece, "right") - 1, np.searchsorted(ends, byte, "right"))
            byte = int(ends[at])
            a_to, b_to = np.searchsorted(a_ends, byte) + 1, np.searchsorted(b_ends, byte) + 1
            x, y, shared = product(
                byte_incidence(self.a_lengths[a_from:a_to]), byte_incidence_transposed(self.b_lengths[b_from:b_to])
            )
            out.append((x + a_from, y + b_from, shared))
            a_from, b_from = a_to, b_to
        if not out:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def groups(self) -> tuple[Rows, Rows]:
        """Tokens of a, and of b, by groups."""
        ends = self.ends()
        place = lambda lengths: np.searchsorted(ends, np.cumsum(lengths), "left")
        one = lambda lengths: Rows(np.arange(len(lengths) + 1), place(lengths), len(ends))
        return one(self.a_lengths), one(self.b_lengths)


@dataclass(frozen=True)
class Joined:
    """Tokens of several texts, and where each text's tokens end (from 0)."""

    tokens: Aligned
    a_ends: np.ndarray
    b_ends: np.ndarray


class Tokenizers:
    """Both tokenizers, the bytes of their tokens and the texts of their ids."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.encode_a, a_bytes = byte_level(a_path)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
        b_bytes = [piece_bytes(self.pieces, i) for i in range(self.pieces.get_piece_size())]
        self.a_bytes, self.b_bytes = a_bytes, b_bytes
        self.a_lengths = np.array([len(x) for x in a_bytes], np.int64)
        self.b_lengths = np.array([len(x) for x in b_bytes], np.int64)
        a_ids, b_ids = [str(i) for i in range(len(a_bytes))], [str(i) for i in range(len(b_bytes))]
        #: Each id with what follows it: in a group, or at the end of its tokens of a, or of b.
        self.shown = [
            *(x + "," for x in a_ids), *(x + "|" for x in a_ids), *(x + "," for x in b_ids), *(x + ";" for x in b_ids)
        ]

    def align(self, text: str | None) -> Aligned | None:
        """The tokens of a text; None where there are none, or where they are not its bytes."""
        if not text:
            return None
        spaced = " " + text
        raw = spaced.encode()
        a, b = self.encode_a(spaced), self.pieces.encode(text)
        if b"".join(map(self.a_bytes.__getitem__, a)) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        return Aligned(a, b, self.a_lengths[a], self.b_lengths[b])

    def joined(self, texts: list[str | None]) -> Joined:
        """The tokens of several texts one behind the other: both cut where a text ends, so nothing crosses it."""
        parts = [self.align(t) for t in texts]
        there = [p for p in parts if p is not None]
        none = np.zeros(0, np.int64)
        whole = Aligned(*(np.concatenate([none, *(getattr(p, f) for p in there)]) for f in ("a", "b", "a_lengths", "b_lengths")))
        ends = lambda f: np.cumsum([0, *(0 if p is None else len(getattr(p, f)) for p in parts)])
        return Joined(whole, ends("a"), ends("b"))

    def pairs(self, texts: Joined) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Links of each text; its distinct linked id pairs, and how often they are linked."""
        tokens, width = texts.tokens, len(self.b_bytes)
        x, y, _ = tokens.links()
        n = np.diff(np.searchsorted(x, texts.a_ends))
        space = len(self.a_bytes) * width
        keys = np.repeat(np.arange(len(n)), n) * space + tokens.a[x] * width + tokens.b[y]
        keys, often = np.unique(keys, return_counts=True)
        cuts = np.searchsorted(keys, np.arange(1, len(n)) * space)
        return n, np.split(keys % space, cuts), np.split(often, cuts)

    def groups(self, texts: Joined) -> list[tuple[int, int, str]]:
        """(groups, links of tokens that share a group, digest of the groups' ids) of each text."""
        tokens = texts.tokens
        by_a, by_b = tokens.groups()
        n_a, n_b, half = len(tokens.a), len(tokens.b), len(self.a_bytes)
        last = lambda g: np.append(g.columns[1:] != g.columns[:-1], True)[: len(g)]
        # A group's tokens of a stand behind all tokens of the groups before, its tokens of b behind those.
        order = np.empty(n_a + n_b, np.int64)
        order[np.arange(n_a) + np.searchsorted(by_b.columns, by_a.columns, "left")] = tokens.a + half * last(by_a)
        ids_b = 2 * half + tokens.b + len(self.b_bytes) * last(by_b)
        order[np.arange(n_b) + np.searchsorted(by_a.columns, by_b.columns, "right")] = ids_b
        n_groups = np.concatenate([[0], np.cumsum(last(by_a))])[texts.a_ends]
        shared = np.concatenate([[0], np.cumsum(entries(by_a, by_b.transposed()))])[texts.a_ends]
        out, ends = [], texts.a_ends + texts.b_ends
        for i, (start, end) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
            digest = hashlib.sha256()
            for at in range(start, end, 1 << 20):
                to = min(at + (1 << 20), end)
                shown = "".join(map(self.shown.__getitem__, order[at:to].tolist()))
                digest.update((shown if to < end else shown[:-1]).encode())
            text = digest.hexdigest() if end > start else ""
            out.append((int(n_groups[i + 1] - n_groups[i]), int(shared[i + 1] - shared[i]), text))
        return out


def byte_level(path: str):
    """(text -> ids without special tokens, bytes of each id) of a byte-level BPE file.

    An equal tiktoken encoding does the work where the file's fields are those
    that it stands for; else the file's own library.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    model, special = spec["model"], {x["content"]: x["id"] for x in spec["added_tokens"]}
    vocab = model["vocab"]
    size = max([*vocab.values(), *special.values()]) + 1
    token_bytes = [b""] * size
    for token, i in [*special.items(), *vocab.items()]:
        token_bytes[i] = token.encode() if token in special else bytes(byte[c] for c in token)
    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    plain = {t: i for t, i in vocab.items() if t not in special}
    merged = [plain.get(x + y) for x, y in merges]
    before = spec.get("pre_tokenizer") or {}
    equal = (
        model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges"))
        and spec.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and not before.get("add_prefix_space")
        and before.get("use_regex", True)
        and None not in merged
        and merged == sorted(merged)
        and len({*merged}) == len(merged) == len(plain) - 256
        and sorted(token_bytes[i] for i in range(256)) == [bytes([b]) for b in range(256)]
    )
    if not equal:
        return lambda text: own.encode(text, add_special_tokens=False).ids, token_bytes
    # Fixed value: the pattern that the file's pre-tokenizer type stands for.
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    ranks = {token_bytes[i]: i for i in plain.values()}
    fast = tiktoken.Encoding("byte_level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return fast.encode_ordinary, token_bytes


def piece_bytes(pieces: sentencepiece.SentencePieceProcessor, i: int) -> bytes:
    piece = pieces.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()


@lru_cache(maxsize=2)
def load(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


# -- the corpus ---------------------------------------------------------------

FIELDS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_group_links bigint, groups_sha256 string"


def _tokenized(a_path: str, b_path: str, block_bytes: int):
    """Documents with the places of their pairs in their block, and a row for each block with its pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = load(a_path, b_path)
        piece = min(PIECE_BYTES, block_bytes)
        block, ids, rows, pairs, times, held = TaskContext.get().partitionId() << 32, [], [], [], [], 0

        def close() -> pa.RecordBatch:
            every = np.concatenate([np.zeros(0, np.int64), *pairs])
            keys, at, docs = np.unique(every, return_inverse=True, return_counts=True)
            ends = np.cumsum([0, *map(len, pairs)])
            # Places ascend, so their differences are small numbers that compress well.
            steps = [np.diff(at[x:y], prepend=0).astype("<u4").tobytes() for x, y in zip(ends, ends[1:], strict=False)]
            n = len(rows)
            columns = [pa.array([x[i] for x in rows] + [None], kind) for i, kind in enumerate([pa.int64()] * 5 + [pa.string()])]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * (n + 1), pa.int64()),
                    pa.array([False] * n + [True], pa.bool_()),
                    pa.concat_arrays([*ids, pa.nulls(1, ids[0].type)]),
                    *columns,
                    pa.array([*steps, keys.astype("<i8").tobytes()], pa.binary()),
                    pa.array([*[t.astype("<u4").tobytes() for t in times], docs.astype("<u4").tobytes()], pa.binary()),
                ],
                names=["block", "is_block", "id", *names, "pairs", "times"],
            )

        names = [f.split()[0] for f in FIELDS.split(", ")]
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sizes = np.cumsum([len(t or "") + 16 for t in texts])
            begun = 0
            while begun < len(texts):
                # Texts are multiplied together up to a piece's size.
                base = sizes[begun - 1] if begun else 0
                to = max(begun + 1, int(np.searchsorted(sizes, base + piece)))
                joined = both.joined(texts[begun:to])
                n_links, found, often = both.pairs(joined)
                n_a, n_b = np.diff(joined.a_ends).tolist(), np.diff(joined.b_ends).tolist()
                for a, b, links, (groups, shared, digest) in zip(n_a, n_b, n_links.tolist(), both.groups(joined), strict=True):
                    rows.append((a, b, groups, links, shared, digest))
                pairs += found
                times += often
                ids.append(batch.column("id").slice(begun, to - begun))
                held += int(sizes[to - 1] - base)
                begun = to
                if held >= block_bytes:
                    yield close()
                    block, held = block + 1, 0
                    ids, rows, pairs, times = [], [], [], []
        if rows:
            yield close()

    return run


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, keys, docs in zip(*(batch.column(c).to_pylist() for c in ("block", "pairs", "times")), strict=True):
            pair = np.frombuffer(keys, "<i8")
            n = np.frombuffer(docs, "<u4").astype(np.int64)
            for at in range(0, len(pair), 1 << 16):
                part = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pair[part]), block)), pa.array(pair[part]), pa.array(n[part])],
                    names=["block", "pair", "n"],
                )


def _summed(key: tuple, docs: pa.Table, counts: pa.Table) -> pa.Table:
    """Sums over the links of each document of a block, from the counts of the block's pairs."""
    order = np.argsort(counts.column("pair").to_numpy())
    n = counts.column("n").to_numpy()[order]
    best = counts.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
    sums, bests = [], []
    for steps, often in zip(docs.column("pairs").to_pylist(), docs.column("times").to_pylist(), strict=True):
        at = np.cumsum(np.frombuffer(steps, "<u4").astype(np.int64))
        often = np.frombuffer(often, "<u4").astype(np.int64)
        sums.append(int(n[at] @ often))
        bests.append(int(best[at] @ often))
    kept = docs.select([c for c in docs.column_names if c not in ("block", "pairs", "times")])
    return kept.append_column("n_best", pa.array(bests, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))


def align_documents(
    df: DataFrame, id_col: str, text_col: str, a_path: str, b_path: str, block_bytes: int = BLOCK_BYTES
) -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, counts and digest; pairs of ids: a_id, b_id, documents that link them, whether it's a_id's best)."""
    spark = df.sparkSession
    docs = df.select(col(id_col).alias("id"), col(text_col).alias("text"))
    fields = T.StructType([docs.schema["id"]] + T._parse_datatype_string(FIELDS).fields)
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("is_block", T.BooleanType()),
            *fields,
            T.StructField("pairs", T.BinaryType()),
            T.StructField("times", T.BinaryType()),
        ]
    )
    table = written(spark, docs.mapInArrow(_tokenized(a_path, b_path, block_bytes), schema), "aligned")
    held = table.filter("is_block").select("block", "pairs", "times")
    held = held.mapInArrow(_pairs, "block bigint, pair bigint, n bigint")
    width = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    totals = written(spark, held.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    a = F.expr(f"pair div {width}")
    top = totals.groupBy(a.alias("a")).agg(F.max("n").alias("top"))
    counts = totals.withColumn("a", a).join(top, "a").select("pair", "a", "n", (F.col("n") == F.col("top")).alias("best"))
    counts = written(spark, counts, "counts")
    back = held.select("block", "pair").join(counts.select("pair", "n", "best"), "pair")
    out = T.StructType([*fields, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    summed = (
        table.filter("not is_block")
        .drop("is_block")
        .groupBy("block")
        .cogroup(back.groupBy("block"))
        .applyInArrow(_summed, out)
        .withColumnRenamed("id", "doc_id")
    )
    pairs = counts.select(
        F.col("a").alias("a_id"), F.expr(f"pair % {width}").alias("b_id"), F.col("n").alias("documents"), "best"
    )
    return summed, pairs
