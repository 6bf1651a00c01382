"""Byte-level BPE: encoding of whole texts in overlapping chunks, and decoding.

A text of up to one chunk is encoded where it is read. A longer one is cut
into chunks that overlap; all chunks are pre-tokenised in parallel, each from
its own start. The scan of a chunk may begin out of step, but once it shares a
boundary with its predecessor's scan both agree from there on, because the
split pattern looks ahead only. The first such boundary inside the overlap is
the seam; where none exists the two chunks are joined. The pieces between
seams are then encoded in parallel and their ids put together again.

A seam must stay a boundary when a piece is encoded by itself, so only
boundaries between a non-blank character and a blank (or line feed) qualify.

Defined cases: null text counts as empty and has no ids; repeated rows (same
id and text) are encoded once and returned as often as they came; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.common import col

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 2_048
#: Matches that end this near to a chunk's end could differ if the text went on.
LOOKAHEAD = 4
#: White space to one regex engine but not to another; never beside a seam.
DOUBTFUL = "\x1c\x1d\x1e\x1f\x85\u180e\u200b\u2028\ufeff"


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id, from a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})


@lru_cache(maxsize=4)
def vocabulary(path: str) -> list[bytes]:
    """Token bytes by id."""
    ranks = load_ranks(path)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def ids_bytes(ids: list[int]) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def seams(text: str, pattern: regex.Pattern, low: int, high: int) -> list[int]:
    """Boundaries of ``text``'s matches in [low, high) where a piece may end."""
    found = []
    for m in pattern.finditer(text):
        at = m.start()
        if at >= high:
            break
        if at >= max(low, 1) and text[at] in " \n" and not text[at - 1].isspace() and text[at - 1] not in DOUBTFUL:
            found.append(at)
    return found


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that a worker holds the texts and ids of a few hundred rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _encode_short(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        for batch in _slices(batches):
            ids = [ids_bytes(enc.encode_ordinary(t or "")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(ids, pa.binary())], names=["id", "ids"])

    return run


def _chunks(chunk: int, overlap: int):
    """Long texts to (row key, chunk number, start, text) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("text").to_pylist()):
                ident = batch.column("id").slice(i, 1)
                key = hashlib.sha256(repr(ident[0].as_py()).encode() + b"\0" + text.encode()).digest()
                starts = list(range(0, max(1, len(text) - overlap), chunk))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key] * len(starts), pa.binary()),
                        pa.concat_arrays([ident] * len(starts)),
                        pa.array(range(len(starts)), pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array([text[s : s + chunk + overlap] if s != starts[-1] else text[s:] for s in starts]),
                    ],
                    names=["key", "id", "chunk", "start", "text"],
                )

    return run


def _boundaries(pattern: str, chunk: int, overlap: int):
    """Adds the seams near a chunk's head and tail, as positions in the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        for batch in batches:
            head, tail = [], []
            for start, text in zip(batch.column("start").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = seams(text, compiled, 0, len(text) - LOOKAHEAD)
                head.append([start + p for p in found if p < overlap])
                tail.append([start + p for p in found if p >= chunk])
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(head, kind), pa.array(tail, kind)],
                names=[*batch.schema.names, "head", "tail"],
            )

    return run


def _encode_pieces(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        for batch in batches:
            ids = [ids_bytes(enc.encode_ordinary("".join(p))) for p in batch.column("parts").to_pylist()]
            names = ["key", "id", "copies", "piece"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(ids, pa.binary())], names=[*names, "ids"]
            )

    return run


def _join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [b"".join(x["ids"] for x in row) for row in batch.column("parts").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(ids, pa.binary())], names=["id", "ids"])


def encode_documents(
    df: DataFrame,
    id_col: str,
    text_col: str,
    ranks_path: str,
    pattern: str,
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """One row per row of ``df``: doc_id, ids (little-endian unsigned 32-bit), n_tokens."""
    if not 0 < overlap_chars * 2 <= chunk_chars:
        raise ValueError("a chunk must be at least twice its overlap")
    docs = df.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    ident = docs.schema["id"]
    is_long = F.length("text") > chunk_chars + overlap_chars
    encoded = T.StructType([ident, T.StructField("ids", T.BinaryType())])
    short = docs.filter(~is_long).mapInArrow(_encode_short(ranks_path, pattern), encoded)

    fields = [
        T.StructField("key", T.BinaryType()),
        ident,
        T.StructField("chunk", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("text", T.StringType()),
    ]
    positions = T.ArrayType(T.LongType())
    # One exchange deals out the chunks and merges those of repeated rows.
    chunks = (
        docs.filter(is_long)
        .mapInArrow(_chunks(chunk_chars, overlap_chars), T.StructType(fields))
        .groupBy("key", "chunk")
        .agg(
            F.first("id").alias("id"),
            F.first("start").alias("start"),
            F.first("text").alias("text"),
            F.count("*").alias("copies"),
        )
        .select("key", "id", "copies", "chunk", "start", "text")
    )
    scanned = chunks.mapInArrow(
        _boundaries(pattern, chunk_chars, overlap_chars),
        T.StructType([*chunks.schema.fields, T.StructField("head", positions), T.StructField("tail", positions)]),
    )
    by_doc = Window.partitionBy("key").orderBy("chunk")
    following = F.lead("start").over(by_doc)
    pieces = (
        scanned.withColumn("next_start", following)
        .withColumn("seam", F.array_min(F.array_intersect("tail", F.lead("head").over(by_doc))))
        .withColumn("begin", F.coalesce(F.lag("seam").over(by_doc), F.col("start")))
        .withColumn("end", F.coalesce("seam", "next_start", F.col("start") + F.length("text")))
        .withColumn("piece", F.sum(F.lag("seam").over(by_doc).isNotNull().cast("int")).over(by_doc))
        .withColumn(
            "part",
            F.substring("text", (F.col("begin") - F.col("start") + 1).cast("int"), (F.col("end") - F.col("begin")).cast("int")),
        )
        .groupBy("key", "piece")
        .agg(
            F.first("id").alias("id"),
            F.first("copies").alias("copies"),
            F.transform(F.array_sort(F.collect_list(F.struct("chunk", "part"))), lambda x: x["part"]).alias("parts"),
        )
    )
    long = (
        pieces.mapInArrow(
            _encode_pieces(ranks_path, pattern),
            T.StructType(
                [
                    T.StructField("key", T.BinaryType()),
                    ident,
                    T.StructField("copies", T.LongType()),
                    T.StructField("piece", T.LongType()),
                    T.StructField("ids", T.BinaryType()),
                ]
            ),
        )
        .groupBy("key")
        .agg(
            F.first("id").alias("id"),
            F.first("copies").alias("copies"),
            F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("parts"),
        )
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
        .select("id", "parts")
        .mapInArrow(_join_pieces, encoded)
    )
    return short.unionByName(long).select(
        F.col("id").alias("doc_id"), "ids", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens")
    )


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Adds ``decoded``, the bytes that the ids stand for, to rows with an ``ids`` column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = vocabulary(ranks_path)
        for batch in _slices(batches):
            texts = [
                b"".join(map(table.__getitem__, np.frombuffer(x, "<u4").tolist())) if x else b""
                for x in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, "decoded"]
            )

    return encoded.mapInArrow(
        run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])
    )
