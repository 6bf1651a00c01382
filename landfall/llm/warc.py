"""WARC archives, compressed record by record with a shared Zstandard dictionary.

The dictionary is trained on a bounded sample of the records to be archived.
Every archive begins with a skippable frame that holds it (compressed); each
record is a Zstandard frame of its own, made with that dictionary, so any
record can be read alone. Archives are written by Spark's own text writer: a
row is the bytes of one frame, and the line separator is an empty skippable
frame, which readers pass over. So they go to any shared store, and a lost
executor's files are never committed.

Records with equal payloads of at least ``min_bytes`` bytes are stored once:
that with the largest id is a response, the others revisit it.

Defined cases: null or empty payloads are responses with an empty payload; a
null URL has no target header; rows that share the winning id are all
responses; a null id revisits like any other, and of payloads with null ids
only all are responses; line breaks in a URL are percent-encoded; an empty
table gives no archives and reads back empty; other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm.common import col
from landfall.session import scratch_dir

DICTIONARY_FRAME = 0x184D2A5D
#: An empty skippable frame (magic 0x184D2A50), all of it ASCII.
SEPARATOR = "P*M\x18\x00\x00\x00\x00"
#: The dictionary is built from at most so many records, of at most so many bytes each.
SAMPLE_RECORDS = 400
SAMPLE_BYTES = 32 << 10
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
ID_PREFIX = "<urn:x-page:"


def http_head(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def record(kind: str, ident, url: str | None, date: str, length: int, sha1: str, refers_to, payload: bytes) -> bytes:
    """One WARC record; a revisit stores the HTTP head only."""
    name = lambda x: f"{ID_PREFIX}{'' if x is None else x}>"
    block = http_head(length) + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name(ident)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines += [f"WARC-Payload-Digest: sha1:{sha1}", "Content-Type: application/http; msgtype=response"]
    if kind == "revisit":
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {name(refers_to)}",
        ]
    lines += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def dictionary_of(samples: list[bytes]) -> bytes:
    """A trained dictionary; of too few samples, their own end as plain content."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:] or b"WARC/1.1"


def dictionary_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed


def records_of(archive: bytes) -> Iterator[bytes]:
    """The records of one archive, in order."""
    at, size, reader = 0, len(archive), None
    view = memoryview(archive)
    while at < size:
        (magic,) = struct.unpack_from("<I", archive, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            (length,) = struct.unpack_from("<I", archive, at + 4)
            if magic == DICTIONARY_FRAME:
                held = zstandard.ZstdDecompressor().decompress(bytes(view[at + 8 : at + 8 + length]))
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held))
            at += 8 + length
            continue
        if reader is None:
            raise ValueError("the archive does not begin with its dictionary")
        frame, parts = reader.decompressobj(), []
        while not frame.eof:
            if at >= size:
                raise ValueError("the archive ends inside a record")
            window = view[at : at + 8192]
            parts.append(frame.decompress(window))
            at += len(window) - len(frame.unused_data)
        yield b"".join(parts)


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines if ": " in line)


def _write(dictionary: bytes, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = zstandard.ZstdCompressionDict(dictionary)
        held.precompute_compress(level=LEVEL)
        writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=True)
        first = True
        for batch in batches:
            frames = [dictionary_frame(dictionary)] if first and batch.num_rows else []
            first = first and not batch.num_rows
            for row in batch.to_pylist():
                payload = (row["payload"] or "").encode()
                frames.append(
                    writer.compress(
                        record(row["kind"], row["id"], row["url"], date, row["length"], row["sha1"], row["refers_to"], payload)
                    )
                )
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])

    return run


def write_archives(
    df: DataFrame,
    id_col: str,
    url_col: str,
    payload_col: str,
    path: str | None = None,
    min_bytes: int = 1000,
    date: str = "1970-01-01T00:00:00Z",
) -> str:
    """Write one record per row of ``df``; returns the archives' folder."""
    path = path or scratch_dir(df.sparkSession, "warc")
    payload = F.coalesce(col(payload_col), F.lit(""))
    rows = df.select(
        col(id_col).alias("id"),
        col(url_col).alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("length"),
        F.sha1(payload.cast("binary")).alias("sha1"),
    )
    # Counted by (sha1, length), joined by sha1 alone: both sides get an exchange of their own,
    # which lets Spark split the rows of a payload that very many records share.
    owners = (
        rows.filter(F.col("length") >= min_bytes)
        .groupBy("sha1", "length")
        .agg(F.max("id").alias("owner"), F.count("*").alias("n"))
        .filter("n > 1 and owner is not null")
        .select("sha1", "owner")
    )
    revisits = F.col("owner").isNotNull() & ~F.col("id").eqNullSafe(F.col("owner")) & (F.col("length") >= min_bytes)
    typed = rows.join(owners, "sha1", "left").select(
        "id",
        "url",
        "length",
        "sha1",
        F.when(revisits, "revisit").otherwise("response").alias("kind"),
        F.when(revisits, F.col("owner")).alias("refers_to"),
        F.when(~revisits, F.col("payload")).alias("payload"),
    )
    chosen = rows.select("id").filter("id is not null").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_RECORDS).distinct()
    picked = (
        rows.join(F.broadcast(chosen), "id")  # bounded: SAMPLE_RECORDS ids
        .select("id", "url", "length", "sha1", F.substring("payload", 1, SAMPLE_BYTES).alias("payload"))
        .orderBy("id", "sha1")
        .limit(SAMPLE_RECORDS)
        .collect()
    )
    samples = [
        record("response", r["id"], r["url"], date, r["length"], r["sha1"], None, r["payload"].encode()) for r in picked
    ]
    frames = typed.mapInArrow(_write(dictionary_of(samples), date), "frame binary")
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR).text(path)
    return path


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def emit(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
        kinds = [pa.string()] * 4 + [pa.int64(), pa.binary()]
        names = ["record_type", "record_id", "refers_to", "target_uri", "http_length", "payload"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    for batch in batches:
        for archive in batch.column("content"):
            rows, held = [], 0
            for data in records_of(archive.as_buffer().to_pybytes()):
                head, block = data.split(b"\r\n\r\n", 1)
                warc = _headers(head)
                block = block[: int(warc["Content-Length"])]
                http, payload = block.split(b"\r\n\r\n", 1)
                name = lambda x: x.removeprefix(ID_PREFIX).removesuffix(">") or None
                kind = warc["WARC-Type"]
                rows.append(
                    (
                        kind,
                        name(warc["WARC-Record-ID"]),
                        name(warc.get("WARC-Refers-To", "")),
                        warc.get("WARC-Target-URI"),
                        int(_headers(http)["Content-Length"]),
                        payload if kind == "response" else None,
                    )
                )
                rows[-1] += (warc["WARC-Payload-Digest"].removeprefix("sha1:"),)
                held += len(payload)
                if held > 16 << 20:
                    yield _with_digest(rows, emit)
                    rows, held = [], 0
            if rows:
                yield _with_digest(rows, emit)


def _with_digest(rows: list[tuple], emit) -> pa.RecordBatch:
    batch = emit([r[:-1] for r in rows])
    return pa.RecordBatch.from_arrays(
        [*batch.columns, pa.array([r[-1] for r in rows], pa.string())], names=[*batch.schema.names, "payload_digest"]
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: record_type, record_id, refers_to, target_uri, http_length, payload, payload_digest."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(
        _read,
        "record_type string, record_id string, refers_to string, target_uri string, http_length bigint, "
        "payload binary, payload_digest string",
    )
