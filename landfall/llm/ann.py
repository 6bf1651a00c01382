"""Approximate nearest neighbours by collision counting on sorted projections.

Vectors are cut into hashed blocks. A block's index holds, for each of a few
dozen random directions, its vectors sorted by their projection. A query's
window is centred on its own projection in every direction; a vector inside
the window collides. While too few vectors reach the collision threshold, all
windows grow (virtual rehashing: the same arrays, wider windows).
Vectors at or above the threshold are verified with the exact measure on the
original vectors in double precision.

For inner products, vectors get one more coordinate that makes all norms
equal, which turns the largest inner product into the smallest distance.
Block answers are merged per query; ties go to the smaller id.

Defined cases: null vectors, zero vectors and those with null or non-finite
components take no part, nor do rows with a null id or of another than the
commonest dimension (of equally common ones the smallest); repeated rows count
once; rows that share a query's id are not its candidates; fewer candidates
than asked for are all returned; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import col, written

BLOCK = 8192
QUERIES = 2048


@dataclass(frozen=True)
class Collisions:
    """Directions, the share of them that must collide, half the first window (in norms) and its growth,
    and how many vectors of a block are verified at least: a number, or a share if that is more."""

    directions: int = 48
    share: float = 0.6
    first: float = 0.6
    growth: float = 1.2
    wanted: int = 512
    wanted_share: float = 0.35
    seed: int = 7


def clean(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Distinct (id, vector) rows that take part; one dimension."""
    rows = df.select(
        col(id_col).cast("bigint").alias("id"), col(vector_col).cast("array<double>").alias("vector")
    ).filter("id is not null and vector is not null")
    fine = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(fine & F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"))
    dimension = sizes.orderBy(F.desc("n"), "d").limit(1).collect()
    rows = rows.filter(F.size("vector") == (dimension[0]["d"] if dimension else 0))
    return rows.dropDuplicates(["id", "vector"])


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _directions(dimension: int, how: Collisions) -> np.ndarray:
    return np.random.default_rng(how.seed).standard_normal((how.directions, dimension + 1))


def _lifted(vectors: np.ndarray, norm: float) -> np.ndarray:
    """One more coordinate that brings every vector to the same norm."""
    rest = np.sqrt(np.maximum(norm * norm - np.einsum("ij,ij->i", vectors, vectors), 0))
    return np.hstack([vectors, rest[:, None]])


def _pointed(queries: np.ndarray, norm: float) -> np.ndarray:
    """Queries at that norm with nothing in the new coordinate: nearest is then largest product."""
    lengths = np.sqrt(np.einsum("ij,ij->i", queries, queries))
    return np.hstack([queries * (norm / lengths)[:, None], np.zeros((len(queries), 1))])


def _build(norm: float, how: Collisions):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        vectors = _matrix(table.column("vector"))
        ids = table.column("id").to_numpy()
        projected = _directions(vectors.shape[1], how) @ _lifted(vectors, norm).T
        order = np.argsort(projected, axis=1, kind="stable")
        row = {
            "block": pa.array([key[0].as_py()], pa.int32()),
            "ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()),
            "vectors": pa.array([vectors.astype("<f8").tobytes()], pa.binary()),
            "ranks": pa.array([np.argsort(order, axis=1).astype("<i4").tobytes()], pa.binary()),
            "sorted": pa.array([np.take_along_axis(projected, order, 1).astype("<f8").tobytes()], pa.binary()),
        }
        return pa.table(row)

    return run


def _gather(key: tuple, table: pa.Table) -> pa.Table:
    return pa.table(
        {
            "chunk": pa.array([key[0].as_py()], pa.int32()),
            "query_ids": pa.array([table.column("id").to_numpy().astype("<i8").tobytes()], pa.binary()),
            "query_vectors": pa.array([_matrix(table.column("vector")).astype("<f8").tobytes()], pa.binary()),
        }
    )


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, added up component by component, so equal rows get equal sums wherever they stand."""
    total = np.zeros(len(vectors))
    for column, x in zip(vectors.T, query, strict=True):
        total += column * x
    return total


def search_block(
    ids: np.ndarray,
    vectors: np.ndarray,
    ranks: np.ndarray,
    sorted_: np.ndarray,
    query_ids: np.ndarray,
    queries: np.ndarray,
    norm: float,
    k: int,
    how: Collisions,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query's row, candidate ids, scores): each query's best ``k`` of one block among the verified."""
    n = len(ids)
    threshold = max(1, math.ceil(how.share * how.directions))
    wanted = min(n, max(how.wanted, k + 1, math.ceil(how.wanted_share * n)))
    # Ranks below 65536 are compared as 16-bit numbers, which is several times faster.
    small = np.uint16 if n < 1 << 16 else np.uint32
    ranks = ranks.astype(small)
    centres = _directions(vectors.shape[1], how) @ _pointed(queries, norm).T
    best: dict[int, np.ndarray] = {}
    open_, half = np.arange(len(queries)), how.first * norm
    while len(open_):
        low = np.stack([np.searchsorted(s, c - half, "left") for s, c in zip(sorted_, centres[:, open_], strict=True)])
        high = np.stack([np.searchsorted(s, c + half, "right") for s, c in zip(sorted_, centres[:, open_], strict=True)])
        still = []
        for at, q in enumerate(open_):
            # A vector collides where its rank lies in the window; wrap-around makes that one comparison.
            first, width = low[:, at, None].astype(small), (high - low)[:, at, None].astype(small)
            inside = ranks - first < width
            found = np.nonzero(np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint16) >= threshold)[0]
            if len(found) >= wanted or (high - low)[:, at].min() == n:
                best[int(q)] = found
            else:
                still.append(q)
        open_, half = np.array(still, int), half * how.growth
    for q, found in best.items():
        found = found[ids[found] != query_ids[q]]
        near = np.take(vectors, found, axis=0) @ queries[q]
        if len(found) > k:
            # Sums of a matrix product depend on a row's place: what may tie within rounding is scored again.
            close = 1e-9 * norm * math.sqrt(float(queries[q] @ queries[q]))
            found = found[near >= np.partition(near, len(near) - k)[len(near) - k] - close]
        scores = products(vectors[found], queries[q])
        top = np.lexsort((ids[found], -scores))[:k]
        yield q, ids[found][top], scores[top]


def _search(norm: float, k: int, how: Collisions):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part = lambda name, kind: np.frombuffer(batch.column(name)[i].as_buffer(), kind)  # noqa: E731, B023
                ids, query_ids = part("ids", "<i8"), part("query_ids", "<i8")
                m = how.directions
                found = list(
                    search_block(
                        ids,
                        part("vectors", "<f8").reshape(len(ids), -1),
                        part("ranks", "<i4").reshape(m, -1),
                        part("sorted", "<f8").reshape(m, -1),
                        query_ids,
                        part("query_vectors", "<f8").reshape(len(query_ids), -1),
                        norm,
                        k,
                        how,
                    )
                )
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate([np.full(len(c), query_ids[q]) for q, c, _ in found]), pa.int64()),
                            pa.array(np.concatenate([c for _, c, _ in found]), pa.int64()),
                            pa.array(np.concatenate([s for _, _, s in found]), pa.float64()),
                        ],
                        names=["query_id", "vec_id", "score"],
                    )

    return run


def nearest(
    df: DataFrame, id_col: str, vector_col: str, is_query: Column, k: int = 20, how: Collisions = Collisions()
) -> DataFrame:
    """Each query's ``k`` nearest found: query_id, rank (from 1), vec_id, score.

    ``is_query`` is a condition on the column ``id``. Several vectors under
    one query id are searched one by one and answered together.
    """
    spark = df.sparkSession
    rows = written(spark, clean(df, id_col, vector_col), "vectors")
    size = rows.agg(
        F.count("*").alias("n"),
        F.count(F.when(is_query, 1)).alias("q"),
        F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))).alias("norm"),
    ).first()
    blocks, chunks = max(1, math.ceil(size["n"] / BLOCK)), max(1, math.ceil(size["q"] / QUERIES))
    norm = float(size["norm"] or 1.0)
    hashed = F.xxhash64("id", "vector")
    index = (
        rows.withColumn("block", F.pmod(hashed, F.lit(blocks)).cast("int"))
        .groupBy("block")
        .applyInArrow(_build(norm, how), "block int, ids binary, vectors binary, ranks binary, sorted binary")
    )
    index = written(spark, index, "index")
    queries = (
        rows.filter(is_query)
        .withColumn("chunk", F.pmod(hashed, F.lit(chunks)).cast("int"))
        .groupBy("chunk")
        .applyInArrow(_gather, "chunk int, query_ids binary, query_vectors binary")
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    )
    # A task for each block and chunk, as far as a shuffle has partitions.
    tasks = min(blocks * chunks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = (
        queries.join(index, "block")
        .repartition(tasks, "block", "chunk")
        .mapInArrow(_search(norm, k, how), "query_id bigint, vec_id bigint, score double")
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
