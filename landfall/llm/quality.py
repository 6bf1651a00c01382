"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed word beginnings (which gather a word's inflected
forms, each of which may be rare) and word shapes is shared by all grades;
ordered thresholds cut the score s = w.x, so that
P(grade > j) = sigmoid(s - threshold_j). The expected grade and the
probability of the top grades select documents.

The model is fitted on a bounded sample of rated documents (``sample``, by
hash of the id); its parameters have a fixed size. The sample reaches the driver
as two bytes a beginning. Scoring reads every whole text once, without a shuffle.

Defined cases: null text counts as empty; an empty text has only the
constant features and is scored like any other; null ratings are left out;
several ratings of a document all count; without any rated document, or with
fewer than two grades seen, all scores are those of the untrained model and
nothing is rejected; an empty table gives an empty result; other columns are
kept (``select_documents``) or ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.common import col

STEM_BITS = 16
SHAPE_BITS = 10
STEMS, SHAPES = 1 << STEM_BITS, 1 << SHAPE_BITS
#: Letters of a word's short and long beginning, hashed to the same buckets.
SHORT, LONG = 3, 4
#: Beginnings, shapes, repeats of the previous word, share of distinct words.
DIMENSIONS = STEMS + SHAPES + 2
SAMPLE = 20_000
#: Value of a beginning that is there; scale of the shares of shapes, repeats and distinct words.
PRESENT, STYLE = 0.25, 12.0
WORD_CACHE = 400_000
_PUNCT = re.compile(r"[\W_]+")


def _shape(word: str) -> str:
    if word.isalpha():
        if word.islower():
            return "a"
        if word.isupper():
            return "A"
        return "Aa" if word[0].isupper() and word[1:].islower() else "aA"
    out = ""
    for ch in word:
        kind = "a" if ch.islower() else "A" if ch.isupper() else "0" if ch.isdigit() else ch
        if out[-1:] != kind:
            out += kind
    return out


class _Codes(dict):
    """word -> buckets of both beginnings and of the shape in one integer, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        bare = word.lower() if word.isalpha() else _PUNCT.sub("", word.lower())
        code = zlib.crc32(bare[:SHORT].encode()) % STEMS
        code = code << STEM_BITS | zlib.crc32(bare[:LONG].encode()) % STEMS
        code = code << SHAPE_BITS | zlib.crc32(_shape(word).encode()) % SHAPES
        self[word] = code
        return code


_CODES = _Codes()


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sparse features of a whole text: (positions, values)."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return np.array([DIMENSIONS - 1]), np.array([0.0])
    codes = np.fromiter(map(_CODES.__getitem__, words), np.int64, n)
    distinct = np.unique(codes)
    long_ones = distinct >> SHAPE_BITS
    present = np.unique(np.concatenate([long_ones >> STEM_BITS, long_ones & (STEMS - 1)]))
    shapes = np.bincount(codes & (SHAPES - 1), minlength=SHAPES)
    used = np.nonzero(shapes)[0]
    repeats = np.count_nonzero(codes[1:] == codes[:-1]) / n
    positions = np.concatenate([present, STEMS + used, [DIMENSIONS - 2, DIMENSIONS - 1]])
    values = np.concatenate(
        [
            np.full(len(present), PRESENT),
            STYLE * np.sqrt(shapes[used] / n),
            [STYLE * math.sqrt(repeats), STYLE * len(set(words)) / n],
        ]
    )
    return positions, values


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades

    def score(self, text: str | None) -> float:
        positions, values = features(text)
        return float(self.weights[positions] @ values)

    def tails(self, score: float) -> np.ndarray:
        """P(grade > j) for each threshold j."""
        return _sigmoid(score - self.thresholds)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_ordinal(
    rows: list[tuple[np.ndarray, np.ndarray]],
    grades: list[int],
    n_grades: int,
    epochs: int = 12,
    rate: float = 0.3,
    decay: float = 1e-5,
    min_documents: int = 60,
    seed: int = 0,
) -> OrdinalModel:
    """Maximum likelihood by adaptive stochastic gradients over the sample.

    Buckets of beginnings met in fewer than ``min_documents`` rated documents
    (at most a fiftieth of the sample) get no weight.
    """
    weights, squares = np.zeros(DIMENSIONS), np.full(DIMENSIONS, 1e-8)
    cuts = np.linspace(-1, 1, n_grades - 1) if n_grades > 2 else np.zeros(n_grades - 1)
    cut_squares = np.full(n_grades - 1, 1e-8)
    if len(set(grades)) < 2:
        return OrdinalModel(weights, cuts - 36)
    met = np.zeros(DIMENSIONS, np.int64)
    for positions, _ in rows:
        met[positions] += 1
    enough = min(min_documents, max(1, len(rows) // 50))
    usable = (met >= enough) | (np.arange(DIMENSIONS) >= STEMS)
    rows = [(p[usable[p]], v[usable[p]]) for p, v in rows]
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            (at, x), y = rows[i], grades[i]
            s = weights[at] @ x
            upper = _sigmoid(cuts[y] - s) if y < n_grades - 1 else 1.0
            lower = _sigmoid(cuts[y - 1] - s) if y else 0.0
            p = max(upper - lower, 1e-9)
            d_upper, d_lower = upper * (1 - upper), lower * (1 - lower)
            g = (d_upper - d_lower) / p * x + decay * weights[at]
            squares[at] += g * g
            weights[at] -= rate * g / np.sqrt(squares[at])
            for j, step in ((y, -d_upper / p), (y - 1, d_lower / p)):
                if 0 <= j < n_grades - 1:
                    cut_squares[j] += step * step
                    cuts[j] -= rate * step / math.sqrt(cut_squares[j])
            cuts = np.maximum.accumulate(cuts)
    return OrdinalModel(weights, cuts)


def _pack(text: str | None) -> tuple[bytes, bytes, bytes]:
    """The features of a text as bytes: beginnings, then positions and values of the others."""
    positions, values = features(text)
    n = np.searchsorted(positions, STEMS)
    style = (positions[n:] - STEMS).astype("<u2"), values[n:].astype("<f4")
    return positions[:n].astype("<u2").tobytes(), style[0].tobytes(), style[1].tobytes()


def _unpack(stems: bytes, style: bytes, style_values: bytes) -> tuple[np.ndarray, np.ndarray]:
    stems, style = (np.frombuffer(b, "<u2").astype(np.int32) for b in (stems, style))
    values = np.concatenate([np.full(len(stems), PRESENT, np.float32), np.frombuffer(style_values, "<f4")])
    return np.concatenate([stems, STEMS + style]), values


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = [_pack(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("key"),
                batch.column("grade"),
                *(pa.array([p[i] for p in packed], pa.binary()) for i in range(3)),
            ],
            names=["key", "grade", "stems", "style", "style_values"],
        )


def train(
    df: DataFrame,
    id_col: str,
    text_col: str,
    ratings: DataFrame,
    rating_id: str,
    grade: Column,
    n_grades: int,
    sample: int = SAMPLE,
) -> OrdinalModel:
    """Fit on at most ``sample`` ratings, chosen by hash of the id; grades are 0 .. n_grades-1."""
    rated = (
        ratings.select(col(rating_id).alias("id"), grade.cast("int").alias("grade"))
        .filter("id is not null and grade is not null")
        .orderBy(F.xxhash64("id"), "id", "grade")
        .limit(sample)
    )
    docs = df.select(col(id_col).alias("id"), col(text_col).alias("text"))
    # At most ``sample`` rows of two numbers: bounded, so broadcast.
    rows = (
        docs.join(F.broadcast(rated), "id")
        .select(F.xxhash64("id", "grade", "text").alias("key"), "grade", "text")
        .mapInArrow(_featurise, "key bigint, grade int, stems binary, style binary, style_values binary")
        .orderBy("key")
        .limit(2 * sample)
        .collect()
    )
    return fit_ordinal(
        [_unpack(r["stems"], r["style"], r["style_values"]) for r in rows],
        [r["grade"] for r in rows],
        n_grades,
    )


def score_documents(df: DataFrame, id_col: str, text_col: str, model: OrdinalModel) -> DataFrame:
    """One row per row of ``df``: doc_id, score, expected_grade, tail (P(grade > j) for each j)."""
    docs = df.select(col(id_col).alias("id"), col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t) for t in batch.column("text").to_pylist()]
            tails = [model.tails(s) for s in scores]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(scores, pa.float64()),
                    pa.array([float(t.sum()) for t in tails], pa.float64()),
                    pa.array([t.tolist() for t in tails], pa.list_(pa.float64())),
                ],
                names=["id", "score", "expected_grade", "tail"],
            )

    schema = T.StructType(
        [
            docs.schema["id"],
            T.StructField("score", T.DoubleType()),
            T.StructField("expected_grade", T.DoubleType()),
            T.StructField("tail", T.ArrayType(T.DoubleType())),
        ]
    )
    return docs.mapInArrow(run, schema).withColumnRenamed("id", "doc_id")


def select_documents(df: DataFrame, text_col: str, model: OrdinalModel, grade: int, least: float) -> DataFrame:
    """The rows of ``df`` with P(grade >= ``grade``) >= ``least``, all columns kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            kept = [bool(model.tails(model.score(t))[grade - 1] >= least) for t in texts]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return df.mapInArrow(run, df.schema)
