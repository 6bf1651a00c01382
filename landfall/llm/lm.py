"""Language-model scores by masked pseudo-likelihood.

Each token is predicted from its neighbours on both sides: embeddings of the
two tokens before and the two after (one table per position) add up, through
tanh, to a hidden vector; a softmax over word classes and one inside the class
give the token's conditional probability. A document's score is the sum of
these log-probabilities over all its tokens.

Words are counted over the whole corpus; the most frequent have tokens of
their own, the others share hashed tokens. The network predicts tokens; a word
with a shared token adds the log of its share of that token's occurrences, so
the score is of the word itself. The shares of the commonest words go along
with the vocabulary, those of all others come from the table of counts by a
join on the word. Training masks every
position of every document in one of its rounds (of two rounds, each every
second position): each task runs stochastic gradients over its
documents, and the parameters of all tasks are averaged, weighted by their
positions. So every document adds to the model, and what is gathered grows
with the tasks, that is with the input. Words are looked up once: training and
scoring read the written tokens.

Defined cases: null or blank text has no tokens, score 0 and no mean; a single
token is predicted from padding; a word that was never counted has the share
it would get by one occurrence; repeated rows get equal scores; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.common import col, written

CLASSES = 32
PER_CLASS = 32
TOKENS = CLASSES * PER_CLASS
#: Token 0 is padding; own tokens for the commonest words; the rest are hashed.
OWN = 767
SHARED = TOKENS - 1 - OWN
#: So many of the hashed words take their shares along; all others are joined.
KNOWN = 100_000
HIDDEN = 16
NEIGHBOURS = (-2, -1, 1, 2)
BATCH = 2048
ROUNDS = 2

Parameters = dict[str, np.ndarray]


def _shared(word: str) -> int:
    return 1 + OWN + zlib.crc32(word.encode()) % SHARED


class Vocabulary(dict):
    """word -> place in ``token_of`` and ``share_of``.

    Words without a token of their own are hashed; those not in ``known`` are
    remembered up to a bound, and their share is not known here (nan).
    ``words_counted`` (word, n) and ``counts`` by token stay on the driver.
    """

    def __init__(self, words: list[str], known: list[str] = (), shares: np.ndarray = ()) -> None:
        super().__init__()
        self.words, self.known, self.shares, self.bound = words, known, shares, len(words) + 400_000
        self.words_counted: DataFrame | None = None
        self.counts: np.ndarray | None = None
        self.token_of = np.concatenate([np.arange(TOKENS), [_shared(w) for w in known]]).astype(np.int32)
        self.share_of = np.concatenate([np.zeros(1 + OWN), np.full(SHARED, np.nan), shares])
        self._fill()

    def _fill(self) -> None:
        self.update((w, TOKENS + i) for i, w in enumerate(self.known))
        self.update((w, i + 1) for i, w in enumerate(self.words))

    def __reduce__(self):
        return Vocabulary, (self.words, self.known, self.shares)

    def __missing__(self, word: str) -> int:
        if len(self) >= self.bound:
            self.clear()
            self._fill()
        token = self[word] = _shared(word)
        return token

    def places(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))

    def tokens(self, text: str | None) -> np.ndarray:
        return self.token_of[self.places((text or "").lower().split())]


def contexts(tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(targets, neighbours by position) of documents; padding beyond their ends."""
    reach = max(NEIGHBOURS)
    pad = np.zeros(reach, np.int32)
    flat = np.concatenate([pad, *[x for t in tokens for x in (t, pad)]])
    at = np.nonzero(flat)[0]
    return flat[at], np.stack([flat[at + d] for d in NEIGHBOURS])


def initial(counts: np.ndarray, seed: int = 0) -> Parameters:
    """Small random embeddings; output biases from the tokens' counts."""
    rng = np.random.default_rng(seed)
    p = (counts + 0.5) / (counts + 0.5).sum()
    by_class = p.reshape(CLASSES, PER_CLASS)
    mass = by_class.sum(1)
    small = lambda *shape: rng.normal(0, 0.05, shape).astype(np.float32)
    return {
        "embed": small(len(NEIGHBOURS), TOKENS, HIDDEN),
        "class_w": small(HIDDEN, CLASSES),
        "class_b": np.log(mass).astype(np.float32),
        "word_w": small(CLASSES, HIDDEN, PER_CLASS),
        "word_b": np.log(by_class / mass[:, None]).astype(np.float32),
    }


def _row_max(z: np.ndarray) -> np.ndarray:
    return z.T.copy().max(0)[:, None]  # along long rows, which is faster


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - _row_max(z)
    return z - np.log(np.exp(z) @ np.ones((z.shape[1], 1), z.dtype))


def _hidden(params: Parameters, near: np.ndarray) -> np.ndarray:
    h = params["embed"][0].take(near[0], 0)
    for d in range(1, len(NEIGHBOURS)):
        h += params["embed"][d].take(near[d], 0)
    return np.tanh(h, out=h)


def _by_class(target: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order that puts the positions of a class together, and (class, from, to) of those that occur."""
    cls = (target // PER_CLASS).astype(np.int16)
    order = np.argsort(cls, kind="stable")
    edges = np.searchsorted(cls[order], np.arange(CLASSES + 1)).tolist()
    return order, [(c, edges[c], edges[c + 1]) for c in range(CLASSES) if edges[c] < edges[c + 1]]


def _inner(params: Parameters, h: np.ndarray, cls: np.ndarray, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Logits inside the class of each position; positions lie by class."""
    z = params["word_b"].take(cls, 0)
    for c, start, end in spans:
        z[start:end] += h[start:end] @ params["word_w"][c]
    return z


def log_probabilities(params: Parameters, target: np.ndarray, near: np.ndarray) -> np.ndarray:
    """log P(target | both sides) for each position."""
    order, spans = _by_class(target)
    target, near = target[order], near[:, order]
    h = _hidden(params, near)
    cls, word = target // PER_CLASS, target % PER_CLASS
    rows = np.arange(len(target))
    logs = _log_softmax(h @ params["class_w"] + params["class_b"])[rows, cls]
    logs += _log_softmax(_inner(params, h, cls, spans))[rows, word]
    out = np.empty_like(logs)
    out[order] = logs
    return out


def _error(z: np.ndarray, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Softmax less the true choice, in place of ``z``."""
    z -= _row_max(z)
    np.exp(z, out=z)
    z /= z @ np.ones((z.shape[1], 1), z.dtype)
    z[rows, at] -= 1
    return z


def step(params: Parameters, squares: Parameters, target: np.ndarray, near: np.ndarray, rate: float) -> None:
    """One adaptive gradient step on a batch of positions, in place."""
    order, spans = _by_class(target)
    target, near = target[order], near[:, order]
    h = _hidden(params, near)
    cls, word = target // PER_CLASS, target % PER_CLASS
    n, rows = len(target), np.arange(len(target))
    err = _error(h @ params["class_w"] + params["class_b"], rows, cls)
    grads = {"class_w": h.T @ err, "class_b": err.sum(0)}
    back = err @ params["class_w"].T
    grads["word_w"], grads["word_b"] = np.zeros_like(params["word_w"]), np.zeros_like(params["word_b"])
    inner = _error(_inner(params, h, cls, spans), rows, word)
    for c, start, end in spans:
        grads["word_w"][c] = h[start:end].T @ inner[start:end]
        back[start:end] += inner[start:end] @ params["word_w"][c].T
    classes, starts = [c for c, _, _ in spans], [start for _, start, _ in spans]
    grads["word_b"][classes] = np.add.reduceat(inner, starts, axis=0)
    back *= 1 - h * h
    for d in range(len(NEIGHBOURS)):  # rows that no neighbour uses have no gradient
        order = np.argsort(near[d].astype(np.int16), kind="stable")
        tokens = near[d][order]
        first = np.flatnonzero(np.diff(tokens, prepend=-1))
        used, g = tokens[first], np.add.reduceat(back.take(order, 0), first, axis=0) / n
        total = squares["embed"][d].take(used, 0) + g * g
        squares["embed"][d][used] = total
        params["embed"][d][used] -= rate * g / np.sqrt(total)
    for name, g in grads.items():
        g /= n
        squares[name] += g * g
        params[name] -= rate * g / np.sqrt(squares[name])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def emit(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"]
        )

    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column("text").to_pylist():
            counts.update((text or "").lower().split())
            if len(counts) > 300_000:
                yield emit(counts)
                counts.clear()
    if counts:
        yield emit(counts)


def _shared_token(word: Column) -> Column:
    """``_shared`` as a column expression."""
    return F.crc32(word.cast("binary")) % SHARED + (1 + OWN)


def _common_from(words: DataFrame, most: int) -> int:
    """A count that at most ``most`` words reach, from a histogram of counts with 16 classes for each power of two."""
    kind = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    held = words.groupBy(kind.alias("kind")).agg(F.count("*").alias("words"), F.min("n").alias("least"))
    total, cut = 0, 1 << 62
    for row in sorted(held.collect(), key=lambda r: -r["kind"]):  # no more than 16 * 63 rows
        total += row["words"]
        if total > most:
            break
        cut = row["least"]
    return cut


def build_vocabulary(docs: DataFrame) -> tuple[Vocabulary, np.ndarray]:
    """The commonest words of all documents, and the count of every token."""
    counted = docs.mapInArrow(_count_words, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    words = written(docs.sparkSession, counted, "words")  # read three times, counted once
    cut = _common_from(words, OWN + KNOWN)
    own = words.orderBy(F.desc("n"), "word").limit(OWN).collect()
    mine = {row["word"] for row in own}
    known = [r for r in words.filter(F.col("n") >= cut).collect() if r["word"] not in mine]
    counts = np.zeros(TOKENS)
    for row in words.groupBy(_shared_token(F.col("word")).alias("token")).agg(F.sum("n").alias("n")).collect():
        counts[row["token"]] = row["n"]  # at most SHARED rows
    for i, row in enumerate(own):
        counts[_shared(row["word"])] -= row["n"]
        counts[i + 1] = row["n"]
    names = [r["word"] for r in known]
    shares = np.array([np.log(r["n"] / counts[_shared(r["word"])]) for r in known])
    vocabulary = Vocabulary([r["word"] for r in own], names, shares)
    vocabulary.words_counted, vocabulary.counts = words, counts
    return vocabulary, counts


def _joined_shares(rare: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(key, share): the summed log shares of the ``words`` of each key."""
    totals = F.array(*[F.lit(float(n)) for n in vocabulary.counts])
    total = F.element_at(totals, (_shared_token(F.col("word")) + 1).cast("int"))
    share = F.log(F.coalesce("n", F.lit(1))) - F.log(total + F.when(F.col("n").isNull(), 1).otherwise(0))
    said = rare.select("key", F.explode("words").alias("word"))
    return (
        said.join(vocabulary.words_counted, "word", "left").groupBy("key").agg(F.sum(share).alias("share"))
    )


def turn_targets(tokens: np.ndarray, turn: int, rounds: int) -> slice:
    """The positions of a document that round ``turn`` masks: over the rounds each of them once."""
    return slice((zlib.crc32(tokens[:16].tobytes()) + turn) % rounds, None, rounds)


TOKENIZED = "n_tokens bigint, tokens binary, share double, key string, words array<string>"


def _tokenized(vocabulary: Vocabulary):
    """Tokens (two bytes each), the summed known log shares, and the words whose share is not known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, tokens, shares, keys, rare = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                words = (text or "").lower().split()
                places = vocabulary.places(words)
                share = vocabulary.share_of[places]
                unknown = np.nonzero(np.isnan(share))[0].tolist()
                sizes.append(len(words))
                tokens.append(vocabulary.token_of[places].astype("<u2").tobytes())
                shares.append(float(np.nansum(share)))
                keys.append(hashlib.blake2b(text.encode(), digest_size=16).hexdigest() if unknown else None)
                rare.append([words[i] for i in unknown])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(tokens, pa.binary()),
                    pa.array(shares, pa.float64()),
                    pa.array(keys, pa.string()),
                    pa.array(rare, pa.list_(pa.string())),
                ],
                names=["id", "n_tokens", "tokens", "share", "key", "words"],
            )

    return run


def tokenize(df: DataFrame, id_col: str | None, text_col: str, vocabulary: Vocabulary) -> DataFrame:
    """(id, tokens and what their scores need) of every row, written once: training and scoring read it."""
    ident = F.lit(None).cast("bigint") if id_col is None else col(id_col)
    docs = df.select(ident.alias("id"), col(text_col).alias("text"))
    schema = T.StructType([docs.schema["id"]] + T._parse_datatype_string(TOKENIZED).fields)
    return written(df.sparkSession, docs.mapInArrow(_tokenized(vocabulary), schema), "tokens")


def _read_tokens(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(t, "<u2").astype(np.int32) for t in batch.column("tokens").to_pylist()]


#: Parameters travel in parts of so many numbers.
PART = 1 << 12


def _train(params: Parameters, turn: int, rounds: int, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {k: v.copy() for k, v in params.items()}
        squares = {k: np.full_like(v, 1e-6) for k, v in params.items()}
        seen, waiting, held = 0, [], 0

        def learn() -> None:
            target, near = (np.concatenate(x, axis=-1) for x in zip(*waiting, strict=True))
            for at in range(0, len(target), BATCH):
                step(own, squares, target[at : at + BATCH], near[:, at : at + BATCH], rate)

        for batch in batches:
            for tokens in _read_tokens(batch):
                if not len(tokens):
                    continue
                target, near = contexts([tokens])
                mine = turn_targets(tokens, turn, rounds)
                waiting.append((target[mine], near[:, mine]))
                held += len(waiting[-1][0])
                if held >= 16 * BATCH:
                    learn()
                    seen, waiting, held = seen + held, [], 0
        if waiting:
            learn()
            seen += held
        if seen:
            flat = _flat(own).astype(np.float64) * seen
            parts = [flat[at : at + PART].tobytes() for at in range(0, len(flat), PART)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(parts)), pa.int32()),
                    pa.array([float(seen)] * len(parts), pa.float64()),
                    pa.array(parts, pa.binary()),
                ],
                names=["part", "weight", "total"],
            )

    return run


def _flat(params: Parameters) -> np.ndarray:
    return np.concatenate([v.ravel() for v in params.values()])


def _unflat(flat: np.ndarray, like: Parameters) -> Parameters:
    out, at = {}, 0
    for name, v in like.items():
        out[name] = flat[at : at + v.size].astype(np.float32).reshape(v.shape)
        at += v.size
    return out


def _added(key: tuple, table: pa.Table) -> pa.Table:
    """One row for the rows of a part."""
    # In the order of their bytes, so that the sum doesn't depend on the order of arrival.
    rows = sorted(zip(table.column("total").to_pylist(), table.column("weight").to_pylist(), strict=True))
    total = np.zeros(len(rows[0][0]) // 8)
    for part, _ in rows:
        total += np.frombuffer(part, np.float64)
    weight = sum(w for _, w in rows)
    return pa.table(
        {
            "part": pa.array([key[0].as_py()], pa.int32()),
            "weight": pa.array([weight], pa.float64()),
            "total": pa.array([total.tobytes()], pa.binary()),
        }
    )


def fit_tokens(tokens: DataFrame, counts: np.ndarray, rounds: int = ROUNDS, rate: float = 0.1) -> Parameters:
    """Averaged parameters from all documents of a table of :func:`tokenize`.

    Each task trains on its partition, so the model depends on how the table
    is cut into tasks.
    """
    params, kind = initial(counts), "part int, weight double, total binary"
    for turn in range(rounds):
        sums = (
            tokens.select("tokens")
            .mapInArrow(_train(params, turn, rounds, rate), kind)
            .withColumn("salt", F.spark_partition_id() % 64)
            .groupBy("part", "salt")
            .applyInArrow(_added, kind)
            .groupBy("part")
            .applyInArrow(_added, kind)
            .collect()  # one row for each part of the parameters, of fixed size
        )
        if sums:
            parts = sorted(sums, key=lambda r: r["part"])
            params = _unflat(np.concatenate([np.frombuffer(r["total"], np.float64) / r["weight"] for r in parts]), params)
    return params


def train(docs: DataFrame, rounds: int = ROUNDS, rate: float = 0.1) -> tuple[Vocabulary, Parameters]:
    """Vocabulary and averaged parameters from all documents (column ``text``)."""
    vocabulary, counts = build_vocabulary(docs)
    return vocabulary, fit_tokens(tokenize(docs, None, "text", vocabulary), counts, rounds, rate)


def score_documents(
    df: DataFrame, id_col: str, text_col: str, vocabulary: Vocabulary, params: Parameters
) -> DataFrame:
    """One row per row of ``df``: doc_id, n_tokens, sum_log_prob, mean_log_prob."""
    return score_tokens(tokenize(df, id_col, text_col, vocabulary), vocabulary, params)


def train_and_score(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """:func:`score_documents` by a model of the same documents; words are looked up once for both."""
    vocabulary, counts = build_vocabulary(df.select(col(text_col).alias("text")))
    tokens = tokenize(df, id_col, text_col, vocabulary)
    return score_tokens(tokens, vocabulary, fit_tokens(tokens, counts))


def score_tokens(tokens: DataFrame, vocabulary: Vocabulary, params: Parameters) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, waiting, held = [], [], 0

            def score(waiting: list[np.ndarray]) -> list[float]:
                # Long documents pass in slices; each position sees its true neighbours.
                target, near = contexts(waiting)
                logs = [
                    log_probabilities(params, target[at : at + 16 * BATCH], near[:, at : at + 16 * BATCH])
                    for at in range(0, len(target), 16 * BATCH)
                ]
                ends = np.cumsum([0, *map(len, waiting)])
                total = np.concatenate([[0.0], np.cumsum(np.concatenate([[], *logs]), dtype=np.float64)])
                return (total[ends[1:]] - total[ends[:-1]]).tolist()

            for document in _read_tokens(batch):
                waiting.append(document)
                held += len(document)
                if held >= 16 * BATCH:
                    sums += score(waiting)
                    waiting, held = [], 0
            sums += score(waiting)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("n_tokens"),
                    pc.add(pa.array(sums, pa.float64()), batch.column("share")),
                    batch.column("key"),
                ],
                names=["id", "n_tokens", "partial", "key"],
            )

    schema = T.StructType(
        [
            tokens.schema["id"],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("partial", T.DoubleType()),
            T.StructField("key", T.StringType()),
        ]
    )
    scored = tokens.select("id", "n_tokens", "tokens", "share", "key").mapInArrow(run, schema)
    # Rows of equal text share a key; those without rare words get keys that match nothing and spread.
    rare = tokens.filter("key is not null").select("key", "words").dropDuplicates(["key"])
    shares = written(tokens.sparkSession, _joined_shares(rare, vocabulary), "shares")
    seek = F.coalesce("key", F.concat(F.lit("\0"), F.xxhash64("id", "partial").cast("string")))
    found = scored.withColumn("key", seek).join(shares, "key", "left")
    total = F.col("partial") + F.coalesce(shares["share"], F.lit(0.0))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_tokens",
        total.alias("sum_log_prob"),
        F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_prob"),
    )
