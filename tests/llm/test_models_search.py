"""Classifier and language model on held-out rows; search recall against brute force."""

import math
import zlib
from functools import reduce

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID

from landfall.llm import ann, lm, quality
from landfall.llm.queries import N_GRADES, grade_of_labels

TEXTS = [(1, "a plain text", 0), (2, None, 1), (3, "", 2), (3, "", 2), (None, "x " * 50_000, 3)]
CLASH = "doc_id bigint, text string, grade int"


# -- quality classifier ----------------------------------------------------------


def test_classifier_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    held_out = F.col("doc_id") % 4 == 0
    model = quality.train(docs, "doc_id", "text", labels.filter(~held_out), "doc_id", grade_of_labels(), N_GRADES)
    assert (np.diff(model.thresholds) >= 0).all()
    scored = quality.score_documents(docs.filter(held_out), "doc_id", "text", model)
    rows = scored.join(labels, "doc_id").collect()
    good = [r.tail[0] >= 0.5 for r in rows if r.quality == 1]
    poor = [r.tail[0] >= 0.5 for r in rows if r.quality == 0]
    assert len(good) > 50 and np.mean(good) > 0.97
    assert np.mean(poor) < 0.1
    clean = [r.tail[1] >= 0.5 for r in rows if r.quality == 1 and not r.toxic]
    assert np.mean(clean) > 0.97
    for r in rows[:20]:
        assert r.expected_grade == pytest.approx(sum(r.tail))
        assert r.tail[0] >= r.tail[1]


def test_selection_keeps_columns_and_odd_rows(spark):
    df = spark.createDataFrame(TEXTS, CLASH)
    untrained = quality.fit_ordinal([], [], 3)
    assert quality.select_documents(df, "text", untrained, 2, 0.5).count() == len(TEXTS)
    kept = quality.select_documents(df, "text", quality.OrdinalModel(untrained.weights, np.array([1.0, 2.0])), 1, 0.5)
    assert kept.columns == df.columns and kept.count() == 0
    assert quality.score_documents(df, "doc_id", "text", untrained).count() == len(TEXTS)
    empty = df.limit(0)
    ratings = df.select("doc_id", "grade").limit(0)
    model = quality.train(empty, "doc_id", "text", ratings, "doc_id", F.col("grade"), 3)
    assert quality.score_documents(empty, "doc_id", "text", model).count() == 0


def plain_loss(weights, cuts, rows, grades):
    """Mean negative log-likelihood of the cumulative-link model, written out."""
    total = 0.0
    for x, y in zip(rows, grades, strict=True):
        below = [0.0, *(1 / (1 + math.exp(-(c - float(weights @ x)))) for c in cuts), 1.0]
        total -= math.log(max(below[y + 1] - below[y], 1e-12))
    return total / len(rows)


def test_fit_comes_near_the_plain_maximum_of_likelihood():
    """Against a descent along numeric gradients of the loss as written out."""
    rng = np.random.default_rng(11)
    x = rng.standard_normal((400, 3))
    noisy = x @ np.array([1.5, -1.0, 0.5]) + rng.logistic(size=400)
    grades = np.digitize(noisy, [-1.0, 1.2]).tolist()
    model = quality.fit_ordinal([(np.arange(3), r) for r in x], grades, 3, epochs=30)
    theta = np.array([0.0, 0.0, 0.0, -1.0, 1.0])
    loss = lambda t: plain_loss(t[:3], np.sort(t[3:]), x, grades)
    for _ in range(80):
        numeric = np.array([(loss(theta + e) - loss(theta - e)) / 2e-4 for e in np.eye(5) * 1e-4])
        theta -= 2.0 * numeric
    assert np.abs(numeric).max() < 5e-3
    got = plain_loss(model.weights[:3], model.thresholds, x, grades)
    assert got < loss(theta) * 1.03 < loss(np.array([0.0, 0.0, 0.0, -1.0, 1.0])) * 0.9
    assert not model.weights[3:].any()


def test_packed_features_are_the_features():
    for text in (None, "", "a", "Word word WORD ... 42 §§", "straße naïve " * 30_000):
        positions, values = quality.features(text)
        got_positions, got_values = quality._unpack(*quality._pack(text))
        assert got_positions.tolist() == positions.tolist()
        assert got_values.tolist() == pytest.approx(values.tolist(), rel=1e-6)


def test_rare_forms_of_a_word_share_a_weight():
    rng = np.random.default_rng(0)
    noise = lambda: "".join(rng.choice(list("aeioustrn"), 8))
    text = lambda bad: " ".join([noise() for _ in range(20)] + ([f"zlub{noise()}"] if bad else []))
    grades = [i % 2 for i in range(600)]
    model = quality.fit_ordinal([quality.features(text(not g)) for g in grades], grades, 2)
    held_out = [[model.tails(model.score(text(bad)))[0] >= 0.5 for _ in range(200)] for bad in (True, False)]
    assert np.mean(held_out[0]) < 0.05 and np.mean(held_out[1]) > 0.95


def test_ratings_with_nulls_and_repeats(spark):
    docs = spark.createDataFrame([(i, "good word" if i % 2 else "bad thing") for i in range(60)], "doc_id bigint, text string")
    ratings = spark.createDataFrame(
        [(i, i % 2) for i in range(60)] + [(1, 1), (None, 1), (2, None)], "doc_id bigint, grade int"
    )
    model = quality.train(docs, "doc_id", "text", ratings, "doc_id", F.col("grade"), 2)
    assert model.tails(model.score("good word"))[0] > 0.5 > model.tails(model.score("bad thing"))[0]


# -- language model ----------------------------------------------------------------


def test_log_probabilities_sum_to_one_and_match_a_plain_loop():
    rng = np.random.default_rng(0)
    params = lm.initial(rng.integers(0, 50, lm.TOKENS).astype(float), seed=1)
    params = {k: v + rng.normal(0, 0.3, v.shape).astype(np.float32) for k, v in params.items()}
    docs = [rng.integers(1, lm.TOKENS, n).astype(np.int32) for n in (1, 0, 7, 30)]
    target, near = lm.contexts([d for d in docs])
    got = lm.log_probabilities(params, target, near)
    at = 0
    for d in docs:
        padded = [0, 0, *d, 0, 0]
        for i, t in enumerate(d):
            h = np.tanh(sum(params["embed"][j][padded[i + 2 + o]] for j, o in enumerate(lm.NEIGHBOURS)))
            z = h @ params["class_w"] + params["class_b"]
            cls = np.exp(z) / np.exp(z).sum()
            p = []
            for c in range(lm.CLASSES):
                y = h @ params["word_w"][c] + params["word_b"][c]
                p.append(cls[c] * np.exp(y) / np.exp(y).sum())
            p = np.concatenate(p)
            assert p.sum() == pytest.approx(1, abs=1e-4)
            assert got[at] == pytest.approx(math.log(p[t]), abs=1e-3)
            at += 1


def test_gradient_steps_reduce_the_loss():
    rng = np.random.default_rng(1)
    tokens = np.tile(np.array([5, 90, 300, 700], np.int32), 300)
    target, near = lm.contexts([tokens])
    params = lm.initial(np.ones(lm.TOKENS))
    squares = {k: np.full_like(v, 1e-6) for k, v in params.items()}
    before = lm.log_probabilities(params, target, near).mean()
    for _ in range(40):
        pick = rng.integers(0, len(target), 256)
        lm.step(params, squares, target[pick], near[:, pick], 0.1)
    assert lm.log_probabilities(params, target, near).mean() > before + 3


def test_trained_model_beats_word_frequencies_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    held_out = docs.filter("doc_id % 5 = 0")
    train = docs.filter("doc_id % 5 <> 0").repartition(2).select("text")
    vocabulary, params = lm.train(train)
    flat = lm.initial(lm.build_vocabulary(train)[1])
    total = lambda p: lm.score_documents(held_out, "doc_id", "text", vocabulary, p).agg(
        F.sum("sum_log_prob") / F.sum("n_tokens")
    ).first()[0]
    assert total(params) > total(flat) + 0.1


def test_scores_of_odd_rows(spark):
    df = spark.createDataFrame(TEXTS, CLASH)
    vocabulary, params = lm.train(df.select("text"))
    got = lm.score_documents(df, "doc_id", "text", vocabulary, params).collect()
    assert len(got) == len(TEXTS)
    by = {r.doc_id: r for r in got}
    assert by[2].n_tokens == 0 and by[2].sum_log_prob == 0 and by[2].mean_log_prob is None
    assert by[None].n_tokens == 50_000 and math.isfinite(by[None].sum_log_prob)
    vocabulary, params = lm.train(df.limit(0).select("text"))
    assert lm.score_documents(df.limit(0), "doc_id", "text", vocabulary, params).count() == 0


def test_every_position_is_a_target_once(spark, monkeypatch):
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 900, n) for n in (1, 2, 7, 8, 9, 40, 500)]
    df = spark.createDataFrame([(" ".join(f"w{x}" for x in d),) for d in docs], "text string").coalesce(1)
    vocabulary, counts = lm.build_vocabulary(df)
    got = np.zeros(lm.TOKENS)

    def seen(params, squares, target, near, rate):
        np.add.at(got, target, 1)

    monkeypatch.setattr(lm, "step", seen)
    batches = lm.tokenize(df, None, "text", vocabulary).select("tokens").toArrow().to_batches()
    weights = []
    for turn in range(lm.ROUNDS):
        for out in lm._train(lm.initial(counts), turn, lm.ROUNDS, 0.1)(iter(batches)):
            weights.append(out.column("weight")[0].as_py())
    assert sum(weights) == sum(map(len, docs))
    assert got.tolist() == counts.tolist()


def test_hashed_words_are_scored_by_their_own_counts(spark, monkeypatch):
    monkeypatch.setattr(lm, "KNOWN", 20)  # so that most shares come by the join
    own = " ".join(f"own{i} " * 9 for i in range(lm.OWN))
    hashed = {f"h{i}": 1 + i % 5 for i in range(600)}
    text = own + " ".join(f"{w} " * n for w, n in hashed.items())
    rows = [(1, text), (2, "own1 h4 h5 h4 H4"), (2, "own1 h4 h5 h4 H4"), (None, "h4 never seen"), (4, "own1 own2")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    vocabulary, counts = lm.build_vocabulary(df.filter("doc_id = 1").select("text"))
    bucket = lambda w: 1 + lm.OWN + zlib.crc32(w.encode()) % 256
    want = np.zeros(lm.TOKENS)
    want[1 : 1 + lm.OWN] = 9
    for w, n in hashed.items():
        want[bucket(w)] += n
    assert counts.tolist() == want.tolist()
    params = lm.initial(counts)
    got = lm.score_documents(df, "doc_id", "text", vocabulary, params).collect()
    assert len(got) == len(rows)
    for (doc_id, said), r in zip(sorted(rows, key=str), sorted(got, key=lambda r: str((r.doc_id,))), strict=True):
        target, near = lm.contexts([vocabulary.tokens(said)])
        total = float(lm.log_probabilities(params, target, near).astype(float).sum())
        for w in said.lower().split():
            if w in hashed:
                total += math.log(hashed[w] / want[bucket(w)])
            elif not w.startswith("own"):
                total += math.log(1 / (want[bucket(w)] + 1))
        assert r.doc_id == doc_id and r.n_tokens == len(said.split())
        assert r.sum_log_prob == pytest.approx(total, rel=1e-5)
        assert r.mean_log_prob == pytest.approx(total / r.n_tokens, rel=1e-5)


# -- nearest neighbours --------------------------------------------------------------


def brute(rows, k):
    out = {}
    for q, v in rows:
        if q % 20 == 0:
            scored = sorted((-float(np.dot(v, w)), i) for i, w in rows if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def test_recall_and_exact_scores(spark):
    rows = duckdb.sql(f"select vec_id, embedding from '{SF_MID}/embeddings.parquet'").fetchall()
    rows = [(i, np.array(v, float)) for i, v in rows]
    want = brute(rows, 20)
    df = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    got = {}
    for r in ann.nearest(df, "vec_id", "embedding", F.col("id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r)
    vectors = dict(rows)
    hits = 0
    for q, near in want.items():
        assert [r.rank for r in got[q]] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in got[q]] == sorted((-r.score, r.vec_id) for r in got[q])
        assert all(r.score == pytest.approx(float(vectors[q] @ vectors[r.vec_id]), rel=1e-12) for r in got[q])
        hits += len({r.vec_id for r in got[q]} & {i for i, _ in near})
    assert hits / (20 * len(want)) >= 0.9


def test_recall_over_many_blocks_and_norms(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 2000)
    monkeypatch.setattr(ann, "QUERIES", 30)
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(4000, 24)) * rng.uniform(0.2, 3, (4000, 1))
    rows = [(i, v) for i, v in enumerate(vectors)]
    want = brute(rows, 10)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "id bigint, v array<double>")
    got = {}
    for r in ann.nearest(df, "id", "v", F.col("id") % 20 == 0, k=10).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(got[q] & {i for i, _ in near}) / 10 for q, near in want.items()]) >= 0.9


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0])]
    rows += [(6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (20, [3.0, 0.0]), (9, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "id bigint, v array<double>, rank int")
    got = ann.nearest(df, "id", "v", F.col("id") % 20 == 0, k=20).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [
        (0, 1, 20, 3.0), (0, 2, 1, 2.0), (0, 3, 2, 2.0), (20, 1, 1, 6.0), (20, 2, 2, 6.0), (20, 3, 0, 3.0),
    ]
    assert ann.nearest(df.limit(0), "id", "v", F.col("id") % 20 == 0).count() == 0
    assert ann.nearest(df.filter("id = 1"), "id", "v", F.col("id") % 20 == 0).count() == 0


def test_equal_vectors_come_in_the_order_of_their_ids():
    rng = np.random.default_rng(8)
    how = ann.Collisions()
    vectors = rng.standard_normal((601, 37))
    vectors[rng.choice(601, 200, replace=False)] = rng.standard_normal(37)
    ids = rng.permutation(601).astype(np.int64)
    norm = float(np.sqrt((vectors**2).sum(1)).max())
    projected = ann._directions(37, how) @ ann._lifted(vectors, norm).T
    order = np.argsort(projected, axis=1, kind="stable")
    queries = rng.standard_normal((100, 37))
    found = ann.search_block(
        ids, vectors, np.argsort(order, axis=1).astype("<i4"), np.take_along_axis(projected, order, 1),
        np.arange(1000, 1100), queries, norm, 20, ann.Collisions(wanted=601),
    )
    for q, got, scores in found:
        exact = [reduce(lambda s, x: s + x[0] * x[1], zip(v.tolist(), queries[q].tolist(), strict=True), 0.0) for v in vectors]
        want = sorted(zip([-x for x in exact], ids.tolist(), strict=True))[:20]
        assert got.tolist() == [i for _, i in want]
        assert scores.tolist() == [-s for s, _ in want]
