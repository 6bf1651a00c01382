"""The Jaccard join against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from landfall.llm import jaccard


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(texts, k, num, den):
    sets = [shingles(t, k) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    shared = [rng.choice(words) for _ in range(40)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.5 and texts:
            ws = (rng.choice(texts) or "a b").split()
            for _ in range(rng.randrange(3)):
                if ws:
                    ws[rng.randrange(len(ws))] = rng.choice(words)
        else:
            ws = [rng.choice(words) for _ in range(rng.randrange(1, 80))]
            if kind > 0.8:
                ws = shared + ws[:10]
        texts.append(" ".join(ws))
    return texts + ["", None, " \t\n", "one", "ONE", "one two", "a b c d", "A\x0bb c D", "ä b c d e", "Ä b c d e"]


@pytest.mark.parametrize("k,num,den", [(4, 85, 100), (5, 80, 100), (1, 1, 2)])
def test_components_equal_all_pairs(spark, k, num, den):
    texts = corpus(k, 150)
    roots, sizes = brute(texts, k, num, den)
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in enumerate(texts)], "id bigint, text string, size int, sid string")
    got = {r.doc_id: r for r in jaccard.near_duplicate_classes(df, "id", "text", k, num, den).collect()}
    assert {i: r.component_id for i, r in got.items()} == dict(enumerate(roots))
    assert {i: r.n_shingles for i, r in got.items()} == dict(enumerate(sizes))


def test_blocks_of_a_large_owner(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 5)
    rng = random.Random(1)
    base = [f"b{i}" for i in range(60)]
    texts = []
    for _ in range(60):
        ws = list(base)
        ws[rng.randrange(60)] = f"x{rng.randrange(1000)}"
        texts.append(" ".join(ws))
    texts += [" ".join(f"{w}{i}" for w in base) for i in range(5)]
    roots, _ = brute(texts, 3, 85, 100)
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicate_classes(df, "id", "text", 3, 85, 100).collect()}
    assert got == dict(enumerate(roots))


@given(st.lists(st.sets(st.integers(0, 25), min_size=1, max_size=12), max_size=40), st.sampled_from([(85, 100), (1, 2)]))
@settings(max_examples=150, deadline=None)
def test_tree_finds_the_same_components_as_all_pairs(sets, t):
    num, den = t
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    roots = jaccard.tree_links(arrays, num, den)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if den * len(a & sets[j]) >= num * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    assert [find(r) for r in range(len(sets))] == [min(j for j in range(len(sets)) if roots[j] == roots[i]) for i in range(len(sets))]


def test_one_row_of_each_component_stays(spark):
    texts = corpus(9, 120)
    roots, sizes = brute(texts, 5, 80, 100)
    rows = [(i, t, 1, "c") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, component int, `stays.x` string")
    got = jaccard.drop_near_copies(df, "doc_id", "text")
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted({r for r, n in zip(roots, sizes, strict=True) if n} | {i for i, n in enumerate(sizes) if not n})


def test_repeats_null_ids_and_nothing(spark):
    text = "a b c d e f g h"
    rows = [(3, text), (3, text), (None, text), (3, text + " i"), (None, None), (None, None), (7, "z")]
    df = spark.createDataFrame(rows, "id bigint, text string")
    got = jaccard.near_duplicate_classes(df, "id", "text", 4, 80, 100).collect()
    assert len(got) == len(rows)
    assert {r.component_id for r in got if r.n_shingles > 1} == {3}
    kept = jaccard.drop_near_copies(df, "id", "text", 4, 80, 100).collect()
    assert sorted((r.id is None, r.id or 0) for r in kept) == [(False, 3), (False, 7), (True, 0), (True, 0)]
    assert jaccard.near_duplicate_classes(df.limit(0), "id", "text").count() == 0
    assert jaccard.drop_near_copies(df.limit(0), "id", "text").count() == 0


def test_components_of_a_chain(spark):
    ids = [bytes([i]) for i in range(40)]
    links = spark.createDataFrame(list(zip(ids[1:], ids[:-1], strict=True)), "a binary, b binary")
    assert {bytes(r.root) for r in jaccard.components(spark, links).collect()} == {ids[0]}


def test_texts_written_to_share_a_hash_do_not_link(spark):
    # Their last words were sought so that plain xxh3 hashes of the words, mixed as shingles are, come out equal.
    one, two = "this is one y1#jsv?l", "that was two x_`b`c%>"
    df = spark.createDataFrame([(1, one), (2, two), (3, f"{one} {two}")], "id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicate_classes(df, "id", "text", 4, 85, 100).collect()}
    assert got == {1: (1, 1), 2: (1, 2), 3: (5, 3)}


def owner_rows(sets, num, den, batch=7):
    """What ``_owners`` makes of the prefixes of ``sets`` under the tokens' own order, a set's number as its key."""
    rows = []
    for key, s in enumerate(sets):
        prefix = sorted(s)[: jaccard.prefix_length(len(s), num, den)]
        rows += [(t, len(s), key, len(s) * 8 + i * 8 // len(prefix)) for i, t in enumerate(prefix)]
    rows.sort()
    table = {n: [r[i] for r in rows] for i, n in enumerate(("token", "size", "key", "place"))}
    kinds = [("token", pa.int64()), ("size", pa.int32()), ("key", pa.int64()), ("place", pa.int32())]
    batches = pa.Table.from_pydict(table, pa.schema(kinds)).to_batches(max_chunksize=batch)
    return {(r["owner"], r["key"]) for b in jaccard._owners(num, den)(iter(batches)) for r in b.to_pylist()}


@pytest.mark.parametrize("window", [2, 64])
def test_sets_that_link_have_an_owner_in_common(monkeypatch, window):
    monkeypatch.setattr(jaccard, "WINDOW", window, raising=False)
    rng = random.Random(window)
    for num, den in [(85, 100), (1, 2), (1, 1)] * 20:
        sets = [set(rng.sample(range(30), rng.randrange(1, 20))) for _ in range(30)]
        sets += [s - {rng.randrange(30)} or s for s in sets for _ in range(2)]
        met = {}
        for owner, key in owner_rows(sets, num, den):
            met.setdefault(key, set()).add(owner)
        for i, a in enumerate(sets):
            for j in range(i):
                if den * len(a & sets[j]) >= num * len(a | sets[j]):
                    assert met.get(i, set()) & met.get(j, set())


def test_sets_whose_common_token_comes_too_late_do_not_meet():
    # 100 tokens each; the only common one is the 15th, after which too few are left for a similarity of 0.85.
    sets = [{1000} | {i + j * 50 for i in range(14)} | {2000 + i + j * 100 for i in range(85)} for j in range(2)]
    assert owner_rows(sets, 85, 100) == set()


def test_a_small_set_does_not_blur_the_bitmaps_of_larger_ones():
    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 1 << 63, n, np.uint64) for n in [40] + [600] * 30]
    n = len(sets)
    columns = {
        "owner": [0] * n, "low": [0] * n, "high": [0] * n, "sid": [bytes([i]) for i in range(n)], "side": [0] * n,
        "size": [len(s) for s in sets], "bits": [jaccard.bitmap(s) for s in sets],
    }
    batch = pa.RecordBatch.from_pydict(columns)
    assert sum(b.num_rows for b in jaccard._survivors(85, 100)(iter([batch]))) == 0


def test_common_shingles_stand_out_of_a_full_sketch(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SKETCH_BITS", 8)
    rng, key = random.Random(4), b"k" * 16
    texts = [" ".join(f"{rng.random()}" for _ in range(100)) for _ in range(300)] + ["very common"] * 60
    classes = jaccard.frequency_classes(spark.createDataFrame([(t,) for t in texts], "text string"), 2, key)
    common = classes[int(jaccard.shingle_set("very common", 2, key)[0]) >> 56]
    assert common > np.median(classes) and (classes < common).mean() > 0.9


def test_texts_without_a_partner_are_not_fetched(spark):
    ids = spark.range(0, 5000).selectExpr("if(id = 7, null, id) as id", "cast(id as string) as text")
    few = ids.filter("id < 3 or id is null")
    bitmap = jaccard.filled(few)
    asked = ids.select("id", "text", jaccard._spot("id").alias("spot")).mapInArrow(jaccard._at_spots(bitmap), ids.schema)
    got = [r.id for r in asked.collect()]
    assert {0, 1, 2, None} <= set(got) and len(got) < 50
    assert not jaccard.filled(ids.limit(0)).any()
