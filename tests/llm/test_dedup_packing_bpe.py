"""Exact dedup, packing and BPE against brute force and round trips."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from landfall.llm import bpe, exact_dedup, packing

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
CLASH = "id bigint, text string, digest string, copies int, length int, `a.b` int"


# -- exact dedup ---------------------------------------------------------------


@given(st.lists(st.binary(max_size=6), max_size=40))
@settings(max_examples=200, deadline=None)
def test_trie_counts_whole_strings(keys):
    trie = exact_dedup.PatriciaTrie()
    for k in keys:
        node = trie.entry(k)
        node[2] = (node[2] or 0) + 1
    assert dict(trie.terminals()) == Counter(keys)


ROWS = [
    (1, "Same", "x", 1, 1, 1),
    (9, "same", "y", 1, 1, 1),
    (None, "SAME", "z", 1, 1, 1),
    (4, "ÄB", None, None, None, None),
    (5, "äb", None, None, None, None),
    (6, None, None, None, None, None),
    (7, "", None, None, None, None),
    (3, "twice", "q", 2, 2, 2),
    (3, "twice", "q", 2, 2, 2),
]


def norm(t):
    return (t or "").encode().lower()


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_classes_and_survivors(spark, keep):
    df = spark.createDataFrame(ROWS, CLASH)
    pick = max if keep == "largest" else min
    groups = {}
    for r in ROWS:
        groups.setdefault(norm(r[1]), []).append(r[0])
    got = exact_dedup.duplicate_classes(df, "id", "text", keep).collect()
    assert len(got) == len(ROWS)
    assert sum(r.kept for r in got) == len(groups)
    for r in got:
        ids = next(v for k, v in groups.items() if hashlib.sha256(k).hexdigest() == r.text_sha256 and r.doc_id in v)
        assert r.group_size == len(ids)
        assert r.keep_id == pick(i for i in ids if i is not None)
        assert not r.kept or r.doc_id == r.keep_id
    out = exact_dedup.drop_copies(df, "id", "text", keep)
    assert out.columns == df.columns
    assert {norm(r.text): r.id for r in out.collect()} == {k: pick(i for i in v if i is not None) for k, v in groups.items()}
    assert out.count() == len(groups)


def test_dedup_of_nothing_and_of_long_texts(spark):
    empty = spark.createDataFrame([], CLASH)
    assert exact_dedup.duplicate_classes(empty, "id", "text").count() == 0
    assert exact_dedup.drop_copies(empty, "id", "text").count() == 0
    long = "Word " * 400_000
    df = spark.createDataFrame([(1, long), (2, long.upper()), (3, long + "x")], "id bigint, text string")
    assert {r.id for r in exact_dedup.drop_copies(df, "id", "text").collect()} == {2, 3}


def test_dedup_of_a_hot_group_over_partitions(spark):
    df = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 'hot' else concat('t', id) end as text")
    got = exact_dedup.duplicate_classes(df.repartition(16), "id", "text").filter("text_sha256 = sha2('hot', 256)").collect()
    assert {(r.keep_id, r.group_size) for r in got} == {(2997, 1000)}
    assert [r.doc_id for r in got if r.kept] == [2997]


def test_tries_branch_and_are_cut_into_whole_subtrees():
    rng = random.Random(5)
    keys = [bytes(rng.choice(b"abcdefgh") for _ in range(rng.randint(0, 4))) for _ in range(400)]
    trie, left = exact_dedup.PatriciaTrie(), []
    for k in keys:
        node = trie.entry(k)
        if node[1] is None:
            left.append((node[2], k))
        else:
            node[2] = (node[2] or 0) + 1
        if trie.size > 20_000:
            left += [(name, k) for name, below in trie.close(10_000) for k, n in below for _ in range(n)]
    kept = Counter(dict(trie.terminals()))
    assert left and kept
    assert kept + Counter(k for _, k in left) == Counter(keys)
    assert not kept.keys() & {k for _, k in left}
    assert len({k for _, k in left}) == len(set(left))  # equal strings leave by one name


def test_texts_below_one_stem_are_cut_below_it():
    trie = exact_dedup.PatriciaTrie()
    for k in (b"stem", b"stem of one", b"stem of two"):
        trie.entry(k)[2] = 1
    cut = {k for _, below in trie.close(0) for k, _ in below}
    assert cut == {b"stem of one", b"stem of two"} and dict(trie.terminals()) == {b"stem": 1}
    alone = exact_dedup.PatriciaTrie()
    alone.entry(b"only")[2] = 1
    assert list(alone.close(0)) == []


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_dedup_over_several_rounds_of_subtrees(spark, keep):
    rng = random.Random(11)
    texts = ["".join(rng.choice("aAb") for _ in range(rng.randint(0, 7))) + "\u00c4" * (i % 2) for i in range(1500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id bigint, text string").repartition(8)
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault(norm(t), []).append(i)
    pick = max if keep == "largest" else min
    got = exact_dedup.duplicate_classes(df, "id", "text", keep, budget=6_000).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == sorted(
        (i, pick(v), len(v), i == pick(v)) for v in groups.values() for i in v
    )
    out = exact_dedup.drop_copies(df, "id", "text", keep, budget=6_000).collect()
    assert sorted((r.id, r.text) for r in out) == sorted((pick(v), texts[pick(v)]) for v in groups.values())


# -- packing ---------------------------------------------------------------------


@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=8), st.integers(0, 60))
@settings(max_examples=200, deadline=None)
def test_best_fill_is_the_best(counts, space):
    use = packing.best_fill(counts, space)
    assert all(0 < n <= counts[x] for x, n in use.items())
    sums = {0}
    for x, n in counts.items():
        sums = {s + x * k for s in sums for k in range(n + 1)}
    assert sum(x * n for x, n in use.items()) == max(s for s in sums if s <= space)


@given(st.dictionaries(st.integers(1, 31), st.integers(1, 50), max_size=12))
@settings(max_examples=200, deadline=None)
def test_windows_place_every_token_and_fill_all_but_the_last(counts):
    total = sum(x * n for x, n in counts.items())
    made = [(sum(x * n for x, n in use.items()) + part, times) for use, _, part, times in packing.windows(dict(counts), 32)]
    assert sum(f * t for f, t in made) == total
    assert all(f == 32 for f, _ in made[:-1]) and all(f <= 32 for f, _ in made)


def tokens(text):
    return [*Tokenizer.from_file(JSON).encode(text or "", add_special_tokens=False).ids, 1]


def check_pieces(rows, got, window):
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
    want = Counter((i, tuple(tokens(t))) for i, t in rows)
    seen = Counter()
    for i, t in {(i, t) for i, t in rows}:
        parts = sorted(by_doc[i], key=lambda r: r.start)
        ids = tokens(t)
        mine = [r for r in parts if r.doc_tokens == len(ids)]
        for r in mine:
            assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.start : r.start + r.length]
        cover = Counter(x for r in mine for x in range(r.start, r.start + r.length))
        assert set(cover) == set(range(len(ids))) and len(set(cover.values())) == 1
        seen[i, tuple(ids)] = cover[0]
    assert seen == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end == window or end & (end - 1) == 0


def test_pieces_cover_each_document_once(spark):
    rng = random.Random(3)
    words = ["alpha", "Beta", " gam ma", "\n\n", "  ", "1234", "Straße", "日本語", "!!", "'s"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(400)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "a" * 5000), (63, "a <|endoftext|> b"), (64, "same"), (64, "same")]
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id bigint, text string, start int, ids string").repartition(3)
    got = packing.pack_documents(df, "doc_id", "text", JSON, window=256, buffer_tokens=3000).collect()
    check_pieces(rows, got, 256)


def test_equal_lengths_are_cut_not_padded(spark):
    rows = [(i, "one two three four five six seven eight nine") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    got = packing.pack_documents(df, "doc_id", "text", JSON, window=16).collect()
    check_pieces(rows, got, 16)
    assert packing.pack_documents(df.limit(0), "doc_id", "text", JSON).count() == 0


# -- byte-level BPE ------------------------------------------------------------


def reference(text):
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return enc.encode_ordinary(text or "")


NASTY = ["word", " ", "  ", "\n", "\n\n ", "\t", "'re", "'", "é", "日本", "123", "!?", "\xa0", "\x1c", "\x85", "👍🏽", "don't", "<|endoftext|>"]


def test_chunked_ids_equal_whole_ids_and_decode_back(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice(NASTY) for _ in range(rng.randrange(300))) for _ in range(80)]
    texts += ["x" * 700, " " * 700, "ab " * 300, "", None, "a\n" * 400, "日" * 500, "twin " * 90, "twin " * 90]
    rows = [(i if i < len(texts) - 2 else 999, t, 1, "k") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, chunk int, key string")
    enc = bpe.encode_documents(df, "doc_id", "text", RANKS, public_tokenizers.PATTERN, chunk_chars=64, overlap_chars=16)
    got = bpe.decode_documents(enc, RANKS).collect()
    assert len(got) == len(rows)
    assert sum(r.doc_id == 999 for r in got) == 2
    want = {r[0]: r[1] for r in rows}
    for r in got:
        assert np.frombuffer(r.ids, "<u4").tolist() == reference(want[r.doc_id])
        assert r.n_tokens * 4 == len(r.ids)
        assert bytes(r.decoded) == (want[r.doc_id] or "").encode()


def test_encoding_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    enc = bpe.encode_documents(df, "doc_id", "text", RANKS, public_tokenizers.PATTERN)
    assert bpe.decode_documents(enc, RANKS).count() == 0


def test_fast_ids_equal_the_tokenizers(spark):
    rng = random.Random(8)
    for _ in range(200):
        text = "".join(rng.choice(NASTY) for _ in range(rng.randrange(60)))
        assert [*packing.token_ids(JSON, text), 1] == tokens(text)
    assert zlib.crc32(b"") == 0
