"""Alignment of two tokenizers against plain loops over bytes, and sparse products against dense ones."""

import hashlib
import json
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from conftest import SF_SMALL
from tokenizers import Tokenizer

from landfall.llm import align

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, block bigint, pairs string, n_a int, id string"
ODD = [
    "", None, "a", " ", "  two  blanks ", "plain text", "plain text", "▁ joined", "a<|endoftext|>b <s> </s> <unk>", "é" * 50,
    "日本語 and 🙂🙂 emoji‍", "\x00\x01", "tab\tline\n\nend\r\n", "word " * 30_000, "x" * 20_000, "İ ﬁ ½", "1234567890" * 40,
]


def plain(texts):
    """Per text: (n_a, n_b, n_groups, n_links, digest, links as id pairs)."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [x for x in range(256) if x not in shown]
    byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(hidden)}
    out = []
    for text in texts:
        if not text:
            out.append((0, 0, 0, 0, "", []))
            continue
        xs, ys = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        x_bytes = [bytes(byte[c] for c in a.id_to_token(i)) for i in xs]
        y_bytes = [bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ys]
        raw = (" " + text).encode()
        if b"".join(x_bytes) != raw or b"".join(y_bytes) != raw:
            out.append((0, 0, 0, 0, "", []))
            continue
        owner_x = [i for i, t in enumerate(x_bytes) for _ in t]
        owner_y = [i for i, t in enumerate(y_bytes) for _ in t]
        links = sorted(set(zip(owner_x, owner_y, strict=True)))
        ends = lambda ts: set(np.cumsum([len(t) for t in ts]).tolist())
        cuts = sorted(ends(x_bytes) & ends(y_bytes))
        end_x, end_y = np.cumsum([len(t) for t in x_bytes]), np.cumsum([len(t) for t in y_bytes])
        groups, low = [], 0
        for cut in cuts:
            part = lambda ids, e: ",".join(str(i) for i, z in zip(ids, e, strict=True) if low < z <= cut)  # noqa: E731, B023
            groups.append(part(xs, end_x) + "|" + part(ys, end_y))
            low = cut
            if len(groups) > 400:
                break
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if len(groups) == len(cuts) else None
        out.append((len(xs), len(ys), len(cuts), len(links), digest, [(xs[i], ys[j]) for i, j in links]))
    return out


def summed(rows):
    held = Counter(p for r in rows for p in set(r[5]))
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    return held, [(*r[:5], sum(held[p] == top[p[0]] for p in r[5]), sum(held[p] for p in r[5])) for r in rows]


def run(spark, texts, block_bytes=align.BLOCK_BYTES):
    df = spark.createDataFrame([(i, t, 0, "x", 1, "y") for i, t in enumerate(texts)], SCHEMA)
    docs, pairs = align.align_documents(df.repartition(3), "doc_id", "text", A, B, block_bytes)
    return {r.doc_id: r for r in docs.collect()}, pairs


@pytest.mark.parametrize("block_bytes", [1, 200, 1 << 24])
def test_documents_equal_plain_loops(spark, block_bytes):
    sample = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").limit(25).collect()]
    texts = ODD + sample
    got, pairs = run(spark, texts, block_bytes)
    held, want = summed(plain(texts))
    for i, (n_a, n_b, n_groups, n_links, digest, n_best, count_sum) in enumerate(want):
        r = got[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) == (n_a, n_b, n_groups, n_links, n_best, count_sum), texts[i]
        assert digest is None or r.groups_sha256 == digest
        assert r.n_group_links >= r.n_links
    assert {(p.a_id, p.b_id): p.documents for p in pairs.collect()} == held


def test_empty_table(spark):
    docs, pairs = align.align_documents(spark.createDataFrame([], SCHEMA), "doc_id", "text", A, B)
    assert docs.count() == 0 and pairs.count() == 0
    assert docs.columns[:3] == ["doc_id", "n_a", "n_b"]


def test_products_equal_dense_ones():
    rng = np.random.default_rng(0)
    for _ in range(50):
        m, k, n = rng.integers(0, 9, 3)
        dense = [(rng.random(s) < 0.4).astype(int) for s in ((m, k), (k, n))]
        a, b = (
            align.Rows(np.concatenate([[0], np.cumsum(d.sum(1))]).astype(int), np.nonzero(d)[1], d.shape[1]) for d in dense
        )
        x, y, v = align.product(a, b)
        got = np.zeros((m, n), int)
        got[x, y] = v
        assert (got == dense[0] @ dense[1]).all() and (v > 0).all()
        assert align.entries(a, b).sum() == v.sum()
        back = np.zeros((n, k), int)
        t = b.transposed()
        back[np.repeat(np.arange(n), np.diff(t.starts)), t.columns] = 1
        assert (back == dense[1].T).all()


def test_pieces_and_groups_give_the_same_links():
    both = align.load(A, B)
    tokens = both.align("Some words, 12345 and naïve 🙂 text " * 20)
    whole = tokens.links()
    for piece in (1, 7, 100):
        assert all((x == y).all() for x, y in zip(tokens.links(piece), whole, strict=True))
    by_a, by_b = tokens.groups()
    x, y, _ = align.product(by_a, by_b.transposed())
    assert set(zip(*(w.tolist() for w in whole[:2]), strict=True)) <= set(zip(x.tolist(), y.tolist(), strict=True))
    assert align.entries(by_a, by_b.transposed()).sum() == len(x)
    assert whole[2].sum() == tokens.a_lengths.sum()


def test_other_tokenizer_files_use_their_own_library(tmp_path):
    with open(A, encoding="utf-8") as f:
        spec = json.load(f)
    text = " It's 12 <|endoftext|> naïve  blanks\n"
    fast, _ = align.byte_level(A)
    own = Tokenizer.from_file(A)
    own.encode_special_tokens = True
    assert fast(text) == own.encode(text, add_special_tokens=False).ids
    spec["pre_tokenizer"]["use_regex"] = False
    other = tmp_path / "other.json"
    other.write_text(json.dumps(spec), encoding="utf-8")
    slow, _ = align.byte_level(str(other))
    own = Tokenizer.from_file(str(other))
    own.encode_special_tokens = True
    assert slow(text) == own.encode(text, add_special_tokens=False).ids
    assert fast.__self__.__class__.__name__ == "Encoding" and not hasattr(slow, "__self__")
