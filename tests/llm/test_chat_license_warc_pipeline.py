"""Chat formatting, licence scans, WARC archives and the pipeline."""

import glob
import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from landfall.llm import chat, licenses, warc
from landfall.llm.common import written
from landfall.llm.queries import grade_of_labels, op5_byte_bpe
from test_jaccard import brute

# -- chat --------------------------------------------------------------------------


def rendered(turns):
    return "".join(f"<|{r or 'unknown'}|>\n{(t or '').replace('<|', '< |')}<|end|>\n" for r, t in turns)


def maximal(rows):
    """conversation -> turns, of those that begin no longer one; of equal ones the smallest id."""
    low = lambda x: (x is not None, x or 0 if not isinstance(x, str) else x)
    convs = {}
    for c, n, r, t in sorted(set(rows), key=lambda x: (low(x[1]), (x[2] is not None, x[2] or ""), (x[3] is not None, x[3] or ""))):
        convs.setdefault(c, []).append((r, t))
    kept = {}
    for c in sorted(convs, key=lambda c: (c is None, c or 0)):
        mine = convs[c]
        if not any(len(o) > len(mine) and o[: len(mine)] == mine for o in convs.values()) and mine not in kept.values():
            kept[c] = mine
    return {c: rendered(v) for c, v in kept.items()}


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    logs = []
    for c in range(60):
        if logs and rng.random() < 0.6:
            turns = rng.choice(logs)[: rng.randrange(1, 9)] + [("user", f"t{rng.randrange(4)}")] * rng.randrange(2)
        else:
            turns = [(rng.choice(["user", "assistant", None]), rng.choice(["hi", "<|end|>", "", None, "yo"])) for _ in range(rng.randrange(1, 9))]
        logs.append(turns)
        rows += [(c, i, r, t) for i, (r, t) in enumerate(turns)]
    return rows


@pytest.mark.parametrize("block", [3, 256])
def test_maximal_conversations_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK_TURNS", block)
    rows = conversations(block) + [(None, 0, "user", "hi"), (70, None, "a", "x"), (70, 1, "a", "y"), (70, 1, "a", "y"), (71, 5, None, "a"), (72, 5, "a", None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv bigint, turn bigint, role string, text string, block int")
    got = {}
    parts = chat.format_conversations(df, "conv", "turn", "role", "text", part_turns=block).orderBy("part").collect()
    for r in parts:
        got[r.conv_id] = got.get(r.conv_id, "") + r.text
    assert got == maximal(rows)
    assert chat.format_conversations(df.limit(0), "conv", "turn", "role", "text").count() == 0


# -- licences --------------------------------------------------------------------------


def cosine(statement):
    rows, idf, other = licenses.template_weights()
    tf = Counter(re.findall(licenses.TERM, statement.lower()))
    w = {t: n * idf.get(t, other) for t, n in tf.items()}
    norm = math.sqrt(sum(x * x for x in w.values()))
    dots = Counter()
    for name, number, term, weight in rows:
        if term in w:
            dots[name, number] += w[term] * weight
    return min(((-round(d / norm, 6), n[0]) for n, d in dots.items()), default=(0, None))


def test_own_and_inherited_licences(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        (1, "/a/LICENSE", mit),
        (2, "/a/x.txt", "plain"),
        (3, "/a/b/c/y.txt", None),
        (4, "/a/b/z.txt", f"Text before. More!\n{gpl} Text after it."),
        (5, "/a/b/COPYING", "Licensed under CC BY-NC 4.0."),
        (6, "/q/w.txt", "no licence is named here, copyright nobody knows"),
        (7, None, mit),
        (8, None, ""),
        (9, "/ab/v.txt", "word " * 50_000),
        (9, "/ab/v.txt", "word " * 50_000),
        (10, "/a/LICENSE", gpl + " And some more."),
    ]
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id bigint, path string, text string, key string")
    got = licenses.scan_licenses(df, "doc_id", "path", "text", F.col("path").rlike("(LICENSE|COPYING)$")).collect()
    assert sorted((r.doc_id, r.license, r.origin, r.from_directory) for r in got if r.license) == [
        (1, "MIT", "own", None),
        (2, "MIT", "inherited", "/a"),
        (3, "CC-BY-NC-4.0", "inherited", "/a/b"),
        (4, "GPL-3.0", "own", None),
        (5, "CC-BY-NC-4.0", "own", None),
        (7, "MIT", "own", None),
        (10, "GPL-3.0", "own", None),
    ]
    assert len(got) == len(rows)
    assert licenses.scan_licenses(df.limit(0), "doc_id", "path", "text", F.lit(True)).count() == 0


def test_headers_and_licence_files_are_compared_whole(spark):
    texts = dict(licenses.text_templates())
    assert {n for n, _ in licenses.TEMPLATES} - set(texts) == {"CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0"}
    mpl = "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at https://mozilla.org/MPL/2.0/. */\n\nint x;\n"
    gpl = "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.\n#\n# More words.\nx = 1\n"
    whole = {f.stem: f.read_text() for f in (licenses.Path(licenses.__file__).parent / "license_texts").glob("*.txt")}
    body = whole["MIT"].split("\n\n", 1)[1]
    excerpt = whole["BSD-3-Clause"].split("THIS SOFTWARE")[0].replace("\n\n", "\n\nCopyright (c) 2020, A. Holder\n", 1)
    rows = [("MPL-2.0", "/s/a.c", mpl), ("GPL-3.0", "/s/b.py", gpl), ("MIT", "/m/LICENSE", body), ("MIT", "/m/x", "plain")]
    rows += [("BSD-3-Clause", "/b/LICENSE", excerpt), (None, "/p/LICENSE", "the license of the story and all of the words in it " * 9)]
    rows += [(name, f"/w/{name}/LICENSE", text) for name, text in whole.items()]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id int, want string, path string, text string")
    got = licenses.scan_licenses(df, "doc_id", "path", "text", F.col("path").rlike("LICENSE$")).collect()
    assert {r.doc_id: r.license for r in got} == {i: r[0] for i, r in enumerate(rows)}


def test_scores_equal_a_plain_cosine(spark):
    texts = ["Licensed under the Apache License, Version 2.0", "MIT license", "license", "under the terms of the Mozilla Public License, v. 2.0", "copyright 2020 the authors"]
    df = spark.createDataFrame([(t,) for t in texts], "statement string")
    got = {r.statement: (-r.score, r.license) for r in licenses.score_statements(df, threshold=0.0).collect()}
    assert got == {t: cosine(t) for t in texts if cosine(t)[1]}


# -- WARC --------------------------------------------------------------------------


def page_rows():
    big, other = "<p>" + "é" * 600, "x" * 1000
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (9, None, big), (3, "u\r\nv", None), (4, "http://a/4", "")]
    rows += [(5, "http://a/5", "small"), (6, "http://a/6", "small"), (7, "http://a/7", other), (7, "http://a/7", other)]
    return rows + [(None, "http://a/n", other), (8, "http://a/8", "line\r\n\r\nWARC/1.1\r\n" * 9000)]


def test_archives_round_trip(spark):
    rows = page_rows()
    df = spark.createDataFrame([(*r, "k") for r in rows], "page_id bigint, url string, html string, kind string").repartition(2)
    path = warc.write_archives(df, "page_id", "url", "html")
    got = warc.read_archives(spark, path).collect()
    assert len(got) == len(rows)
    owner = {}
    for i, _, h in rows:
        if len((h or "").encode()) >= 1000 and i is not None:
            owner[h] = max(owner.get(h, i), i)
    want, have = Counter(), Counter()
    for i, u, h in rows:
        revisit = h in owner and i != owner[h]
        sha1 = hashlib.sha1((h or "").encode()).hexdigest()
        u = u and u.replace("\r", "%0D").replace("\n", "%0A")
        want[revisit, None if i is None else str(i), str(owner[h]) if revisit else None, u, len((h or "").encode()), sha1] += 1
    for r in got:
        have[r.record_type == "revisit", r.record_id, r.refers_to, r.target_uri, r.http_length, r.payload_digest] += 1
        if r.record_type == "response":
            assert hashlib.sha1(r.payload).hexdigest() == r.payload_digest and len(r.payload) == r.http_length
    assert have == want


def test_archives_are_plain_zstandard_with_a_leading_dictionary(spark):
    df = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    path = warc.write_archives(df, "page_id", "url", "html")
    files = [f for f in glob.glob(path.removeprefix("file:") + "/part-*")]
    records = 0
    for f in files:
        data = open(f, "rb").read()
        assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_FRAME
        size = int.from_bytes(data[4:8], "little")
        held = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
        # The library's own reader passes over the skippable frames.
        reader = zstandard.ZstdDecompressor(dict_data=held).stream_reader(data, read_across_frames=True)
        assert reader.read() == b"".join(warc.records_of(data))
        records += len(list(warc.records_of(data)))
    assert records == df.count()


def test_no_pages_no_records(spark):
    df = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.read_archives(spark, warc.write_archives(df, "page_id", "url", "html")).count() == 0


def test_cut_archive_is_an_error():
    frame = warc.dictionary_frame(warc.dictionary_of([b"abc" * 50] * 20))
    body = zstandard.ZstdCompressor().compress(b"x" * 50_000)
    with pytest.raises(ValueError):
        list(warc.records_of(frame + body[:-3]))
    with pytest.raises(ValueError):
        list(warc.records_of(body))


# -- queries without SQL, and the pipeline ------------------------------------------------


def test_bpe_query_round_trips_whole_documents(spark):
    import tiktoken

    from landfall.llm.bpe import load_ranks

    docs = duckdb.sql(f"select doc_id, text from '{SF_SMALL}/documents.parquet'").fetchall()
    ranks = load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in op5_byte_bpe(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for i, t in docs:
        ids = enc.encode_ordinary(t or "")
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(raw).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = written(spark, stage(spark, docs, SF_SMALL), "stage")
        assert docs.columns == before.columns
        assert docs.exceptAll(before).isEmpty()
        out[name] = (before.collect(), docs.collect())
    labels = {r.doc_id: r.g for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").select("doc_id", grade_of_labels().alias("g")).collect()}
    kept = {r.doc_id for r in out["quality_classifier"][1]}
    assert sum(i in kept for i, g in labels.items() if g == 2) >= 0.97 * sum(g == 2 for g in labels.values())
    assert not [i for i, g in labels.items() if g == 0 and i in kept]
    before, after = out["exact_dedup"]
    owner = {}
    for r in before:
        key = (r.text or "").encode().lower()
        owner[key] = max(owner.get(key, r.doc_id), r.doc_id)
    assert {r.doc_id for r in after} == set(owner.values())
    before, after = out["ngram_jaccard_join"]
    before = sorted(before, key=lambda r: r.doc_id)
    roots, sizes = brute([r.text for r in before], 5, 80, 100)
    assert {r.doc_id for r in after} == {before[x].doc_id for x in roots}
    pieces = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in after}
    totals = Counter()
    for r in pieces:
        totals[r.doc_id, r.doc_tokens] += r.length
    assert all(n == tokens for (_, tokens), n in totals.items())


def test_pipeline_stages_on_odd_rows(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, sid int"
    rows = [(1, None, None, None, None, "a", 1), (None, "", "en", None, 0, "b", 2), (3, "w " * 3000, "en", "s", 6000, "c", 3), (3, "w " * 3000, "en", "s", 6000, "c", 3)]
    for df in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, SF_SMALL)
            assert out.columns == df.columns
            df = written(spark, out, "odd")
        corpus_pipeline.STAGES[-1][1](spark, df, SF_SMALL).count()
