"""Licence scan: TF-IDF cosine to templates, inheritance from the nearest directory.

Only DataFrame functions run here. A file's licence statements are its
sentences (cut at line ends and sentence marks, over the whole text) with a
licence cue. Its blocks are its paragraphs (cut at lines without a letter or
digit, so comment marks do not matter) with a cue, whole, as headers wrap over
lines; a licence file is a block as a whole too, whatever its words. Blocks
are compared with full licence texts and standard headers besides the short
notices. Distinct statements and blocks are scored once: their sparse TF-IDF vectors
meet the templates' by a join on terms, and the best cosine at or above the
threshold names the licence. A file without a licence of its own takes that of
the nearest ancestor directory that has a licence file; distinct directories
are resolved by a join of their ancestors, so a directory that holds very many
files is resolved once.

Defined cases: null or empty text has no statement; a null path inherits
nothing; equal cosines go to the licence name that sorts first; of several
licence files in a directory the best cosine, then the smallest id speaks;
repeated rows are returned as often as they come; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import cache, reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm.common import col, written

CUE = r"(?i)licen[sc]e|copyright|spdx|public domain|creativecommons"
BLOCK_CUE = CUE + r"|permission|redistribut|endorse|warrant"
#: A text without any of these, in lower case, holds no cue; finding them takes no pattern.
CUE_WORDS = ("license", "licence", "copyright", "spdx", "public domain", "creativecommons")
BLOCK_WORDS = (*CUE_WORDS, "permission", "redistribut", "endorse", "warrant")
PARAGRAPH_END = r"\n[^\p{L}\p{N}\n]*(?=\n)"
SENTENCE_END = r"[.;!?]\s+|\n"
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
THRESHOLD = 0.6

# Short public notices by which licences are named in headers and licence files.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)


@cache
def text_templates() -> tuple[tuple[str, str], ...]:
    """(licence, text) of the full texts and standard headers in ``license_texts``."""
    files = sorted((Path(__file__).parent / "license_texts").iterdir())
    return tuple((re.sub(r"\.(txt|header|third)$", "", f.name), f.read_text(encoding="utf-8")) for f in files)


def template_weights(templates=TEMPLATES) -> tuple[list[tuple[str, int, str, float]], dict[str, float], float]:
    """(licence, template, term, normalised weight) rows, idf by term, and the idf of any other term."""
    bags = [Counter(re.findall(TERM, text.lower())) for _, text in templates]
    n = len(bags)
    idf = {t: math.log((1 + n) / (1 + sum(t in b for b in bags))) + 1 for b in bags for t in b}
    rows = []
    for number, ((name, _), bag) in enumerate(zip(templates, bags, strict=True)):
        norm = math.sqrt(sum((c * idf[t]) ** 2 for t, c in bag.items()))
        rows += [(name, number, t, c * idf[t] / norm) for t, c in bag.items()]
    return rows, idf, math.log(1 + n) + 1


def _template_frames(spark: SparkSession, templates) -> tuple[DataFrame, DataFrame, float]:
    rows, idf, other = template_weights(templates)
    weights = spark.createDataFrame(rows, "license string, template int, term string, weight double")
    return weights, spark.createDataFrame(list(idf.items()), "term string, idf double"), other


def score_statements(statements: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(statement, license, score) for those of the distinct ``statements`` that reach a template."""
    return _score(statements.select("statement", F.col("statement").alias("text")), templates, threshold)


def _score(texts: DataFrame, templates, threshold: float) -> DataFrame:
    """(statement, license, score) for the distinct keys ``statement`` whose ``text`` reaches a template."""
    weights, idf, other = _template_frames(texts.sparkSession, templates)
    terms = (
        texts.select("statement", F.explode(F.expr(f"regexp_extract_all(lower(text), '{TERM}', 0)")).alias("term"))
        .groupBy("statement", "term")
        .agg(F.count("*").alias("tf"))
        .join(F.broadcast(idf), "term", "left")  # as many rows as the fixed templates have terms
        .withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(other)))
    )
    norms = terms.groupBy("statement").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = (
        terms.join(F.broadcast(weights), "term")
        .groupBy("statement", "license", "template")
        .agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    )
    best = (
        dots.join(norms, "statement")
        .select("statement", "license", F.round(F.col("dot") / F.col("norm"), 6).alias("score"))
        .filter(F.col("score") >= threshold)
        .groupBy("statement")
        .agg(F.min(F.struct((-F.col("score")).alias("minus"), "license")).alias("best"))
    )
    return best.select("statement", "best.license", (-F.col("best.minus")).alias("score"))


def scan_licenses(
    df: DataFrame,
    id_col: str,
    path_col: str,
    text_col: str,
    is_license_file: Column,
    templates=TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of ``df``: doc_id, path, license, score, origin (own, inherited, none), from_directory."""
    spark = df.sparkSession
    text, low = F.col("text"), F.lower("text")
    holds = lambda words: reduce(lambda a, b: a | b, [low.contains(w) for w in words])
    no_blocks = F.array().cast("array<string>")
    statements = F.filter(F.split(text, SENTENCE_END), lambda s: s.rlike(CUE))
    paragraphs = F.filter(F.split(text, PARAGRAPH_END), lambda s: s.rlike(BLOCK_CUE))
    # Texts are read and cut once; what was cut out is written.
    cut = df.select(
        col(id_col).alias("id"),
        col(path_col).alias("path"),
        F.regexp_extract(col(path_col), "^(.*)/[^/]*$", 1).alias("directory"),
        F.coalesce(is_license_file, F.lit(False)).alias("speaks"),
        col(text_col).alias("text"),
    ).select(
        "id", "path", "directory", "speaks",
        F.when(holds(CUE_WORDS), statements).otherwise(no_blocks).alias("sentences"),
        F.array_distinct(
            F.concat(
                F.when(holds(BLOCK_WORDS), paragraphs).otherwise(no_blocks),
                F.when(F.col("speaks") & text.rlike("(?i)[a-z0-9]"), F.array(text)).otherwise(no_blocks),
            )
        ).alias("blocks"),
    )
    cut = written(spark, cut, "statements")
    # A block stands among the statements by its hash, which holds no cue, so no statement equals it.
    mark = lambda b: F.concat(F.lit("\0"), F.sha2(b, 256))
    texts = (
        cut.select(F.explode("blocks").alias("text"))
        .select(mark(F.col("text")).alias("statement"), "text")
        .dropDuplicates(["statement"])
    )
    # Files with equal statements share a key; those without any get keys that match nothing and spread.
    files = cut.select(
        "id", "path", "directory", "speaks", F.concat("sentences", F.transform("blocks", mark)).alias("statements")
    )
    key = F.when(F.size("statements") > 0, F.sha2(F.array_join("statements", "\n"), 256))
    files = files.withColumn("key", F.coalesce(key, F.concat(F.lit("\0"), F.xxhash64("id", "path").cast("string"))))
    keys = files.filter(F.size("statements") > 0).groupBy("key").agg(F.first("statements").alias("statements"))
    said = written(spark, keys.select("key", F.explode("statements").alias("statement")), "said")
    sentences = said.filter(~F.col("statement").rlike("^\\x00[0-9a-f]{64}$")).select("statement").distinct()
    scored = score_statements(sentences, templates, threshold).union(
        _score(texts, (*templates, *text_templates()), threshold)
    )
    scored = written(spark, scored, "scored")
    own = (
        said.join(scored, "statement")
        .groupBy("key")
        .agg(F.min(F.struct((-F.col("score")).alias("minus"), "license")).alias("best"))
        .select("key", F.col("best.license").alias("license"), (-F.col("best.minus")).alias("score"))
    )
    own = written(spark, own, "own")
    marked = written(spark, files.drop("statements").join(own, "key", "left").drop("key"), "marked")
    speaking = (
        marked.filter("speaks and license is not null and path is not null")
        .groupBy("directory")
        .agg(F.min(F.struct((-F.col("score")).alias("minus"), "id", "license")).alias("best"))
        .select(
            F.col("directory").alias("ancestor"),
            F.col("best.license").alias("dir_license"),
            (-F.col("best.minus")).alias("dir_score"),
        )
    )
    steps = F.split("directory", "/")
    lineage = (
        marked.filter("license is null and path is not null")
        .select("directory")
        .distinct()
        .withColumn("depth", F.explode(F.sequence(F.lit(1), F.size(steps))))
        .withColumn("ancestor", F.array_join(F.slice(steps, F.lit(1), F.col("depth")), "/"))
    )
    resolved = (
        lineage.join(speaking, "ancestor")
        .groupBy("directory")
        .agg(F.max(F.struct("depth", "ancestor", "dir_license", "dir_score")).alias("near"))
        .select("directory", "near.ancestor", "near.dir_license", "near.dir_score")
    )
    bare = F.col("license").isNull()
    # Files with a licence of their own take no part: their keys match nothing and spread.
    seek = F.when(bare & F.col("path").isNotNull(), F.col("directory")).otherwise(
        F.concat(F.lit("\0"), F.xxhash64("id", "path").cast("string"))
    )
    found = marked.withColumn("seek", seek).join(resolved.withColumnRenamed("directory", "seek"), "seek", "left")
    return found.select(
        F.col("id").alias("doc_id"),
        "path",
        F.coalesce("license", "dir_license").alias("license"),
        F.coalesce("score", "dir_score").alias("score"),
        F.when(~bare, "own").when(F.col("dir_license").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(bare, F.col("ancestor")).alias("from_directory"),
    )
