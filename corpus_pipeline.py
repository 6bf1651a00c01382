"""The corpus pipeline: documents in, packed training sequences out.

Each stage is ``(name, function)`` with ``function(spark, docs, sf_dir)``;
its result is written as Parquet and read again as the next stage's ``docs``.
All but the last return the columns of ``documents``.

1. quality classifier: documents without even odds of the top grade go;
2. exact dedup: of texts equal up to ASCII case the largest id stays;
3. n-gram Jaccard join: of each component at five-word similarity 0.8 the
   smallest id stays;
4. packing: pieces of documents in windows of 2048 tokens.

Null, empty and repeated rows, empty tables and further columns are treated
as the operators' docstrings state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landfall.llm import exact_dedup, jaccard, quality
from landfall.llm.common import written
from landfall.llm.queries import LEAST_TAIL, TOP_GRADE, pieces, quality_model, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_model(spark, docs, sf_dir)
    return quality.select_documents(docs, "text", model, TOP_GRADE, LEAST_TAIL)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs, "doc_id", "text", keep="largest")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.drop_near_copies(docs, "doc_id", "text", k=5, num=80, den=100)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_stage),
    ("ngram_jaccard_join", near_stage),
    ("packing", packing_stage),
]

#: The fitted classifier and the tokenizer can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
