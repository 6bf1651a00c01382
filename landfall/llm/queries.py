"""The registered queries of this subpackage: thin applications to the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm import align, ann, bpe, chat, exact_dedup, forest, jaccard, licenses, lm, merkle, packing, quality, warc

#: Grades: 0 poor, 1 good but toxic, 2 good. A document needs at least even odds of the top grade.
N_GRADES = 3
TOP_GRADE, LEAST_TAIL = 2, 0.5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def grade_of_labels():
    return F.col("quality") + F.col("quality") * (1 - F.coalesce("toxic", F.lit(0)))


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.OrdinalModel:
    labels = table(spark, sf_dir, "labels")
    return quality.train(docs, "doc_id", "text", labels, "doc_id", grade_of_labels(), N_GRADES)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no paths, so source and id give them the layout of an archive:
    /source/thousands/hundreds/tens/id, where every tenth document is the notice file
    of its directory (of a higher one, if its id is a round hundred or thousand)."""
    docs = table(spark, sf_dir, "documents")
    step = lambda n, of: F.expr(f"cast({of} div {n} as string)")
    k, h, t = step(1000, "doc_id"), step(100, "(doc_id % 1000)"), step(10, "(doc_id % 100)")
    notice = F.concat(F.lit("LICENSE-"), F.col("doc_id").cast("string"))
    path = (
        F.when(F.expr("doc_id % 1000 = 0"), F.concat_ws("/", k, notice))
        .when(F.expr("doc_id % 100 = 0"), F.concat_ws("/", k, h, notice))
        .when(F.expr("doc_id % 10 = 0"), F.concat_ws("/", k, h, t, notice))
        .otherwise(F.concat_ws("/", k, h, t, F.col("doc_id").cast("string")))
    )
    docs = docs.select("doc_id", "text", F.concat(F.lit("/"), "source", F.lit("/"), path).alias("path"))
    speaks = F.col("path").rlike("/LICENSE-[^/]*$")
    return licenses.scan_licenses(docs, "doc_id", "path", "text", speaks)


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score_documents(docs, "doc_id", "text", quality_model(spark, docs, sf_dir))
    tail = F.col("tail")[TOP_GRADE - 1]
    return scored.select(
        "doc_id", "score", "expected_grade", F.col("tail")[0].alias("p_good"), tail.alias("p_top"),
        (tail >= LEAST_TAIL).alias("kept"),
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_archives(table(spark, sf_dir, "pages"), "page_id", "url", "html")
    records = warc.read_archives(spark, path)
    stored = F.col("record_type") == "response"
    return records.select(
        F.col("record_id").cast("bigint").alias("page_id"),
        F.when(stored, F.octet_length("payload")).otherwise(F.col("http_length")).cast("bigint").alias("payload_bytes"),
        F.when(stored, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents")
    encoded = bpe.encode_documents(docs, "doc_id", "text", ranks, public_tokenizers.PATTERN)
    return bpe.decode_documents(encoded, ranks).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.train_and_score(table(spark, sf_dir, "documents"), "doc_id", "text")


def pieces(docs: DataFrame) -> DataFrame:
    packed = packing.pack_documents(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_classes(table(spark, sf_dir, "documents"), "doc_id", "text", keep="largest")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicate_classes(table(spark, sf_dir, "documents"), "doc_id", "text", k=4, num=85, den=100)


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("id") % 20 == 0, k=20)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    digest = lambda text: merkle.record_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    now = F.when(tampered, digest(F.replace(F.col("text"), F.lit("\n"), F.lit(""))))
    proofs = merkle.prove(docs, "doc_id", "source", digest(F.col("text")), now, fanout=3)
    folded = merkle.fold(F.coalesce("presented", "leaf"), F.col("path"))
    return proofs.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", threshold=0.95)


def op13_cross_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    documents, _ = align.align_documents(table(spark, sf_dir, "documents"), "doc_id", "text", a, b)
    return documents


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_chat_format,
        op3_quality_classifier,
        op4_warc,
        op5_byte_bpe,
        op6_lm_score,
        op7_packing,
        op8_exact_dedup,
        op9_jaccard_join,
        op10_nearest,
        op11_merkle_manifest,
        op12_embedding_near_dedup,
        op13_cross_alignment,
        pipeline,
    )
}
