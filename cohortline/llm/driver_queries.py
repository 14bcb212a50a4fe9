"""The operators applied to the driver's tables, whole tables and whole texts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from cohortline.llm import (
    bytebpe, decontam, exactdup, huffman, maintext, neardup, packing, quality, resample, secrets, toxicity, unigram, whitening)
from cohortline.llm.common import read_small_file, read_table
from cohortline.llm.oracles import ORACLES  # noqa: F401


def op1_token_counts(spark: SparkSession, d: str) -> DataFrame:
    pieces = unigram.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    return unigram.count_tokens(read_table(spark, d, "documents"), pieces)


def op2_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_duplicates(read_table(spark, d, "documents"))


def op3_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(read_table(spark, d, "documents"), read_small_file(public_tokenizers.path("byte_bpe_50k.json")))


def op4_exact_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return exactdup.exact_duplicates(read_table(spark, d, "documents")).drop("n_chars")


def op5_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents")
    return toxicity.grade(docs, toxicity.train(docs, read_table(spark, d, "labels"), "toxic"))


def op6_huffman_ids(spark: SparkSession, d: str) -> DataFrame:
    return huffman.encode_and_read(read_table(spark, d, "documents"), read_small_file(public_tokenizers.path("byte_bpe_50k.json")))


def op7_quality(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    model = quality.train(docs, read_table(spark, d, "labels").where(~held_out), "quality")
    scored = quality.score(docs, model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op8_main_text(spark: SparkSession, d: str) -> DataFrame:
    return maintext.extract(read_table(spark, d, "pages"))


def op9_secrets(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents")
    found = secrets.find_secrets(docs, secrets.train(docs))

    def n(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[n(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secrets.span_list(F.col("base")), 256).alias("base_sha256"), secrets.span_list(F.col("spans")).alias("spans"))


def op10_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontam.contaminated(read_table(spark, d, "documents"), read_table(spark, d, "benchmark"))


def op11_whitening(spark: SparkSession, d: str) -> DataFrame:
    return whitening.whitened_rows(read_table(spark, d, "embeddings"))


def op12_resampling(spark: SparkSession, d: str) -> DataFrame:
    return resample.resample(read_table(spark, d, "documents"), read_table(spark, d, "benchmark"))


def op13_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    ranks = bytebpe.read_ranks(read_small_file(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    coded = bytebpe.decode(bytebpe.encode(read_table(spark, d, "documents"), ranks, public_tokenizers.PATTERN, cut_at_spaces=True), ranks)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_near_duplicates, op3_packing, op4_exact_duplicates, op5_toxicity, op6_huffman_ids, op7_quality,
    op8_main_text, op9_secrets, op10_decontamination, op11_whitening, op12_resampling, op13_byte_bpe)}
