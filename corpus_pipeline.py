"""The corpus pipeline: toxic documents go, then exact copies, near copies and leaked benchmark
passages, and what stays is packed. Each stage is written as Parquet and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm import decontam, exactdup, neardup, packing, toxicity
from cohortline.llm.common import read_small_file, read_table, store


def _text_key() -> Column:
    """64 bits of a row's text. What a text is found to be holds for every row with it, whatever its id; rows without an
    id are decided like all others."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _fresh(docs: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as it takes to be no column of ``docs``."""
    taken = {column.lower() for column in docs.columns}
    while name in taken:
        name = "_" + name
    return name


def _texts(docs: DataFrame) -> DataFrame:
    """The texts under their keys, without any other column."""
    return docs.select(_text_key().alias("doc_id"), "text")


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose text has none of ``keys`` (doc_id)."""
    key = _fresh(docs, "key")
    return docs.withColumn(key, _text_key()).join(keys.select(F.col("doc_id").alias(key)).distinct(), key, "left_anti").drop(key)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a text that the model, fitted on the labelled documents, does not call toxic. Null and empty texts
    stay; of rows that share an id only the toxic texts go. Very long texts are read whole."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"), "toxic")
    return _without(docs, toxicity.grade(_texts(docs), model).where("toxic"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, also of rows that repeat the kept id."""
    found = store(exactdup.exact_duplicates(docs).where("kept").select("doc_id", "n_chars", "text_sha256"), "kept-texts")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sha256, length = _fresh(docs, "sha256"), _fresh(docs, "length")
    marked = docs.withColumn(sha256, F.sha2(exactdup.normalised(text), 256)).withColumn(length, F.char_length(text).cast("long"))
    stay = marked.join(found, [
        marked["doc_id"].eqNullSafe(found["doc_id"]), marked[sha256] == found["text_sha256"], marked[length] == found["n_chars"]], "left_semi")
    repeated = found.groupBy("doc_id", "text_sha256").count().where("count > 1")
    if not repeated.isEmpty():
        stay = stay.dropDuplicates(["doc_id", sha256])
    return stay.drop(sha256, length)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the texts of a component the one of the smallest id (rows without an id last) stays; rows that share
    a text stay or go together. Texts without words stay."""
    found = store(neardup.near_duplicates(_texts(docs)).select("doc_id", "component_id", "kept").distinct(), "near-classes")
    several = found.where("not kept").select("component_id").distinct()
    members = found.join(several, "component_id").select(F.col("doc_id").alias("key"), "component_id")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    ids = docs.select("doc_id", _text_key().alias("key"))
    first = ids.join(members, "key").groupBy("component_id").agg(F.min(rank).alias("first"))
    gone = members.join(first, "component_id").where(F.col("key") != F.col("first.key"))
    return _without(docs, gone.select(F.col("key").alias("doc_id")))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a text that holds no passage of the benchmark; null and empty texts stay."""
    return _without(docs, decontam.contaminated(_texts(docs), read_table(spark, sf_dir, "benchmark")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows, packed; null and empty texts are their end id alone, rows that share an id are
    packed each."""
    return packing.pack(docs, read_small_file(public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is stored in the shared folder before the next begins."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


#: Tokenizer, model fit and packing plan are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
