"""Importance resampling towards a target distribution, by hashed n-grams.

Each text becomes lower-case words with single spaces between them; a regular expression of n words
between boundary lookarounds is searched with overlapping matches, so every hit is the span of one
n-gram, whose CRC names its bucket. Bucket counts of the corpus and of the target give each bucket a
gain; the gains of a document's n-grams are its weight, Gumbel noise from a hash of its id makes the
highest scores a weighted draw without replacement.

The corpus is scanned once: the bucket numbers of each text are stored, the counts come along.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortline.llm.common import store, sum_arrays

# Buckets, longest n-gram, share drawn, least words of a drawn document, seed of the noise.
BUCKETS = 10_000
MAX_N = 1
DRAW_PERCENT = 10
MIN_WORDS = 20
SEED = 2024

#: Bytes of words stand for themselves (A-Z in lower case, all bytes beyond ASCII), others are separators.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def collapse(text: str | None) -> bytes:
    """The words of a text in UTF-8 with one space between them."""
    return b" ".join((text or "").encode("utf-8").translate(WORD_BYTES).split())


def ngram_pattern(n: int) -> regex.Pattern:
    return regex.compile(rb"(?<![^ ])[^ ]+(?: [^ ]+){%d}(?![^ ])" % (n - 1))


def hashes(words: bytes, patterns: list[regex.Pattern]) -> np.ndarray:
    """CRC of each n-gram, in order of n, then place."""
    return np.concatenate([
        np.fromiter(map(zlib.crc32, map(itemgetter(0), pattern.finditer(words, overlapped=True))), np.uint32) for pattern in patterns])


def featurise(rows: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS) -> DataFrame:
    """``rows``: (id, text). Per row: id, n_words, n_features, buckets (bytes), and per task one row
    with ``counts`` of all its buckets instead; ``part`` is the task's number."""
    dtype = "<u2" if buckets <= 65_536 else "<u4"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [ngram_pattern(n) for n in range(1, max_n + 1)]
        counts = np.zeros(buckets, dtype="<i8")
        part = TaskContext.get().partitionId()

        def batch_of(*columns: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()])],
                names=["part", "id", "n_words", "n_features", "buckets", "counts"])

        for batch in batches:
            n_words, n_features, found = [], [], []
            for text in batch.column(1):
                words = collapse(text.as_py())
                at = hashes(words, patterns) % buckets
                counts += np.bincount(at, minlength=buckets)
                n_words.append(words.count(b" ") + 1 if words else 0)
                n_features.append(len(at))
                found.append(at.astype(dtype).tobytes())
            n = len(found)
            yield batch_of([part] * n, batch.column(0).to_pylist(), n_words, n_features, found, [None] * n)
        yield batch_of([part], [None], [None], [None], [None], [counts.tobytes()])

    return rows.mapInArrow(search, "part int, id long, n_words long, n_features long, buckets binary, counts binary")


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    partials = features.where("counts is not null").select("part", F.col("counts").alias("data"))
    total = sum_arrays(partials, features.agg(F.max("part")).first()[0] or 0, "<i8")
    return np.zeros(buckets, dtype=np.int64) if total is None else total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of the smoothed shares) of each bucket."""
    size, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1.0) * (s_all + size) / ((s + 1.0) * (t_all + size)))) for s, t in zip(corpus.tolist(), target.tolist())],
        dtype=np.int64)


def weigh(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """(id, n_words, n_features, weight): the sum of the gains of a document's n-grams."""
    shared = features.sparkSession.sparkContext.broadcast(gain)  # one number per bucket
    dtype = "<u2" if len(gain) <= 65_536 else "<u4"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = [int(shared.value[np.frombuffer(b, dtype)].sum()) for b in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weights, pa.int64())], names=["id", "n_words", "n_features", "weight"])

    rows = features.where("counts is null").select("id", "n_words", "n_features", "buckets")
    return rows.mapInArrow(add, "id long, n_words long, n_features long, weight long")


def noise(doc_id, seed: int = SEED):
    """Gumbel noise in thousandths, from 32 bits of a hash; a null id counts as an empty text."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, limit: int, order: list) -> DataFrame:
    """``rows`` with ``rank``, 1 to ``limit`` in the given order, null beyond it. Ranges of the order are
    numbered side by side and shifted by the sizes of those before them; one row a range meets in
    the window."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n))], names=[*batch.schema.names, "part", "place"])
            at += n

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", part int, place long"
    numbered = store(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(number, schema), "ranked")
    sizes = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    rank = F.col("base") + F.col("place") + 1
    return numbered.join(F.broadcast(offsets), "part").withColumn("rank", F.when(rank <= limit, rank)).drop("part", "place", "base")


def resample(docs: DataFrame, target: DataFrame, id_column: str = "doc_id", text_column: str = "text", target_text_column: str = "text",
             max_n: int = MAX_N, buckets: int = BUCKETS, percent: int = DRAW_PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, n_features, weight, score, rank (null: not drawn).

    ``percent`` of the documents with at least ``min_words`` words are drawn, the highest scores, ties
    to the smaller id. Null and empty texts have no features and weight 0; repeated rows count and are
    drawn each; an empty table gives no rows, an empty target leaves the corpus' own counts; other
    columns are ignored."""
    def texts(df: DataFrame, id_name: str | None, name: str) -> DataFrame:
        key = F.col(id_name).cast("long") if id_name else F.lit(None).cast("long")
        return df.select(key.alias("id"), F.col(name).cast("string").alias("text"))

    features = store(featurise(texts(docs, id_column, text_column), max_n, buckets), "ngrams")
    wanted = store(featurise(texts(target, None, target_text_column), max_n, buckets), "target-ngrams")
    weighed = weigh(features, gains(bucket_counts(features, buckets), bucket_counts(wanted, buckets)))
    scored = store(weighed.withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "scores")
    eligible = scored.where(F.col("n_words") >= min_words)
    drawn = ranked(eligible, eligible.count() * percent // 100, [F.desc("score"), F.asc("id")])
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")
