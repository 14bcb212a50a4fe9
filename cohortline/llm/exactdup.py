"""Exact duplicates through an extendible-hash index in the shared folder.

Every text becomes a 64-bit key. The top bits of the key name a key range; ranges are dealt to
owner tasks, and an owner builds one range's index at a time: a directory over the next bits whose
buckets split, doubling the directory where needed, once they hold too many keys. Entries whose
keys collide are chained and told apart by their bytes. Equal texts of one batch are merged before
the shuffle, so that a text with a third of all rows sends one entry per batch. The finished index
(one row per distinct text) is written to the shared folder by Spark's committer.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import store, worker_state

WHITE_SPACE = " \t\n\x0b\x0c\r"
#: Distinct keys that a bucket may hold.
BUCKET_KEYS = 64
#: A directory has at most 2 ** SLACK_BITS times as many entries as keys.
SLACK_BITS = 4
#: Key ranges for each shuffle partition; a range is the unit that an owner holds in memory.
RANGES_PER_PARTITION = 16

INDEX_SCHEMA = (
    "key long, sha256 string, range int, bucket string, local_depth int, chain int, "
    "keep_id long, keep_chars long, group_size long")


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def keyed(docs: DataFrame, id_column: str, text_column: str, key: str = "xxhash64(body)") -> DataFrame:
    """doc_id, code points of the original text, normalised text, key and SHA-256."""
    text = F.col(text_column).cast("string")
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.char_length(F.coalesce(text, F.lit(""))).cast("long").alias("n_chars"),
        normalised(text).alias("body"))
    return rows.select("doc_id", "n_chars", "body", F.expr(key).cast("long").alias("key"), F.sha2("body", 256).alias("sha256"))


def _better(left: tuple, right: tuple) -> tuple:
    """Of (doc_id, n_chars): more code points, then the smaller id; a missing id comes last."""
    rank = lambda x: (-x[1], x[0] is None, x[0] or 0)
    return min(left, right, key=rank)


class Bucket:
    __slots__ = ("depth", "prefix", "keys")

    def __init__(self, depth: int, prefix: int):
        self.depth, self.prefix = depth, prefix
        self.keys: dict[int, list[list]] = {}


class KeyRange:
    """The index of one key range: a directory over the key bits below the range's own."""

    def __init__(self, skip_bits: int, bucket_keys: int = BUCKET_KEYS):
        self.room = 64 - skip_bits
        self.bucket_keys = bucket_keys
        self.depth = 0
        self.n_keys = 0
        self.directory = [Bucket(0, 0)]

    def _slot(self, key: int) -> int:
        low = key & ((1 << self.room) - 1)
        return low >> (self.room - self.depth)

    def insert(self, key: int, body: bytes, sha256: str, best: tuple, count: int) -> None:
        bucket = self.directory[self._slot(key)]
        chain = bucket.keys.setdefault(key, [])
        for entry in chain:
            if entry[0] == body:
                entry[2], entry[3] = _better(entry[2], best), entry[3] + count
                return
        chain.append([body, sha256, best, count])
        self.n_keys += len(chain) == 1
        # keys that agree in too many bits overflow their bucket, so that the directory stays in proportion
        deepest = min(self.room, self.n_keys.bit_length() + SLACK_BITS)
        while len(bucket.keys) > self.bucket_keys and bucket.depth < deepest:
            self._split(bucket)
            bucket = self.directory[self._slot(key)]

    def _split(self, bucket: Bucket) -> None:
        if bucket.depth == self.depth:
            self.directory = [b for b in self.directory for _ in range(2)]
            self.depth += 1
        halves = [Bucket(bucket.depth + 1, bucket.prefix << 1 | bit) for bit in (0, 1)]
        shift = self.room - bucket.depth - 1
        for key, chain in bucket.keys.items():
            halves[key >> shift & 1].keys[key] = chain
        span = 1 << (self.depth - bucket.depth)
        first = bucket.prefix * span
        self.directory[first:first + span] = [halves[0]] * (span // 2) + [halves[1]] * (span // 2)

    def entries(self) -> Iterator[tuple]:
        """(bucket's bits, its depth, key, place in the chain, entry), each bucket once."""
        last = None
        for bucket in self.directory:
            if bucket is last:
                continue
            last = bucket
            bits = format(bucket.prefix, f"0{bucket.depth}b") if bucket.depth else ""
            for key, chain in bucket.keys.items():
                for place, entry in enumerate(chain):
                    yield bits, bucket.depth, key, place, entry


def build_index(rows: DataFrame, range_bits: int | None = None, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """The written index over ``keyed`` rows: one row per distinct normalised text."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    range_bits = range_bits or (RANGES_PER_PARTITION * partitions - 1).bit_length()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("exactdup")  # drops what an earlier operator cached
        for batch in batches:
            found: dict[str, list] = {}
            for doc_id, n, body, key, sha256 in zip(*(c.to_pylist() for c in batch.columns)):
                entry = found.get(body)
                if entry is None:
                    found[body] = [key, sha256, (doc_id, n), 1]
                else:
                    entry[2], entry[3] = _better(entry[2], (doc_id, n)), entry[3] + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([e[0] for e in found.values()], pa.int64()), pa.array(list(found), pa.string()),
                 pa.array([e[1] for e in found.values()], pa.string()), pa.array([e[2][0] for e in found.values()], pa.int64()),
                 pa.array([e[2][1] for e in found.values()], pa.int64()), pa.array([e[3] for e in found.values()], pa.int64())],
                names=["key", "body", "sha256", "keep_id", "keep_chars", "count"])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = None, None

        def finished() -> pa.RecordBatch:
            out: list[list] = [[] for _ in range(9)]
            for bits, depth, key, place, (_, sha256, best, count) in held.entries():
                signed = key - (1 << 64) if key >> 63 else key
                for column, value in zip(out, (signed, sha256, at, bits, depth, place, best[0], best[1], count)):
                    column.append(value)
            types = [pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types)], names=[f.split()[0] for f in INDEX_SCHEMA.split(", ")])

        for batch in batches:
            for owner, key, body, sha256, keep_id, keep_chars, count in zip(*(c.to_pylist() for c in batch.columns)):
                if owner != at:
                    if held:
                        yield finished()
                    held, at = KeyRange(range_bits, bucket_keys), owner
                held.insert(key & ((1 << 64) - 1), body.encode("utf-8"), sha256, (keep_id, keep_chars), count)
        if held:
            yield finished()

    merged = rows.select("doc_id", "n_chars", "body", "key", "sha256").mapInArrow(
        merge, "key long, body string, sha256 string, keep_id long, keep_chars long, count long")
    owned = merged.select(F.shiftrightunsigned("key", 64 - range_bits).cast("int").alias("owner"), "*")
    dealt = owned.repartition(partitions, "owner").sortWithinPartitions("owner")
    return store(dealt.mapInArrow(index, INDEX_SCHEMA), "hash-index")


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", key: str = "xxhash64(body)",
                     range_bits: int | None = None, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and n_chars (of the original) of every row.

    Texts are equal when they agree without ASCII white space. The row with the most code points
    in its original text stays, then the smallest id (a missing id last). Null counts as empty,
    so all null, empty and blank texts are one group. Rows that repeat an id with an equal text
    share one decision; group_size counts rows. An empty table gives no rows; other columns are
    ignored. ``key`` may be a poorer hash of ``body``: collisions are chained, never merged.
    """
    rows = keyed(docs, id_column, text_column, key)
    index = build_index(rows, range_bits, bucket_keys).select("key", "sha256", "keep_id", "keep_chars", "group_size")
    named = rows.select("doc_id", "n_chars", "key", "sha256").join(index, ["key", "sha256"])
    # of rows that share the kept id only those as long as the kept text stay
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))
    return named.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("sha256").alias("text_sha256"), "n_chars")
