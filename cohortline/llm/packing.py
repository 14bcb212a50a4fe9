"""Packing documents into fixed-length sequences by minimum bin slack.

A document's whole windows are sequences of their own; its remainder is one item. Items are only
counted by length, so the plan works on at most ``capacity`` counts however large the input:
a bitset subset-sum finds the multiset of remaining lengths that fills a window closest to the
capacity, backtracking gives its counts, and the pattern is used as often as the counts allow.
Where the best pattern leaves more slack than ``max_slack``, the longest length is set aside; what
was set aside is laid end to end and cut at the window borders. Items are then numbered within their length (in hash buckets,
so that a hot length is split) and the number gives sequence and offset by arithmetic.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortline.llm.common import store
from cohortline.llm.tokens import UnitEncoder

BUCKETS = 256

PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def cut_documents(docs: DataFrame, tokenizer_json: bytes, capacity: int, end_id: int) -> DataFrame:
    """One row per whole window and one per remainder; only a remainder carries its ids."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = UnitEncoder.shared(shared.value)
        dtype = np.dtype("<u2") if encoder.vocabulary_size <= 65_536 and end_id <= 65_535 else np.dtype("<u4")
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for doc_id, joined in zip(batch.column(0).to_pylist(), encoder.encode_all(batch.column(1).to_pylist())):
                joined += end
                total = len(joined) // 4
                for start in range(0, total, capacity):
                    part = joined[4 * start:4 * (start + capacity)]
                    length = len(part) // 4
                    rest = None if length == capacity else np.frombuffer(part, "<u4").astype(dtype).tobytes()
                    for column, value in zip(out, (doc_id, start, length, zlib.crc32(part), total, rest)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in out[:5]] + [pa.array(out[5], pa.binary())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    return docs.mapInArrow(pieces, PIECE_SCHEMA)


def fill_window(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of remaining lengths, with the longest among them, whose sum comes closest to the capacity."""
    longest = max(counts)
    room = capacity - longest
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        left = counts[length] - (length == longest)
        if length > room or not left:
            continue
        left, size = min(left, room // length), 1
        while left:
            take = min(size, left)
            left -= take
            size *= 2
            steps.append((reach, length, take))
            reach |= (reach << (take * length)) & mask
            if reach >> room & 1:
                left = 0
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    used = {longest: 1}
    for before, length, take in reversed(steps):
        if not before >> at & 1:
            at -= take * length
            used[length] = used.get(length, 0) + take
    return used


def plan_windows(counts: dict[int, int], capacity: int, max_slack: int) -> tuple[list[tuple[dict[int, int], int]], dict[int, int]]:
    """Patterns with their number of uses, and the counts of the items left over. A length is left
    over from when, as the longest that remains, it has no filling within ``max_slack``."""
    left = {length: n for length, n in counts.items() if n}
    patterns, over = [], {}
    while left:
        used = fill_window(left, capacity)
        if capacity - sum(length * n for length, n in used.items()) > max_slack:
            longest = max(left)
            over[longest] = left.pop(longest)
            continue
        times = min(left[length] // n for length, n in used.items())
        patterns.append((used, times))
        for length, n in used.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
    return patterns, over


def _numbered(pieces: DataFrame, tail_lengths: list[int]) -> DataFrame:
    """Pieces with their number within the length; ids are kept only where a cut may come."""
    rows = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(BUCKETS)))
    sizes = rows.groupBy("length", "bucket").count()
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    keep = F.when(F.col("length").isin(tail_lengths), F.col("ids")) if tail_lengths else F.lit(None).cast("binary")
    in_bucket = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    return (
        rows.withColumn("ids", keep).withColumn("row", F.row_number().over(in_bucket) - 1)
        # at most capacity x BUCKETS rows
        .join(F.broadcast(sizes), ["length", "bucket"])
        .withColumn("number", F.col("first") + F.col("row")).drop("first", "row", "bucket"))


def pack(docs: DataFrame, tokenizer_json: bytes, id_column: str = "doc_id", text_column: str = "text",
         capacity: int = 1024, end_id: int = 0, max_slack: int = 4) -> DataFrame:
    """Pieces of documents with the sequence and the offset they go to.

    Every id of every document (its text's ids, then ``end_id``) lies in exactly one piece. A null
    or empty text is the end id alone; rows with equal or null ids are packed one by one; an
    empty table gives no pieces; other columns are ignored. Equal lengths are told apart by
    (doc_id, start), so the result doesn't depend on the partitioning.
    """
    spark = docs.sparkSession
    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    pieces = store(cut_documents(picked, tokenizer_json, capacity, end_id), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most capacity rows
    patterns, left = plan_windows(counts, capacity, max_slack)

    ranges, taken, sequence = [], dict.fromkeys(counts, 0), 0
    for used, times in patterns:
        offset = 0
        for length, n in sorted(used.items(), reverse=True):
            ranges.append((length, taken[length], taken[length] + n * times, sequence, n, offset))
            taken[length] += n * times
            offset += length * n
        sequence += times
    tails, at = [], 0
    for length in sorted(left, reverse=True):
        tails.append((length, taken[length], at))
        at += length * left[length]
    tail_base = sequence

    rows = _numbered(pieces, sorted(left))
    # at most capacity x log2(rows) patterns
    placed_at = spark.createDataFrame(ranges, "length long, lo long, hi long, sequence long, n long, place long")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    placed = (
        rows.join(F.broadcast(placed_at), "length")
        .where((F.col("number") >= F.col("lo")) & (F.col("number") < F.col("hi")))
        .withColumn("nth", F.col("number") - F.col("lo"))
        .select(*names, (F.col("sequence") + F.expr("nth div n")).alias("sequence_id"),
                (F.col("place") + F.expr("nth % n") * F.col("length")).alias("offset")))
    if not tails:
        return placed
    tail_at = spark.createDataFrame(tails, "length long, lo long, base long")
    tail = (
        rows.join(F.broadcast(tail_at), "length").where(F.col("number") >= F.col("lo"))
        .select(*names, "ids", (F.col("base") + (F.col("number") - F.col("lo")) * F.col("length")).alias("at")))
    return placed.unionByName(_cut_tail(tail, capacity, tail_base))


def _cut_tail(tail: DataFrame, capacity: int, first_sequence: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for r in batch.to_pylist():
                width = len(r["ids"]) // r["length"]
                ids = np.frombuffer(r["ids"], f"<u{width}").astype("<u4")
                done = 0
                while done < r["length"]:
                    sequence, offset = divmod(r["at"] + done, capacity)
                    n = min(capacity - offset, r["length"] - done)
                    for column, value in zip(out, (
                            r["doc_id"], r["start"] + done, n, zlib.crc32(ids[done:done + n].tobytes()), r["doc_tokens"],
                            first_sequence + sequence, offset)):
                        column.append(value)
                    done += n
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return tail.mapInArrow(cut, ", ".join(f"{n} long" for n in names))
