"""Token ids on disk: canonical length-limited Huffman codes from global counts.

File format: a Parquet table of independent blocks (Spark's committer makes a block appear once,
whole, whatever executors die) and a table of code lengths, from which the canonical codes follow.
A block's payload is little-endian: ``HUF1``, the number of documents, ids, checkpoint interval and
checkpoints (unsigned 32-bit), then document ids (signed 64), null marks (8), ids per document
(unsigned 32), the bit offset of every ``interval``-th id (unsigned 64), and the code bits, first
bit highest, as big-endian 32-bit words. Decoding looks up ``max_length`` bits at once and works
on all checkpoints of a block in step.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortline.llm.common import shared_path, store, sum_arrays
from cohortline.llm.tokens import UnitEncoder

MAGIC = b"HUF1"
BLOCK_IDS = 1 << 18
INTERVAL = 256
MAX_LENGTH = 16


def code_lengths(counts: np.ndarray, max_length: int = MAX_LENGTH) -> np.ndarray:
    """Optimal code length of each symbol (0: unused) with none above ``max_length`` (package-merge).

    Ties go to the smaller symbol number."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) == 0:
        return lengths
    if len(used) == 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_length:
        raise ValueError(f"{len(used)} symbols need codes longer than {max_length} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    is_leaf, packages = [], np.empty(0, dtype=np.int64)
    for _ in range(max_length):
        weights = np.concatenate([leaves, packages])
        rank = np.argsort(weights, kind="stable")
        is_leaf.append(rank < len(leaves))
        merged = weights[rank]
        even = len(merged) // 2 * 2
        packages = merged[0:even:2] + merged[1:even:2]
    take = 2 * (len(leaves) - 1)
    depth = np.zeros(len(leaves), dtype=np.int64)
    for marks in reversed(is_leaf):
        n = int(marks[:take].sum())
        depth[:n] += 1
        take = 2 * (take - n)
    lengths[order] = depth
    return lengths


class Codebook:
    """Canonical codes: symbols sorted by (length, number) get consecutive codes."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        self.max_length = int(lengths.max()) if len(used) else 1
        spans = np.int64(1) << (self.max_length - self.lengths[order])
        starts = np.cumsum(spans) - spans
        # code and length of each symbol, and symbol and length behind each ``max_length`` bits, in one number
        self.codes = np.zeros(len(lengths), dtype=np.int64)
        self.codes[order] = (starts >> (self.max_length - self.lengths[order])) << 6 | self.lengths[order]
        table = np.repeat(order << 6 | self.lengths[order], spans)
        self.symbols = np.ones(1 << self.max_length, dtype=np.int64)
        self.symbols[:len(table)] = table

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, bytes]:
        """Bit offset of each id, and the bits."""
        packed = self.codes[ids]
        widths = packed & 63
        ends = np.cumsum(widths)
        at = ends - widths
        total = int(ends[-1]) if len(ids) else 0
        words = np.zeros(total // 32 + 2, dtype=np.uint64)
        if len(ids):
            word = at >> 5
            value = (packed >> 6).astype(np.uint64) << (64 - (at & 31) - widths).astype(np.uint64)
            # the codes that begin in one word: their bits are disjoint, so sums stand for disjunctions
            first = np.flatnonzero(np.diff(word, prepend=-1))
            words[word[first]] += np.add.reduceat(value >> np.uint64(32), first)
            words[word[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
        return at, words[:(total + 31) // 32].astype(">u4").tobytes()

    def decode(self, bits: bytes, checkpoints: np.ndarray, n: int, interval: int) -> np.ndarray:
        words = np.frombuffer(bits, ">u4").astype(np.uint64)
        words = np.concatenate([words, np.zeros(interval * self.max_length // 32 + 2, dtype=np.uint64)])
        pairs = (words[:-1] << np.uint64(32)) | words[1:]
        at = checkpoints.astype(np.int64)
        out = np.empty((interval, len(at)), dtype="<u4")
        drop = np.uint64(64 - self.max_length)
        for step in range(min(interval, n)):
            look = ((pairs[at >> 5] << (at & 31).astype(np.uint64)) >> drop).astype(np.int64)
            found = self.symbols[look]
            out[step] = found >> 6
            at += found & 63
        return out.T.ravel()[:n]


def write_block(book: Codebook, doc_ids: list, sizes: list[int], ids: np.ndarray, interval: int = INTERVAL) -> bytes:
    at, bits = book.encode(ids)
    checkpoints = at[::interval].astype("<u8")
    return b"".join([
        MAGIC, struct.pack("<4I", len(doc_ids), len(ids), interval, len(checkpoints)),
        np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(), bytes([d is None for d in doc_ids]),
        np.array(sizes, dtype="<u4").tobytes(), checkpoints.tobytes(), bits])


def read_block(book: Codebook, payload: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """Document ids, ids per document, and all ids."""
    if payload[:4] != MAGIC:
        raise ValueError("not a block of token ids")
    n_docs, n, interval, n_checkpoints = struct.unpack_from("<4I", payload, 4)
    at = 20
    doc_ids = np.frombuffer(payload, "<i8", n_docs, at).tolist()
    at += 8 * n_docs
    doc_ids = [None if null else d for d, null in zip(doc_ids, payload[at:at + n_docs])]
    at += n_docs
    sizes = np.frombuffer(payload, "<u4", n_docs, at)
    at += 4 * n_docs
    checkpoints = np.frombuffer(payload, "<u8", n_checkpoints, at)
    return doc_ids, sizes, book.decode(payload[at + 8 * n_checkpoints:], checkpoints, n, interval)


def token_ids(docs: DataFrame, tokenizer_json: bytes, end_id: int) -> DataFrame:
    """(doc_id, n_ids, ids) of each row of ``docs`` (doc_id, text), straight from the scan; ids take two bytes
    where the vocabulary allows it. Each task's last row holds its counts of ids instead."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = UnitEncoder.shared(shared.value)
        size = max(encoder.vocabulary_size, end_id + 1)
        dtype = "<u2" if size <= 65_536 else "<u4"
        end = np.array([end_id], dtype="<u4").tobytes()
        counts = np.zeros(size, dtype="<i8")

        def rows(doc_ids: pa.Array, n_ids: np.ndarray, ids: list[bytes | None], counted: list[bytes | None]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()] * len(ids), pa.int32()), doc_ids, pa.array(n_ids, pa.int64()),
                 pa.array(ids, pa.binary()), pa.array(counted, pa.binary())], names=["part", "doc_id", "n_ids", "ids", "counts"])

        for batch in batches:
            found = [joined + end for joined in encoder.encode_all(text.as_py() for text in batch.column(1))]
            n_ids = np.array([len(ids) // 4 for ids in found], dtype=np.int64)
            flat = np.frombuffer(b"".join(found), "<u4")
            counts += np.bincount(flat, minlength=size)
            data, ends = flat.astype(dtype).tobytes(), (np.cumsum(n_ids) * np.dtype(dtype).itemsize).tolist()
            yield rows(batch.column(0), n_ids, [data[a:b] for a, b in zip([0, *ends], ends)], [None] * len(found))
        yield rows(pa.nulls(1, pa.int64()), np.zeros(1, dtype=np.int64), [None], [counts.tobytes()])

    return docs.mapInArrow(tokenize, "part int, doc_id long, n_ids long, ids binary, counts binary")


def write_ids(docs: DataFrame, path: str, tokenizer_json: bytes, end_id: int = 2, id_column: str = "doc_id",
              text_column: str = "text", partitions: int | None = None, max_length: int | None = None) -> None:
    """Encode every text, append ``end_id`` to it and write ``path``/blocks and ``path``/codebook.

    Documents are in ascending order of their ids (nulls first, rows of one id in the order of a hash of
    their token ids, so that a frequent id spreads over partitions). A null or empty text is the end id
    alone, an empty table gives no blocks, other columns are ignored. Codes have at most ``max_length``
    bits, by default ``MAX_LENGTH`` or what the number of ids needs."""
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    raw = store(token_ids(picked, tokenizer_json, end_id), "token-ids")
    counted = raw.where("counts is not null").select("part", F.col("counts").alias("data"))
    counts = sum_arrays(counted, raw.agg(F.max("part")).first()[0] or 0, "<i8")
    counts = np.zeros(1, dtype=np.int64) if counts is None else counts
    lengths = code_lengths(counts, max_length or max(MAX_LENGTH, int((counts > 0).sum()).bit_length()))
    used = np.flatnonzero(lengths)
    spark.createDataFrame(
        [(int(i), int(lengths[i])) for i in used], "id int, length int").coalesce(1).write.parquet(f"{path}/codebook")
    shared = spark.sparkContext.broadcast(lengths)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(shared.value)
        part, number, before = TaskContext.get().partitionId(), 0, 0
        doc_ids, sizes, ids, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            width = len(ids[0]) // sizes[0]
            payload = write_block(book, doc_ids, sizes, np.frombuffer(b"".join(ids), f"<u{width}"))
            values = [part, number, before, held, payload]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()])],
                names=["part", "block", "before", "n_ids", "payload"])

        for batch in batches:
            for doc_id, n, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                doc_ids.append(doc_id)
                sizes.append(n)
                ids.append(data)
                held += n
                if held >= BLOCK_IDS:
                    yield block()
                    number, before = number + 1, before + held
                    doc_ids, sizes, ids, held = [], [], [], 0
        if doc_ids:
            yield block()

    order = ["doc_id", F.xxhash64("ids"), "ids"]
    ordered = raw.where("counts is null").select("doc_id", "n_ids", "ids").repartitionByRange(partitions, *order[:2]).sortWithinPartitions(*order)
    ordered.mapInArrow(encode, "part int, block int, before long, n_ids long, payload binary").write.option(
        "compression", "uncompressed").parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents of a written folder: id, ids of all documents before it, number and crc32 of its
    ids, and the ids themselves on request."""
    blocks = spark.read.schema("part int, block int, before long, n_ids long, payload binary").parquet(f"{path}/blocks")
    code = spark.read.parquet(f"{path}/codebook").collect()  # at most the vocabulary
    lengths = np.zeros(max((r["id"] for r in code), default=0) + 1, dtype=np.uint8)
    for r in code:
        lengths[r["id"]] = r["length"]
    shared = spark.sparkContext.broadcast(lengths)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(shared.value)
        for batch in batches:
            for r in batch.to_pylist():
                doc_ids, sizes, ids = read_block(book, r["payload"])
                ends = np.cumsum(sizes, dtype=np.int64)
                starts = ends - sizes
                data = ids.tobytes()
                texts = [data[4 * a:4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                columns = [
                    pa.array(doc_ids, pa.int64()), pa.array([r["part"]] * len(doc_ids), pa.int32()),
                    pa.array(starts + r["before"], pa.int64()), pa.array(sizes.astype(np.int64), pa.int64()),
                    pa.array([zlib.crc32(t) for t in texts], pa.int64())]
                names = ["doc_id", "part", "in_part", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(texts, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, part int, in_part long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row per written partition
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    docs = blocks.mapInArrow(decode, schema).join(F.broadcast(parts), "part")
    return docs.select("doc_id", (F.col("base") + F.col("in_part")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def encode_and_read(docs: DataFrame, tokenizer_json: bytes, **options) -> DataFrame:
    """Write the ids of ``docs`` into the shared folder and read them back."""
    spark = docs.sparkSession
    path = shared_path(spark, "huffman")
    write_ids(docs, path, tokenizer_json, **options)
    return read_ids(spark, path)
