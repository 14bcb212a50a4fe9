"""Near duplicates on word shingles: banded MinHash, odd sketches, exact confirmation.

1. A document's MinHash samples are cut into bands, and each sample toggles one bit of a parity
   bitmap (odd sketch). Documents with equal shingle sets form one class with one representative.
2. Members of a bucket of equal band keys are compared with its leader; the exclusive-or population
   count of two sketches and the set sizes throw hopeless pairs out, full sets confirm the rest,
   and linked members merge. Buckets that still hold several components go on in rounds: cut into
   blocks by another hash each time, every member proposes its nearest member of another component,
   sketch against sketch. A bucket of thousands of near copies thus costs a few comparisons a member.
3. What is still apart is compared completely: members outside a bucket's largest component against
   all others, in blocks of bounded size, which get the full sets of those that the sketches let pass.

With 32 bands of 4 rows a pair at the threshold 0.75 escapes all bands with probability 5e-6,
and the sketch filter is four and a half standard deviations below the threshold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import store, worker_state

SHINGLE = 5
ROWS = 4
BANDS = 32
SKETCH_BITS = 1024
PERCENT = 75
#: Pairs whose sketches estimate less than this similarity are not looked at further.
SKETCH_FLOOR = 0.58
#: Rounds in which members propose their nearest.
NEAR_ROUNDS = 1
BLOCK = 512
MAX_CACHED_WORDS = 400_000
SEED = 20_250_401

_RANDOM = np.random.default_rng(SEED)
_PLACE = _RANDOM.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SAMPLE = _RANDOM.integers(1, 1 << 63, ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = _RANDOM.integers(1, 1 << 63, ROWS * BANDS, dtype=np.uint64)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct shingles. Words are lower-cased in A-Z only and
    separated by ASCII white space; fewer words than a shingle make one shingle, none make none."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    cache = worker_state("neardup")
    if len(cache) > MAX_CACHED_WORDS:
        cache.clear()
    for word in set(words).difference(cache):
        cache[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    hashes = np.array([cache[w] for w in words], dtype=np.uint64)
    width = min(SHINGLE, len(words))
    count = len(words) - width + 1
    total = np.full(count, width, dtype=np.uint64)
    for i in range(width):
        total += hashes[i:i + count] * _PLACE[i]
    return np.unique(_mixed(total))


def minhash(shingles: np.ndarray) -> np.ndarray:
    best = (shingles[:2048, None] * _SAMPLE[None, :]).min(axis=0)
    for at in range(2048, len(shingles), 2048):
        np.minimum(best, (shingles[at:at + 2048, None] * _SAMPLE[None, :]).min(axis=0), out=best)
    return best


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, which holds the band's number."""
    rows = _mixed(samples ^ _SALT).reshape(BANDS, ROWS)
    return _mixed((rows * _PLACE[:ROWS]).sum(axis=1, dtype=np.uint64)).view(np.int64)


def odd_sketch(samples: np.ndarray) -> bytes:
    """Parity bitmap: each sample, told apart by its number, toggles one bit."""
    bit = (_mixed(samples + _SALT) >> np.uint64(64 - SKETCH_BITS.bit_length() + 1)).astype(np.int64)
    return np.packbits((np.bincount(bit, minlength=SKETCH_BITS) & 1).astype(np.uint8)).tobytes()


def most_different_bits(floor: float = SKETCH_FLOOR) -> int:
    """Exclusive-or population count expected of two sketches at similarity ``floor``."""
    toggles = 2 * ROWS * BANDS * (1 - floor)
    return int(SKETCH_BITS * (1 - (1 - 2 / SKETCH_BITS) ** toggles) / 2)


def estimate(different_bits: int) -> float:
    """Similarity that a population count stands for."""
    return 1 + SKETCH_BITS / (4 * ROWS * BANDS) * float(np.log(max(1 - 2 * different_bits / SKETCH_BITS, 1e-9)))


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest of the set, band keys and odd sketch of every row."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[bytes, tuple] = {}
            sizes, digests, keys, sketches = [], [], [], []
            for i in range(batch.num_rows):
                shingles = shingle_set(batch.column(1)[i].as_py())
                digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
                if len(shingles) and digest not in seen:
                    samples = minhash(shingles)
                    seen[digest] = (band_keys(samples), odd_sketch(samples))
                found = seen.get(digest, (None, None))
                sizes.append(len(shingles))
                digests.append(digest)
                keys.append(found[0])
                sketches.append(found[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                names=["doc_id", "n_shingles", "digest", "bands", "sketch"])

    return docs.mapInArrow(sign, "doc_id long, n_shingles long, digest binary, bands array<long>, sketch binary")


def similar(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    """Whether two full sets are similar enough."""
    both = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * both >= percent * (len(left) + len(right) - both)


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id and the full set of every wanted document, stored."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([shingle_set(t.as_py()).tobytes() for t in part.column(1)], pa.binary())],
                    names=["doc_id", "shingles"])

    return store(docs.join(wanted, "doc_id", "left_semi").mapInArrow(sets, "doc_id long, shingles binary"), "shingles")


def _confirm(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; only sets of the pairs' documents are built."""
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array([similar(*(np.frombuffer(batch.column(c)[i].as_buffer(), dtype=np.uint64) for c in (2, 3)), percent)
                             for i in range(batch.num_rows)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    ends = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "doc_id")
    full = shingle_sets(docs, ends)
    both = (
        pairs.join(full.select(F.col("doc_id").alias("a"), F.col("shingles").alias("left")), "a")
        .join(full.select(F.col("doc_id").alias("b"), F.col("shingles").alias("right")), "b")
        .select("a", "b", "left", "right"))
    return both.mapInArrow(linked, "a long, b long").distinct()


def _hopeful(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that neither their set sizes nor their sketches rule out."""
    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = most_different_bits()
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint64).reshape(batch.num_rows, -1) for c in (2, 3))
            keep = pa.array(np.bitwise_count(left ^ right).sum(axis=1) <= most)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    left = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sketch").alias("sketch_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sketch").alias("sketch_b"))
    sized = pairs.join(left, "a").join(right, "b").where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return sized.select("a", "b", "sketch_a", "sketch_b").mapInArrow(alike, "a long, b long").distinct()


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """node and component (the smallest node it reaches) for every node of the edges (a, b) that is not
    that smallest node, by large-star and small-star rounds, each written to the shared folder."""
    edges = store(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        # large star: every larger neighbour goes to the smallest
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        # small star: smaller neighbours and the node itself go to the smallest
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
        edges = store(small.where("a <> b").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before == tuple(now):
            break
        before = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    return edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")


def _with_component(members: DataFrame, found: DataFrame | None) -> DataFrame:
    if found is None:
        return members.withColumn("component", F.col("node"))
    return members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _open_buckets(members: DataFrame, found: DataFrame | None) -> DataFrame:
    """Members (key, node, component) of the buckets that hold more than one component."""
    rows = _with_component(members, found)
    mixed = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
    return rows.join(mixed.where("low < high"), "key").select("key", "node", "component", "size")


def _in_units(rows: DataFrame, block: int, salt: int | None) -> DataFrame:
    """Members with the unit of work they are compared in. With a ``salt`` a bucket is cut into blocks
    and each block is a unit. Without, the members outside its largest component meet each other and
    that component, and each pair of blocks is a unit."""
    if salt is not None:
        cut = rows.withColumn("own", F.pmod(F.xxhash64("node", F.lit(salt)), F.ceil(F.col("size") / block)))
        return cut.select("key", "node", "component", F.xxhash64("key", "own").alias("unit"))
    counts = rows.groupBy("key", "component").count()
    largest = counts.groupBy("key").agg(
        F.max(F.struct("count", "component")).alias("top"), F.sum("count").alias("all")).select(
        "key", F.col("top.component").alias("largest"), F.ceil(F.col("top.count") / block).cast("int").alias("n_largest"),
        F.ceil((F.col("all") - F.col("top.count")) / block).cast("int").alias("n_rest"))
    cut = rows.join(largest, "key").withColumn("inside", F.col("component") == F.col("largest"))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("inside"), F.col("n_largest")).otherwise(F.col("n_rest"))).cast("int"))
    rest, main = F.sequence(F.lit(0), F.col("n_rest") - 1), F.sequence(F.lit(0), F.col("n_largest") - 1)
    units = F.when(F.col("inside"), F.transform(rest, lambda i: F.xxhash64("key", F.lit("main"), F.col("own"), i))).otherwise(F.concat(
        F.transform(main, lambda i: F.xxhash64("key", F.lit("main"), i, F.col("own"))),
        F.transform(rest, lambda i: F.xxhash64("key", F.lit("rest"), F.least("own", i), F.greatest("own", i)))))
    return cut.select("key", "node", "component", F.explode(units).alias("unit"))


class Unit:
    """The members of one unit of work as arrays."""

    def __init__(self, key: int, rows: list, percent: int):
        self.key, self.percent = key, percent
        self.node, self.component, self.size = (np.array([r[c] for r in rows], dtype=np.int64) for c in range(3))
        self.sketch = np.frombuffer(b"".join(r[3] for r in rows), dtype=np.uint64).reshape(len(rows), -1)
        self.bands = np.array([r[4] for r in rows], dtype=np.int64)
        self.rest = [r[5:] for r in rows]

    def near(self, i: int, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Members from ``first`` on, in other components than member ``i``, that neither size nor sketch
        rules out, and their different bits. A pair counts in the bucket of its first common band only."""
        size, own = self.size[first:], self.size[i]
        near = first + np.flatnonzero(
            (self.component[first:] != self.component[i]) & (100 * np.minimum(size, own) >= self.percent * np.maximum(size, own)))
        different = np.bitwise_count(self.sketch[near] ^ self.sketch[i]).sum(axis=1)
        near, different = near[different <= most_different_bits()], different[different <= most_different_bits()]
        common = np.argmax(self.bands[near] == self.bands[i], axis=1)
        mine = self.bands[i][common] == self.key
        return near[mine], different[mine]


def _units(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[tuple[int, Unit]]:
    """Units of at least two members from rows sorted by (unit, key)."""
    held, at = [], None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:2] != at:
                if len(held) > 1:
                    yield at[0], Unit(at[1], held, percent)
                held, at = [], row[:2]
            held.append(row[2:])
    if len(held) > 1:
        yield at[0], Unit(at[1], held, percent)


MEMBER = ["unit", "key", "node", "component", "n_shingles", "sketch", "bands"]


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.repartition("unit").sortWithinPartitions("unit", "key", "node")


def _proposals(rows: DataFrame, nodes: DataFrame, percent: int, salt: int, block: int = BLOCK) -> DataFrame:
    """For each member its nearest member of another component, over all blocks it is in: pairs (a, b)."""
    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, unit in _units(batches, percent):
            found = []
            for i in range(len(unit.node)):
                near, different = unit.near(i)
                if len(near):
                    best = int(np.argmin(different))
                    found.append((int(unit.node[i]), int(unit.node[near[best]]), int(different[best])))
            yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], pa.int64()) for c in range(3)], names=["node", "other", "different"])

    members = _in_units(rows, block, salt).join(nodes, "node").select(*MEMBER)
    proposed = _grouped(members).mapInArrow(nearest, "node long, other long, different long")
    best = proposed.groupBy("node").agg(F.min(F.struct("different", "other")).alias("best")).select("node", F.col("best.other").alias("other"))
    return best.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _links_across(rows: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """All links (a, b) between components within the buckets. A first pass over the sketches finds the
    members that have a hopeful pair; only their sets are brought to the units, and compared there, so
    that no row stands for a pair that isn't a link."""
    def hopeful(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, unit in _units(batches, percent):
            keep = np.zeros(len(unit.node), dtype=bool)
            for i in range(len(unit.node) - 1):
                near, _ = unit.near(i, i + 1)
                keep[near] = True
                keep[i] |= len(near) > 0
            node = unit.node[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (np.full(len(node), number), np.full(len(node), unit.key), node)], names=["unit", "key", "node"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, unit in _units(batches, percent):
            sets = [np.frombuffer(r[0], dtype=np.uint64) for r in unit.rest]
            found = []
            for i in range(len(unit.node) - 1):
                for j in unit.near(i, i + 1)[0]:
                    if similar(sets[i], sets[j], percent):
                        found.append(sorted((int(unit.node[i]), int(unit.node[j]))))
            yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], pa.int64()) for c in range(2)], names=["a", "b"])

    members = store(_in_units(rows, block, None).join(nodes, "node").select(*MEMBER), "members")
    kept = store(_grouped(members).mapInArrow(hopeful, "unit long, key long, node long"), "hopeful")
    full = shingle_sets(docs, kept.select(F.col("node").alias("doc_id")).distinct())
    chosen = members.join(kept, ["unit", "key", "node"]).join(full.withColumnRenamed("doc_id", "node"), "node")
    return _grouped(chosen.select(*MEMBER, "shingles")).mapInArrow(linked, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row.

    Two documents are linked when ``100 * |intersection| >= percent * |union|`` of their shingle
    sets; a component is everything reachable over links and carries its smallest id, whose
    document is kept. Bands and sketches are laid out for ``PERCENT`` and more; a lower ``percent`` raises. Null, empty and blank texts have no shingles and are linked with nothing.
    Rows with one id are one document, linked by any of its texts; a row without id stays alone
    with a null component and is kept. An empty table gives no rows; other columns are ignored.
    """
    if percent < PERCENT:
        raise ValueError(f"{percent} % is less than the bands are laid out for ({PERCENT} %)")
    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    signed = store(signatures(picked), "signatures")
    usable = signed.where("n_shingles > 0 and doc_id is not null")
    classes = store(usable.groupBy("digest").agg(
        F.min(F.struct("doc_id", "n_shingles", "sketch", "bands")).alias("first")).select("digest", "first.*"), "classes")
    nodes = classes.select(F.col("doc_id").alias("node"), "n_shingles", "sketch", "bands")
    keyed = classes.select(F.explode("bands").alias("key"), F.col("doc_id").alias("node")).distinct()
    shared_keys = keyed.groupBy("key").count().where("count > 1").select("key")
    members = store(keyed.join(shared_keys, "key", "left_semi"), "buckets")

    links, found = None, None
    for turn in range(NEAR_ROUNDS + 2):
        rows = store(_open_buckets(members, found), "open-buckets")
        if rows.isEmpty():
            break
        if turn == 0:
            leaders = rows.groupBy("key").agg(F.min("node").alias("leader"))
            pairs = rows.join(leaders, "key").where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
            linked = _confirm(store(_hopeful(pairs, nodes, percent), "pairs"), picked, percent)
        elif turn <= NEAR_ROUNDS:
            linked = _confirm(store(_proposals(rows, nodes, percent, turn), "pairs"), picked, percent)
        else:
            linked = _links_across(rows, nodes, picked, percent)
        linked = store(linked, "links")
        if not linked.isEmpty():
            links = linked if links is None else links.unionByName(linked)
            found = store(components(links), "components")

    classed = usable.select("doc_id", "digest").distinct().join(
        classes.select("digest", F.col("doc_id").alias("node")), "digest").select("doc_id", "node")
    same = classed.where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    # an id with several texts ties their classes together
    several = classed.groupBy("doc_id").agg(F.count_distinct("node").alias("n")).where("n > 1")
    if not several.isEmpty():
        found = store(components(same if links is None else same.unionByName(links)), "components")
        classed = classed.select("doc_id", F.col("doc_id").alias("node"))
    named = _with_component(classed, found).groupBy("doc_id").agg(F.min("component").alias("component"))
    return (
        signed.select("doc_id", "n_shingles").join(named, "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
