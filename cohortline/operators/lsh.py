"""Approximate k nearest neighbours: hash tables of random projections, several buckets of each probed.

A table's code of a vector is the signs of its projections on a few orthonormal directions. A query
looks into its own bucket and into those that differ in the signs it is least sure of, in the order
in which such buckets are expected to hold neighbours. How many buckets is not guessed: the exact
neighbours of a bounded sample of queries are found against all rows, and the least number that finds
enough of them is taken, with fewer directions, and in the end a single bucket, where none does.

Where a table has more rows than signs of as many directions as dimensions can tell apart, further directions cut it at
places drawn from the sample, and of all lengths of code the one with the least estimated work is taken.

Every row is indexed. A scope (class) has as many directions as its own size calls for, so that small
classes are searched whole. Buckets are cut into blocks of bounded size on both sides, a hot bucket
into many, and no bucket or candidate list is capped. Queries that met fewer than k other points
are searched again, exactly.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cohortline.functions.text import stable_hash
from cohortline.operators.knn import BLOCK_ROWS, CHUNK_VALUES, MIN_PARTS, Points, _best, arrow_matrix, block_search
from cohortline.session import cut_lineage

#: Scopes (classes) an index can tell apart; one number of each is broadcast.
MAX_SCOPES = 10_000
#: Signs of a code, at most, and how many rows compared cost as much as one more bucket to look into.
MAX_BITS, PROBE_ROWS = 24, 2_048


@lru_cache(maxsize=64)
def likely_flips(bits: int, probes: int) -> np.ndarray:
    """(probes, bits) 0/1: which of the signs, from the least to the most certain, differ in each bucket to
    probe. Buckets come in the order of the squared distance a query of the expected certainties is away."""
    gaps = [NormalDist().inv_cdf(0.5 + (j + 1) / (2 * (bits + 1))) ** 2 for j in range(bits)]
    out, heap = [()], [(gaps[0], (0,))] if bits else []
    while heap and len(out) < probes:
        total, flipped = heapq.heappop(heap)
        out.append(flipped)
        last = flipped[-1]
        if last + 1 < bits:
            heapq.heappush(heap, (total + gaps[last + 1], (*flipped, last + 1)))
            heapq.heappush(heap, (total - gaps[last] + gaps[last + 1], (*flipped[:-1], last + 1)))
    table = np.zeros((len(out), bits), dtype=np.int64)
    for row, flipped in zip(table, out):
        row[list(flipped)] = 1
    return table


def bucket_codes(vectors: np.ndarray, centre: np.ndarray, planes: np.ndarray, flips: np.ndarray, cuts: np.ndarray | float = 0.0) -> np.ndarray:
    """(rows, probes): codes of the buckets to look into, a row's own one first."""
    bits = planes.shape[1]
    shown = (vectors - centre) @ planes - cuts
    own = (shown > 0) @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(len(vectors), dtype=np.int64)
    sure = np.argsort(np.abs(shown), axis=1, kind="stable")
    return own[:, None] ^ ((1 << sure.astype(np.int64)) @ flips.T)


@dataclass(frozen=True)
class Index:
    """``planes``: (tables, dimensions, bits); ``recall``: share of the sample's neighbours that ``probes`` find; ``cuts``:
    (tables, bits), where each direction is cut, by default at the centre."""

    planes: np.ndarray
    centre: np.ndarray
    probes: int
    bits_of: dict[str, int]
    recall: float
    cuts: np.ndarray | None = None

    def route(self, rows: DataFrame, probing: bool) -> DataFrame:
        """(pid, scope, vec, cell): each row once per table, or with ``probing`` once per bucket to look into."""
        schema = StructType([*rows.schema.fields, StructField("cell", LongType())])
        planes, centre, bits_of, probes = self.planes, self.centre, self.bits_of, self.probes if probing else 1
        cuts = np.zeros((planes.shape[0], planes.shape[2])) if self.cuts is None else self.cuts
        flips = {bits: likely_flips(bits, probes) for bits in set(bits_of.values())}

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bits = np.array([bits_of[scope] for scope in batch.column(1).to_pylist()], dtype=np.int64)
                for b in np.unique(bits):
                    rows = np.flatnonzero(bits == b)
                    # what is sent is many times the batch, so a few rows at a time
                    step = max(1, CHUNK_VALUES // (len(flips[b]) * max(len(centre), 1)))
                    for start in range(0, len(rows), step):
                        part = batch.take(pa.array(rows[start:start + step]))
                        vectors = arrow_matrix(part.column(2))
                        for t in range(len(planes)):
                            codes = bucket_codes(vectors, centre, planes[t][:, :b], flips[b], cuts[t, :b])
                            at = np.repeat(np.arange(len(vectors)), codes.shape[1])
                            sent = part.take(pa.array(at))
                            yield pa.RecordBatch.from_arrays([*sent.columns, pa.array(codes.ravel() * len(planes) + t)], schema=to_arrow(sent.schema))

        def to_arrow(kinds: pa.Schema) -> pa.Schema:
            return kinds.append(pa.field("cell", pa.int64()))

        return rows.mapInArrow(send, schema)


def nearest_of_sample(table: DataFrame, sample: list, k: int) -> dict:
    """pid -> vectors of its k exact neighbours in its scope, over all rows, for a bounded list of rows."""
    ids = [r["pid"] for r in sample]
    scopes = [r["scope"] for r in sample]
    vectors = np.array([r["vec"] for r in sample], dtype=np.float64)
    text = isinstance(table.schema["pid"].dataType, StringType)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in ids]
        for batch in batches:
            if not batch.num_rows:
                continue
            data = arrow_matrix(batch.column(2))
            names, of = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), dtype=object)
            gaps = ((vectors ** 2).sum(1)[:, None] + (data ** 2).sum(1)[None, :]) - 2 * vectors @ data.T
            for q in range(len(ids)):
                allowed = np.flatnonzero(of == scopes[q])
                near = allowed[np.argpartition(gaps[q, allowed], min(k, len(allowed) - 1))[:k + 1]] if len(allowed) else allowed
                found = [(float(((vectors[q] - data[i]) ** 2).sum()), names[i], data[i]) for i in near if names[i] != ids[q]]
                best[q] = sorted(best[q] + found, key=lambda e: e[:2])[:k]
        rows = [(q, dist, name, vec) for q, entries in enumerate(best) for dist, name, vec in entries]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.float64()),
             pa.array([r[2] for r in rows], pa.string() if text else pa.int64()), pa.array([r[3] for r in rows], pa.list_(pa.float64()))],
            names=["q", "dist", "nid", "vec"])

    schema = f"q int, dist double, nid {'string' if text else 'bigint'}, vec array<double>"
    best = table.mapInArrow(search, schema).groupBy("q").agg(F.slice(F.array_sort(F.collect_list(F.struct("dist", "nid", "vec"))), 1, k).alias("near"))
    # at most k vectors for each row of the sample
    found = {r["q"]: [e["vec"] for e in r["near"]] for r in best.collect()}
    return {ids[q]: np.array(found.get(q, []), dtype=np.float64).reshape(-1, vectors.shape[1]) for q in range(len(ids))}


@dataclass(frozen=True)
class Projections:
    """Settings of an index. ``recall`` is what the sample must reach, ``slack`` what is added for the sample's error;
    ``bucket_rows`` is the wished size of a bucket, ``sample_rows`` the bound of the sample."""

    recall: float = 0.95
    slack: float = 0.02
    tables: int = 4
    bucket_rows: int = 1024
    max_probes: int = 256
    sample_rows: int = 256
    block_rows: int = BLOCK_ROWS
    seed: int = 42

    def fit(self, points: Points, k: int) -> Index:
        """The index of all points; its recall is measured against the exact neighbours of the sample."""
        table = points.table.select("pid", "scope", "vec")
        sizes = table.groupBy("scope").agg(F.count(F.lit(1)).alias("n")).limit(MAX_SCOPES + 1).collect()
        if len(sizes) > MAX_SCOPES:
            raise ValueError(f"more than {MAX_SCOPES} scopes")
        sample = table.select("*", stable_hash("pid", seed=self.seed).alias("h")).orderBy("h", "pid").limit(self.sample_rows).collect()
        if not sample:
            return Index(np.zeros((1, 1, 0)), np.zeros(1), 1, {}, 1.0)
        truth = nearest_of_sample(table, sample, k)
        vectors = np.array([r["vec"] for r in sample], dtype=np.float64)
        centre, dims = vectors.mean(axis=0), vectors.shape[1]
        draws = np.random.default_rng(self.seed)
        whole = min(MAX_BITS, max(0, int(np.log2(max(points.n_points / self.bucket_rows, 1)))))
        most = min(dims, whole)
        planes = np.array([np.linalg.qr(draws.normal(size=(dims, dims)))[0] for _ in range(self.tables)])
        n_of = {r["scope"]: r["n"] for r in sizes}
        if whole > dims:
            found = self._long_codes(planes, centre, vectors, sample, truth, n_of, whole, draws)
            if found:
                return found
        for bits in range(most, 0, -1):
            bits_of = {s: min(bits, max(0, int(np.log2(max(n / self.bucket_rows, 1))))) for s, n in n_of.items()}
            places = np.concatenate([self._places(planes, centre, bits_of[r["scope"]], v, truth[r["pid"]]) for r, v in zip(sample, vectors)])
            if not len(places):
                break
            order = np.sort(places)
            probes = int(order[min(len(order) - 1, int(np.ceil((self.recall + self.slack) * len(order))) - 1)]) + 1
            # looking into more than half of all buckets is no better than looking everywhere
            if probes <= self.max_probes and probes * self.tables * 2 <= 1 << bits:
                return Index(planes[:, :, :bits], centre, probes, bits_of, float((places < probes).mean()))
        return Index(planes[:1, :, :0], centre, 1, dict.fromkeys(n_of, 0), 1.0)

    def _long_codes(self, planes: np.ndarray, centre: np.ndarray, vectors: np.ndarray, sample: list, truth: dict, n_of: dict, whole: int,
                    draws: np.random.Generator) -> Index | None:
        """The index of the least estimated work among codes of more signs than dimensions; none where no code does."""
        dims, n_points = len(centre), max(n_of.values())
        more = [np.concatenate([np.linalg.qr(draws.normal(size=(dims, dims)))[0] for _ in range(-(-(whole - dims) // dims))], axis=1) for _ in planes]
        planes = np.concatenate([planes, np.array(more)], axis=2)[:, :, :whole]
        cuts = np.zeros((len(planes), whole))
        for t in range(len(planes)):
            drawn = vectors[draws.integers(0, len(vectors), whole - dims)] - centre
            cuts[t, dims:] = (drawn * planes[t][:, dims:].T).sum(axis=1)
        best, least = None, np.inf
        for bits in range(dims + 1, whole + 1):
            bits_of = {s: min(bits, max(0, int(np.log2(max(n / self.bucket_rows, 1))))) for s, n in n_of.items()}
            places = np.concatenate([self._places(planes, centre, bits_of[r["scope"]], v, truth[r["pid"]], cuts) for r, v in zip(sample, vectors)])
            if not len(places):
                return None
            order = np.sort(places)
            probes = int(order[min(len(order) - 1, int(np.ceil((self.recall + self.slack) * len(order))) - 1)]) + 1
            if probes > self.max_probes or probes * self.tables * 2 > 1 << bits:
                continue
            # rows looked at: the share of the sample in the buckets of one of it, at least what even buckets would hold
            flips, met = likely_flips(bits, probes), 0
            for t in range(len(planes)):
                looked = bucket_codes(vectors, centre, planes[t][:, :bits], flips, cuts[t, :bits])
                met += sum(int(np.isin(looked[:, 0], codes).sum()) - 1 for codes in looked)
            share = max(met / (len(planes) * len(vectors) * max(len(vectors) - 1, 1)), probes / (1 << bits))
            work = n_points * share + probes * PROBE_ROWS
            if work < least:
                best, least = Index(planes[:, :, :bits], centre, probes, bits_of, float((places < probes).mean()), cuts[:, :bits]), work
        return best

    def _places(self, planes: np.ndarray, centre: np.ndarray, bits: int, query: np.ndarray, near: np.ndarray, cuts: np.ndarray | None = None) -> np.ndarray:
        """In which probe each neighbour is first met, over all tables."""
        flips = likely_flips(bits, self.max_probes)
        met = np.full(len(near), self.max_probes + 1)
        for t in range(self.tables):
            cut = 0.0 if cuts is None else cuts[t, :bits]
            looked = bucket_codes(query[None, :], centre, planes[t][:, :bits], flips, cut)[0]
            held = bucket_codes(near, centre, planes[t][:, :bits], flips[:1], cut)[:, 0] if len(near) else np.zeros(0, dtype=np.int64)
            place = {code: i for i, code in reversed(list(enumerate(looked.tolist())))}
            met = np.minimum(met, [place.get(code, self.max_probes + 1) for code in held.tolist()]) if len(near) else met
        return met

    def search(self, points: Points, k: int, queries: DataFrame | None = None) -> DataFrame:
        """(pid, nid, dist): up to k near other points of each query in its scope, by default of every point."""
        table = points.table.select("pid", "scope", "vec")
        return self.search_with(self.fit(points, k), table, k, queries)

    def search_with(self, index: Index, table: DataFrame, k: int, queries: DataFrame | None = None) -> DataFrame:
        asked = table if queries is None else queries.select("pid", "scope", "vec").join(table.select("scope").distinct(), "scope", "left_semi").select(
            "pid", "scope", "vec")
        whole = all(bits == 0 for bits in index.bits_of.values())
        found = cut_lineage(block_search(
            index.route(asked, True), index.route(table, False), k, self.block_rows, MIN_PARTS if whole else 1))
        if whole:
            return found
        met = found.groupBy("pid").agg(F.count(F.lit(1)).alias("n"))
        few = asked.join(met, "pid", "left").filter(F.coalesce("n", F.lit(0)) < k).select("pid", "scope", "vec")
        # what small scopes lack is no shortage: their one bucket held everything
        few = few.filter(F.col("scope").isin([s for s, bits in index.bits_of.items() if bits]) if any(index.bits_of.values()) else F.lit(False))
        again = block_search(few.withColumn("cell", F.lit(0)), table.withColumn("cell", F.lit(0)), k, self.block_rows)
        return _best(found.unionByName(again), k)
