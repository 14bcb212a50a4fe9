"""k nearest neighbours by (distance, id), exact, without all-pairs output.

Equal vectors first collapse to one point, which keeps its k + 1 smallest ids;
no other row ever needs more of them, so a vector copied over a third of the
table costs as much as any other. Points are then assigned to the nearest of a
bounded set of pivots. A first search inside a point's own cells gives an upper
bound of its k-th distance, and a second search visits only the cells that the
triangle inequality cannot rule out. Where it rules out few of them, as among
many dimensions, neighbouring cells are searched together, so that a row is sent
to a few large regions instead of every cell. Cells are cut into blocks of bounded
size on both sides, several even in the smallest table; a block runs as matrix
products and emits k rows per query. ``probes`` limits the search to the nearest
cells instead, ``operators.lsh`` to the buckets of hash tables (both approximate).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from cohortline.functions.text import stable_hash
from cohortline.operators.replicate import lookup_join
from cohortline.session import cut_lineage, store

BLOCK_ROWS = 1024
#: Blocks of each side of a cell that is searched whole.
MIN_PARTS = 2
ROWS_PER_CELL = 2000
MAX_PIVOTS = 4096
#: Blocks grow with the table until it has about so many, then until they hold so many numbers: a row is copied into every
#: block of the other side, so blocks of a fixed number of rows would copy a table as often as it is long.
MAX_BLOCKS = 16
BLOCK_VALUES = 1 << 22
#: Distances, or copies of a vector's numbers, held at a time.
CHUNK_VALUES = 1 << 20
#: Share of the cells from which on regions are searched instead, and their number.
WIDE_SHARE = 0.25
REGIONS = 12


@dataclass(frozen=True)
class Points:
    """Distinct vectors. ``table``: (pid, scope, vec, members[(id, payload)], copies);
    pid is the smallest id of the vector inside its scope."""

    table: DataFrame
    n_points: int
    n_rows: int


def distinct_points(rows: DataFrame, k: int) -> Points:
    """``rows``: (id, scope, vec, payload). The rank filter cuts each vector to
    k + 1 rows per task before the shuffle."""
    order = W.partitionBy("scope", "vec").orderBy("id")
    members = (
        rows.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= k + 1)
        .groupBy("scope", "vec").agg(F.array_sort(F.collect_list(F.struct("id", "payload"))).alias("members"))
    )
    counts = rows.groupBy("scope", "vec").agg(F.count(F.lit(1)).alias("copies"))
    table = cut_lineage(
        members.join(counts, ["scope", "vec"]).select(
            F.get("members", F.lit(0))["id"].alias("pid"), "scope", "vec", "members", "copies"))
    size = table.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("copies"), F.lit(0)).alias("r")).first()
    return Points(table, int(size["n"]), int(size["r"]))


def _distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    squared = (left * left).sum(1)[:, None] + (right * right).sum(1)[None, :] - 2.0 * left @ right.T
    return np.sqrt(np.maximum(squared, 0.0))


def _block_neighbours(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, data_ids: np.ndarray, k: int):
    """The k nearest data rows of each query, itself excluded. The matrix product
    only preselects (with a margin above its rounding error); the order comes from
    exactly summed differences, ties by id."""
    out_q, out_d, out_dist = [], [], []
    query_squares, data_squares = (queries * queries).sum(1), (data * data).sum(1)
    margin = 1e-9 * (1.0 + query_squares.max(initial=0.0) + data_squares.max(initial=0.0))
    # equal ids get equal codes, null ids none
    codes = pd.factorize(np.concatenate([query_ids, data_ids]))[0]
    query_codes, data_codes = codes[:len(query_ids)], codes[len(query_ids):]
    by_code = np.argsort(data_codes, kind="stable")
    first, last = [np.searchsorted(data_codes[by_code], query_codes, side=side) for side in ("left", "right")]
    own = np.where(query_codes < 0, 0, last - first)
    width = 64 if len(data) >= 64 * 4 * k else 1
    n_groups = len(data) // width
    strange = np.flatnonzero(~np.isfinite(data_squares))
    step = max(16, 4 * CHUNK_VALUES // max(len(data), 1))
    for start in range(0, len(queries), step):
        part, part_ids = queries[start:start + step], query_ids[start:start + step]
        rough = part @ data.T
        rough *= -2.0
        rough += data_squares[None, :]
        rough += query_squares[start:start + step, None]
        same = np.repeat(np.arange(len(part)), own[start:start + step])
        nth = np.arange(len(same)) - np.searchsorted(same, same, side="left")
        rough[same, by_code[first[start + same] + nth]] = np.inf
        rough[:, strange] = np.inf
        # the least of a group of columns stands for it: k groups hold k rows up to the greatest of theirs
        least = rough[:, :n_groups * width].reshape(len(part), n_groups, width).min(axis=2) if width > 1 else rough
        if least.shape[1] > k:
            bound = np.partition(least, k - 1, axis=1)[:, k - 1] + 2 * margin
        else:
            bound = np.full(len(part), np.inf)
        qi, di = np.nonzero((rough <= bound[:, None]) & (rough < np.inf))
        exact = np.empty(len(qi))
        rows = max(1, CHUNK_VALUES // max(queries.shape[1], 1))
        for at in range(0, len(qi), rows):
            exact[at:at + rows] = np.sqrt(((part[qi[at:at + rows]] - data[di[at:at + rows]]) ** 2).sum(1))
        order = np.lexsort((data_ids[di], exact, qi))
        qi, di, exact = qi[order], di[order], exact[order]
        keep = np.arange(len(qi)) - np.searchsorted(qi, qi, side="left") < k
        out_q.append(part_ids[qi[keep]])
        out_d.append(data_ids[di[keep]])
        out_dist.append(exact[keep])
    return np.concatenate(out_q), np.concatenate(out_d), np.concatenate(out_dist)


def arrow_matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _id_type(df: DataFrame):
    return df.schema["pid"].dataType


def blocks(routed: DataFrame, data: DataFrame, block_rows: int = BLOCK_ROWS, min_parts: int = 1) -> tuple[DataFrame, DataFrame]:
    """Queries and data, both (pid, scope, vec, cell), with the blocks they meet in: (scope, cell, q_part,
    d_part). Each side of a cell is cut by hash into parts of about ``block_rows``, more in a large table
    (``MAX_BLOCKS``, ``BLOCK_VALUES``), so that no block grows with its cell, and every query part meets every
    data part."""
    # fresh column identities: both sides may come from the same table
    routed = routed.select(*[F.col(c).alias(c) for c in ("pid", "scope", "vec", "cell")])
    parts = store(data.groupBy("scope", "cell").agg(F.count(F.lit(1)).alias("n_data")).join(
        routed.groupBy("scope", "cell").agg(F.count(F.lit(1)).alias("n_query")), ["scope", "cell"]), "cells")
    totals = parts.agg(F.sum("n_data").alias("n_data"), F.sum("n_query").alias("n_query")).first()
    one = data.select(F.size("vec").alias("n")).first()
    most = max(block_rows, BLOCK_VALUES // max(one["n"] or 1, 1) if one else 1)

    def n_parts(n: str):
        rows = min(max(block_rows, -(-(totals[n] or 0) // MAX_BLOCKS)), most)
        return F.greatest(F.lit(min_parts), F.ceil(F.col(n) / rows)).cast("int")

    parts = parts.select("scope", "cell", n_parts("n_data").alias("d_parts"), n_parts("n_query").alias("q_parts"), "n_data", "n_query")

    def with_parts(rows: DataFrame, size: str) -> DataFrame:
        hot = parts.filter(F.col(size) * 1000 > (totals[size] or 0)).select("scope", "cell")
        return lookup_join(rows, parts.drop("n_data", "n_query"), ["scope", "cell"], hot)

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    keyed = stable_hash("pid", seed=7)
    queries = with_parts(routed, "n_query").withColumn("q_part", F.pmod(keyed, F.col("q_parts")).cast("int")).select(
        "pid", "vec", "scope", "cell", "q_part", every("d_parts").alias("d_part"))
    points = with_parts(data, "n_data").withColumn("d_part", F.pmod(keyed, F.col("d_parts")).cast("int")).select(
        "pid", "vec", "scope", "cell", "d_part", every("q_parts").alias("q_part"))
    return queries, points


def block_search(routed: DataFrame, data: DataFrame, k: int, block_rows: int = BLOCK_ROWS, min_parts: int = 1) -> DataFrame:
    """(pid, nid, dist): the k nearest data rows of each query among the cells it was routed to."""
    queries, points = blocks(routed, data, block_rows, min_parts)
    schema = StructType([StructField("pid", _id_type(data)), StructField("nid", _id_type(data)), StructField("dist", DoubleType())])
    id_type = pa.string() if isinstance(_id_type(data), StringType) else pa.int64()

    def one_block(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            found = [], [], []
        else:
            found = _block_neighbours(arrow_matrix(left["vec"]), left["pid"].to_numpy(), arrow_matrix(right["vec"]), right["pid"].to_numpy(), k)
        return pa.table([pa.array(found[0], id_type), pa.array(found[1], id_type), pa.array(found[2], pa.float64())], names=["pid", "nid", "dist"])

    keys = ["scope", "cell", "q_part", "d_part"]
    return _best(queries.groupBy(*keys).cogroup(points.groupBy(*keys)).applyInArrow(one_block, schema), k)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query; a neighbour found more than once counts once."""
    order = W.partitionBy("pid").orderBy("dist", "nid")
    return found.withColumn("_rn", F.dense_rank().over(order)).filter(F.col("_rn") <= k).drop("_rn").dropDuplicates(["pid", "nid"])


def nearest_points(points: Points, k: int, probes: int | None = None, n_pivots: int | None = None,
                   block_rows: int = BLOCK_ROWS, queries: DataFrame | None = None) -> DataFrame:
    """(pid, nid, dist): up to k nearest other points of each of the ``queries`` (pid, scope, vec), by default of
    every point, in its scope."""
    table = points.table.select("pid", "scope", "vec")
    asked = table if queries is None else queries.select("pid", "scope", "vec")
    if n_pivots is None:
        n_pivots = int(min(max(points.n_points // ROWS_PER_CELL, 1), MAX_PIVOTS))
    if n_pivots <= 1:
        return block_search(asked.withColumn("cell", F.lit(0)), table.withColumn("cell", F.lit(0)), k, block_rows, MIN_PARTS)
    # at most MAX_PIVOTS vectors, chosen by hash
    chosen = table.select("vec", stable_hash("pid", seed=11).alias("h"), "pid").orderBy("h", "pid").limit(n_pivots).collect()
    pivots = np.array([row["vec"] for row in chosen], dtype=np.float64)
    slice_rows = max(1, CHUNK_VALUES // (4 * len(pivots)))
    sent_rows = max(1, CHUNK_VALUES // pivots.shape[1])

    def slices(batches):
        """A batch's rows a few at a time, with their distances from the pivots."""
        for batch in batches:
            for start in range(0, batch.num_rows, slice_rows):
                rows = batch.slice(start, slice_rows)
                yield rows, _distances(arrow_matrix(rows.column(2)), pivots)

    def assign(batches):
        for rows, gaps in slices(batches):
            own = gaps.argmin(1)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(own.astype(np.int64)), pa.array(gaps[np.arange(len(own)), own])],
                                             names=[*rows.schema.names, "cell", "radius"])

    assigned = cut_lineage(table.mapInArrow(assign, StructType([*table.schema.fields, StructField("cell", LongType()), StructField("radius", DoubleType())])))
    # one row per (scope, cell)
    stats = assigned.groupBy("scope", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("radius").alias("radius")).collect()
    scopes: dict = {}
    for row in stats:
        n, radius = scopes.setdefault(row["scope"], (np.zeros(len(pivots), dtype=np.int64), np.zeros(len(pivots))))
        n[row["cell"]], radius[row["cell"]] = row["n"], row["radius"]
    # each region is the cells around one of the first pivots
    region = _distances(pivots, pivots[:REGIONS]).argmin(1)

    def wanted_cells(rows: pa.RecordBatch, gaps: np.ndarray, bounded: bool) -> np.ndarray:
        wanted = np.zeros(gaps.shape, dtype=bool)
        names = np.array(rows.column(1).to_pylist(), dtype=object)
        for scope in set(names.tolist()):
            at = np.flatnonzero(names == scope)
            if scope not in scopes:
                continue
            n, radius = scopes[scope]
            order = np.argsort(gaps[at], axis=1, kind="stable")
            held = np.cumsum(n[order], axis=1)
            # nearest cells until they hold enough points (or the probe limit)
            before = np.concatenate([np.zeros((len(at), 1), dtype=np.int64), held[:, :-1]], axis=1)
            near = before < 1 + k if probes is None else np.cumsum(n[order] > 0, axis=1) <= probes
            initial = np.zeros((len(at), len(n)), dtype=bool)
            np.put_along_axis(initial, order, near, axis=1)
            initial &= n[None, :] > 0
            if not bounded:
                wanted[at] = initial
            else:
                bound = rows.column(3).to_numpy(zero_copy_only=False)[at][:, None]
                low = np.maximum(gaps[at] - radius[None, :], 0.0)
                slack = 1e-7 * (1.0 + gaps[at])
                wanted[at] = (low <= bound + slack) & (n[None, :] > 0) & ~initial
        return wanted

    def route(rows: DataFrame, bounded: bool, wide: bool = False) -> DataFrame:
        """Rows once for each cell, or region with a cell, that they have to search."""
        def send(batches):
            for part, gaps in slices(batches):
                wanted = wanted_cells(part, gaps, bounded)
                if wide:
                    wanted = np.stack([wanted[:, region == r].any(axis=1) for r in range(REGIONS)], axis=1)
                qi, cell = np.nonzero(wanted)
                for start in range(0, len(qi), sent_rows):
                    sent = part.select([0, 1, 2]).take(pa.array(qi[start:start + sent_rows]))
                    yield pa.RecordBatch.from_arrays([*sent.columns, pa.array(cell[start:start + sent_rows].astype(np.int64))], names=["pid", "scope", "vec", "cell"])

        return rows.mapInArrow(send, StructType([*table.schema.fields, StructField("cell", LongType())]))

    def count(batches):
        for part, gaps in slices(batches):
            wanted = wanted_cells(part, gaps, True)
            yield pa.RecordBatch.from_arrays([pa.array([int(wanted.sum())], pa.int64()), pa.array([wanted.size], pa.int64())], names=["visits", "cells"])

    data = assigned.select("pid", "scope", "vec", "cell")
    first = cut_lineage(block_search(route(asked, False), data, k, block_rows))
    if probes is not None:
        return first
    bounds = first.groupBy("pid").agg(F.count(F.lit(1)).alias("c"), F.max("dist").alias("d")).select(
        "pid", F.when(F.col("c") >= k, F.col("d")).otherwise(F.lit(float("inf"))).alias("bound"))
    bounded = cut_lineage(asked.join(bounds, "pid", "left").select("pid", "scope", "vec", F.coalesce("bound", F.lit(float("inf"))).alias("bound")))
    visits = bounded.mapInArrow(count, "visits bigint, cells bigint").agg(F.sum("visits").alias("visits"), F.sum("cells").alias("cells")).first()
    wide = n_pivots > REGIONS and (visits["visits"] or 0) > WIDE_SHARE * (visits["cells"] or 0)
    if wide:
        to_region = F.get(F.array(*[F.lit(int(r)) for r in region]), F.col("cell").cast("int"))
        data = data.withColumn("cell", to_region.cast("bigint"))
    routed = cut_lineage(route(bounded, True, wide))
    return _best(first.unionByName(block_search(routed, data, k, block_rows)), k)


def neighbour_entries(points: Points, near: DataFrame, k: int) -> DataFrame:
    """(pid, entries): the first k + 1 (dist, id, payload) around each vector, own
    copies included, so that any of its rows finds k others among them."""
    own = points.table.select("pid", F.lit(0.0).alias("dist"), "members")
    others = near.join(points.table.select(F.col("pid").alias("nid"), "members"), "nid").select("pid", "dist", "members")
    flat = own.unionByName(others).select("pid", "dist", F.explode("members").alias("m")).select(
        "pid", F.struct("dist", F.col("m.id").alias("id"), F.col("m.payload").alias("payload")).alias("e"))
    return flat.groupBy("pid").agg(F.slice(F.array_sort(F.collect_list("e")), 1, k + 1).alias("entries"))


def row_neighbours(rows: DataFrame, k: int, probes: int | None = None, n_pivots: int | None = None,
                   block_rows: int = BLOCK_ROWS, search: Callable[[Points, int], DataFrame] | None = None) -> DataFrame:
    """Every input row with ``neighbours``: its k nearest other rows in its scope
    as (dist, id, payload), nearest first, ties by id. ``search`` replaces the exact
    search, for instance ``lsh.Projections().search``."""
    points = distinct_points(rows, k)
    near = search(points, k) if search else nearest_points(points, k, probes, n_pivots, block_rows)
    entries = cut_lineage(points.table.select("scope", "vec", "pid", "copies").join(neighbour_entries(points, near, k), "pid").drop("pid"))
    hot = entries.filter(F.col("copies") * 1000 > points.n_rows).select("scope", "vec")
    joined = lookup_join(rows, entries.drop("copies"), ["scope", "vec"], hot)
    others = F.filter("entries", lambda e: e["id"] != F.col("id"))
    return joined.withColumn("neighbours", F.slice(others, 1, k)).drop("entries")


def as_rows(df: DataFrame, id_col: str, vec_col: str, payload: str | None = None, scope: str | None = None) -> DataFrame:
    """The (id, scope, vec, payload) shape the search works on."""
    return df.select(
        F.col(id_col).alias("id"),
        (F.col(scope).cast("string") if scope else F.lit("all")).alias("scope"),
        F.col(vec_col).cast(ArrayType(DoubleType())).alias("vec"),
        (F.col(payload) if payload else F.lit(None).cast(StringType())).alias("payload"),
    )
