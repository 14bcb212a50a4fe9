"""Whitening of embeddings by shifted CholeskyQR.

Entries are put on an integer grid, so that count, sums and centring are exact. Each pass over the
rows solves the centred rows against the triangular factors found so far and adds up the Gram
matrix of the result; the Cholesky factor of that matrix, shifted in the first pass and wherever it
is not positive definite, is the next factor. The factors compose to R with ``rows = Q R``; the
singular values and right singular vectors of R are those of the rows, hence the deviations and
directions of their covariance, without the covariance ever being formed from uncentred numbers.

Tasks only hold a batch of rows and one Gram matrix; the matrices of all tasks are added up in levels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import store, sum_arrays

# The grid x = floor(GRID * c) + OFFSET, and the number of components.
GRID, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Entries beyond this do not fit the exact sums of the grid.
MAX_ENTRY = 2.0 ** 30
MAX_PASSES = 6
#: Largest entry of Gram matrix minus identity at which the rows count as orthonormal.
ORTHONORMAL = 1e-13


@dataclass(frozen=True)
class Whitening:
    """``components``: one unit column per component, by falling ``variances``."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    total_variance: float
    passes: int


def on_grid(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, x) of the usable vectors, stored: no null or non-finite entry and none beyond ``MAX_ENTRY``.
    Where lengths differ, the commonest one (the longest of equally common ones) counts, vectors
    of other lengths are unusable."""
    vector = F.col(vector_column).cast("array<double>")
    usable = F.size(vector) > 0
    usable &= F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) <= MAX_ENTRY), F.lit(False)))
    grid = rows.where(F.coalesce(usable, F.lit(False))).select(
        F.col(id_column).alias("id"), F.transform(vector, lambda c: F.floor(c * GRID) + F.lit(OFFSET).cast("long")).alias("x"))
    grid = store(grid, "grid")
    # one row per length, ordered by a top-1
    common = grid.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return grid.where(F.size("x") == (common["length"] if common else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def centre(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - sums / n``, the difference exact before the one rounding of the division."""
    return (x * n - sums[None, :]).astype(np.float64) / n


def solve(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """``rows @ inverse(factor)`` of an upper triangular factor, column by column."""
    out = rows.copy()
    for j in range(len(factor)):
        out[:, j] = (out[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def _totals(grid: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows and exact sums per dimension."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = np.concatenate([[batch.num_rows], _matrix(batch.column(0)).sum(axis=0)])
                total = part if total is None else total + part
        if total is not None:
            yield _partial(total.astype("<i8"))

    found = sum_arrays(grid.select("x").mapInArrow(add, "part int, data binary"), grid.rdd.getNumPartitions(), "<i8")
    return (0, np.zeros(0, dtype=np.int64)) if found is None else (int(found[0]), found[1:])


def _partial(value: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([value.tobytes()], pa.binary())], names=["part", "data"])


def _gram(grid: DataFrame, n: int, sums: np.ndarray, factors: list[np.ndarray], whitener: np.ndarray | None = None) -> np.ndarray:
    """Gram matrix of the centred rows behind the triangular solves, or of their whitened values.
    The last row and column hold the sums of the columns and the count."""
    shared = grid.sparkSession.sparkContext.broadcast((n, sums, factors, whitener))  # a few matrices of the dimension

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, factors, whitener = shared.value
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = centre(_matrix(batch.column(0)), n, sums)
            for factor in factors:
                rows = solve(rows, factor)
            rows = rows if whitener is None else rows @ whitener
            rows = np.concatenate([rows, np.ones((len(rows), 1))], axis=1)
            part = rows.T @ rows
            total = part if total is None else total + part
        if total is not None:
            yield _partial(total)

    width = (len(sums) if whitener is None else whitener.shape[1]) + 1
    found = sum_arrays(grid.select("x").mapInArrow(add, "part int, data binary"), grid.rdd.getNumPartitions(), "<f8")
    shared.unpersist()
    return found.reshape(width, width)


def factor_of(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper Cholesky factor; a shift that does not make ``gram`` positive definite grows until it does."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, len(gram) * np.finfo(float).eps * max(np.trace(gram), 1.0))


def fit(grid: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Components of all rows of ``grid``. Directions without variance have none, so a table of
    fewer than two different rows has no component at all."""
    n, sums = _totals(grid)
    d = len(sums)
    composed, factors, passes = np.eye(d), [], 0
    gram = np.zeros((d, d))
    while n and passes < MAX_PASSES:
        gram = _gram(grid, n, sums, factors)[:d, :d]
        passes += 1
        scale = np.trace(gram)
        if scale == 0 or np.abs(gram - np.eye(d)).max() <= ORTHONORMAL:
            break
        shift = 11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2 * scale if passes == 1 else 0.0
        if passes < MAX_PASSES:
            factor = factor_of(gram, min(shift, scale / d))
            factors.append(factor)
            composed = factor @ composed
    # what the passes left short of orthonormal (directions without variance) is one more factor
    weights, vectors = np.linalg.eigh(gram)
    last = np.sqrt(np.maximum(weights, 0.0))[:, None] * vectors.T @ composed
    _, singular, directions = np.linalg.svd(last)
    variances = singular ** 2 / max(n, 1)
    real = variances > d * np.finfo(float).eps * 16 * max(variances.max(initial=0.0), 1e-300)
    kept = int(min(real.sum(), components))
    return Whitening(n, sums, directions[:kept].T.copy(), variances[:kept], float(variances.sum()), passes)


def whitener_of(model: Whitening) -> np.ndarray:
    return model.components / np.sqrt(model.variances)[None, :]


def identity_error(grid: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured over all rows."""
    k = len(model.variances)
    if not k:
        return 0.0
    gram = _gram(grid, model.n, model.sums, [], whitener_of(model))
    mean = gram[:k, k] / model.n
    return float(np.abs(gram[:k, :k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Exact sums of (n * x - sums) ** 2; null where a sum does not fit a long."""
    rough = ((x.astype(np.float64) * n - sums[None, :]) ** 2).sum(axis=1).max(initial=0.0)
    if rough < 2.0 ** 62:
        return pa.array(((x * n - sums[None, :]) ** 2).sum(axis=1), pa.int64())
    exact = [sum((int(v) * n - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
    return pa.array([v if v < 2 ** 63 else None for v in exact], pa.int64())


def whiten(grid: DataFrame, model: Whitening) -> DataFrame:
    """(id, deviation, whitened) of every row of ``grid``; ``whitened`` has a value per component."""
    shared = grid.sparkSession.sparkContext.broadcast((model.n, model.sums, whitener_of(model)))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, whitener = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            values = centre(x, n, sums) @ whitener
            ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _deviations(x, n, sums), pa.ListArray.from_arrays(ends, values.ravel())], names=["id", "deviation", "whitened"])

    id_type = grid.schema["id"].dataType.simpleString()
    return grid.select("id", "x").mapInArrow(apply, f"id {id_type}, deviation bigint, whitened array<double>")


def whitened_rows(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: id, component (from 1), n, deviation, whitened,
    explained, identity_error.

    Null vectors and those with null or non-finite entries are left out (see ``on_grid``), repeated
    rows and ids count each, an empty table gives no rows, other columns are ignored. Equal
    eigenvalues leave the choice of directions among them open."""
    grid = on_grid(rows, id_column, vector_column)
    model = fit(grid, components)
    explained = [float(v / model.total_variance) for v in model.variances]
    out = whiten(grid, model).select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(
        F.col("id").alias(id_column), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.array(*[F.lit(e) for e in explained]).cast("array<double>")[F.col("at")].alias("explained"),
        F.lit(identity_error(grid, model)).alias("identity_error"))
