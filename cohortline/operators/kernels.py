"""Feature maps whose inner products approximate a kernel, so that linear machines stand in for kernel ones.

A map is a small fixed object: settings and at most a few thousand landmark rows. It is applied to Arrow batches
of a vector column, without a shuffle; how close its products come to the kernel is measured by ``kernel_errors``."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most landmarks a map may have; their kernel matrix is decomposed on the driver.
MAX_LANDMARKS = 2_048
HASH_RANGE = 2 ** 32


def rbf(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    """exp(-gamma |x - y|^2) of all rows of ``a`` with all rows of ``b``."""
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    return np.exp(-gamma * np.maximum(squares, 0.0))


@dataclass(frozen=True)
class Fourier:
    """Random Fourier features of the RBF kernel: a seeded projection, whatever the data."""

    n_inputs: int
    n_components: int = 256
    gamma: float = 0.05
    seed: int = 42

    def apply(self, block: np.ndarray) -> np.ndarray:
        draws = np.random.default_rng(self.seed)
        weights = draws.normal(0.0, math.sqrt(2.0 * self.gamma), (self.n_inputs, self.n_components))
        offsets = draws.uniform(0.0, 2.0 * math.pi, self.n_components)
        return math.sqrt(2.0 / self.n_components) * np.cos(block @ weights + offsets)


@dataclass(frozen=True)
class Landmarks:
    """Nystroem features of the RBF kernel: kernel values with the landmark rows, whitened by the landmarks' own
    kernel matrix. Products are exact between landmarks; directions without weight in that matrix are left out."""

    points: np.ndarray
    gamma: float = 0.05
    whiten: np.ndarray = field(init=False, repr=False)

    def __post_init__(self):
        values, vectors = np.linalg.eigh(rbf(self.points, self.points, self.gamma))
        used = values > max(values.max(initial=0.0), 0.0) * len(values) * np.finfo(float).eps
        object.__setattr__(self, "whiten", vectors[:, used] / np.sqrt(values[used]))

    @property
    def n_inputs(self) -> int:
        return self.points.shape[1]

    def apply(self, block: np.ndarray) -> np.ndarray:
        return rbf(block, self.points, self.gamma) @ self.whiten


@dataclass(frozen=True)
class TensorSketch:
    """Sketch of the polynomial kernel ``(gamma x.y)^degree``, without a constant: one count sketch per factor,
    multiplied in the frequency domain. Its width does not grow with inputs^degree, as an expansion does."""

    n_inputs: int
    n_components: int = 1_024
    degree: int = 3
    gamma: float = 0.1
    seed: int = 42

    def draws(self, factor: int) -> tuple[np.ndarray, np.ndarray]:
        """Place and sign of each input in one factor's count sketch: the first eight hex digits of
        ``md5(seed:factor:input)`` modulo the width, and whether the ninth is below eight."""
        digests = [hashlib.md5(f"{self.seed}:{factor}:{i}".encode()).hexdigest() for i in range(self.n_inputs)]
        place = np.array([int(d[:8], 16) % self.n_components for d in digests], dtype=np.int64)
        return place, np.array([1.0 if int(d[8], 16) < 8 else -1.0 for d in digests])

    def apply(self, block: np.ndarray) -> np.ndarray:
        product = np.ones((len(block), self.n_components // 2 + 1), dtype=np.complex128)
        reached = np.arange(self.n_components) == 0
        for factor in range(self.degree):
            place, sign = self.draws(factor)
            sketch = np.zeros((len(block), self.n_components))
            for i in range(self.n_inputs):
                sketch[:, place[i]] += sign[i] * math.sqrt(self.gamma) * block[:, i]
            product *= np.fft.rfft(sketch, axis=1)
            reached = np.logical_or.reduce([np.roll(reached, at) for at in set(place.tolist())])
        # a place no product falls on is exactly zero: what the transform leaves there would be scaled up as a feature
        return np.fft.irfft(product, self.n_components, axis=1) * reached


def lifted(values: Column, kernel_map, chunk: int = 1_024) -> Column:
    """The map of an array column. A null array and one with null or non-finite entries give null; an array of another
    length raises. Mapped rows are many times wider than their inputs, so each chunk leaves before the next is mapped."""

    @F.arrow_udf("array<double>")
    def lift(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for start in range(0, len(batch), chunk):
                rows = batch.slice(start, chunk)
                present = np.flatnonzero(rows.is_valid().to_numpy(zero_copy_only=False))
                found = rows.take(pa.array(present, pa.int64()))
                for length in found.value_lengths().unique().to_pylist():
                    if length != kernel_map.n_inputs:
                        raise ValueError(f"vectors of {length} entries, the map takes {kernel_map.n_inputs}")
                block = found.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(found), kernel_map.n_inputs)
                usable = np.isfinite(block).all(axis=1)
                mapped = kernel_map.apply(block[usable])
                holds = np.zeros(len(rows), dtype=bool)
                holds[present[usable]] = True
                places = np.concatenate([[0], np.cumsum(holds) * mapped.shape[1]]).astype(np.int32)
                yield pa.ListArray.from_arrays(pa.array(places), pa.array(np.ascontiguousarray(mapped).ravel()), mask=pa.array(~holds))

    return lift(values)


def map_features(df: DataFrame, kernel_map, col: str = "features") -> DataFrame:
    """``df`` with its vector column replaced by the mapped one."""
    return df.withColumn(col, array_to_vector(lifted(vector_to_array(col), kernel_map)))


def choose_landmarks(df: DataFrame, vec: str, n_landmarks: int = 256, seed: int = 42) -> np.ndarray:
    """At most ``n_landmarks`` different vectors of an array column, those of the smallest hashes of their values, in
    hash order: the same under any partitioning, and copies of a row never take a second place.

    Null vectors and those with null or non-finite entries are no landmarks; no usable row raises. Only rows below a
    hash cut-off are grouped; the cut-off is raised until there are enough of them."""
    if not 0 < n_landmarks <= MAX_LANDMARKS:
        raise ValueError(f"between 1 and {MAX_LANDMARKS} landmarks, not {n_landmarks}")
    value = F.col(vec).cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    text = F.concat_ws(",", F.lit(str(seed)), F.transform(value, lambda x: x.cast("string")))
    hashed = df.filter(F.col(vec).isNotNull() & finite).select(
        value.alias("v"), F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint").alias("h"))
    n_rows = hashed.count()
    if not n_rows:
        raise ValueError(f"{vec}: no usable vector")
    limit = min(HASH_RANGE, max(1, HASH_RANGE * 4 * n_landmarks // n_rows))
    while True:
        # at most n_landmarks rows
        found = hashed.filter(F.col("h") < limit).distinct().orderBy("h", "v").limit(n_landmarks).collect()
        if len(found) == n_landmarks or limit >= HASH_RANGE:
            break
        limit = min(HASH_RANGE, limit * 16)
    return np.array([row["v"] for row in found], dtype=np.float64)


def products(left: Column, right: Column, maps: Sequence, chunk: int = 1_024) -> Column:
    """Products of two mapped array columns, one per map. The mapped rows of a chunk are all that is held. Null where either
    array is null or has null or non-finite entries."""

    @F.pandas_udf("array<double>")
    def multiply(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            out = pd.Series([None] * len(a), dtype=object)
            present = np.flatnonzero((a.notna() & b.notna()).to_numpy())
            for start in range(0, len(present), chunk):
                rows = present[start:start + chunk]
                x, y = [np.array([np.asarray(side.iloc[i], dtype=np.float64) for i in rows]).reshape(len(rows), -1) for side in (a, b)]
                usable = np.isfinite(x).all(axis=1) & np.isfinite(y).all(axis=1)
                found = np.stack([(m.apply(x[usable]) * m.apply(y[usable])).sum(axis=1) for m in maps], axis=1)
                for i, row in zip(rows[usable], found):
                    out.iloc[i] = row
            yield out

    return multiply(left, right)


def kernel_errors(pairs: DataFrame, maps: dict[str, object], left: str, right: str, exact: dict[str, Column],
                  keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., map, exact, estimate) for each pair of arrays and each map: the kernel as ``exact`` states it, and the
    product of the mapped vectors."""
    mapped = pairs.select(*keep, F.array(*[exact[name] for name in maps]).alias("_exact"),
                          products(F.col(left), F.col(right), list(maps.values())).alias("_estimate"))
    return mapped.select(*keep, F.inline(F.array(*[
        F.struct(F.lit(name).alias("map"), F.get("_exact", F.lit(i)).alias("exact"), F.get("_estimate", F.lit(i)).alias("estimate"))
        for i, name in enumerate(maps)])))
