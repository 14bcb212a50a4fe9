"""Linear machines of several classes over the polynomial expansion of their inputs, fitted side by side: rows are expanded
a few at a time, and one pass over them serves the machines of all classes.

Each machine is the library's: hinge loss with class weights, centred and scaled features, a ridge on the unscaled
coefficients, and the steps of the library's quasi-Newton search, which ask for one loss and gradient after the other. The
hinge is not smooth and the steps depend on signs of numbers near zero, so rounding alone leads to other last points."""

from __future__ import annotations

import math
from collections.abc import Generator, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Numbers of expanded rows at a time.
BLOCK_VALUES = 1 << 20
#: Steps kept by the search, trial steps of a line search, values that tell convergence.
MEMORY, TRIALS, VALUES = 10, 20, 20


def n_monomials(n_inputs: int, degree: int) -> int:
    return math.comb(n_inputs + degree, degree) - 1


def expanded(x: np.ndarray, degree: int) -> np.ndarray:
    """(monomials, rows) of degree 1 to ``degree``; those of a degree follow each other by their first input."""
    n = x.shape[1]
    out = np.empty((n_monomials(n, degree), len(x)))
    out[:n] = x.T
    # where the monomials of the last degree with a first input of at least i begin
    begins, start, end, at = np.arange(n), 0, n, n
    for _ in range(degree - 1):
        new = []
        for i in range(n):
            new.append(at)
            size = end - start - begins[i]
            np.multiply(out[start + begins[i]:end], out[i], out=out[at:at + size])
            at += size
        start, end = end, at
        begins = np.array(new) - start
    return out


def _blocks(batch: pa.RecordBatch, scale: float, degree: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(monomials, labels) of some rows at a time."""
    if not batch.num_rows:
        return
    values = batch.column(0)
    flat = values.flatten().to_numpy(zero_copy_only=False)
    if values.null_count or len(flat) % len(values) or (np.diff(values.offsets.to_numpy()) * len(values) != len(flat)).any() or not np.isfinite(flat).all():
        raise ValueError("every row needs a vector of finite features, all of one length")
    x, labels = flat.reshape(len(values), -1) * scale, batch.column(1).to_numpy(zero_copy_only=False)
    if np.isnan(labels).any():
        raise ValueError("every row needs a label")
    step = max(1, BLOCK_VALUES // max(n_monomials(x.shape[1], degree), 1))
    for at in range(0, len(x), step):
        yield expanded(x[at:at + step], degree), labels[at:at + step]


@dataclass(frozen=True)
class Machine:
    """A row's decision value is its expansion times ``coefficients`` plus ``intercept``."""

    coefficients: np.ndarray
    intercept: float


def _summed(rows: DataFrame, scale: float, degree: int, function) -> np.ndarray:
    """``function(monomials, labels)``, an array, summed over all rows: one array leaves a partition."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for z, labels in _blocks(batch, scale, degree):
                one = function(z, labels)
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(total).tobytes()], pa.binary())], names=["sums"])

    found = rows.mapInArrow(add, "sums binary").toArrow().column(0)
    return sum(np.frombuffer(one.as_buffer(), np.float64) for one in found)


def _search(n: int, max_iter: int, tolerance: float) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """The library's quasi-Newton search from zero: yields points, is sent their loss and gradient, returns the last point.
    Coordinates stay on their side of zero within a step."""
    x = np.zeros(n)
    value, grad = yield x
    first, steps, changes, seen, failed, done = value, [], [], [value], False, 0
    while True:
        if done >= max_iter or np.linalg.norm(grad) <= max(tolerance * abs(value), 1e-8):
            return x
        if len(seen) >= 2 and abs(value - seen[0]) <= tolerance * abs(first) and len(seen) == VALUES:
            return x
        direction, ok = grad.copy(), True
        if steps:
            against = [s @ y for s, y in zip(steps, changes)]
            ok = against[0] >= 0
            shares = []
            for s, y, sy in zip(steps, changes, against):
                with np.errstate(divide="ignore", invalid="ignore"):
                    shares.append((s @ direction) / sy)
                direction -= shares[-1] * y
            direction *= against[0] / (changes[0] @ changes[0])
            for s, y, sy, share in reversed(list(zip(steps, changes, against, shares))):
                direction += (share - (y @ direction) / sy) * s
            ok = ok and np.isfinite(direction).all()
        if ok:
            direction = -direction
            direction[direction * grad >= 0] = 0.0
            side = np.where(x != 0, np.sign(x), np.sign(-grad))

            def stepped(length):
                to = x + direction * length
                return np.where(np.sign(to) == side, to, 0.0)

            # the library's line search starts with the loss of no step at all, so its first length is always shrunk
            shrink = 0.1 if done == 0 else 0.5
            slope, length = grad @ direction, shrink * (0.5 / np.linalg.norm(grad) if done == 0 else 1.0)
            new_value, new_grad = yield stepped(length)
            for trial in range(1, TRIALS):
                along = new_grad @ direction
                if new_value > value + length * slope * 1e-4:
                    factor = shrink
                elif along < 0.9 * slope:
                    factor = 2.1
                elif along > -0.9 * slope:
                    factor = shrink
                else:
                    break
                if trial + 1 >= TRIALS:
                    break
                if not 1e-10 <= length * factor <= 1e10:
                    ok = False
                    break
                length *= factor
                new_value, new_grad = yield stepped(length)
        if not ok:
            # history is forgotten once; a second failure ends the search
            if failed:
                return x
            failed, steps, changes = True, [], []
            continue
        failed = False
        to = stepped(length)
        steps, changes = [to - x, *steps][:MEMORY], [new_grad - grad, *changes][:MEMORY]
        x, value, grad, done = to, new_value, new_grad, done + 1
        seen = [*seen, value][-VALUES:]


def fit_machines(rows: DataFrame, classes: Sequence[int], scale: float, degree: int, reg: float, max_iter: int, tolerance: float = 1e-6) -> dict[int, Machine]:
    """A machine for each class against the rest. ``rows``: (features vector, label)."""
    spark = rows.sparkSession
    shaped = rows.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("label"))
    first = shaped.first()
    if first is None or first["x"] is None:
        raise ValueError("no row, or one without features")
    width, keys = n_monomials(len(first["x"]), degree), np.array(classes, dtype=np.float64)

    def marks(labels):
        """(rows, classes + 1): whether a row is of each class, and one."""
        return np.concatenate([labels[:, None] == keys, np.ones((len(labels), 1))], axis=1).astype(np.float64)

    # sums and centred squares of all rows and those of each class, from which every weighting follows
    found = _summed(shaped, scale, degree, lambda z, labels: np.concatenate([(z @ marks(labels)).ravel(), marks(labels).sum(axis=0)]))
    n_of, sums = found[width * (len(keys) + 1):], found[:width * (len(keys) + 1)].reshape(width, -1)
    n_all, centre = n_of[-1], sums[:, -1] / n_of[-1]
    sent = spark.sparkContext.broadcast(centre)
    squares = _summed(shaped, scale, degree, lambda z, labels: ((z - sent.value[:, None]) ** 2 @ marks(labels)).ravel()).reshape(width, -1)
    sent.destroy()
    weights, means, spreads, whole = [], [], [], []
    for c in range(len(keys)):
        n_in, n_out = n_of[c], n_all - n_of[c]
        kinds = (n_in > 0) + (n_out > 0)
        inside, outside = (n_all / (kinds * n) if n else 0.0 for n in (n_in, n_out))
        total = inside * n_in + outside * n_out
        mean = (inside * sums[:, c] + outside * (sums[:, -1] - sums[:, c])) / total
        spread = inside * squares[:, c] + outside * (squares[:, -1] - squares[:, c]) - total * (mean - centre) ** 2
        spread = np.maximum(spread, 0.0) / (total - (inside ** 2 * n_in + outside ** 2 * n_out) / total)
        weights.append((inside, outside))
        means.append(mean)
        spreads.append(np.sqrt(spread))
        whole.append(total)
    inverse = [np.divide(1.0, s, out=np.zeros_like(s), where=s > 0) for s in spreads]

    def losses(points: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
        asked = sorted(points)
        plain = np.stack([points[c][:-1] * inverse[c] for c in asked])
        offsets = np.array([points[c][-1] for c in asked]) - np.array([p @ means[c] for p, c in zip(plain, asked)])
        held = spark.sparkContext.broadcast((plain, offsets, keys[asked], np.array([weights[c] for c in asked])))

        def one(z, labels):
            plain, offsets, keys, weights = held.value
            inside = labels == keys[:, None]
            sign, weight = np.where(inside, 1.0, -1.0), np.where(inside, weights[:, :1], weights[:, 1:])
            short = 1.0 - sign * (plain @ z + offsets[:, None])
            pull = np.where(short > 0, -sign * weight, 0.0)
            return np.concatenate([(z @ pull.T).ravel(), pull.sum(axis=1), (np.maximum(short, 0.0) * weight).sum(axis=1)])

        got = _summed(shaped, scale, degree, one)
        held.destroy()
        k = len(asked)
        pulls, ends, sums_of = got[:width * k].reshape(width, k), got[width * k:width * k + k], got[width * k + k:]
        out = {}
        for i, c in enumerate(asked):
            ridge = reg * points[c][:-1] * inverse[c] ** 2
            grad = (pulls[:, i] - means[c] * ends[i]) * inverse[c] / whole[c] + ridge
            out[c] = sums_of[i] / whole[c] + 0.5 * points[c][:-1] @ ridge, np.append(grad, ends[i] / whole[c])
        return out

    searches = {c: _search(width + 1, max_iter, tolerance) for c in range(len(keys))}
    points, ended = {c: next(search) for c, search in searches.items()}, {}
    while points:
        for c, told in losses(points).items():
            try:
                points[c] = searches[c].send(told)
            except StopIteration as last:
                ended[c] = last.value
                del points[c]
    machines = {}
    for c, cls in enumerate(classes):
        plain = ended[c][:-1] * inverse[c]
        machines[cls] = Machine(plain, float(ended[c][-1] - plain @ means[c]))
    return machines


def margins(features: Column, machines: dict[int, Machine], scale: float, degree: int, spark) -> Column:
    """The decision value of each machine, as an array."""
    held = spark.sparkContext.broadcast((np.stack([m.coefficients for m in machines.values()]), np.array([m.intercept for m in machines.values()])))
    n = len(machines)

    @F.arrow_udf("array<double>")
    def valued(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            batch = pa.RecordBatch.from_arrays([values, pa.array(np.zeros(len(values)))], names=["x", "label"])
            found = [(held.value[0] @ z + held.value[1][:, None]).T for z, _ in _blocks(batch, scale, degree)]
            places = np.arange(len(values) + 1, dtype=np.int32) * n
            yield pa.ListArray.from_arrays(pa.array(places), pa.array(np.concatenate(found).ravel() if found else np.zeros(0)))

    return valued(vector_to_array(features))
