"""Order statistics that stay distributed: running sums, exact quantiles, dense
indexes, bottom-k samples, last-n and first-of-key.

Both running sums and quantiles take one way at any size. For running sums, equal values of a group are
added up first, so that the rest are distinct and spread over ranges of (group,
value), however often one value occurs. Each range sums up its rows in order
where it is sorted; the totals of the ranges before it are added afterwards.
Neither a group nor a value has to fit one task, and only one row per range and
group meets in a window.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from cohortline.functions.numeric import with_count_at_most
from cohortline.session import pin_small, store

MAX_GROUPS = 2000
#: Accuracy of the sketch that brackets quantiles (its ranks are off by one part in so many), and how far the
#: brackets reach to both sides.
SKETCH_ACCURACY = 10_000
BRACKET = 2 / SKETCH_ACCURACY


def _opens(batch: pa.RecordBatch, last: pa.RecordBatch | None, groups: Sequence[str]) -> np.ndarray:
    """Whether each row's group differs from that of the row before it, in this batch or at the end of the last."""
    opens = np.zeros(batch.num_rows, dtype=bool)
    opens[0] = last is None
    for name in groups:
        at = batch.schema.get_field_index(name)
        column = batch.column(at)
        if last is not None:
            column = pa.concat_arrays([last.column(at).slice(last.num_rows - 1), column])
        before, now = column.slice(0, len(column) - 1), column.slice(1)
        unlike = pc.fill_null(pc.not_equal(before, now), False).to_numpy(zero_copy_only=False)
        unlike = unlike | (before.is_null().to_numpy(zero_copy_only=False) != now.is_null().to_numpy(zero_copy_only=False))
        opens[batch.num_rows - len(unlike):] |= unlike
    return opens


def _segment_sums(values: np.ndarray, opens: np.ndarray, carried: float) -> np.ndarray:
    """Running sums that begin anew where ``opens`` is set; ``carried`` continues the segment before the first."""
    starts = np.flatnonzero(opens)
    if values.dtype.kind == "f":
        # segment by segment, as differences of running sums would lose digits
        parts = np.split(values, starts)
        return np.concatenate([np.cumsum(part) + (carried if i == 0 else 0) for i, part in enumerate(parts)])
    running = np.cumsum(values)
    before = np.full(len(values), -carried, dtype=running.dtype)
    segment = np.cumsum(opens) - 1
    inside = segment >= 0
    before[inside] = (running[starts] - values[starts])[segment[inside]]
    return running - before


def _sums_in_range(rows: DataFrame, groups: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sorted partitions with ``_part`` and, per measure, its sum over the group's rows of the partition so far."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last: pa.RecordBatch | None = None
        carried = [0] * len(measures)
        for batch in batches:
            if not batch.num_rows:
                continue
            opens = _opens(batch, last, groups)
            sums = [_segment_sums(batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False), opens, carried[i])
                    for i, name in enumerate(measures)]
            carried = [found[-1] for found in sums]
            last = batch
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), *map(pa.array, sums)],
                                             names=[*batch.schema.names, "_part", *[f"{m}_cum" for m in measures]])

    fields = {f.name: f for f in rows.schema.fields}
    schema = StructType([*rows.schema.fields, StructField("_part", IntegerType()), *[
        StructField(f"{m}_cum", fields[m].dataType) for m in measures]])
    return rows.mapInArrow(add, schema)


def running_sums(df: DataFrame, groups: Sequence[str], order_col: str, measures: Sequence[str], ascending: bool = True) -> DataFrame:
    """Per group and distinct order value: the summed measures and their running
    totals ``<measure>_cum``. Null measures count as zero."""
    groups, measures = list(groups), list(measures)
    direction = F.col(order_col).asc() if ascending else F.col(order_col).desc()
    summed = df.groupBy(*groups, order_col).agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])
    ranges = summed.repartitionByRange(*groups, direction).sortWithinPartitions(*groups, direction)
    found = store(_sums_in_range(ranges, groups, measures), "running")
    totals = found.groupBy(*groups, "_part").agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
    # one row per range, and one more per group
    earlier = W.partitionBy(*groups).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = pin_small(totals.select(
        "_part", *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
        *[F.coalesce(F.sum(f"_t_{m}").over(earlier), F.lit(0)).alias(f"_o_{m}") for m in measures]))
    same = [F.col("_part") == F.col("_at")] + [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)]
    joined = found.join(offsets.withColumnRenamed("_part", "_at"), same)
    return joined.select(*groups, order_col, *measures, *[(F.col(f"_o_{m}") + F.col(f"{m}_cum")).alias(f"{m}_cum") for m in measures])


def exact_quantiles(df: DataFrame, group: str, value: str, probs: Sequence[float]) -> DataFrame:
    """(group, n, quantiles): linearly interpolated quantiles of the non-null values, as an
    array in the order of ``probs``.

    A sketch brackets each quantile, and one more pass counts what lies between the brackets and
    every value within them, some ten thousandths of a group's rows each. The sketch decides
    how few these are, never the result: a rank just outside a bracket is the least or the
    greatest value beyond it."""
    probs = [float(p) for p in probs]
    around = [min(1.0, max(0.0, p + side * BRACKET)) for p in probs for side in (-1, 1)]
    present = df.filter(F.col(value).isNotNull()).select(F.col(group).alias("_g"), F.col(value).cast("double").alias("_v"))
    bounds = F.percentile_approx("_v", F.array(*[F.lit(p) for p in around]), SKETCH_ACCURACY)
    sketch = present.groupBy("_g").agg(F.count(F.lit(1)).alias("_size"), bounds.alias("_bounds"))
    low_of, high_of = F.slice("_points", 1, F.size("_points") - 1), F.slice("_points", 2, F.size("_points") - 1)

    def bracketed(low: Column, high: Column) -> Column:
        return reduce(or_, [(F.get("_bounds", F.lit(2 * i)) <= low) & (high <= F.get("_bounds", F.lit(2 * i + 1))) for i in range(len(probs))])

    stats = pin_small(sketch.withColumn("_points", F.array_sort(F.array_distinct("_bounds"))).withColumn("_inside", F.zip_with(low_of, high_of, bracketed)), MAX_GROUPS)
    # groups join by null-safe equality, so that rows without one form a group of their own
    marked = stats.select(F.col("_g").alias("_of"), "_points", "_inside")
    joined = with_count_at_most(present.join(marked, F.col("_g").eqNullSafe(F.col("_of"))), "_v", "_points", 2 * len(probs), "_place")
    on_point = F.coalesce(F.get("_points", F.col("_place") - 1) == F.col("_v"), F.lit(False))
    kept = F.when(on_point | F.coalesce(F.get("_inside", F.col("_place") - 1), F.lit(False)), F.col("_v"))
    counted = pin_small(joined.groupBy("_g", "_place", (~on_point).alias("_open"), kept.alias("_at")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_low"), F.max("_v").alias("_high")), 200_000)
    in_cell = W.partitionBy("_g", "_place", "_open").orderBy("_at")
    cells = counted.groupBy("_g", "_place", "_open").agg(F.sum("_c").alias("_c"))
    before = W.partitionBy("_g").orderBy("_place", "_open").rowsBetween(W.unboundedPreceding, -1)
    offsets = cells.select(F.col("_g").alias("_h"), F.col("_place").alias("_p"), F.col("_open").alias("_o"), F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_base"))
    placed = counted.withColumn("_sum", F.sum("_c").over(in_cell)).join(
        offsets, F.col("_g").eqNullSafe(F.col("_h")) & (F.col("_place") == F.col("_p")) & (F.col("_open") == F.col("_o")))
    spans = placed.select("_g", (F.col("_base") + F.col("_sum") - F.col("_c")).alias("_from"), (F.col("_base") + F.col("_sum")).alias("_to"), "_low", "_high")
    wanted = F.posexplode(F.array(*[F.lit(p) * (F.col("_size") - 1) for p in probs])).alias("_i", "_rank")
    points = stats.select(F.col("_g").alias("_w"), F.col("_size").alias("n"), wanted)

    def value_at(rank: Column) -> Column:
        here = (F.col("_from") <= rank) & (rank < F.col("_to"))
        return F.max(F.when(here & (rank == F.col("_from")), F.col("_low")).when(here & ((rank == F.col("_to") - 1) | (F.col("_low") == F.col("_high"))), F.col("_high")))

    found = spans.join(points, F.col("_g").eqNullSafe(F.col("_w")) & (F.col("_from") <= F.ceil("_rank")) & (F.floor("_rank") < F.col("_to"))).groupBy(
        "_g", "n", "_i", "_rank").agg(value_at(F.floor("_rank")).alias("_v0"), value_at(F.ceil("_rank")).alias("_v1"))
    point = found.withColumn("_q", F.col("_v0") + (F.col("_v1") - F.col("_v0")) * (F.col("_rank") - F.floor("_rank")))
    return point.groupBy(F.col("_g").alias(group), "n").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_i", "_q"))), lambda s: s["_q"]).alias("quantiles"))


def dense_index(df: DataFrame, groups: Sequence[str], hash_col: str, tie_col: str, index: str = "row_index",
                total: str = "group_size", bits: int = 12) -> DataFrame:
    """0-based position of every row in its group by (hash, tie), plus the group
    size. Hash prefixes cut each group into 2^bits even buckets, so the largest
    group numbers its rows in parallel."""
    groups = list(groups)
    cut = df.withColumn("_bucket", F.shiftright(F.col(hash_col), 32 - bits))
    sizes = cut.groupBy(*groups, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    ordered = W.partitionBy(*groups).orderBy("_bucket")
    offsets = sizes.select(
        *groups, "_bucket",
        (F.sum("_size").over(ordered) - F.col("_size")).alias("_offset"),
        F.sum("_size").over(W.partitionBy(*groups)).alias(total),
    )
    local = W.partitionBy(*groups, "_bucket").orderBy(hash_col, tie_col)
    return (
        cut.withColumn("_rn", F.row_number().over(local) - 1)
        .join(offsets, groups + ["_bucket"])
        .withColumn(index, F.col("_offset") + F.col("_rn"))
        .drop("_bucket", "_rn", "_offset")
    )


def bottom_k_sample(df: DataFrame, groups: Sequence[str], hash_col: str, row_key: Sequence[str], k: int,
                    bits: int = 16) -> DataFrame:
    """At most k rows per group without replacement: those with the smallest 32-bit
    hashes, ties by ``row_key``, which must tell rows apart. Hash-prefix counts
    find the cut-off, so only about k rows per group (plus one prefix bucket) are
    ever sorted."""
    groups = list(groups)
    hashed = df.withColumn("_prefix", F.shiftright(hash_col, 32 - bits))
    sizes = hashed.groupBy(*groups, "_prefix").agg(F.count(F.lit(1)).alias("_size"))
    ordered = W.partitionBy(*groups).orderBy("_prefix")
    needed = sizes.withColumn("_before", F.sum("_size").over(ordered) - F.col("_size")).filter(F.col("_before") < k)
    cutoff = pin_small(needed.groupBy(*groups).agg(F.max("_prefix").alias("_cut")), MAX_GROUPS)
    candidates = hashed.join(cutoff, groups).filter("_prefix <= _cut")
    rank = W.partitionBy(*groups).orderBy(hash_col, *row_key)
    return candidates.withColumn("_rn", F.row_number().over(rank)).filter(F.col("_rn") <= k).drop("_prefix", "_cut", "_rn")


def last_n(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The last n rows in the given order, oldest first: per-task top-n, then one
    merge of n-row lists; never a global window."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    return df.orderBy(*[c.desc() for c in cols]).limit(n).orderBy(*[c.asc() for c in cols])


def head(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The first n rows in the given order: per-task top-n, then one merge. Columns that
    do not tell all rows apart leave the choice among equals open."""
    return df.orderBy(*order).limit(n)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in the given order. The rank filter limits each
    key to one row per task before the shuffle, so hot keys stay cheap."""
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")
