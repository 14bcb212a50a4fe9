"""Distinct counts over many loads from stored sketches: one row per load, merged instead of scanned again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sketch size as a power of two; the standard error is about one part in the square root of it.
LOG_SIZE = 14
#: Three standard errors of either sketch at this size.
RELATIVE_ERROR = 0.025


def load_sketches(df: DataFrame, load: str | Column, key: str, log_size: int = LOG_SIZE) -> DataFrame:
    """(load, n_rows, distinct_sketch, set_sketch) per load, of the non-null keys: an HLL sketch for counts over
    unions, a theta sketch for differences and intersections. Loads are written once and never read again."""
    text = F.col(key).cast("string")
    return df.groupBy((F.col(load) if isinstance(load, str) else load).alias("load")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(text, log_size).alias("distinct_sketch"),
        F.theta_sketch_agg(text, log_size).alias("set_sketch"))


def distinct_over(sketches: DataFrame, *by: str) -> DataFrame:
    """(by, n_loads, n_rows, n_distinct): estimated distinct keys over the union of the given loads."""
    return sketches.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_loads"), F.sum("n_rows").alias("n_rows"), F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("n_distinct"))


def lost_between(earlier: DataFrame, later: DataFrame) -> DataFrame:
    """(n_earlier, n_later, n_lost, n_new): estimated keys of two layers or sets of loads, and those of one side only."""
    def union(sketches: DataFrame) -> Column:
        return sketches.agg(F.theta_union_agg("set_sketch")).scalar()

    return earlier.sparkSession.range(1).select(union(earlier).alias("a"), union(later).alias("b")).select(
        F.theta_sketch_estimate("a").alias("n_earlier"), F.theta_sketch_estimate("b").alias("n_later"),
        F.theta_sketch_estimate(F.theta_difference("a", "b")).alias("n_lost"), F.theta_sketch_estimate(F.theta_difference("b", "a")).alias("n_new"))
