"""Numeric expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Lower bound of bin shares inside the stability index.
PSI_EPSILON = 1e-6


def log1p(col: Column) -> Column:
    return F.log1p(col.cast("double"))


def flag_sum(cols: Sequence[Column | str], skip_nulls: bool = False) -> Column:
    """Sum of 0/1 flags; one null makes the sum null unless ``skip_nulls``."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    if skip_nulls:
        parts = [F.coalesce(part, F.lit(0)) for part in parts]
    return reduce(add, parts).cast("bigint")


def to_number(col: Column) -> Column:
    """Double or null: unreadable text and NaN both become null."""
    number = col.try_cast("double")
    return F.when(~F.isnan(number), number)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    return numerator.cast("double") / F.nullif(denominator, F.lit(0)).cast("double")


def share_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(safe_ratio(numerator, denominator), F.lit(0.0))


def clip_low(col: Column, bound: float) -> Column:
    return F.greatest(col, F.lit(bound))


def psi_term(reference_share: Column, current_share: Column, epsilon: float = PSI_EPSILON) -> Column:
    """One bin's part of the population-stability index."""
    ref, cur = clip_low(reference_share, epsilon), clip_low(current_share, epsilon)
    return (cur - ref) * F.ln(cur / ref)


def with_count_at_most(df: DataFrame, value: str, sorted_points: str, max_points: int, out: str) -> DataFrame:
    """Adds how many entries of a sorted array column are <= value. Binary descent,
    one projection per step: each step reads the one before as a plain column, so
    the whole search stays in generated code at log2 of the array length per row."""
    step = 1
    while step * 2 <= max_points:
        step *= 2
    points = F.col(sorted_points)
    df = df.withColumn(out, F.when(F.get(points, F.lit(step - 1)) <= F.col(value), step).otherwise(0))
    while step > 1:
        step //= 2
        df = df.withColumn(out, F.when(F.get(points, F.col(out) + (step - 1)) <= F.col(value), F.col(out) + step).otherwise(F.col(out)))
    return df


def adjusted_skewness(col: Column) -> Column:
    """Bias-corrected sample skewness; null below three values or without spread."""
    n = F.count(col).cast("double")
    factor = F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))
    return F.when(n >= 3, F.skewness(col) * factor)


#: Both samples up to this size: the exact law of the two-sample statistic.
KS_EXACT_UP_TO = 10_000


def ks_exact_p_value(statistic: float, n: int, m: int) -> float:
    """P(D >= statistic) for two samples of one continuous law, by counting the paths from
    (0, 0) to (n, m) that stay within the band |i / n - j / m| < statistic. A row of counts
    is the running sum of the row before, so each of the n + 1 steps is one vector operation."""
    reach = round(statistic * n * m)
    if reach <= 0:
        return 1.0
    paths = np.zeros(m + 1)
    paths[:min(m, (reach - 1) // n) + 1] = 1.0
    scale = 0.0
    for i in range(1, n + 1):
        low, high = max(0, (i * m - reach) // n + 1), min(m, (i * m + reach - 1) // n)
        inside = np.cumsum(paths[low:high + 1])
        if not len(inside) or inside[-1] == 0:
            return 1.0
        paths[:] = 0.0
        paths[low:high + 1] = inside / inside[-1]
        scale += math.log(inside[-1])
    if paths[m] == 0:
        return 1.0
    all_paths = math.lgamma(n + m + 1) - math.lgamma(n + 1) - math.lgamma(m + 1)
    return min(1.0, max(0.0, -math.expm1(math.log(paths[m]) + scale - all_paths)))


@F.pandas_udf(DoubleType())
def _ks_exact(statistic: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    """One row per feature; null where a sample is too large for the exact law."""
    return pd.Series([
        ks_exact_p_value(d, int(a), int(b)) if d == d and 0 < a and 0 < b and max(a, b) <= KS_EXACT_UP_TO else None
        for d, a, b in zip(statistic, n, m)], dtype="float64")


def ks_p_value(statistic: Column, n_left: Column, n_right: Column, terms: int = 100, exact: bool = True) -> Column:
    """Two-sided two-sample Kolmogorov-Smirnov p-value, exact up to ``KS_EXACT_UP_TO`` values
    a side, asymptotic beyond and without ``exact``, in [0, 1]."""
    n, m = n_left.cast("double"), n_right.cast("double")
    scaled = statistic * statistic * (n * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda total, k: total + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * scaled),
    )
    asymptotic = F.when(scaled < 0.02, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * series)))
    if not exact:
        return asymptotic
    return F.when(F.greatest(n, m) <= KS_EXACT_UP_TO, _ks_exact(statistic, n, m)).otherwise(asymptotic)
