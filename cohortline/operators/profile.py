"""Profiling: nulls, constants, skew, correlation, duplicates, value counts."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from cohortline.functions.numeric import adjusted_skewness
from cohortline.operators.columns import distinct_classes, numeric_columns
from cohortline.operators.replicate import replicate


def _one_row_as_long(row: DataFrame, names: Sequence[str], name: str, value: str) -> DataFrame:
    """Columns v0..vn of a one-row aggregate as (name, value) rows."""
    pairs = [F.struct(F.lit(n).alias(name), F.col(f"v{i}").alias(value)) for i, n in enumerate(names)]
    return row.select(F.inline(F.array(*pairs)))


def _chunked(items: Sequence, size: int) -> list[list]:
    return [list(items[i:i + size]) for i in range(0, len(items), size)]


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def null_profile(df: DataFrame, chunk: int = 60) -> DataFrame:
    """(column_name, null_count) of the columns that hold nulls."""
    parts = []
    for names in _chunked(df.columns, chunk):
        row = df.agg(*[F.count_if(F.col(f"`{n}`").isNull()).alias(f"v{i}") for i, n in enumerate(names)])
        parts.append(_one_row_as_long(row, names, "column_name", "null_count"))
    return _union(parts).filter("null_count > 0")


def constant_columns(df: DataFrame) -> list[str]:
    """Columns with exactly one distinct non-null value; all-null ones are not."""
    return [c for c, kind in distinct_classes(df, df.columns).items() if kind == "constant"]


def skew_profile(df: DataFrame, cols: Sequence[str] | None = None, chunk: int = 20) -> DataFrame:
    """(column_name, skewness), most skewed first."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    parts = []
    for names in _chunked(cols, chunk):
        row = df.agg(*[adjusted_skewness(F.col(f"`{n}`").cast("double")).alias(f"v{i}") for i, n in enumerate(names)])
        parts.append(_one_row_as_long(row, names, "column_name", "skewness"))
    return _union(parts).orderBy(F.desc_nulls_last("skewness"), "column_name")


def corr_pairs(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson r of each column pair over the rows where both are present, as
    (left_pos, left_col, right_pos, right_col, r); NaN counts as missing. A pair
    without spread has a null r. One pass of matrix products that moves no rows:
    as aggregates every pair would need seven, beyond generated code."""
    return _corr_by_products(df, list(cols) if cols is not None else numeric_columns(df))


def _corr_by_products(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pairwise sums from products of the value and presence matrices of each Arrow
    batch; values are centred by the column means first, against cancellation."""
    wide = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    wide = wide.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in wide.columns])
    means_row = wide.agg(*[F.avg(f"c{i}").alias(f"c{i}") for i in range(len(cols))]).first()
    means = np.array([0.0 if v is None else v for v in means_row], dtype=np.float64)
    left, right = np.triu_indices(len(cols), k=1)

    def partial_sums(batches):
        n = sx = sxx = sxy = 0.0
        for batch in batches:
            values = batch.to_numpy(dtype=np.float64, na_value=np.nan) - means
            present = (~np.isnan(values)).astype(np.float64)
            values = np.where(present > 0, values, 0.0)
            n = n + present.T @ present
            sx = sx + values.T @ present
            sxx = sxx + (values * values).T @ present
            sxy = sxy + values.T @ values
        if not np.isscalar(n):
            yield pd.DataFrame({
                "i": left, "j": right, "n": n[left, right], "sx": sx[left, right], "sy": sx[right, left],
                "sxx": sxx[left, right], "syy": sxx[right, left], "sxy": sxy[left, right]})

    schema = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"
    sums = wide.mapInPandas(partial_sums, schema).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    covariance = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    # spread that is nothing but rounding counts as none
    left_var, right_var = F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n"), F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    defined = (F.col("n") > 1) & (left_var > 1e-12 * F.col("sxx")) & (right_var > 1e-12 * F.col("syy"))
    names = F.array(*[F.lit(c) for c in cols])
    return sums.select(
        F.col("i").alias("left_pos"), F.get(names, "i").alias("left_col"), F.col("j").alias("right_pos"), F.get(names, "j").alias("right_col"),
        F.when(defined, covariance / F.sqrt(left_var * right_var)).alias("r"))


def corr_prune(pairs: DataFrame, threshold: float = 0.85) -> DataFrame:
    """Columns to drop: any column whose |r| with an earlier column, kept or not,
    is above the threshold. Undefined r never drops."""
    strength = F.when(~F.isnan("r"), F.abs("r"))
    return (
        pairs.groupBy("right_pos", "right_col")
        .agg(F.max(strength).alias("max_abs_r"))
        .filter(F.col("max_abs_r") > threshold)
        .orderBy("right_pos")
        .select(F.col("right_col").alias("column_name"), "max_abs_r")
    )


def duplicate_groups(df: DataFrame, count_col: str = "n_copies") -> DataFrame:
    """Each distinct repeated row once, with its number of copies. Copies meet in
    map-side partial counts, so a row that fills a third of the table costs no more
    than any other."""
    return df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias(count_col)).filter(F.col(count_col) > 1)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Every copy of every repeated row; ``is_repeat`` is false for the first one.
    The copies are equal in all columns, so they are laid out again from their
    counts instead of being joined back."""
    return replicate(duplicate_groups(df, "_n"), "_n", "_i").withColumn("is_repeat", F.col("_i") > 0).drop("_n", "_i")


def duplicate_columns(df: DataFrame) -> DataFrame:
    """(column_name, same_as): columns equal in every row to an earlier column.
    One pass sums a per-column digest in which each value is tied to its row's
    own hash; only columns with equal digests are compared value by value."""
    names = df.columns
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}

    def comparable(name):
        # adding zero folds -0.0 into 0.0, which compare as equal
        return F.col(f"`{name}`").cast("double") + F.lit(0.0) if name in numeric else F.col(f"`{name}`")

    row_hash = F.xxhash64(*[comparable(n) for n in names])
    hashed = df.withColumn("_row", row_hash)
    digests: dict[tuple, list[str]] = {}
    for part in _chunked(names, 40):
        tied = {n: F.xxhash64(F.col("_row"), F.isnull(comparable(n)), comparable(n)) for n in part}
        # two sums of 20 bits each stay inside a long for trillions of rows
        sums = hashed.agg(*[
            F.sum(F.shiftright(tied[n], shift).bitwiseAND(F.lit(0xFFFFF))).alias(f"v{i}_{shift}")
            for i, n in enumerate(part) for shift in (0, 20)
        ]).first()
        for i, n in enumerate(part):
            digests.setdefault((n in numeric, sums[f"v{i}_0"], sums[f"v{i}_20"]), []).append(n)
    pairs = [(a, b) for group in digests.values() for a, b in combinations(group, 2)]
    same: dict[str, str] = {}
    for part in _chunked(pairs, 60):
        equal = df.agg(*[F.bool_and(F.col(f"`{a}`").eqNullSafe(F.col(f"`{b}`"))).alias(f"v{i}") for i, (a, b) in enumerate(part)]).first()
        for i, (a, b) in enumerate(part):
            if equal[f"v{i}"] is not False and b not in same:
                same[b] = a
    rows = [(n, same[n]) for n in names if n in same]
    return df.sparkSession.createDataFrame(rows, "column_name string, same_as string")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, n, share, pct) of the non-null values, most frequent first."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.col(col))).scalar()
    share = F.col("n") / F.col("total")
    return counts.withColumn("total", total).select(
        "value", "n", share.alias("share"), (100 * share).alias("pct")).orderBy(F.desc("n"), "value")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def crosstab(df: DataFrame, row_col: str, column_col: str, values: Sequence, other: str = "other") -> DataFrame:
    """Counts of two columns, one output column per given value (zeros filled) and
    one, ``other``, for all the rest, so that every row is counted."""
    if other in values:
        raise ValueError(f"{other!r} is one of the values; name the column for the rest differently")
    counts = [F.count_if(F.col(column_col) == v).alias(str(v)) for v in values]
    listed = F.coalesce(F.col(column_col).isin(*values), F.lit(False)) if values else F.lit(False)
    return df.groupBy(row_col).agg(*counts, F.count_if(~listed).alias(other))


def stage_sizes(stages: dict[str, DataFrame]) -> DataFrame:
    """(stage, n_rows, n_columns) of each named frame, one union of counts."""
    return _union([
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(stage).alias("stage"), "n_rows", F.lit(len(df.columns)).alias("n_columns"))
        for stage, df in stages.items()
    ])
