"""Column-level operators: projections that fail loudly, type-based choice."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DoubleType, FloatType, IntegerType, LongType, NumericType, ShortType


def missing_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [name for name in names if name not in present]


def project(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns in the given order; unknown names raise."""
    lost = missing_columns(df, names)
    if lost:
        raise ValueError(f"missing columns: {lost}")
    return df.select(*[F.col(f"`{n}`") for n in names])


def star_exclude(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """All columns but the named ones; unknown names raise (``drop`` ignores them)."""
    lost = missing_columns(df, names)
    if lost:
        raise ValueError(f"cannot exclude unknown columns: {lost}")
    dropped = set(names)
    return df.select(*[F.col(f"`{n}`") for n in df.columns if n not in dropped])


def replace_at_end(df: DataFrame, replacements: Mapping[str, Column]) -> DataFrame:
    """Recompute columns under their own names; they move to the end."""
    lost = missing_columns(df, replacements)
    if lost:
        raise ValueError(f"missing columns: {lost}")
    kept = [F.col(f"`{n}`") for n in df.columns if n not in replacements]
    return df.select(*kept, *[col.alias(n) for n, col in replacements.items()])


def rename_first(df: DataFrame, renames: Sequence[tuple[str, str]]) -> DataFrame:
    """Renamed columns first, in the order given; all others follow unchanged."""
    sources = [source for source, _ in renames]
    rest = [F.col(f"`{n}`") for n in star_exclude(df, sources).columns]
    return df.select(*[F.col(f"`{s}`").alias(t) for s, t in renames], *rest)


def split_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    return star_exclude(df, [target]), project(df, [target])


def numeric_columns(df: DataFrame) -> list[str]:
    kinds = (ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, NumericType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def distinct_classes(df: DataFrame, cols: Sequence[str], chunk: int = 20) -> dict[str, str]:
    """``empty``, ``constant``, ``binary`` or ``many`` distinct non-null values per
    column. Two shuffle-free passes: min and max, then whether any value lies
    off both. Exact, with no distinct sets."""
    classes: dict[str, str] = {}
    for start in range(0, len(cols), chunk):
        part = list(cols[start:start + chunk])
        bounds = df.agg(*[f(F.col(f"`{c}`")).alias(f"{tag}{i}") for i, c in enumerate(part) for tag, f in (("lo", F.min), ("hi", F.max))]).first()
        open_cols = []
        for i, c in enumerate(part):
            low, high = bounds[f"lo{i}"], bounds[f"hi{i}"]
            if low is None:
                classes[c] = "empty"
            elif low == high:
                classes[c] = "constant"
            else:
                open_cols.append((c, low, high))
        if open_cols:
            off = df.agg(*[
                F.coalesce(F.bool_or(~F.col(f"`{c}`").isin(low, high)), F.lit(False)).alias(f"o{i}")
                for i, (c, low, high) in enumerate(open_cols)
            ]).first()
            for i, (c, _, _) in enumerate(open_cols):
                classes[c] = "many" if off[f"o{i}"] else "binary"
    return {c: classes[c] for c in cols}


def continuous_columns(df: DataFrame) -> list[str]:
    """Numeric columns with more than two distinct non-null values."""
    return [c for c, kind in distinct_classes(df, numeric_columns(df)).items() if kind == "many"]


def binary_columns(df: DataFrame) -> list[str]:
    return [c for c, kind in distinct_classes(df, numeric_columns(df)).items() if kind == "binary"]


def long_form(df: DataFrame, cols: Sequence[str], name: str = "column_name", value: str = "value",
              keep: Sequence[str] = ()) -> DataFrame:
    """Numeric columns as (name, value) rows; one pass, no shuffle."""
    wide = df.select(*keep, *[F.col(f"`{c}`").cast("double").alias(c) for c in cols])
    return wide.unpivot(list(keep), list(cols), name, value)
