"""Model preparation: splits, folds, standardisation, class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.functions.text import row_fingerprint, stable_hash
from cohortline.operators.columns import continuous_columns, project
from cohortline.operators.profile import _chunked, _one_row_as_long, _union
from cohortline.operators.ranked import dense_index, running_sums
from cohortline.session import pin_small

HASH_RANGE = 2 ** 32


def hash_split(df: DataFrame, keys: Sequence[str] | None = None, test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a keyed hash: a narrow filter, equal under any partitioning.
    Without keys the whole row is the key, which keeps copies on one side."""
    key = stable_hash(*keys, seed=seed) if keys else stable_hash(row_fingerprint(*df.columns, strict=True), seed=seed)
    limit = int(test_share * HASH_RANGE)
    return df.filter(key >= limit), df.filter(key < limit)


def stratified_folds(df: DataFrame, label: str, key: str, n_folds: int = 5, seed: int = 42, fold: str = "fold") -> DataFrame:
    """Fold number per row: hash order inside each class dealt out in turn, so class
    sizes differ by at most one row between folds."""
    hashed = df.withColumn("_h", stable_hash(key, seed=seed))
    indexed = dense_index(hashed, [label], "_h", key, "_i", "_n")
    return indexed.withColumn(fold, F.pmod("_i", F.lit(n_folds)).cast("int")).drop("_h", "_i", "_n")


def fit_standardiser(train: DataFrame, cols: Sequence[str] | None = None, chunk: int = 40) -> DataFrame:
    """(column_name, mean, std) with the population deviation; zero becomes one.
    By default the numeric columns with more than two distinct values."""
    cols = list(cols) if cols is not None else continuous_columns(train)
    parts = []
    for names in _chunked(cols, chunk):
        row = train.agg(*[
            F.struct(F.avg(F.col(f"`{n}`").cast("double")).alias("mean"), F.stddev_pop(F.col(f"`{n}`").cast("double")).alias("std")).alias(f"v{i}")
            for i, n in enumerate(names)
        ])
        parts.append(_one_row_as_long(row, names, "column_name", "s"))
    return _union(parts).select(
        "column_name", F.col("s.mean").alias("mean"), F.when(F.col("s.std") == 0, 1.0).otherwise(F.col("s.std")).alias("std"))


def apply_standardiser(df: DataFrame, stats: DataFrame, others_after: bool = True) -> DataFrame:
    """Scaled columns in fit order, all other columns after them. One row per
    column comes to the driver; the rows only see column expressions."""
    fitted = stats.collect()
    names = [row["column_name"] for row in fitted]
    scaled = [((F.col(f"`{r['column_name']}`") - F.lit(r["mean"])) / F.lit(r["std"])).alias(r["column_name"]) for r in fitted]
    if others_after:
        return df.select(*scaled, *[F.col(f"`{c}`") for c in df.columns if c not in set(names)])
    by_name = dict(zip(names, scaled))
    return df.select(*[by_name.get(c, F.col(f"`{c}`")) for c in df.columns])


def scale_split(train: DataFrame, test: DataFrame, exclude: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, test, stats), fitted on the training side alone; ``exclude`` columns
    (keys, target) are never scaled."""
    cols = [c for c in continuous_columns(train.drop(*exclude))]
    stats = fit_standardiser(train, cols)
    return apply_standardiser(train, stats), apply_standardiser(test, stats), stats


def select_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The chosen features in order; a missing one raises."""
    return project(df, [*features, *keep])


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight) with weight n_rows / (n_classes * n_class)."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    mean_size = counts.agg(F.avg("n")).scalar()
    return counts.select("label", "n", (mean_size / F.col("n")).alias("weight"))


def with_class_weight(df: DataFrame, label: str, weight: str = "weight") -> DataFrame:
    weights = class_weights(df, label).select(F.col("label").alias(label), F.col("weight").alias(weight))
    return df.join(pin_small(weights), label)


#: Labels that fit one CASE expression; more are coded by a join.
MAX_LABELS = 1_000


def fit_label_codes(df: DataFrame, col: str) -> dict:
    """Label -> code in alphabetical order of the non-null labels, at most ``MAX_LABELS`` of
    them; ``label_code_table`` has no such bound."""
    labels = df.filter(F.col(col).isNotNull()).select(col).distinct().limit(MAX_LABELS + 1).collect()
    if len(labels) > MAX_LABELS:
        raise ValueError(f"{col}: more than {MAX_LABELS} labels; code them by label_code_table")
    return {label: code for code, label in enumerate(sorted(row[0] for row in labels))}


def label_code_table(df: DataFrame, col: str) -> DataFrame:
    """(label, code): the same codes for any number of labels, as a table to join."""
    labels = df.filter(F.col(col).isNotNull()).select(F.col(col).alias("label"), F.lit(1).cast("bigint").alias("n")).distinct()
    return running_sums(labels, [], "label", ["n"]).select("label", (F.col("n_cum") - 1).alias("code"))


def encode_by_table(df: DataFrame, col: str, codes: DataFrame, code: str) -> DataFrame:
    """``df`` with the ``code`` of its labels; unknown and null labels have none."""
    named = codes.select(F.col("label").alias("_label"), F.col("code").alias(code))
    return df.join(named, F.col(col) == F.col("_label"), "left").drop("_label")
