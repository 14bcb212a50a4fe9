"""Batch scoring: validate, transform, scale, order, predict, decode."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from cohortline.functions.numeric import log1p, to_number
from cohortline.functions.text import ordinal_decode
from cohortline.operators.columns import long_form
from cohortline.operators.nodes import NodeForest
from cohortline.operators.prep import apply_standardiser


def checked_inputs(df: DataFrame, required: Sequence[str], optional: Sequence[str] = (), default: float = 0.0) -> DataFrame:
    """All rows with ``numbers``, a struct of the inputs as numbers (a missing optional
    one takes the default), and ``reasons``, why the row is rejected (empty: accepted).
    Every input must read as a number; a missing required one rejects the row. Absent
    columns count as missing. Each text is cast once."""
    present = set(df.columns)
    names = [*required, *optional]
    cast = df.withColumn("_cast", F.struct(*[
        (to_number(F.col(f"`{c}`")) if c in present else F.lit(None).cast("double")).alias(c) for c in names]))
    number = {c: F.col(f"_cast.`{c}`") for c in names}
    unreadable = {c: F.col(f"`{c}`").isNotNull() & number[c].isNull() if c in present else F.lit(False) for c in names}
    problems = [F.when(number[c].isNull() & ~unreadable[c], F.lit(f"{c}: missing")) for c in required]
    problems += [F.when(unreadable[c], F.lit(f"{c}: not a number")) for c in names]
    numbers = F.struct(*[number[c].alias(c) for c in required], *[F.coalesce(number[c], F.lit(default)).alias(c) for c in optional])
    return cast.select(*[F.col(f"`{c}`") for c in df.columns], numbers.alias("numbers"), F.array_compact(F.array(*problems)).alias("reasons"))


def validate_inputs(df: DataFrame, required: Sequence[str], optional: Sequence[str] = (), default: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of ``checked_inputs``: accepted rows with their numbers,
    rejected ones with their texts and the reasons."""
    checked = checked_inputs(df, required, optional, default)
    names = [*required, *optional]
    accepted = checked.filter(F.size("reasons") == 0).select(
        *[F.col(f"`{c}`") for c in df.columns if c not in names], *[F.col(f"numbers.`{c}`").alias(c) for c in names])
    return accepted, checked.filter(F.size("reasons") > 0).drop("numbers")


def range_violations(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """(column_name, low, high, n) of the columns with values out of bounds."""
    conditions = {c: ~F.col(f"`{c}`").between(lo, hi) for c, (lo, hi) in bounds.items()}
    counted = df.agg(*[F.count_if(cond).alias(f"v{i}") for i, cond in enumerate(conditions.values())])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.lit(float(lo)).alias("low"), F.lit(float(hi)).alias("high"), F.col(f"v{i}").alias("n"))
        for i, (c, (lo, hi)) in enumerate(bounds.items())
    ]
    return counted.select(F.inline(F.array(*rows))).filter("n > 0")


def score(df: DataFrame, model: PipelineModel | NodeForest, scaler: DataFrame | None, features: Sequence[str], codes: Mapping[str, int],
          log_columns: Sequence[str] = (), raw_compat: bool = False, inputs: Sequence[str] | None = None) -> DataFrame:
    """Adds ``inputs`` (the given columns as read, by default the features; a log
    wants every validated one), ``diagnosis`` (decoded label), ``confidence``
    (percent, null without probabilities), ``status`` and ``error``.
    ``log_columns`` get the training transform first; ``raw_compat`` feeds them
    untransformed; without a ``scaler`` the features are taken as they are. A row
    that cannot be scored carries the message and null outputs."""
    # NaN would be read as a value by the trees, so any null or NaN is a row error
    bad = reduce(lambda a, b: a | b, [F.col(f"`{f}`").isNull() | F.isnan(F.col(f"`{f}`").cast("double")) for f in features])
    kept = df.withColumn("inputs", F.struct(*[F.col(f"`{c}`").cast("double").alias(c) for c in inputs or features])).withColumn("unusable", bad)
    ready = kept if raw_compat else kept.withColumns({c: log1p(F.col(c)) for c in log_columns})
    scored = model.transform(ready if scaler is None else apply_standardiser(ready, scaler, others_after=False))
    label = ordinal_decode(F.col("prediction").cast("int"), codes)
    error = F.when(F.col("unusable"), "input is null or not a number").when(label.isNull(), F.concat(F.lit("no label for code "), F.col("prediction").cast("int").cast("string")))
    confidence = F.lit(None).cast("double")
    if "probability" in scored.columns:
        shares = F.col("probability") if isinstance(scored.schema["probability"].dataType, ArrayType) else vector_to_array("probability")
        confidence = F.round(100.0 * F.get(shares, F.col("prediction").cast("int")), 2)
    others = [c for c in df.columns if c not in {*features, *(inputs or ())}]
    return scored.withColumn("error", error).select(
        *others, "inputs", F.when(F.col("error").isNull(), label).alias("diagnosis"),
        F.when(F.col("error").isNull(), confidence).alias("confidence"),
        F.when(F.col("error").isNull(), "success").otherwise("error").alias("status"), "error")


def score_raw(df: DataFrame, model: PipelineModel | NodeForest, scaler: DataFrame | None, features: Sequence[str], codes: Mapping[str, int],
              optional: Sequence[str] = (), default: float = 0.0, log_columns: Sequence[str] = ()) -> DataFrame:
    """Every raw row with ``inputs``, ``diagnosis``, ``confidence``, ``status`` and ``error``: rows whose inputs are
    missing or unreadable carry the reasons, the others are scored; one scan serves both."""
    names = [*features, *optional]
    checked = checked_inputs(df, features, optional, default)
    rejected = F.size("reasons") > 0
    # rejected rows go through the model with the default, so that no row leaves the plan
    numbers = [F.coalesce(F.col(f"numbers.`{c}`"), F.lit(default)).alias(c) for c in names]
    others = [F.col(f"`{c}`") for c in df.columns if c not in names]
    ready = checked.select(*others, F.array_join("reasons", "; ").alias("_reasons"), rejected.alias("_rejected"), *numbers)
    scored = score(ready, model, scaler, features, codes, log_columns, inputs=names)
    kept = {name: F.when(~F.col("_rejected"), F.col(name)).alias(name) for name in ("inputs", "diagnosis", "confidence")}
    return scored.select(
        *others, *kept.values(), F.when(F.col("_rejected"), "error").otherwise(F.col("status")).alias("status"),
        F.when(F.col("_rejected"), F.col("_reasons")).otherwise(F.col("error")).alias("error"))


def score_features(scored: DataFrame, features: Sequence[str]) -> DataFrame:
    """Scored inputs in the long form drift works on."""
    return long_form(scored.select("inputs.*"), features, "feature")
