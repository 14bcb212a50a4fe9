"""Data-quality checks. A check finds violating rows; none means it passed. All
column checks of one table are counted in a single aggregate pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortline.functions.numeric import safe_ratio
from cohortline.functions.text import row_fingerprint

RESULT_COLUMNS = ("check", "layer", "column", "severity", "n_violations", "passed", "sample")


@dataclass(frozen=True)
class ColumnCheck:
    """``not_null``, ``accepted_values`` (nulls pass) or ``in_range`` (nulls pass)."""

    kind: str
    column: str
    values: tuple = ()
    severity: str = "error"

    def violated(self):
        col = F.col(f"`{self.column}`")
        if self.kind == "not_null":
            return col.isNull()
        if self.kind == "accepted_values":
            return col.isNotNull() & ~col.isin(*self.values)
        if self.kind == "in_range":
            low, high = self.values
            return col.isNotNull() & ~col.between(low, high)
        raise ValueError(f"unknown check kind: {self.kind}")


class CheckFailed(RuntimeError):
    """An error-severity check found violations; downstream tables must not build."""


def run_column_checks(df: DataFrame, layer: str, checks: Sequence[ColumnCheck]) -> DataFrame:
    """One result row per check, from one aggregate pass."""
    flagged, marks = flag_violations(df, layer, checks)
    return count_violations(flagged, marks)


def flag_violations(df: DataFrame, layer: str, checks: Sequence[ColumnCheck]) -> tuple[DataFrame, list[tuple[str, str, ColumnCheck]]]:
    """Adds a column per check that holds the violating value as text (empty for a
    null) and is null where the check holds. Later projections carry the columns
    along, so the checks of a whole layer chain can be counted in one pass."""
    marks = [(f"_check_{layer}_{i}", layer, check) for i, check in enumerate(checks)]
    return df.withColumns({
        name: F.when(check.violated(), F.coalesce(F.col(f"`{check.column}`").cast("string"), F.lit("")))
        for name, _, check in marks
    }), marks


def count_violations(flagged: DataFrame, marks: Sequence[tuple[str, str, ColumnCheck]]) -> DataFrame:
    counted = flagged.agg(*[c for name, _, _ in marks for c in (F.count(name).alias(f"n{name}"), F.min(name).alias(f"s{name}"))])
    rows = [
        F.struct(
            F.lit(check.kind).alias("check"), F.lit(layer).alias("layer"), F.lit(check.column).alias("column"),
            F.lit(check.severity).alias("severity"), F.col(f"n{name}").alias("n_violations"),
            (F.col(f"n{name}") == 0).alias("passed"), F.nullif(F.col(f"s{name}"), F.lit("")).alias("sample"),
        )
        for name, layer, check in marks
    ]
    return counted.select(F.inline(F.array(*rows)))


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    result = None
    for layer, df in layers.items():
        counted = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(layer).alias("layer"), "row_count")
        result = counted if result is None else result.unionByName(counted)
    return result


def row_loss(counts: DataFrame, baseline: str) -> DataFrame:
    """Layers whose row count differs from the baseline layer's. One row per
    layer, so gathering them beside the baseline count needs no join."""
    gathered = counts.agg(
        F.collect_list(F.struct("layer", "row_count")).alias("rows"),
        F.max(F.when(F.col("layer") == baseline, F.col("row_count"))).alias("raw_count"),
    )
    return gathered.select(F.inline("rows"), "raw_count").filter("row_count <> raw_count").select("layer", "row_count")


def duplicate_rate(df: DataFrame, cols: Sequence[str], strict: bool = False) -> DataFrame:
    """(total_rows, distinct_rows, duplicate_rate) by fingerprint; the rate is null
    for an empty table."""
    # 16 bytes per distinct row reach the shuffle, not 32 hex digits
    counted = df.select(F.unhex(row_fingerprint(*cols, strict=strict)).alias("fp")).agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_distinct("fp").alias("distinct_rows"))
    return counted.withColumn("duplicate_rate", 1.0 - safe_ratio(F.col("distinct_rows"), F.col("total_rows")))


def outside_band(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    return df.filter((F.col(col) < low) | (F.col(col) > high))


def id_cardinality(df: DataFrame, col: str, approximate: bool = False, name: str = "distinct_ids") -> DataFrame:
    return df.agg((F.approx_count_distinct(col) if approximate else F.count_distinct(col)).alias(name))


def unmapped_labels(df: DataFrame, raw_col: str, label_col: str, bucket: str) -> DataFrame:
    """Raw labels that fell into the default bucket, with their counts."""
    return (
        df.filter(F.col(label_col) == bucket)
        .groupBy(F.col(label_col).alias("label"), F.col(raw_col).alias("raw_label"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def summarise(violations: DataFrame, check: str, layer: str, column: str | None, severity: str) -> DataFrame:
    """A frame of violating rows as one result row."""
    return violations.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.to_json(F.struct("*"))).alias("sample")
    ).select(
        F.lit(check).alias("check"), F.lit(layer).alias("layer"), F.lit(column).cast("string").alias("column"),
        F.lit(severity).alias("severity"), F.col("n").alias("n_violations"), (F.col("n") == 0).alias("passed"), "sample",
    )


@dataclass(frozen=True)
class SchemaDifference:
    problem: str
    column: str
    expected: str | None
    actual: str | None


def schema_differences(df: DataFrame, expected: StructType, check_order: bool = True) -> list[SchemaDifference]:
    """Missing, extra, retyped and reordered columns; reads no rows."""
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    found = [SchemaDifference("missing", n, t, None) for n, t in wanted.items() if n not in actual]
    found += [SchemaDifference("extra", n, None, t) for n, t in actual.items() if n not in wanted]
    found += [SchemaDifference("type", n, t, actual[n]) for n, t in wanted.items() if n in actual and actual[n] != t]
    if check_order and not found and list(wanted) != list(actual):
        found += [SchemaDifference("order", a, w, a) for w, a in zip(wanted, actual) if w != a]
    return found


def enforce_schema(df: DataFrame, expected: StructType, check_order: bool = True) -> DataFrame:
    differences = schema_differences(df, expected, check_order)
    if differences:
        raise CheckFailed(f"schema contract broken: {differences}")
    return df


def enforce(results: DataFrame) -> list[str]:
    """Raise on failed error-severity checks; returns the names of failed warnings.
    One row per check comes to the driver."""
    failed = results.filter(~F.col("passed")).collect()
    errors = [f"{r['layer']}.{r['column'] or '*'} {r['check']}: {r['n_violations']}" for r in failed if r["severity"] == "error"]
    if errors:
        raise CheckFailed("; ".join(sorted(errors)))
    return sorted(f"{r['layer']}.{r['column'] or '*'} {r['check']}" for r in failed)
