"""Reports, reference statistics, encoder maps, run records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.sources.records import path_exists


class ReferenceMissing(FileNotFoundError):
    """Stored reference statistics were asked for before they were built."""


def save_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Overwrite a (small, aggregated) report. The one file comes from a shuffle: a
    plain coalesce would pull the aggregation before it into one task as well."""
    df.repartition(1).write.mode("overwrite").format(fmt).save(path)


def save_reference(reference: DataFrame, path: str) -> None:
    reference.repartition(1).write.mode("overwrite").parquet(path)


def load_reference(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        raise ReferenceMissing(f"reference statistics not built yet: {path}")
    return spark.read.parquet(path)


def save_encoder(codes: Mapping[str, int], spark: SparkSession, path: str) -> None:
    rows = [(int(code), label) for label, code in codes.items()]
    spark.createDataFrame(rows, "code int, label string").coalesce(1).write.mode("overwrite").json(path)


def load_encoder(spark: SparkSession, path: str) -> dict[str, int]:
    """Encoder map as label -> code; one entry per class, so small by nature. Reads
    both the row form written here and one ``{"0": "label", ..}`` object."""
    frame = spark.read.json(path)
    if set(frame.columns) == {"code", "label"}:
        return {row["label"]: int(row["code"]) for row in frame.orderBy("code").collect()}
    row = frame.first()
    return {row[name]: int(name) for name in sorted(frame.columns, key=int)}


def append_runs(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").parquet(path)


def load_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("metric_names", F.map_keys("metrics"))
