"""Tolerant JSON-lines logs: predictions, HTTP requests and health probes.

Lines parse to VARIANT first, so one odd field never drops a whole event; blank,
malformed and non-object lines are skipped. A missing log reads as empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortline.functions import variant as V
from cohortline.functions.text import short_request_id
from cohortline.functions.timefn import iso_now, parse_iso
from cohortline.session import pin_small, store
from cohortline.sources.records import path_exists

FILE_ORDER = ("log_time", "log_file", "log_block", "log_position")


def read_lines(spark: SparkSession, path: str, by_name: bool = False) -> DataFrame:
    """Raw lines with their place in the log: files by their last change, then name (rotated logs
    keep their order), or ``by_name`` alone; lines as they stand in a file. What an event says
    about its time does not matter to its place."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "line string, log_time timestamp, log_file string, log_block bigint, log_position bigint")
    return spark.read.text(path).select(
        F.col("value").alias("line"),
        (F.lit(None).cast("timestamp") if by_name else F.col("_metadata.file_modification_time")).alias("log_time"),
        F.col("_metadata.file_path").alias("log_file"),
        F.col("_metadata.file_block_start").alias("log_block"),
        F.monotonically_increasing_id().alias("log_position"),
    )


def line_numbers(lines: DataFrame) -> DataFrame:
    """With ``log_line``, the number of a line in its file, from 0, equal in every reading. Splits of a file are
    counted side by side; the counts of those before give each its first number."""
    first = lines.groupBy("log_file", "log_block").agg(F.count(F.lit(1)).alias("_n"), F.min("log_position").alias("_first"))
    earlier = W.partitionBy("log_file").orderBy("log_block").rowsBetween(W.unboundedPreceding, -1)
    # one row per split of a file
    starts = first.select(F.col("log_file").alias("_file"), F.col("log_block").alias("_block"), "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    joined = lines.join(pin_small(starts, 100_000), (F.col("log_file") == F.col("_file")) & (F.col("log_block") == F.col("_block")))
    return joined.withColumn("log_line", F.col("_base") + F.col("log_position") - F.col("_first")).drop("_file", "_block", "_first", "_base")


def _events(lines: DataFrame) -> DataFrame:
    order = [c for c in FILE_ORDER if c in lines.columns]
    # exploding the zero or one parsed events drops bad lines after a single parse;
    # a null filter would be pushed below the projection and parse every line again
    return lines.select(F.explode(F.array_compact(F.array(V.parse_line(F.col("line"))))).alias("e"), *order)


def prediction_events(lines: DataFrame) -> DataFrame:
    """One row per prediction event. ``features`` stays VARIANT and is null when
    the logged value is not an object."""
    e = F.col("e")
    events = _events(lines)
    order = [c for c in FILE_ORDER if c in events.columns]
    return events.select(
        parse_iso(V.text_field(e, "timestamp")).alias("ts"),
        V.text_field(e, "request_id").alias("request_id"),
        V.text_field(e, "status").alias("status"),
        V.text_field(e, "prediction").alias("prediction"),
        V.number_field(e, "latency_ms").alias("latency_ms"),
        V.object_field(e, "features").alias("features"),
        V.text_field(e, "error").alias("error"),
        *order,
    )


def http_events(lines: DataFrame) -> DataFrame:
    e = F.col("e")
    events = _events(lines)
    order = [c for c in FILE_ORDER if c in events.columns]
    return events.select(
        parse_iso(V.text_field(e, "timestamp")).alias("ts"),
        V.text_field(e, "request_id").alias("request_id"),
        V.text_field(e, "method").alias("method"),
        V.text_field(e, "path").alias("path"),
        V.field(e, "status_code", "int").alias("status_code"),
        V.number_field(e, "latency_ms").alias("latency_ms"),
        *order,
    )


def health_events(lines: DataFrame) -> DataFrame:
    """Probes; ``detail`` may be an object or a text and stays VARIANT."""
    e = F.col("e")
    events = _events(lines)
    order = [c for c in FILE_ORDER if c in events.columns]
    return events.select(
        V.text_field(e, "timestamp").alias("checked_at"),
        V.text_field(e, "url").alias("url"),
        V.truthy_field(e, "up").alias("up"),
        V.field(e, "status_code", "int").alias("status_code"),
        V.number_field(e, "response_time_ms").alias("response_time_ms"),
        V.field(e, "detail").alias("detail"),
        *order,
    )


def feature_values(events: DataFrame, features: list[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Long form (feature, value) of the logged feature objects: numbers and
    readable texts, without nulls and NaN. ``keep`` columns stay before them."""
    entries = events.filter(F.col("features").isNotNull()).select(*keep, F.explode(V.as_map(F.col("features"))).alias("feature", "v"))
    if features is not None:
        entries = entries.filter(F.col("feature").isin(*features))
    value = F.try_variant_get("v", "$", "double")
    return entries.select(*keep, "feature", value.alias("value")).filter(F.col("value").isNotNull() & ~F.isnan("value"))


def as_log_lines(df: DataFrame, feature_cols: list[str], prediction: Column, status: Column, latency_ms: Column,
                 error: Column | None = None, request_id: Column | None = None) -> DataFrame:
    """Scored rows as prediction-log records, ready for ``append_json``."""
    return df.select(
        iso_now().alias("timestamp"),
        F.lit("INFO").alias("level"),
        F.lit("predictions").alias("logger"),
        F.lit("prediction").alias("message"),
        F.lit("prediction").alias("event"),
        (short_request_id() if request_id is None else request_id).alias("request_id"),
        status.alias("status"),
        prediction.alias("prediction"),
        F.round(latency_ms.cast("double"), 2).alias("latency_ms"),
        F.struct(*[F.col(c).cast("double").alias(c) for c in feature_cols]).alias("features"),
        (F.lit(None).cast("string") if error is None else error).alias("error"),
    )


def append_batch(df: DataFrame, path: str, batch_id: str, day: Column) -> None:
    """Append as JSON lines under ``path``/day=<date>/batch=<id>. A repeated write of a batch replaces its own rows,
    also where they now fall on other days, so a retried job appends once. Readers take the directory."""
    spark = df.sparkSession
    before = _batch_folders(spark, path, batch_id)
    rows = df.withColumns({"day": F.date_format(day, "yyyy-MM-dd"), "batch": F.lit(batch_id)})
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", False).partitionBy("day", "batch").json(path)
    if before:
        days = {r[0] for r in rows.select("day").distinct().collect()}  # one row per day of the batch
        for folder, of_day, files in before:
            if of_day not in days and not (of_day == "__HIVE_DEFAULT_PARTITION__" and None in days):
                files.delete(folder, True)


def _batch_folders(spark: SparkSession, path: str, batch_id: str) -> list[tuple]:
    """(folder, day, file system) of what a batch has written."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path}/day=*/batch={batch_id}")
    files = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.globStatus(pattern) or []
    return [(status.getPath(), status.getPath().getParent().getName().removeprefix("day="), files) for status in found]


def compact_day(spark: SparkSession, path: str, day: str, files: int = 1) -> None:
    """Rewrite each batch of one day into ``files`` files. Batches stay apart, so that a repeated write still finds
    what to replace."""
    lines = store(spark.read.option("basePath", path).text(f"{path}/day={day}").select("value", "day", "batch"), "compacted")
    spread = lines.repartition(F.col("batch"), F.pmod(F.xxhash64("value"), F.lit(files)))
    spread.withColumn("day", F.lit(day)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").text(path)


def append_json(df: DataFrame, path: str) -> None:
    """Append as JSON lines; each write adds files, readers take the directory."""
    df.write.mode("append").option("ignoreNullFields", False).json(path)
