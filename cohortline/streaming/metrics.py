"""Structured Streaming over the logs, and the batch twins of its aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortline.operators import drift as D
from cohortline.operators.ranked import last_n
from cohortline.sources import logs


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Log lines of a growing directory as a stream."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).select(F.col("value").alias("line"))


def stream_predictions(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    return logs.prediction_events(stream_lines(spark, path, max_files))


def _failed():
    return ~F.col("status").eqNullSafe(F.lit("success"))


def running_totals(events: DataFrame) -> DataFrame:
    """Cumulative counts and latency sums by status; state is one row per status."""
    return events.groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.sum("latency_ms").alias("latency_sum_ms"), F.count("latency_ms").alias("latency_count"))


def window_metrics(events: DataFrame, width: str = "1 minute", lateness: str | None = None, percentile: bool = True) -> DataFrame:
    """Count, errors, mean and approximate p95 latency per event-time window. With
    ``lateness`` the windows close behind a watermark, and later rows are dropped."""
    if lateness:
        events = events.withWatermark("ts", lateness)
    measures = [
        F.count(F.lit(1)).alias("n"), F.count_if(_failed()).alias("errors"), F.avg("latency_ms").alias("avg_latency_ms"),
    ]
    if percentile:
        measures.append(F.percentile_approx("latency_ms", 0.95, 10_000).alias("p95_latency_ms"))
    grouped = events.groupBy(F.window("ts", width)).agg(*measures)
    return grouped.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                          *[c for c in grouped.columns if c != "window"])


def running_uptime(probes: DataFrame, order: str = "checked_at") -> DataFrame:
    return probes.groupBy().agg(
        F.count(F.lit(1)).alias("probes"),
        F.round(100.0 * F.avg(F.col("up").cast("int")), 2).alias("uptime_pct"),
        F.round(F.avg("response_time_ms"), 2).alias("avg_response_ms"),
        F.max_by(F.when(F.col("up"), "UP").otherwise("DOWN"), F.col(order)).alias("last_status"),
        F.max_by(F.col("checked_at"), F.col(order)).alias("last_check"),
    )


def start_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "complete",
                available_now: bool = True) -> StreamingQuery:
    """Keep the current result of a streaming aggregate as parquet: each trigger of
    ``complete`` replaces it, ``append`` adds closed rows."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if mode == "complete":
            batch.write.mode("overwrite").parquet(path)
        else:
            # one folder per trigger, so that a replayed trigger replaces its own rows
            batch.write.mode("overwrite").parquet(f"{path}/trigger={batch_id}")

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_drift(predictions: DataFrame, reference: DataFrame, counts_path: str, report_path: str, checkpoint: str,
                features: list[str] | None = None, available_now: bool = True) -> StreamingQuery:
    """Drift of everything seen so far, per trigger. A trigger adds its place counts to
    those of the trigger before and keeps the sum: two folders take turns, so that a
    replayed trigger starts from the same sum, and neither the report's cost nor the
    stored counts grow with the number of triggers."""
    def check(batch: DataFrame, batch_id: int) -> None:
        counts = D.place_counts(logs.feature_values(batch, features), reference)
        if batch_id > 0:
            earlier = batch.sparkSession.read.schema(counts.schema).parquet(f"{counts_path}/turn-{(batch_id - 1) % 2}")
            counts = earlier.unionByName(counts).groupBy("feature", "bin", "place", "on_point").agg(
                F.sum("n").alias("n"), F.sum("total").alias("total"))
        path = f"{counts_path}/turn-{batch_id % 2}"
        counts.write.mode("overwrite").parquet(path)
        report = D.drift_from_counts(batch.sparkSession.read.schema(counts.schema).parquet(path), reference)
        report.repartition(1).write.mode("overwrite").parquet(report_path)

    writer = predictions.writeStream.option("checkpointLocation", checkpoint).foreachBatch(check)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def recent_drift(events: DataFrame, reference: DataFrame, last: int, order: list[str], features: list[str] | None = None) -> DataFrame:
    """Drift of the last ``last`` events that carry a feature object."""
    recent = last_n(events.filter("features IS NOT NULL"), last, order)
    return D.feature_drift(logs.feature_values(recent, features), reference)
