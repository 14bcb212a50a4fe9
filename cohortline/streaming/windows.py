"""Event-time windows that close, with a side table of the rows that came too late.

Every trigger adds its rows to the open windows, moves the watermark (the latest time of all earlier
triggers less ``lateness``), appends the windows behind it to the table of closed ones and keeps the
others. A row whose window is already closed goes to the table of late rows instead. Each window
carries a quantile sketch (KLL), which merges: hours into days, or shards of a log into one.

The state is a table of open windows and one of the latest time; two folders take turns, so that a
replayed trigger starts from the same state and replaces what it wrote before. It holds one row per
open window, whatever the number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortline.session import pin_small

#: Size parameter of the sketch, and the error of a rank it stands for, as a share of a window's rows.
SKETCH_K = 2048
RANK_ERROR = 0.002

OPEN_SCHEMA = ("window_start timestamp, window_end timestamp, n bigint, errors bigint, latency_sum_ms double, latency_count bigint, "
               "latency_sketch binary")


def window_sums(events: DataFrame, width: str, sketch_k: int = SKETCH_K) -> DataFrame:
    """Mergeable sums of each window: rows, errors, latencies and their sketch (null without latencies)."""
    failed = ~F.col("status").eqNullSafe(F.lit("success"))
    return events.groupBy(F.window("ts", width).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(failed).alias("errors"), F.coalesce(F.sum("latency_ms"), F.lit(0.0)).alias("latency_sum_ms"),
        F.count("latency_ms").alias("latency_count"), F.kll_sketch_agg_double("latency_ms", sketch_k).alias("latency_sketch"),
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "errors", "latency_sum_ms", "latency_count",
             F.when(F.col("latency_count") > 0, F.col("latency_sketch")).alias("latency_sketch"))


def merge_sums(sums: DataFrame, width: str | None = None, sketch_k: int = SKETCH_K) -> DataFrame:
    """Sums of the same window added up, or with ``width`` those of all windows within a wider one."""
    keys = [F.col("window_start"), F.col("window_end")]
    if width:
        wide = F.window("window_start", width)
        keys = [wide["start"].alias("window_start"), wide["end"].alias("window_end")]
    return sums.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("errors").alias("errors"), F.sum("latency_sum_ms").alias("latency_sum_ms"),
        F.sum("latency_count").alias("latency_count"), F.kll_merge_agg_double("latency_sketch", sketch_k).alias("latency_sketch"),
    ).withColumn("latency_sketch", F.when(F.col("latency_count") > 0, F.col("latency_sketch")))


def window_report(sums: DataFrame, quantile: float = 0.95) -> DataFrame:
    """(window_start, window_end, n, errors, avg_latency_ms, p_latency_ms): mean and sketched quantile, null
    without latencies."""
    return sums.select(
        "window_start", "window_end", "n", "errors",
        F.when(F.col("latency_count") > 0, F.col("latency_sum_ms") / F.col("latency_count")).alias("avg_latency_ms"),
        F.kll_sketch_get_quantile_double("latency_sketch", F.lit(quantile)).alias("p_latency_ms"))


def _turn(path: str, what: str, batch_id: int) -> str:
    return f"{path}/{what}/turn-{batch_id % 2}"


def start_closing_windows(events: DataFrame, path: str, checkpoint: str, width: str = "1 hour", lateness: str = "10 minutes",
                          sketch_k: int = SKETCH_K, available_now: bool = True) -> StreamingQuery:
    """Writes ``path``/closed (sums of closed windows) and ``path``/late (the late rows), a folder per trigger.
    Rows without a time belong to no window and go to the late table as well."""
    def close(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()  # read by four small jobs
        try:
            # one row, null before the first time
            if batch_id > 0:
                seen = spark.read.schema("latest timestamp").parquet(_turn(path, "latest", batch_id - 1)).first()["latest"]
                earlier = spark.read.schema(OPEN_SCHEMA).parquet(_turn(path, "open", batch_id - 1))
            else:
                seen, earlier = None, spark.createDataFrame([], OPEN_SCHEMA)
            newest = batch.agg(F.max("ts")).first()[0]
            latest = max((t for t in (seen, newest) if t is not None), default=None)

            def behind(time, mark):
                return F.lit(False) if mark is None else F.coalesce(time <= F.lit(mark) - F.expr(f"INTERVAL {lateness}"), F.lit(False))

            timed = batch.filter("ts IS NOT NULL")  # a window function drops rows without a time
            is_late = behind(F.window("ts", width)["end"], seen)
            late = batch.filter("ts IS NULL").unionByName(timed.filter(is_late).select(*batch.columns))
            late.write.mode("overwrite").parquet(f"{path}/late/trigger={batch_id}")
            fresh = window_sums(timed.filter(~is_late).select(*batch.columns), width, sketch_k)
            sums = pin_small(merge_sums(earlier.unionByName(fresh), sketch_k=sketch_k))
            closed = behind(F.col("window_end"), latest)
            sums.filter(closed).write.mode("overwrite").parquet(f"{path}/closed/trigger={batch_id}")
            sums.filter(~closed).write.mode("overwrite").parquet(_turn(path, "open", batch_id))
            spark.createDataFrame([(latest,)], "latest timestamp").coalesce(1).write.mode("overwrite").parquet(_turn(path, "latest", batch_id))
        finally:
            batch.unpersist()

    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(close)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def closed_windows(spark: SparkSession, path: str) -> DataFrame:
    """Sums of all closed windows; each window is there once."""
    return spark.read.schema(OPEN_SCHEMA).parquet(f"{path}/closed")


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/late").drop("trigger")
