"""Operational metrics over parsed logs: latency, errors, classes, uptime, HTTP."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.functions.status import is_predict_path, severity
from cohortline.operators.ranked import exact_quantiles, last_n

LATENCY_PROBS = (0.50, 0.95, 0.99)


def _is_error():
    return ~F.col("status").eqNullSafe(F.lit("success"))


def api_metrics(events: DataFrame) -> DataFrame:
    """One row: total, errors (anything but success, missing included), error rate
    in percent and mean latency; zeros for an empty log."""
    return events.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.count_if(_is_error()).alias("errors"),
        F.coalesce(F.round(F.avg("latency_ms"), 2), F.lit(0.0)).alias("avg_latency_ms"),
    ).withColumn(
        "error_rate_pct",
        F.when(F.col("total_predictions") > 0, F.round(100.0 * F.col("errors") / F.col("total_predictions"), 2)).otherwise(0.0),
    ).select("total_predictions", "errors", "error_rate_pct", "avg_latency_ms")


def latency_percentiles(events: DataFrame, approximate: bool = False) -> DataFrame:
    """One row (p50, p95, p99), two decimals, 0.0 for an empty log."""
    values = events.filter("latency_ms IS NOT NULL").select(F.lit(0).alias("g"), F.col("latency_ms"))
    if approximate:
        q = values.agg(F.percentile_approx("latency_ms", list(LATENCY_PROBS), 10_000).alias("quantiles"))
    else:
        q = exact_quantiles(values, "g", "latency_ms", LATENCY_PROBS).agg(F.first("quantiles").alias("quantiles"))
    return q.select(*[
        F.coalesce(F.round(F.get("quantiles", F.lit(i)), 2), F.lit(0.0)).alias(name)
        for i, name in enumerate(("p50_latency_ms", "p95_latency_ms", "p99_latency_ms"))
    ])


def class_counts(events: DataFrame) -> DataFrame:
    """(prediction, n) over successful events with a non-empty label, most frequent
    first."""
    counts = events.filter("status = 'success' AND prediction <> ''").groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "prediction")


def prediction_counts(events: DataFrame) -> DataFrame:
    """(prediction, n) over events with a feature object, a missing label included."""
    return events.filter("features IS NOT NULL").groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))


def prediction_shares(counts: DataFrame) -> DataFrame:
    """(prediction, share) of the present labels, three decimals."""
    counts = counts.filter("prediction IS NOT NULL")
    return counts.select("prediction", F.round(F.col("n") / counts.agg(F.sum("n")).scalar(), 3).alias("share"))


def latency_trend(events: DataFrame, order: Sequence[str], n: int = 50) -> DataFrame:
    """One row with the last n latencies, oldest first."""
    recent = last_n(events.filter("latency_ms IS NOT NULL").select("latency_ms", *order), n, order)
    entries = F.array_sort(F.collect_list(F.struct(*order, "latency_ms")))
    return recent.agg(F.transform(entries, lambda s: s["latency_ms"]).alias("latency_trend"))


def uptime(probes: DataFrame, order: Sequence[str], window: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Probe count, percent up, mean response over the non-null times (down probes
    included), last status and check; nulls for an empty log. ``window`` keeps the
    last probes only; ``keys`` reports per key instead of overall."""
    if window:
        probes = last_n(probes, window, order)
    position = F.struct(*order)
    grouped = probes.groupBy(*keys) if keys else probes.groupBy()
    return grouped.agg(
        F.count(F.lit(1)).alias("probes"),
        F.round(100.0 * F.avg(F.col("up").cast("int")), 2).alias("uptime_pct"),
        F.round(F.avg("response_time_ms"), 2).alias("avg_response_ms"),
        F.max_by(F.when(F.col("up"), "UP").otherwise("DOWN"), position).alias("last_status"),
        F.max_by(F.col("checked_at"), position).alias("last_check"),
    )


def http_counters(events: DataFrame) -> DataFrame:
    """One row of request totals; a request without a status code is a 500."""
    code = F.coalesce("status_code", F.lit(500))
    predict = is_predict_path(F.col("path"))
    return events.agg(
        F.count(F.lit(1)).alias("requests_total"),
        F.count_if(predict).alias("predict_requests_total"),
        F.count_if(predict & (code >= 400)).alias("predict_errors_total"),
        F.coalesce(F.sum("latency_ms"), F.lit(0.0)).alias("latency_sum_ms"),
        F.count("latency_ms").alias("latency_count"),
        F.coalesce(F.avg("latency_ms"), F.lit(0.0)).alias("latency_avg_ms"),
    )


def requests_by_status(events: DataFrame) -> DataFrame:
    return (
        events.groupBy(F.coalesce("status_code", F.lit(500)).cast("string").alias("status_code"))
        .agg(F.count(F.lit(1)).alias("n")).orderBy("status_code")
    )


def dashboard(events: DataFrame, probes: DataFrame, drift_features: DataFrame | None, drift_head: DataFrame | None,
              event_order: Sequence[str], probe_order: Sequence[str]) -> DataFrame:
    """Everything the monitoring page shows as one row of structs; each part is a
    one-row aggregate taken in as a scalar subquery."""
    def packed(df):
        return df.select(F.struct("*").alias("part")).scalar()

    api = events.sparkSession.range(1).select(
        packed(api_metrics(events)).alias("a"), packed(latency_percentiles(events)).alias("p"),
        packed(latency_trend(events, event_order)).alias("t"),
    ).select("a.*", "p.*", "t.*")
    classes = class_counts(events).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("prediction", "n")))).alias("class_distribution"))
    health = uptime(probes, probe_order).withColumn("severity", severity(F.col("last_status")))
    texts = "array<string>"
    if drift_head is None:
        drift = events.sparkSession.range(1).select(
            F.lit("NOT_RUN").alias("overall_status"), F.array().cast(texts).alias("drifted_features"),
            F.array().cast(texts).alias("watch_features"), F.lit(0).cast("bigint").alias("n_samples"),
            F.array().cast("array<struct<feature:string,psi:double,ks_pvalue:double,status:string,ref_mean:double,cur_mean:double>>").alias("features"))
    else:
        rows = drift_features.agg(F.sort_array(F.collect_list(
            F.struct("feature", "psi", "ks_pvalue", "status", "ref_mean", "cur_mean"))).alias("features"))
        drift = drift_head.select(
            "overall_status", F.col("drifted").alias("drifted_features"), F.col("watch").alias("watch_features"),
            F.col("n_production_samples").alias("n_samples"), rows.scalar().alias("features"))
    return events.sparkSession.range(1).select(
        F.current_timestamp().alias("generated_at"), packed(api).alias("api_metrics"), packed(classes).alias("model_metrics"),
        packed(health).alias("health"), packed(drift).alias("drift"))
