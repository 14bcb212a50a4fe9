"""The monitoring plan over stored logs: drift check, dashboard record, uptime."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.operators import drift as D
from cohortline.operators import ops_metrics as O
from cohortline.operators.ranked import last_n
from cohortline.session import cut_lineage, pin_small
from cohortline.sources import logs, reports
from cohortline.sources.records import path_exists

# the order of the log itself: times may be unreadable or shifted
EVENT_ORDER = logs.FILE_ORDER
PROBE_ORDER = logs.FILE_ORDER


def rebuild_reference(table: DataFrame, features: Sequence[str], label: str | None, out_dir: str,
                      row_key: Sequence[str] | None = None) -> DataFrame:
    """Reference statistics of a stored table, and its label shares beside them."""
    reference = D.build_reference(table, features, row_key)
    reports.save_reference(reference, f"{out_dir}/reference")
    if label:
        reports.save_reference(D.label_distribution(table, label), f"{out_dir}/reference_labels")
    return reference


def check_drift(spark: SparkSession, log_path: str, out_dir: str, last: int | None = None,
                features: Sequence[str] | None = None) -> DataFrame:
    """One-row summary of the logged features against the stored reference; writes
    the per-feature report, the summary and the current label shares."""
    reference = reports.load_reference(spark, f"{out_dir}/reference")
    events = logs.prediction_events(logs.read_lines(spark, log_path)).filter("features IS NOT NULL")
    if last:
        events = cut_lineage(last_n(events, last, EVENT_ORDER))
    found = pin_small(D.feature_drift(logs.feature_values(events, list(features) if features else None), reference))
    # the sample count and the label shares come from one pass
    labels = pin_small(O.prediction_counts(events))
    n_samples = labels.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    summary = pin_small(D.drift_summary(found, n_samples))
    reports.save_report(D.rounded_report(found), f"{out_dir}/drift_features")
    reports.save_report(summary, f"{out_dir}/drift_summary")
    reports.save_report(O.prediction_shares(labels), f"{out_dir}/prediction_shares")
    return summary


def build_dashboard(spark: SparkSession, prediction_log: str, health_log: str, out_dir: str) -> DataFrame:
    """The dashboard record; drift reads the last stored report or is ``NOT_RUN``."""
    events = logs.prediction_events(logs.read_lines(spark, prediction_log)).drop("features")
    probes = logs.health_events(logs.read_lines(spark, health_log))
    features = head = None
    if path_exists(spark, f"{out_dir}/drift_summary"):
        head_schema = ("checked_at timestamp, n_production_samples bigint, drifted array<string>, watch array<string>, "
                       "stable array<string>, overall_status string, note string")
        head = spark.read.schema(head_schema).json(f"{out_dir}/drift_summary")
        feature_schema = "feature string, psi double, ks_pvalue double, status string, ref_mean double, cur_mean double"
        features = spark.read.schema(feature_schema).json(f"{out_dir}/drift_features")
    # read by several one-row aggregates: parse the log once
    events = events.persist()
    try:
        record = pin_small(O.dashboard(events, probes, features, head, EVENT_ORDER, PROBE_ORDER))
    finally:
        events.unpersist()
    reports.save_report(record, f"{out_dir}/dashboard")
    return record
