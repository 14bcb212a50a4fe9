import json
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortline.operators import drift as D
from cohortline.sources import logs
from cohortline.streaming import metrics as M


def write_files(folder, batches):
    folder.mkdir(exist_ok=True)
    for i, lines in enumerate(batches):
        (folder / f"part-{i}.log").write_text("\n".join(lines) + "\n")
    return str(folder)


def event(minute, latency, status="success", **features):
    return json.dumps({"timestamp": f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:00+00:00", "status": status, "prediction": "normal",
                       "latency_ms": latency, "features": features})


def run(stream, tmp_path, mode="complete"):
    out = str(tmp_path / "out")
    M.start_table(stream, out, str(tmp_path / "checkpoint"), mode).awaitTermination()
    return out


def test_totals_equal_the_batch(spark, tmp_path):
    path = write_files(tmp_path / "log", [[event(1, 5.0), "{bad", ""], [event(2, 7.0, "error"), event(3, 1.0)], [event(4, 2.0)]])
    out = run(M.running_totals(M.stream_predictions(spark, path, max_files=1)), tmp_path)
    streamed = {tuple(r) for r in spark.read.parquet(out).collect()}
    batch = {tuple(r) for r in M.running_totals(logs.prediction_events(logs.read_lines(spark, path))).collect()}
    assert streamed == batch == {("success", 3, 8.0, 3), ("error", 1, 7.0, 1)}


def test_closed_windows_and_late_rows(spark, tmp_path):
    # files are read one per trigger; the fourth holds a row far behind the watermark
    path = write_files(tmp_path / "log", [
        [event(0, 1.0), event(1, 3.0)], [event(30, 9.0)], [event(32, 9.0)], [event(0, 100.0), event(31, 3.0)], [event(90, 1.0)], [event(91, 1.0)]])
    for i in range(6):
        os.utime(tmp_path / "log" / f"part-{i}.log", (1_700_000_000 + i, 1_700_000_000 + i))
    stream = M.window_metrics(M.stream_predictions(spark, path, max_files=1), "10 minutes", "5 minutes")
    out = run(stream, tmp_path, "append")
    rows = {r["window_start"].strftime("%H:%M"): (r["n"], r["avg_latency_ms"], r["p95_latency_ms"]) for r in spark.read.parquet(out).collect()}
    assert rows == {"00:00": (2, 2.0, 3.0), "00:30": (3, 7.0, 9.0)}


def test_uptime_stream(spark, tmp_path):
    probes = [json.dumps({"up": up, "response_time_ms": ms, "timestamp": f"t{i}"}) for i, (up, ms) in enumerate([(True, 10), (True, 12), (False, 5000), (True, 11)])]
    path = write_files(tmp_path / "health", [probes[:2], probes[2:]])
    out = run(M.running_uptime(logs.health_events(M.stream_lines(spark, path, max_files=1))), tmp_path)
    assert tuple(spark.read.parquet(out).first()) == (4, 75.0, 1258.25, "UP", "t3")


def test_drift_stream_equals_the_batch(spark, tmp_path):
    rng = np.random.default_rng(6)
    reference = D.build_reference(spark.createDataFrame(pd.DataFrame({"id": range(800), "x": rng.normal(0, 1, 800)})), ["x"], ["id"])
    lines = [event(i, 1.0, x=float(v)) for i, v in enumerate(rng.normal(0.5, 1, 300))]
    path = write_files(tmp_path / "log", [lines[:100], lines[100:180], lines[180:]])
    report = str(tmp_path / "report")
    M.start_drift(M.stream_predictions(spark, path, max_files=1), reference, str(tmp_path / "counts"), report, str(tmp_path / "checkpoint")).awaitTermination()
    got = spark.read.parquet(report).first()
    events = logs.prediction_events(logs.read_lines(spark, path))
    want = D.feature_drift(logs.feature_values(events), reference).first()
    assert got["n_current"] == 300 and got["psi"] == pytest.approx(want["psi"]) and got["ks_stat"] == want["ks_stat"] and got["status"] == want["status"]
    recent = M.recent_drift(events, reference, 50, ["ts"]).first()
    assert recent["n_current"] == 50


def test_windows_need_a_timestamp_type(spark):
    events = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts, 'success' AS status, 1.0D AS latency_ms")
    from cohortline.functions.timefn import event_time
    row = M.window_metrics(events.withColumn("ts", event_time(F.col("ts"))), "1 hour").first()
    assert row["n"] == 1


@pytest.mark.parametrize("name, key, form", [("windowed_p95", "window_start", "yyyy-MM-dd HH:00:00"), ("stream_windows_p95", "day", "yyyy-MM-dd")])
def test_registered_p95_within_its_error(spark, sf_dir, tmp_path, name, key, form):
    import __spark_entry__ as entry
    from cohortline.plans import driver_queries as Q

    events = Q._prediction_like(spark, sf_dir)
    if name.startswith("stream"):
        Q._log_lines(spark, sf_dir).write.text(str(tmp_path / "lines"))
        events = logs.prediction_events(logs.read_lines(spark, str(tmp_path / "lines"))).filter("ts IS NOT NULL")
    values = events.groupBy(F.date_format("ts", form).alias("at")).agg(F.collect_list("latency_ms").alias("v")).collect()
    values = {r["at"]: np.array(r["v"]) for r in values}
    got = {r[key]: r["p95_latency_ms"] for r in entry.queries()[name](spark, sf_dir).collect()}
    assert got and set(got) == set(values)
    for at, p95 in got.items():
        if len(values[at]):
            # the rank is off by a ten thousandth of the rows at most
            slack = len(values[at]) / 10_000
            assert (values[at] < p95).sum() - slack <= 0.95 * len(values[at]) <= (values[at] <= p95).sum() + slack
