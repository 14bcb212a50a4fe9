"""Windows that close, their sketches and late rows; drift of the recent part of a stream."""

import json
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortline.operators import drift as D
from cohortline.sources import logs
from cohortline.streaming import metrics as M
from cohortline.streaming import recent as RC
from cohortline.streaming import windows as W


def event(minute, latency, status="success", **features):
    stamp = None if minute is None else f"2024-01-0{1 + minute // 1440}T{minute // 60 % 24:02d}:{minute % 60:02d}:00+00:00"
    return json.dumps({"timestamp": stamp, "status": status, "prediction": "normal", "latency_ms": latency, "features": features})


def write_files(folder, batches):
    folder.mkdir(exist_ok=True)
    for i, lines in enumerate(batches):
        path = folder / f"part-{i}.log"
        path.write_text("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder)


def hm(rows):
    return {r["window_start"].strftime("%d %H:%M"): r for r in rows}


def test_windows_close_and_late_rows_are_kept_aside(spark, tmp_path):
    batches = [[event(0, 1.0), event(1, 3.0)], [event(30, 9.0, "error")], [event(0, 100.0), event(31, 3.0), event(None, 5.0)], [event(90, 1.0)], [event(5, 7.0)]]
    path, out = write_files(tmp_path / "log", batches), str(tmp_path / "out")
    W.start_closing_windows(M.stream_predictions(spark, path, max_files=1), out, str(tmp_path / "checkpoint"), "10 minutes", "5 minutes").awaitTermination()
    got = hm(W.window_report(W.closed_windows(spark, out)).collect())
    assert {k: (r["n"], r["errors"], r["avg_latency_ms"], r["p_latency_ms"]) for k, r in got.items()} == {
        "01 00:00": (2, 0, 2.0, 3.0), "01 00:30": (2, 1, 6.0, 9.0)}
    late = W.late_rows(spark, out).select("ts", "latency_ms").collect()
    assert sorted((r["ts"] is None, r["latency_ms"]) for r in late) == [(False, 7.0), (False, 100.0), (True, 5.0)]
    # the last window is still open, behind no watermark
    assert spark.read.schema(W.OPEN_SCHEMA).parquet(f"{out}/open/turn-0", f"{out}/open/turn-1").count() >= 1


def test_a_replayed_trigger_changes_nothing(spark, tmp_path):
    batches = [[event(10 * i + j, float(j)) for j in range(10)] for i in range(6)]
    path, out = write_files(tmp_path / "log", batches), str(tmp_path / "out")
    checkpoint = tmp_path / "checkpoint"

    def run():
        W.start_closing_windows(M.stream_predictions(spark, path, max_files=1), out, str(checkpoint), "10 minutes", "0 minutes").awaitTermination()
        return {k: (r["n"], r["p_latency_ms"]) for k, r in hm(W.window_report(W.closed_windows(spark, out)).collect()).items()}

    first = run()
    assert first == {f"01 00:{10 * i:02d}": (10, 9.0) for i in range(5)}
    last = max(int(p.name) for p in (checkpoint / "commits").iterdir() if p.name.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        (checkpoint / "commits" / name).unlink(missing_ok=True)  # as if the driver was lost before the commit
    assert run() == first


def test_hours_merge_into_days(spark, tmp_path):
    rng = np.random.default_rng(5)
    minutes, latencies = rng.integers(0, 2 * 1440, 9000), rng.exponential(40, 9000)
    events = spark.createDataFrame(pd.DataFrame({
        "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(minutes, unit="m"), "status": "success", "latency_ms": latencies}))
    hours = W.window_sums(events, "1 hour")
    days = W.merge_sums(hours, "1 day")
    assert hours.count() == 48
    for r in W.window_report(days, 0.95).collect():
        inside = latencies[(minutes // 1440) == r["window_start"].day - 1]
        assert r["n"] == len(inside) and r["avg_latency_ms"] == pytest.approx(inside.mean())
        assert abs((inside <= r["p_latency_ms"]).mean() - 0.95) <= W.RANK_ERROR + 1 / len(inside)
    none = W.window_report(W.merge_sums(W.window_sums(events.withColumn("latency_ms", F.lit(None).cast("double")), "1 hour"), "1 day")).first()
    assert none["avg_latency_ms"] is None and none["p_latency_ms"] is None


# -- recent drift ----------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def reference(spark):
    rng = np.random.default_rng(6)
    return D.build_reference(spark.createDataFrame(pd.DataFrame({"id": range(900), "x": rng.normal(0, 1, 900), "y": rng.integers(0, 9, 900) * 1.0})), ["x", "y"], ["id"])


@pytest.fixture(scope="module")
def shifting():
    """Five files of an hour each, drifting away; one in ten rows without features."""
    rng = np.random.default_rng(7)
    return [[event(60 * i + j % 60, 1.0, **({} if j == 5 else {"x": float(v), "y": float(j % 9)})) if j % 10 else json.dumps({"status": "success"})
             for j, v in enumerate(rng.normal(0.3 * i, 1, 80))] for i in range(5)]


def reported(df):
    return {r["feature"]: (r["n_current"], round(r["psi"], 9), round(r["ks_stat"], 9), r["status"], round(r["cur_mean"], 9)) for r in df.collect()}


@pytest.mark.parametrize("last, files, refresh", [(RC.Last(triggers=2), 2, 100), (RC.Last(events=100), 2, 2), (RC.Last(hours=3), 3, 100)])
def test_recent_drift_equals_the_batch_on_the_same_rows(spark, tmp_path, reference, shifting, last, files, refresh):
    path = write_files(tmp_path / "log", shifting)
    report = str(tmp_path / "report")
    RC.start_recent_drift(M.stream_predictions(spark, path, max_files=1), reference, last, str(tmp_path / "ring"), report,
                          str(tmp_path / "checkpoint"), refresh=refresh).awaitTermination()
    kept = write_files(tmp_path / "kept", shifting[-files:])
    events = logs.prediction_events(logs.read_lines(spark, kept))
    assert reported(spark.read.parquet(report)) == reported(D.feature_drift(logs.feature_values(events), reference))


def test_events_of_expired_hours_do_not_count(spark, tmp_path, reference, shifting):
    path = write_files(tmp_path / "log", [*shifting[1:3], shifting[0], [event(60 * 2, 1.0, x=0.5)]])
    report = str(tmp_path / "report")
    RC.start_recent_drift(M.stream_predictions(spark, path, max_files=1), reference, RC.Last(hours=2), str(tmp_path / "ring"), report,
                          str(tmp_path / "checkpoint")).awaitTermination()
    kept = write_files(tmp_path / "kept", [*shifting[1:3], [event(60 * 2, 1.0, x=0.5)]])
    events = logs.prediction_events(logs.read_lines(spark, kept))
    assert reported(spark.read.parquet(report)) == reported(D.feature_drift(logs.feature_values(events), reference))


def test_one_kind_of_recency():
    with pytest.raises(ValueError):
        RC.Last()
    with pytest.raises(ValueError):
        RC.Last(triggers=1, hours=2)
    assert RC.Last(events=5).live({(0, 0): 9, (1, 1): 3, (2, 2): 3}) == {(2, 2), (1, 1)}
