import itertools
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortline.functions.numeric import flag_sum, ks_exact_p_value, ks_p_value, psi_term, to_number, with_count_at_most
from cohortline.functions.status import drift_status, is_predict_path, severity
from cohortline.functions.text import follow_up_tag, row_fingerprint, short_request_id, stable_hash
from cohortline.operators import drift as D
from cohortline.operators import ops_metrics as O
from cohortline.plans import monitor
from cohortline.sources import logs, reports


def values(spark, **features):
    rows = [(f, None if v is None else float(v)) for f, vs in features.items() for v in vs]
    return spark.createDataFrame(rows, "feature string, value double").repartition(3)


def numpy_psi(ref, cur, edges):
    r, _ = np.histogram(ref, bins=edges)
    c, _ = np.histogram(cur, bins=edges)
    c = c / c.sum() if c.sum() else np.zeros(len(c))
    r, c = np.clip(r / r.sum(), 1e-6, None), np.clip(c, 1e-6, None)
    return float(((c - r) * np.log(c / r)).sum())


def ks_brute(a, b):
    points = np.concatenate([a, b])
    return max(abs((a <= x).mean() - (b <= x).mean()) for x in points)


def one(spark, cur, ref, **kw):
    reference = D.build_reference(spark.createDataFrame(pd.DataFrame({"id": range(len(ref)), "x": np.array(ref, dtype=float)})), ["x"], ["id"])
    return D.feature_drift(values(spark, x=cur), reference, **kw).first()


@pytest.mark.parametrize("stretch, status", [(1.0, "STABLE"), (4.0, "DRIFT")])
def test_status_follows_the_stretch_of_waiting_times(spark, stretch, status):
    """Exponential waits against the same waits and much longer ones."""
    waits = np.random.default_rng(17).exponential(3.0, 1800)
    assert one(spark, waits * stretch, waits)["status"] == status


@pytest.mark.parametrize("seed", range(4))
def test_psi_and_ks_match_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    ref = np.round(rng.normal(10, 3, 700), seed % 3)
    cur = np.round(rng.normal(10.5, 3.5, 900), seed % 3)
    got = one(spark, cur, ref)
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, 11)))
    assert got["psi"] == pytest.approx(numpy_psi(ref, cur, edges), rel=1e-9)
    assert got["ks_stat"] == pytest.approx(ks_brute(ref, cur), abs=1e-12)
    assert got["ref_mean"] == pytest.approx(ref.mean()) and got["cur_mean"] == pytest.approx(cur.mean())
    frames = [values(spark, x=v) for v in (ref, cur)]
    assert D.ks_two_sample(*frames).first()["ks_stat"] == pytest.approx(ks_brute(ref, cur), abs=1e-12)


def test_few_distinct_values_use_even_edges(spark):
    got = D.quantile_edges(values(spark, c=[5.0] * 20, b=[0.0] * 5 + [1.0] * 50))
    edges = {r["feature"]: r["edges"] for r in got.collect()}
    assert edges["c"] == pytest.approx([5.0, 5.0 + 5e-10, 5.0 + 1e-9], abs=1e-12) and len(edges["c"]) == 3
    assert edges["b"] == pytest.approx([0.0, 0.5, 1.0], abs=1e-8)


def test_values_outside_the_edges_are_dropped_unless_asked(spark):
    ref = list(range(100))
    outside = one(spark, [500.0] * 10, ref)
    assert outside["psi"] == pytest.approx(numpy_psi(ref, [500.0] * 10, np.quantile(ref, np.linspace(0, 1, 11))))
    hist = D.histogram(values(spark, x=[-5, 0, 99, 99, 500]), D.quantile_edges(values(spark, x=ref)))
    assert [(r["bin"], r["n"]) for r in hist.orderBy("bin").collect() if r["n"]] == [(1, 1), (10, 2)]
    counted = D.histogram(values(spark, x=[-5, 0, 99, 99, 500]), D.quantile_edges(values(spark, x=ref)), count_outside=True)
    assert [(r["bin"], r["n"]) for r in counted.orderBy("bin").collect() if r["n"]] == [(1, 2), (10, 3)]


def test_bad_values_are_ignored_and_unknown_features_skipped(spark):
    reference = D.build_reference(spark.range(200).withColumn("x", F.col("id") * 1.0).withColumn("y", F.lit(None).cast("double")), ["x", "y", "absent"], ["id"])
    assert [r["feature"] for r in reference.collect()] == ["x"]
    got = D.feature_drift(values(spark, x=[1, 2, float("nan"), None], other=[1]), reference).collect()
    assert [(r["feature"], r["n_current"]) for r in got] == [("x", 2)]


def test_reference_shape_and_sample_stability(spark):
    df = spark.range(5000).withColumn("x", F.col("id") % 1000 * 1.0)
    a = D.build_reference(df, ["x"], ["id"]).first()
    b = D.build_reference(df.repartition(9), ["x"], ["id"]).first()
    assert len(a["edges"]) == 11 and len(a["proportions"]) == 10 and sum(a["proportions"]) == pytest.approx(1.0) and len(a["sample"]) == 2000
    assert a["sample"] == b["sample"] and a["edges"] == pytest.approx(b["edges"])
    assert a["std"] == pytest.approx(np.std(np.arange(5000) % 1000, ddof=1))


def test_counts_of_batches_add_up(spark):
    rng = np.random.default_rng(2)
    ref, cur = rng.normal(0, 1, 500), rng.normal(0.3, 1, 600)
    reference = D.build_reference(spark.createDataFrame(pd.DataFrame({"id": range(500), "x": ref})), ["x"], ["id"])
    parts = D.place_counts(values(spark, x=cur[:200]), reference).unionByName(D.place_counts(values(spark, x=cur[200:]), reference))
    whole = D.feature_drift(values(spark, x=cur), reference).first()
    added = D.drift_from_counts(parts, reference).first()
    assert added["psi"] == pytest.approx(whole["psi"]) and added["ks_stat"] == whole["ks_stat"] and added["n_current"] == 600


def test_status_grid(spark):
    grid = [(0.05, 0.0, "STABLE"), (0.10, 0.0, "STABLE"), (0.11, 0.2, "WATCH"), (0.11, 0.04, "DRIFT"), (0.11, None, "WATCH"), (0.25, 0.05, "WATCH"), (0.26, None, "DRIFT")]
    df = spark.createDataFrame(grid, "psi double, p double, want string")
    assert df.filter(drift_status(F.col("psi"), F.col("p")) != F.col("want")).count() == 0
    states = spark.createDataFrame([("up", "ok"), ("Watch", "warn"), ("DRIFT", "alert"), ("huh", "warn"), (None, "warn")], "s string, want string")
    assert states.filter(severity(F.col("s")) != F.col("want")).count() == 0


def test_summary_takes_the_worst_status(spark):
    df = spark.createDataFrame([("a", "STABLE"), ("b", "WATCH"), ("c", "DRIFT")], "feature string, status string")
    assert D.drift_summary(df, 3).first()["overall_status"] == "DRIFT"
    row = D.drift_summary(df.filter("status <> 'DRIFT'"), 3).first()
    assert (row["overall_status"], row["watch"], row["drifted"]) == ("WATCH", ["b"], [])
    empty = D.drift_summary(df.limit(0), 0).first()
    assert empty["overall_status"] is None and empty["note"]


def test_label_distribution(spark):
    df = spark.createDataFrame([(0,), (0,), (1,), (None,)], "y int")
    assert [tuple(r) for r in D.label_distribution(df, "y").collect()] == [("0", 2 / 3), ("1", 1 / 3)]


# -- expressions -----------------------------------------------------------------------------------------------

def test_expressions(spark):
    df = spark.createDataFrame([(1, None, "7"), (1, 1, "x"), (0, 1, "NaN")], "a int, b int, t string")
    rows = df.select(flag_sum(["a", "b"]).alias("s"), flag_sum(["a", "b"], True).alias("f"), to_number(F.col("t")).alias("n")).collect()
    assert [tuple(r) for r in rows] == [(None, 1, 7.0), (2, 2, None), (1, 1, None)]
    paths = spark.createDataFrame([("/predict", True), ("/api/predict//", True), ("/predictx", False), ("/health", False)], "p string, w boolean")
    assert paths.filter(is_predict_path(F.col("p")) != F.col("w")).count() == 0
    tags = spark.createDataFrame([("systemic_LUPUS_x",), ("normal",)], "l string").select(follow_up_tag(F.col("l")).alias("t"))
    assert [r["t"] for r in tags.collect()] == ["specialist", "general"]
    assert len(spark.range(1).select(short_request_id().alias("r")).first()["r"]) == 8
    shifted = spark.createDataFrame([("x", None), (None, "x")], "a string, b string")
    assert shifted.select(row_fingerprint("a", "b").alias("f")).distinct().count() == 1
    assert shifted.select(row_fingerprint("a", "b", strict=True).alias("f")).distinct().count() == 2
    assert spark.range(1).select(psi_term(F.lit(0.0), F.lit(0.0)).alias("z")).first()["z"] == 0.0
    points = spark.createDataFrame([(x, [1.0, 2.0, 2.0, 5.0]) for x in (0.0, 1.0, 2.0, 9.0)], "x double, p array<double>")
    for most in (4, 5, 100):
        assert [r["c"] for r in with_count_at_most(points, "x", "p", most, "c").orderBy("x").collect()] == [0, 1, 3, 4]
    assert "aggregate(" not in with_count_at_most(points, "x", "p", 4, "c")._jdf.queryExecution().executedPlan().toString()
    spread = spark.range(4000).select(stable_hash("id").alias("h")).agg(F.avg("h"), F.min("h"), F.max("h")).first()
    assert 0 <= spread[1] and spread[2] < 2 ** 32 and abs(spread[0] / 2 ** 31 - 1) < 0.05


# -- logs ------------------------------------------------------------------------------------------------------

ODD_LINES = [
    "", "   ", "{broken", "5", "[1]",
    '{"status":"success","prediction":"normal","latency_ms":12.5,"features":{"Age":40.0,"ESR":"20","bad":"x","nil":null,"yes":true}}',
    '{"status":"success","prediction":"","latency_ms":"7"}',
    '{"status":"error","prediction":null,"latency_ms":null,"features":{"Age":50}}',
    '{"prediction":"normal","latency_ms":true,"features":"none"}',
]


def log_of(spark, tmp_path, lines, name="predictions.log"):
    (tmp_path / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(tmp_path / name)


def test_odd_log_lines(spark, tmp_path):
    events = logs.prediction_events(logs.read_lines(spark, log_of(spark, tmp_path, ODD_LINES)))
    assert events.count() == 4
    row = O.api_metrics(events).first()
    assert tuple(row) == (4, 2, 50.0, 6.75)
    assert [tuple(r) for r in O.class_counts(events).collect()] == [("normal", 1)]
    assert {tuple(r) for r in logs.feature_values(events).collect()} == {("Age", 40.0), ("ESR", 20.0), ("yes", 1.0), ("Age", 50.0)}
    assert logs.feature_values(events, ["Age"]).count() == 2
    assert O.latency_trend(events, monitor.EVENT_ORDER).first()[0] == [12.5, 1.0]
    assert [tuple(r) for r in O.prediction_shares(O.prediction_counts(events)).collect()] == [("normal", 1.0)]


def test_percentiles(spark):
    events = spark.range(41).select((F.pmod(F.col("id") * 17, F.lit(41)) * 2.5).alias("latency_ms"))  # 0 to 100 in steps of 2.5
    assert tuple(O.latency_percentiles(events).first()) == (50.0, 95.0, 99.0)
    assert tuple(O.latency_percentiles(events.filter("latency_ms < 0")).first()) == (0.0, 0.0, 0.0)
    assert O.latency_percentiles(events, approximate=True).first()[1] >= 92.5


def test_empty_log_gives_zeros(spark, tmp_path):
    events = logs.prediction_events(logs.read_lines(spark, str(tmp_path / "none.log")))
    assert tuple(O.api_metrics(events).first()) == (0, 0, 0.0, 0.0)
    probes = logs.health_events(logs.read_lines(spark, str(tmp_path / "none.log")))
    assert tuple(O.uptime(probes, monitor.PROBE_ORDER).first()) == (0, None, None, None, None)


# eight probes a minute apart, two down, the last one down too; one without a response time
PROBES = [
    {"up": minute not in (3, 7), "response_time_ms": None if minute == 5 else 20.0 + 4 * minute,
     "timestamp": f"2025-03-09T06:{minute:02d}:30+00:00", **({"detail": ["a", {"b": minute}, "late"][minute % 3]} if minute else {})}
    for minute in range(8)
]


def test_uptime(spark, tmp_path):
    path = log_of(spark, tmp_path, [json.dumps(p) for p in PROBES] + ["", "{x"], "health.log")
    probes = logs.health_events(logs.read_lines(spark, path))
    assert tuple(O.uptime(probes, monitor.PROBE_ORDER).first()) == (8, 75.0, round(sum(20 + 4 * m for m in (0, 1, 2, 3, 4, 6, 7)) / 7, 2), "DOWN", "2025-03-09T06:07:30+00:00")
    assert tuple(O.uptime(probes, monitor.PROBE_ORDER, window=2).first()) == (2, 50.0, 46.0, "DOWN", "2025-03-09T06:07:30+00:00")


def test_http_counters(spark, tmp_path):
    lines = [json.dumps(r) for r in [
        {"path": "/predict", "status_code": 200, "latency_ms": 10.0}, {"path": "/predict/", "status_code": 422, "latency_ms": 1.0},
        {"path": "/health", "status_code": 200, "latency_ms": 1.0}, {"path": "/predict", "latency_ms": 8.0, "error": "boom"}]]
    events = logs.http_events(logs.read_lines(spark, log_of(spark, tmp_path, lines, "app.log")))
    assert tuple(O.http_counters(events).first()) == (4, 3, 2, 20.0, 4, 5.0)
    assert [tuple(r) for r in O.requests_by_status(events).collect()] == [("200", 2), ("422", 1), ("500", 1)]


def test_appended_events_read_back(spark, tmp_path):
    df = spark.createDataFrame([(40.0, 20.0)], "Age double, ESR double")
    lines = logs.as_log_lines(df, ["Age", "ESR"], F.lit("normal"), F.lit("success"), F.lit(12.345))
    for _ in range(2):
        logs.append_json(lines, str(tmp_path / "log"))
    text = [json.loads(r["line"]) for r in logs.read_lines(spark, str(tmp_path / "log")).collect()]
    assert len(text) == 2 and text[0]["event"] == "prediction" and text[0]["features"] == {"Age": 40.0, "ESR": 20.0} and text[0]["error"] is None
    event = logs.prediction_events(logs.read_lines(spark, str(tmp_path / "log"))).first()
    assert event["ts"] is not None and event["status"] == "success" and event["prediction"] == "normal"


def test_monitoring_plan(spark, tmp_path):
    rng = np.random.default_rng(4)
    out = str(tmp_path / "reports")
    log = log_of(spark, tmp_path, [json.dumps({"timestamp": f"2024-01-01T00:{i // 60:02d}:{i % 60:02d}+00:00", "status": "success", "prediction": "normal", "latency_ms": float(i),
                                               "features": {"Age": float(a), "ESR": float(e)}}) for i, (a, e) in enumerate(zip(rng.normal(80, 5, 300), rng.normal(20, 4, 300)))])
    health = log_of(spark, tmp_path, [json.dumps(p) for p in PROBES], "health.log")
    before = monitor.build_dashboard(spark, log, health, out).first()
    assert before["drift"]["overall_status"] == "NOT_RUN" and before["api_metrics"]["total_predictions"] == 300
    with pytest.raises(reports.ReferenceMissing):
        monitor.check_drift(spark, log, out)
    table = spark.createDataFrame(pd.DataFrame({"id": range(3000), "Age": rng.normal(50, 5, 3000), "ESR": rng.normal(20, 4, 3000), "diagnosis": rng.integers(0, 3, 3000)}))
    monitor.rebuild_reference(table, ["Age", "ESR"], "diagnosis", out, ["id"])
    summary = monitor.check_drift(spark, log, out).first()
    assert (summary["n_production_samples"], summary["drifted"], summary["overall_status"]) == (300, ["Age"], "DRIFT")
    assert monitor.check_drift(spark, log, out, last=50).first()["n_production_samples"] == 50
    after = monitor.build_dashboard(spark, log, health, out).first()
    assert after["drift"]["overall_status"] == "DRIFT" and after["drift"]["n_samples"] == 50 and len(after["drift"]["features"]) == 2
    assert after["api_metrics"]["latency_trend"] == [float(i) for i in range(250, 300)] and after["health"]["uptime_pct"] == 75.0
    assert after["model_metrics"]["class_distribution"] == {"normal": 300} and after["health"]["severity"] == "alert"
    empty = monitor.check_drift(spark, str(tmp_path / "no.log"), out).first()
    assert empty["overall_status"] is None and empty["n_production_samples"] == 0


def test_ks_p_value_is_exact_for_small_samples(spark):
    for n, m in ((3, 4), (5, 6), (4, 4), (1, 7)):
        gaps = []
        for left in itertools.combinations(range(n + m), n):
            i, gap, chosen = 0, 0.0, set(left)
            for k in range(n + m):
                i += k in chosen
                gap = max(gap, abs(i / n - (k + 1 - i) / m))
            gaps.append(gap)
        for gap in set(gaps):
            assert ks_exact_p_value(gap, n, m) == pytest.approx(sum(g >= gap - 1e-9 for g in gaps) / len(gaps), abs=1e-9)
    rows = spark.createDataFrame([(0.5, 5, 6), (0.02, 2_000, 9_000), (0.02, 2_000, 900_000), (0.0, 5, 5)], "d double, n long, m long")
    got = [r[0] for r in rows.select(ks_p_value(F.col("d"), F.col("n"), F.col("m"))).collect()]
    assert got[0] == pytest.approx(ks_exact_p_value(0.5, 5, 6)) and got[3] == 1.0
    assert got[1] == pytest.approx(0.525, abs=0.02) and got[2] == pytest.approx(0.402, abs=0.02)
