"""Versions, repeated appends, log order, sketches, label codes and p-values on small frames."""

import os

import pytest
from pyspark.sql import functions as F

from cohortline.functions.numeric import ks_p_value
from cohortline.operators import checks as C
from cohortline.operators import ops_metrics as O
from cohortline.operators import prep
from cohortline.operators import sketches as SK
from cohortline.operators.ranked import last_n
from cohortline.sources import logs, publish, records


def not_null(df):
    return C.run_column_checks(df, "t", [C.ColumnCheck("not_null", "k"), C.ColumnCheck("accepted_values", "v", ("a", "b"), severity="warn")])


def test_a_bad_version_is_never_read(spark, tmp_path):
    root, schema = str(tmp_path / "t"), "k int, v string"
    good, bad = spark.createDataFrame([(1, "a"), (2, "c")], schema), spark.createDataFrame([(None, "a")], schema)
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, root)
    assert publish.publish(bad, root, not_null).number is None and publish.versions(spark, root) == []
    first = publish.publish(good, root, not_null)
    assert first.number == 1 and len(first.problems) == 1  # the warning
    refused = publish.publish(bad, root, not_null)
    assert refused.number is None and "not_null" in refused.problems[0]
    assert publish.read_published(spark, root).count() == 2
    assert publish.publish(records.LoadResult("missing", None), root).problems == ("missing",)
    assert publish.publish(good.limit(1), root).number == 2
    assert publish.read_published(spark, root).count() == 1 and publish.read_published(spark, root, 1).count() == 2
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, root, 9)


def test_a_batch_appends_once(spark, tmp_path):
    path = str(tmp_path / "log")

    def batch(rows):
        return spark.createDataFrame(rows, "ts timestamp_ntz, latency_ms double, extra string").withColumn("ts", F.col("ts").cast("timestamp"))

    import datetime as dt
    one = batch([(dt.datetime(2024, 1, day, 3), float(day), None) for day in (1, 1, 2, 3)])
    logs.append_batch(one, path, "a", F.col("ts"))
    logs.append_batch(batch([(dt.datetime(2024, 1, 1, 5), 9.0, "x")]), path, "b", F.col("ts"))
    logs.append_batch(one, path, "a", F.col("ts"))
    assert logs.prediction_events(logs.read_lines(spark, path)).count() == 5
    # a repeat whose rows moved to another day leaves nothing behind
    logs.append_batch(batch([(dt.datetime(2024, 1, 5, 3), 1.0, None)] * 4), path, "a", F.col("ts"))
    assert sorted(r["latency_ms"] for r in logs.prediction_events(logs.read_lines(spark, path)).collect()) == [1.0, 1.0, 1.0, 1.0, 9.0]
    logs.append_batch(batch([(dt.datetime(2024, 1, 5, 3), 2.0, None)] * 3).repartition(3), path, "c", F.col("ts"))
    files = len([n for _, _, names in os.walk(tmp_path / "log") for n in names if n.startswith("part")])
    logs.compact_day(spark, path, "2024-01-05")
    assert len([n for _, _, names in os.walk(tmp_path / "log") for n in names if n.startswith("part")]) < files
    assert logs.prediction_events(logs.read_lines(spark, path)).count() == 8
    logs.append_batch(batch([(dt.datetime(2024, 1, 5, 3), 2.0, None)]), path, "c", F.col("ts"))
    assert logs.prediction_events(logs.read_lines(spark, path)).count() == 6


def test_log_order_ignores_times(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    stamps = ["2030-01-01T00:00:00", "not a time", "2001-01-01T00:00:00", None]
    for i, name in enumerate(["predictions.log.2", "predictions.log.1", "predictions.log"]):
        lines = [f'{{"timestamp": "{stamps[(i + j) % 4]}", "latency_ms": {10 * i + j}, "up": {"false" if (i, j) == (2, 5) else "true"}}}' for j in range(6)]
        (folder / name).write_text("\n".join(lines) + "\n")
        os.utime(folder / name, (1_700_000_000 + i, 1_700_000_000 + i))
    lines = logs.read_lines(spark, str(folder))
    events = logs.prediction_events(lines)
    assert [r["latency_ms"] for r in last_n(events, 8, logs.FILE_ORDER).collect()] == [14.0, 15.0, 20.0, 21.0, 22.0, 23.0, 24.0, 25.0]
    assert O.uptime(logs.health_events(lines), logs.FILE_ORDER).first()["last_status"] == "DOWN"
    by_name = logs.prediction_events(logs.read_lines(spark, str(folder), by_name=True))
    assert [r["latency_ms"] for r in last_n(by_name, 2, logs.FILE_ORDER).collect()] == [4.0, 5.0]


def test_line_numbers_over_splits(spark, tmp_path):
    rows = [f'{{"n": {i}, "pad": "{"x" * (i % 50)}"}}' for i in range(4_000)]
    (tmp_path / "a.log").write_text("\n".join(rows) + "\n")
    (tmp_path / "b.log").write_text("\n".join(rows[:7]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        numbered = logs.line_numbers(logs.read_lines(spark, str(tmp_path)))
        assert numbered.select("log_block").distinct().count() > 3
        wrong = numbered.filter(F.col("log_line") != F.get_json_object("line", "$.n").cast("bigint")).count()
        assert wrong == 0 and numbered.count() == 4_007
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert logs.line_numbers(logs.read_lines(spark, str(tmp_path / "none"))).collect() == []


def test_sketches_merge_over_loads(spark):
    df = spark.range(60_000).select(F.pmod("id", F.lit(4)).alias("load"), F.when(F.col("id") % 11 != 0, F.floor(F.col("id") / 2)).alias("key"))
    loads = SK.load_sketches(df, "load", "key")
    exact = {r["load"]: r["n"] for r in df.groupBy("load").agg(F.count_distinct("key").alias("n")).collect()}
    for r in SK.distinct_over(loads, "load").collect():
        assert abs(r["n_distinct"] - exact[r["load"]]) <= SK.RELATIVE_ERROR * exact[r["load"]]
    whole = SK.distinct_over(loads).first()
    n = df.agg(F.count_distinct("key")).first()[0]
    assert whole["n_loads"] == 4 and whole["n_rows"] == 60_000 and abs(whole["n_distinct"] - n) <= SK.RELATIVE_ERROR * n
    lost = SK.lost_between(loads, loads.filter("load < 2")).first()
    truth = df.filter("load >= 2").select("key").subtract(df.filter("load < 2").select("key")).filter("key is not null").count()
    assert abs(lost["n_lost"] - truth) <= SK.RELATIVE_ERROR * n and lost["n_new"] == 0


def test_label_codes_beyond_the_bound(spark):
    df = spark.range(3_000).select(F.format_string("l%05d", F.pmod(F.col("id") * 7, F.lit(2_500))).alias("l")).unionByName(spark.createDataFrame([(None,)], "l string"))
    with pytest.raises(ValueError, match="more than"):
        prep.fit_label_codes(df, "l")
    codes = prep.label_code_table(df, "l")
    assert [(r["label"], r["code"]) for r in codes.orderBy("code").limit(3).collect()] == [("l00000", 0), ("l00001", 1), ("l00002", 2)]
    coded = prep.encode_by_table(df, "l", codes, "c")
    assert coded.count() == 3_001 and coded.filter("c is null").count() == 1
    assert coded.filter(F.col("c") != F.substring("l", 2, 5).cast("int")).count() == 0


def test_asymptotic_p_value_on_request(spark):
    row = spark.range(1).select(ks_p_value(F.lit(0.1), F.lit(400), F.lit(500)).alias("exact"), ks_p_value(F.lit(0.1), F.lit(400), F.lit(500), exact=False).alias("series")).first()
    assert row["series"] == pytest.approx(0.0234, abs=0.001) and row["exact"] != row["series"] and row["exact"] == pytest.approx(row["series"], abs=0.005)
