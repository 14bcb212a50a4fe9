"""Stored artefacts on the driver's tables: versions, repeated appends, log order, sketches, encoders, runs and models,
each beside the same question as plain SQL."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from cohortline.functions.numeric import ks_p_value
from cohortline.functions.text import ordinal_encode
from cohortline.operators import checks as C
from cohortline.operators import columns as K
from cohortline.operators import drift as D
from cohortline.operators import evaluate as E
from cohortline.operators import ops_metrics as O
from cohortline.operators import prep
from cohortline.operators import sketches as SK
from cohortline.operators import training as T
from cohortline.operators.ranked import last_n
from cohortline.plans.driver_oracles import _HASH, _PRICES
from cohortline.plans.driver_queries import _log_lines, _prediction_like, _price_sides, _probes, r6, scratch_path, table
from cohortline.plans.model_oracles import _RUNS, _TEST_LIMIT
from cohortline.plans.model_queries import _judged, _sides
from cohortline.session import store
from cohortline.sources import logs, publish, records, reports


def published_versions(spark, d):
    """Three loads of orders, the second with lost keys: it is refused, and readers keep the first until the third."""
    root, orders = scratch_path(spark, "published"), table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    broken = orders.withColumn("o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderkey")))
    rows = []
    for name, load in (("first", orders.filter("o_orderkey % 2 = 0")), ("broken", broken), ("third", orders)):
        done = publish.publish(load, root, lambda df: C.run_column_checks(df, "orders", [C.ColumnCheck("not_null", "o_orderkey")]))
        seen = publish.read_published(spark, root)
        rows.append(seen.agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum")).select(
            F.lit(name).alias("load"), F.lit(done.number is not None).alias("published"), "n", "key_sum"))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def repeated_append(spark, d):
    """The first half of the events appended twice as one batch, the second half once; then one day compacted."""
    path, events = scratch_path(spark, "batched-log"), _prediction_like(spark, d)
    for batch, half in (("a", "ts < '2024-01-15'"), ("b", "ts >= '2024-01-15'"), ("a", "ts < '2024-01-15'")):
        logs.append_batch(events.filter(half).select("ts", "status", "prediction", "latency_ms"), path, batch, F.col("ts"))
    logs.compact_day(spark, path, "2024-01-03")
    found = logs.prediction_events(logs.read_lines(spark, path))
    return found.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("latency_ms"), 4).alias("latency_sum"))


def _ordered_log(spark, d):
    """Events in the order of their ids, the times of some unreadable and of others shifted."""
    path = scratch_path(spark, "ordered-log")
    key = F.col("event_id") % 7
    stamp = F.when(key == 3, "soon").when(key == 5, F.date_format(F.col("ts") + F.expr("INTERVAL 400 DAYS"), "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    lines = _probes(spark, d).select("event_id", F.to_json(F.struct(
        stamp.alias("timestamp"), "up", "response_time_ms", F.col("event_id").cast("string").alias("request_id"),
        F.coalesce("response_time_ms", F.lit(0.5)).alias("latency_ms"))).alias("value"))
    lines.repartitionByRange(4, "event_id").sortWithinPartitions("event_id").select("value").write.text(path)
    return path


def log_order(spark, d):
    """The last forty latencies and the last probe in the order of the log."""
    lines = logs.read_lines(spark, _ordered_log(spark, d), by_name=True)
    events = logs.prediction_events(lines)
    recent = last_n(events.select("request_id", "latency_ms", *logs.FILE_ORDER), 40, logs.FILE_ORDER)
    probe = O.uptime(logs.health_events(lines), logs.FILE_ORDER, window=40)
    tail = recent.select(F.lit("event").alias("kind"), "request_id", F.col("latency_ms").alias("value"))
    return tail.unionByName(probe.select(F.lit("probe").alias("kind"), F.col("last_status").alias("request_id"), F.col("uptime_pct").alias("value")))


def log_line_numbers(spark, d):
    """Each line's number in its file against the order of the event ids that were written."""
    lines = logs.line_numbers(logs.read_lines(spark, _ordered_log(spark, d), by_name=True))
    numbered = lines.select("log_file", "log_line", F.get_json_object("line", "$.request_id").cast("bigint").alias("event_id"))
    files = numbered.groupBy("log_file").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("low"), F.max("log_line").alias("top"), F.min("log_line").alias("bottom"))
    first = numbered.filter("log_line = 0").select("log_file", F.col("event_id").alias("first_id"))
    return files.join(first, "log_file").agg(
        F.sum("n").alias("n"), F.bool_and((F.col("top") == F.col("n") - 1) & (F.col("bottom") == 0)).alias("dense"), F.bool_and(F.col("first_id") == F.col("low")).alias("in_order"))


def distinct_sketches(spark, d):
    """Customers per year of orders and over all years, from one sketch a year, beside the exact counts."""
    orders = table(spark, d, "orders").select(F.year("o_orderdate").alias("year"), "o_custkey")
    sketches = store(SK.load_sketches(orders, "year", "o_custkey"), "sketches")
    found = SK.distinct_over(sketches, "load").select(F.col("load").cast("string").alias("scope"), "n_rows", "n_distinct").unionByName(
        SK.distinct_over(sketches).select(F.lit("all").alias("scope"), "n_rows", "n_distinct"))
    lost = SK.lost_between(sketches.filter("load < 1995"), sketches.filter("load >= 1995")).select(F.lit("lost").alias("scope"), F.lit(0).cast("bigint").alias("n_rows"), F.col("n_lost").alias("n_distinct"))
    exact = orders.groupBy(F.col("year").cast("string").alias("scope")).agg(F.count_distinct("o_custkey").alias("exact")).unionByName(
        orders.select(F.lit("all").alias("scope"), "o_custkey").groupBy("scope").agg(F.count_distinct("o_custkey").alias("exact")))
    early, late = orders.filter("year < 1995").select("o_custkey").distinct(), orders.filter("year >= 1995").select("o_custkey").distinct()
    gone = early.join(late, "o_custkey", "left_anti").select(F.lit("lost").alias("scope")).groupBy("scope").agg(F.count(F.lit(1)).alias("exact"))
    # a difference is as uncertain as the larger side
    slack = F.greatest(F.col("exact"), F.when(F.col("scope") == "lost", early.agg(F.count(F.lit(1))).scalar()).otherwise(0)) * SK.RELATIVE_ERROR + 1
    both = found.unionByName(lost).join(exact.unionByName(gone), "scope", "left").withColumn("exact", F.coalesce("exact", F.lit(0)))
    return both.select("scope", "n_rows", "exact", (F.abs(F.col("n_distinct") - F.col("exact")) <= slack).alias("close"))


def ks_pvalue(spark, d):
    """Statistic and asymptotic p-value of earlier and later order prices, and of two halves of the earlier ones."""
    ref, cur = _price_sides(spark, d)
    halves = [ref.filter(F.pmod(F.floor(F.col("value") * 100), F.lit(2)) == i).withColumn("feature", F.lit("halves")) for i in (0, 1)]
    pairs = D.ks_two_sample(ref.unionByName(halves[0]), cur.unionByName(halves[1]))
    p = ks_p_value(F.col("ks_stat"), F.col("n_left"), F.col("n_right"), exact=False)
    return pairs.withColumn("ks_pvalue", p).select("feature", "n_left", "n_right", r6("ks_stat"), r6("ks_pvalue"))


def missing_loads(spark, d):
    """Missing and empty files load nothing and replace nothing; a full one does."""
    base, rows = scratch_path(spark, "loads"), []
    region = table(spark, d, "nation")
    records.write_csv(region.limit(0), f"{base}/empty")
    records.write_csv(region, f"{base}/full")
    for name in ("absent", "empty", "full"):
        loaded = records.load_csv(spark, f"{base}/{name}")
        n = 0 if loaded.data is None else loaded.data.count()
        done = publish.publish(loaded, f"{base}/published")
        rows.append((name, loaded.status, done.number is not None, n))
    return spark.createDataFrame(rows, "name string, status string, replaced boolean, n bigint")


def stored_encoder(spark, d):
    """Codes fitted, written, read back and applied, by a CASE and by a joined table."""
    customer, path = table(spark, d, "customer"), scratch_path(spark, "encoder")
    reports.save_encoder(prep.fit_label_codes(customer, "c_mktsegment"), spark, path)
    coded = customer.withColumn("code", ordinal_encode(F.col("c_mktsegment"), reports.load_encoder(spark, path)))
    both = prep.encode_by_table(coded, "c_mktsegment", prep.label_code_table(customer, "c_mktsegment"), "joined_code")
    return both.groupBy("c_mktsegment", "code", "joined_code").agg(F.count(F.lit(1)).alias("n"))


def rejected_contract(spark, d):
    """What a schema contract and a column list find wrong with orders."""
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast("string").alias("o_totalprice"), "o_orderstatus")
    expected = StructType([StructField("o_orderkey", LongType()), StructField("o_totalprice", DoubleType()), StructField("o_clerk", StringType())])
    found = [(x.problem, x.column) for x in C.schema_differences(orders, expected)]
    found += [("absent", name) for name in K.missing_columns(orders, ["o_orderkey", "o_comment"])]
    try:
        C.enforce_schema(orders, expected)
    except C.CheckFailed:
        found.append(("raised", "orders"))
    return spark.createDataFrame(found, "kind string, column_name string")


def selected_features(spark, d):
    """The chosen columns in order, and the error on one that is missing."""
    items = table(spark, d, "lineitem")
    chosen = prep.select_features(items, ["l_tax", "l_quantity"], ["l_returnflag"])
    try:
        prep.select_features(items, ["l_tax", "l_gone"])
        refused = False
    except ValueError:
        refused = True
    totals = chosen.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_tax"), 4).alias("tax"), F.sum("l_quantity").alias("quantity"))
    return totals.select("*", F.lit(",".join(chosen.columns)).alias("names"), F.lit(refused).alias("refused"))


def run_log(spark, d):
    """Runs of two rules appended to a log one by one, read back, and the champion among them."""
    path, judged = scratch_path(spark, "runs"), _judged(spark, d)
    for name, df in (("inverted", judged), ("constant", judged.withColumn("prediction", F.lit(1)))):
        row = E.classification_metrics(df).first()
        reports.append_runs(T.run_record(spark, name, {k: round(row[k], 6) for k in ("accuracy", "composite_score")}, {"rule": name}), path)
    runs = reports.load_runs(spark, path)
    best = E.champion(runs, ["inverted", "constant"]).select("model").scalar()
    return runs.select("model", F.element_at("metrics", "accuracy").alias("accuracy"), F.size("metric_names").alias("n_metrics"), (
        F.col("model") == best).alias("is_champion"))


def reloaded_model(spark, d):
    """A forest saved and read back gives every test row the same class and shares."""
    train, test = _sides(spark, d)
    path = scratch_path(spark, "model")
    model = T.forest(numTrees=8, maxDepth=5).fit(train)
    T.save_model(model, path)

    def scored(m, name):
        return m.transform(test).select("vec_id", F.struct("prediction", vector_to_array("probability").alias("p")).alias(name))

    both = scored(model, "a").join(scored(T.load_model(path), "b"), "vec_id")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("a") != F.col("b")).alias("n_changed"))


STORE_QUERIES = {f.__name__: f for f in (
    published_versions, repeated_append, log_order, log_line_numbers, distinct_sketches, ks_pvalue, missing_loads, stored_encoder,
    rejected_contract, selected_features, run_log, reloaded_model)}

_STATUS = "CASE WHEN event_type <> 'error' THEN 'success' WHEN user_id % 2 = 0 THEN 'error' END"
_UP = "event_type <> 'error'"
_HALVES = f"""SELECT feature, value, is_ref FROM ({_PRICES}) UNION ALL
    SELECT 'halves', value, floor(value * 100)::BIGINT % 2 = 0 FROM ({_PRICES}) WHERE is_ref"""

STORE_ORACLES = {
    "published_versions": """WITH even AS (SELECT count(*) AS n, sum(o_orderkey)::BIGINT AS key_sum FROM orders WHERE o_orderkey % 2 = 0)
        SELECT 'first' AS load, true AS published, n, key_sum FROM even UNION ALL SELECT 'broken', false, n, key_sum FROM even
        UNION ALL SELECT 'third', true, count(*), sum(o_orderkey)::BIGINT FROM orders""",
    "repeated_append": f"SELECT {_STATUS} AS status, count(*) AS n, round(sum(value), 4) AS latency_sum FROM events GROUP BY 1",
    "log_order": f"""WITH tail AS (SELECT * FROM events ORDER BY event_id DESC LIMIT 40)
        SELECT 'event' AS kind, event_id::VARCHAR AS request_id, CASE WHEN event_type <> 'signup' THEN value ELSE 0.5 END AS value FROM tail
        UNION ALL SELECT 'probe', arg_max(CASE WHEN {_UP} THEN 'UP' ELSE 'DOWN' END, event_id), round(100.0 * avg(({_UP})::INT), 2) FROM tail""",
    "log_line_numbers": "SELECT count(*) AS n, true AS dense, true AS in_order FROM events",
    "distinct_sketches": """WITH o AS (SELECT year(o_orderdate) AS year, o_custkey FROM orders)
        SELECT year::VARCHAR AS scope, count(*) AS n_rows, count(DISTINCT o_custkey) AS exact, true AS close FROM o GROUP BY year
        UNION ALL SELECT 'all', count(*), count(DISTINCT o_custkey), true FROM o
        UNION ALL SELECT 'lost', 0, count(DISTINCT o_custkey), true FROM o WHERE year < 1995 AND o_custkey NOT IN (SELECT o_custkey FROM o WHERE year >= 1995)""",
    "ks_pvalue": f"""WITH v AS ({_HALVES}),
        steps AS (SELECT DISTINCT feature, count(*) FILTER (WHERE is_ref) OVER all_of AS n, count(*) FILTER (WHERE NOT is_ref) OVER all_of AS m,
            abs((count(*) FILTER (WHERE is_ref) OVER up_to) / (count(*) FILTER (WHERE is_ref) OVER all_of) - (count(*) FILTER (WHERE NOT is_ref) OVER up_to) / (count(*) FILTER (WHERE NOT is_ref) OVER all_of)) AS gap
            FROM v WINDOW all_of AS (PARTITION BY feature), up_to AS (PARTITION BY feature ORDER BY value RANGE UNBOUNDED PRECEDING)),
        stat AS (SELECT feature, n, m, max(gap) AS s FROM steps GROUP BY ALL),
        terms AS (SELECT *, s * s * (n * m / (n + m)) AS z FROM stat)
        SELECT feature, n AS n_left, m AS n_right, round(s, 6) AS ks_stat,
            round(CASE WHEN z < 0.02 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * list_sum(list_transform(range(1, 101),
                lambda k: (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0::DOUBLE * k * k * z))))) END::DOUBLE, 6) AS ks_pvalue FROM terms""",
    "missing_loads": """SELECT 'absent' AS name, 'missing' AS status, false AS replaced, 0::BIGINT AS n UNION ALL SELECT 'empty', 'empty', false, 0
        UNION ALL SELECT 'full', 'loaded', true, count(*) FROM nation""",
    "stored_encoder": """WITH codes AS (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) - 1 AS code FROM (SELECT DISTINCT c_mktsegment FROM customer))
        SELECT c_mktsegment, code::INT AS code, code AS joined_code, count(*) AS n FROM customer JOIN codes USING (c_mktsegment) GROUP BY ALL""",
    "rejected_contract": """SELECT * FROM (VALUES ('missing', 'o_clerk'), ('extra', 'o_orderstatus'), ('type', 'o_totalprice'), ('absent', 'o_comment'), ('raised', 'orders')) t(kind, column_name)""",
    "selected_features": """SELECT l_returnflag, count(*) AS n, round(sum(l_tax), 4) AS tax, sum(l_quantity) AS quantity, 'l_tax,l_quantity,l_returnflag' AS names, true AS refused
        FROM lineitem GROUP BY l_returnflag""",
    "run_log": f"""SELECT model, round(accuracy, 6) AS accuracy, 2::INT AS n_metrics, model = (
            SELECT model FROM ({_RUNS}) ORDER BY round(composite_score, 6) DESC, model DESC LIMIT 1) AS is_champion FROM ({_RUNS})""",
    "reloaded_model": f"""SELECT count(*) AS n, 0::BIGINT AS n_changed FROM embeddings WHERE {_HASH.format(key="concat_ws('|', vec_id, '42')")} < {_TEST_LIMIT}""",
}
