"""Model-side operators on the driver's tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortline.functions.text import stable_hash
from cohortline.operators import balance as B
from cohortline.operators import drift as D
from cohortline.operators import evaluate as E
from cohortline.operators import kernels
from cohortline.operators import knn as N
from cohortline.operators import lsh
from cohortline.operators import nodes as ND
from cohortline.operators import ops_metrics as O
from cohortline.operators import prep
from cohortline.operators import scoring as S
from cohortline.operators import training as T
from cohortline.plans.driver_queries import ITEM_KEY, MEASURES, _log_lines, _prediction_like, _probes, _requests, r6, scratch_path, table
from cohortline.session import cut_lineage
from cohortline.sources import logs
from cohortline.streaming import metrics as M
from cohortline.streaming import recent as RC
from cohortline.streaming import windows as SW

N_DIMS = 64
CLASSES = list(range(10))
#: Root mean square error each map's products may have, for vectors of length 1: the law of the draws, and for landmarks
#: a bound that holds where the data lie near a few hundred of them.
MAP_ERRORS = {"fourier": 0.05, "landmarks": 0.005, "sketch": 0.056}


# -- preparation -----------------------------------------------------------------------------------------------

def split(spark, d):
    orders = table(spark, d, "orders")
    train, test = prep.hash_split(orders, ["o_orderkey"])
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return both.groupBy("side", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


def folds(spark, d):
    folded = prep.stratified_folds(table(spark, d, "orders"), "o_orderstatus", "o_orderkey")
    return folded.groupBy("o_orderstatus", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


def standardize(spark, d):
    train, test = prep.hash_split(table(spark, d, "lineitem").select(*ITEM_KEY, "l_returnflag", *MEASURES), ITEM_KEY)
    _, scaled, _ = prep.scale_split(train, test, [*ITEM_KEY, "l_returnflag"])
    return scaled.groupBy("l_returnflag").agg(*[
        c for m in MEASURES for c in (F.round(F.avg(m), 6).alias(f"avg_{m}"), F.round(F.max(m), 6).alias(f"max_{m}"))])


def scaler_stats(spark, d):
    item = table(spark, d, "lineitem").select(*MEASURES, (F.col("l_quantity") > 25).cast("int").alias("flag"), F.lit(3.0).alias("fixed"))
    fitted = prep.fit_standardiser(item, [*MEASURES, "fixed"])
    return fitted.select("column_name", r6("mean"), r6("std"))


def class_weights(spark, d):
    return prep.class_weights(table(spark, d, "embeddings"), "label").select("label", "n", r6("weight"))


# -- evaluation ------------------------------------------------------------------------------------------------

def _judged(spark, d):
    return table(spark, d, "labels").select("doc_id", F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction"))


def classification_metrics(spark, d):
    return E.classification_metrics(_judged(spark, d)).select(*[r6(c) for c in ("accuracy", "balanced_accuracy", "f1_weighted", "composite_score")])


def class_report(spark, d):
    return E.class_report(_judged(spark, d)).select("class", r6("precision"), r6("recall"), r6("f1"), "support")


def confusion(spark, d):
    return E.confusion_matrix(_judged(spark, d), [0, 1]).select("label", F.col("0").alias("predicted_0"), F.col("1").alias("predicted_1"), "other")


def _scored_documents(spark, d):
    joined = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return joined.select(F.inline(F.array(
        F.struct(F.lit("quality").alias("class"), (F.col("quality") == 1).alias("is_positive"), F.col("n_chars").cast("double").alias("score")),
        F.struct(F.lit("toxic").alias("class"), (F.col("toxic") == 1).alias("is_positive"), F.col("n_chars").cast("double").alias("score")))))


def roc_auc(spark, d):
    return E.roc_auc(_scored_documents(spark, d)).select("class", r6("auc"))


def roc_curve(spark, d):
    return E.roc_points(_scored_documents(spark, d)).select("class", "threshold", "tp", "fp", r6("tpr"), r6("fpr"))


def _rule_runs(spark, d):
    """Two rules as candidates: the inverted toxic flag, and always good."""
    judged = _judged(spark, d)
    runs = None
    for name, df in (("inverted", judged), ("constant", judged.withColumn("prediction", F.lit(1)))):
        metrics = ("accuracy", "balanced_accuracy", "f1_weighted", "composite_score")
        row = E.classification_metrics(df).select(
            F.lit(name).alias("model"), F.create_map(*[x for m in metrics for x in (F.lit(m), F.round(m, 6))]).alias("metrics"),
            F.create_map(F.lit("rule"), F.lit(name)).alias("params"))
        runs = row if runs is None else runs.unionByName(row)
    return runs


def champion(spark, d):
    return E.champion(_rule_runs(spark, d), ["inverted", "constant"]).select("model", "composite_score")


def metric_comparison(spark, d):
    return E.metric_long(_rule_runs(spark, d))


# -- neighbours and balancing ----------------------------------------------------------------------------------

def nearest_neighbours(spark, d):
    rows = N.as_rows(table(spark, d, "embeddings"), "vec_id", "embedding", "label")
    found = N.row_neighbours(rows, 3)
    return found.select("id", F.posexplode("neighbours").alias("pos", "e")).select(
        "id", "pos", F.col("e.id").alias("neighbour"), F.round("e.dist", 6).alias("dist"))


def nearest_neighbours_pivoted(spark, d):
    rows = N.as_rows(table(spark, d, "embeddings"), "vec_id", "embedding", "label")
    found = N.row_neighbours(rows, 3, n_pivots=12, block_rows=64)
    return found.select("id", F.posexplode("neighbours").alias("pos", "e")).select(
        "id", "pos", F.col("e.id").alias("neighbour"), F.round("e.dist", 6).alias("dist"))


def smote(spark, d):
    made = B.smote(table(spark, d, "embeddings"), "vec_id", "embedding", "label")
    return made.select("base_id", "draw", "nn_id", r6("u"), "label", F.round(F.get("vec", F.lit(0)), 6).alias("first"),
                       F.round(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


def edited_neighbours(spark, d):
    kept = B.edited_neighbours(table(spark, d, "embeddings"), "vec_id", "embedding", "label")
    return kept.select("id", "label", F.size("vec").alias("n_dims"))


def edited_half_spaces(spark, d):
    """Labels by the sign of one coordinate, so that rows near the border go and others stay."""
    rows = table(spark, d, "embeddings").withColumn("side", (F.get("embedding", F.lit(0)) > 0).cast("int"))
    kept = B.edited_neighbours(rows, "vec_id", "embedding", "side")
    return kept.select("id", "label", F.round(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


def nearest_of_twentieth(spark, d):
    """Every vector whose id is divisible by 20 against all vectors, over the hash tables."""
    points = N.distinct_points(N.as_rows(table(spark, d, "embeddings"), "vec_id", "embedding"), 3)
    near = lsh.Projections().search(points, 3, points.table.filter("pid % 20 = 0"))
    place = F.row_number().over(W.partitionBy("pid").orderBy("dist", "nid")) - 1
    return near.select(F.col("pid").alias("id"), place.alias("pos"), F.col("nid").alias("neighbour"), F.round("dist", 6).alias("dist"))


def _order_vectors(spark, d):
    """Orders as points: standardised means and counts of their items."""
    item = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        *[F.avg(m).alias(m) for m in MEASURES], F.count(F.lit(1)).cast("double").alias("n_items"), F.max("l_extendedprice").alias("top_price"))
    names = [c for c in item.columns if c != "l_orderkey"]
    # read by every scan of the standardiser and of the points
    item = cut_lineage(item)
    scaled = prep.apply_standardiser(item, prep.fit_standardiser(item, names), others_after=False)
    return scaled.select("l_orderkey", F.array(*[F.round(c, 9) for c in names]).alias("vec"))


def neighbour_recall(spark, d):
    """Hash tables against the exact search, for the orders whose key is divisible by 20 among all orders."""
    points = N.distinct_points(N.as_rows(_order_vectors(spark, d), "l_orderkey", "vec"), 5)
    asked = points.table.filter("pid % 20 = 0").select("pid", "scope", "vec")
    near = lsh.Projections(bucket_rows=256).search(points, 5, asked)
    exact = N.nearest_points(points, 5, queries=asked)
    both = exact.join(near.select("pid", "nid", F.lit(1).alias("hit")), ["pid", "nid"], "left")
    return both.agg(F.count_distinct("pid").alias("n_queries"), F.count(F.lit(1)).alias("n_pairs"), (F.count("hit") / F.count(F.lit(1)) >= 0.9).alias("recalled"))


# -- training --------------------------------------------------------------------------------------------------

def _vectors(spark, d):
    return table(spark, d, "embeddings").select("vec_id", "embedding", "label")


def _sides(spark, d):
    train, test = prep.hash_split(_vectors(spark, d), ["vec_id"])
    return T.from_arrays(train, "embedding", "label", ["vec_id"]), T.from_arrays(test, "embedding", "label", ["vec_id"])


def _metric_rows(spark, model, metrics):
    return spark.createDataFrame([(model, k, v) for k, v in metrics.items()], "model string, metric string, score double")


def forest_metrics(spark, d):
    train, test = _sides(spark, d)
    return _metric_rows(spark, T.FOREST_NAME, T.evaluate(T.forest().fit(train).transform(test), CLASSES))


def svc_metrics(spark, d):
    train, test = _sides(spark, d)
    return _metric_rows(spark, T.KERNEL_NAME, T.evaluate(T.fit_kernel_svc(train, N_DIMS).transform(test)))


def poly_roc(spark, d):
    train, test = _sides(spark, d)
    scored = T.fit_poly_svc(train, CLASSES)(test)
    return E.roc_auc(E.one_vs_rest_scores(scored, "margins", CLASSES))


def poly_sketch_roc(spark, d):
    """The cubic machine over the sketch of its kernel, stored once for all classes."""
    train, test = _sides(spark, d)
    scored = T.fit_sketched_poly_svc(train, N_DIMS, CLASSES)(test)
    return E.roc_auc(E.one_vs_rest_scores(scored, "margins", CLASSES))


def landmark_metrics(spark, d):
    """The kernel machine over landmark rows."""
    train, test = _sides(spark, d)
    return _metric_rows(spark, T.KERNEL_NAME, T.evaluate(T.fit_landmark_svc(train).transform(test)))


def poly_sketch(spark, d):
    """Sketch of the cubic kernel of every vector: its largest place, that place's value, and the kernel of the vector with
    itself, exact and as the sketch has it."""
    rows = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    sketched = rows.withColumn("s", kernels.lifted(F.col("v"), kernels.TensorSketch(N_DIMS, gamma=1.0)))
    dot = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    return sketched.select(
        "vec_id", F.expr("int(array_position(s, array_max(s)) - 1)").alias("top_place"), F.round(F.array_max("s"), 6).alias("top_value"),
        F.round(F.pow(dot, F.lit(3)), 6).alias("kernel"), F.round(F.aggregate("s", F.lit(0.0), lambda total, x: total + x * x), 6).alias("estimate"))


def kernel_estimates(spark, d):
    """Each vector with the one of the next id: the kernels summed over all pairs, and whether each map's products differ
    from them by no more than its bound on average (root mean square)."""
    rows = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    pairs = rows.join(rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("w")), "vec_id")
    dot = F.aggregate(F.zip_with("v", "w", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
    far = F.aggregate(F.zip_with("v", "w", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, x: total + x)
    radial = F.exp(-T.KERNEL_GAMMA * far)
    maps = {"fourier": kernels.Fourier(N_DIMS, 1_024), "landmarks": kernels.Landmarks(kernels.choose_landmarks(rows, "v", 256)),
            "sketch": kernels.TensorSketch(N_DIMS, 4_096, gamma=1.0)}
    found = kernels.kernel_errors(pairs, maps, "v", "w", {"fourier": radial, "landmarks": radial, "sketch": F.pow(dot, F.lit(3))})
    error = F.sqrt(F.avg(F.pow(F.col("estimate") - F.col("exact"), F.lit(2))))
    bound = F.element_at(F.create_map(*[F.lit(x) for pair in MAP_ERRORS.items() for x in pair]), F.col("map"))
    return found.groupBy("map").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("exact"), 4).alias("kernel_sum"), error.alias("error")).select(
        "map", "n", "kernel_sum", (F.col("error") <= bound).alias("close"))


def cross_validation(spark, d):
    data = T.from_arrays(_vectors(spark, d), "embedding", "label", ["vec_id"])
    return T.cross_validate(data, T.forest(), "vec_id")


def learning_curve(spark, d):
    data = T.from_arrays(_vectors(spark, d), "embedding", "label", ["vec_id"])
    return T.curve_summary(T.learning_curve(data, T.forest(), "vec_id"))


def feature_elimination(spark, d):
    item = table(spark, d, "lineitem").select(
        *MEASURES, (F.col("l_returnflag") == "R").cast("int").alias("label"), stable_hash(*ITEM_KEY).alias("key"))
    return T.eliminate_features(item, MEASURES, "label", "key", T.forest(numTrees=100, maxDepth=10))


# -- scoring ---------------------------------------------------------------------------------------------------

SCORED = ["l_quantity", "l_extendedprice", "l_discount"]
OPTIONAL = ["l_tax", "absent"]
FLAG_CODES = {"accepted": 0, "none": 1}


def _raw_inputs(spark, d):
    """Items as texts, with gaps and unreadable values."""
    return table(spark, d, "lineitem").select(
        *ITEM_KEY, "l_returnflag",
        F.when(F.col("l_linenumber") != 1, F.col("l_quantity").cast("string")).alias("l_quantity"),
        F.when(F.col("l_linenumber") == 2, "n/a").otherwise(F.col("l_extendedprice").cast("string")).alias("l_extendedprice"),
        F.when(F.col("l_linenumber") == 3, "NaN").otherwise(F.col("l_discount").cast("string")).alias("l_discount"),
        F.when(F.col("l_tax") > 0.02, F.col("l_tax").cast("string")).alias("l_tax"))


def input_validation(spark, d):
    checked = S.checked_inputs(_raw_inputs(spark, d), SCORED, OPTIONAL)
    accepted = F.size("reasons") == 0
    return checked.groupBy(F.when(accepted, "accepted").otherwise(F.array_join("reasons", "; ")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.when(accepted, F.col("numbers.l_tax"))), 4).alias("tax_sum"),
        F.sum(F.when(accepted, F.col("numbers.absent"))).alias("absent_sum"))


def input_ranges(spark, d):
    return S.range_violations(table(spark, d, "lineitem"), {
        "l_quantity": (0, 45), "l_discount": (0.0, 0.08), "l_tax": (0, 1), "l_extendedprice": (1000, 100000)})


ROW_FEATURES = ["l_quantity", "l_extendedprice", "l_discount"]


def scored_rows(spark, d):
    """Every raw row with label, confidence and error, scored by a table of nodes: randomised trees whose leaves count the
    training rows of each flag. One flag has no label, so rows scored as it carry that error."""
    items = table(spark, d, "lineitem")
    codes = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    train, _ = prep.hash_split(items.withColumn("label", codes), ITEM_KEY)
    bounds = items.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("feature"), F.col(c).alias("v")) for i, c in enumerate(ROW_FEATURES)]))).groupBy("feature").agg(
        F.min("v").alias("low"), F.max("v").alias("high"))
    forest = ND.NodeForest(ND.random_nodes(bounds, 3, n_trees=9, depth=5), ROW_FEATURES, 3).with_counts(train, "label")
    scored = S.score_raw(_raw_inputs(spark, d), forest, None, ROW_FEATURES, FLAG_CODES, OPTIONAL)
    return scored.select(*ITEM_KEY, "diagnosis", F.round("confidence", 1).alias("confidence"), "status", "error", F.col("inputs.l_tax").alias("l_tax"))


def batch_score(spark, d):
    """Fit on the training side, score every raw row, log it, count the log."""
    codes = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    train, _ = prep.hash_split(table(spark, d, "lineitem").withColumn("label", codes.cast("double")), ITEM_KEY)
    stats = prep.fit_standardiser(train, SCORED)
    model = T.fit_pipeline(prep.apply_standardiser(train, stats, others_after=False), SCORED, T.forest())
    accepted, _ = S.validate_inputs(_raw_inputs(spark, d), SCORED, OPTIONAL)
    logged = [*SCORED, *OPTIONAL]
    # a small file is one partition, which one core alone would score
    accepted = T.spread(accepted, accepted.count())
    scored = S.score(accepted, model, stats, SCORED, FLAG_CODES, inputs=logged)
    path = scratch_path(spark, "scored-log")
    lines = logs.as_log_lines(scored.select("inputs.*", "*"), logged, F.col("diagnosis"), F.col("status"), F.lit(1.0), F.col("error"))
    logs.append_json(lines, path)
    events = logs.prediction_events(logs.read_lines(spark, path))
    return events.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.count("prediction").alias("n_labels"), F.count("error").alias("n_errors"))


# -- streaming -------------------------------------------------------------------------------------------------

def _streamed_log(spark, d, files=4):
    path = scratch_path(spark, "stream-log")
    _log_lines(spark, d).repartition(files).write.text(path)
    return path


def stream_totals(spark, d):
    path, out = _streamed_log(spark, d), scratch_path(spark, "stream-totals")
    stream = M.running_totals(M.stream_predictions(spark, path, max_files=2))
    M.start_table(stream, out, scratch_path(spark, "stream-checkpoint")).awaitTermination()
    return spark.read.parquet(out).select("status", "n", F.round("latency_sum_ms", 4).alias("latency_sum_ms"), "latency_count")


def _stream_windows(spark, d, percentile):
    path, out = _streamed_log(spark, d), scratch_path(spark, "stream-windows")
    events = M.stream_predictions(spark, path, max_files=2).filter("ts IS NOT NULL")
    stream = M.window_metrics(events, "1 day", "60 days", percentile=percentile)
    M.start_table(stream, out, scratch_path(spark, "stream-checkpoint")).awaitTermination()
    return spark.read.parquet(out).select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "n", "errors", r6("avg_latency_ms"), *["p95_latency_ms"] * percentile)


def stream_windows(spark, d):
    """Windows closed behind a watermark wider than the data, so no row is late;
    complete mode keeps the open ones too."""
    return _stream_windows(spark, d, percentile=False)


def stream_windows_p95(spark, d):
    """The same with the approximate p95 of each window."""
    return _stream_windows(spark, d, percentile=True)


def _log_file(spark, path, name, events):
    """One more file of a log, as JSON lines."""
    events.select(F.to_json(F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"), "status", "prediction", "latency_ms",
        F.struct(F.col("latency_ms").alias("v"), F.col("user_id").alias("u")).alias("features"))).alias("value")).repartition(1).write.mode("append").text(path)


def _delayed_log(spark, d):
    """The events in four files by time; a share of the first half only arrives with the last file."""
    path, events = scratch_path(spark, "delayed-log"), _prediction_like(spark, d)
    delayed = (F.col("event_id") % 29 == 0) & (F.col("ts") < "2024-01-15")
    for low, high in (("2024-01-01", "2024-01-08"), ("2024-01-08", "2024-01-15"), ("2024-01-15", "2024-01-22"), ("2024-01-22", "2025-01-01")):
        inside = (F.col("ts") >= low) & (F.col("ts") < high) & ~delayed
        _log_file(spark, path, low, events.filter(inside | delayed if low == "2024-01-22" else inside))
    return path


def _closed(spark, d):
    out = scratch_path(spark, "closed-windows")
    events = M.stream_predictions(spark, _delayed_log(spark, d), max_files=1)
    SW.start_closing_windows(events, out, scratch_path(spark, "stream-checkpoint"), "1 hour", "1 day").awaitTermination()
    return out


def stream_closed_windows(spark, d):
    """Days merged from the hours that closed behind the watermark; whether each day's p95 lies within the sketch's error of the
    exact rank among the rows that were in time."""
    days = SW.merge_sums(SW.closed_windows(spark, _closed(spark, d)), "1 day")
    sums = F.date_format("window_start", "yyyy-MM-dd").alias("day"), F.round("latency_sum_ms", 4).alias("latency_sum")
    report = SW.window_report(days).withColumn("day", F.date_format("window_start", "yyyy-MM-dd")).join(days.select(*sums), "day")
    delayed = (F.col("event_id") % 29 == 0) & (F.col("ts") < "2024-01-15")
    events = _prediction_like(spark, d).filter(~delayed)
    last = events.agg(F.max("ts")).scalar()
    closed = events.filter(F.date_trunc("hour", "ts") + F.expr("INTERVAL 1 HOUR") <= last - F.expr("INTERVAL 1 DAY"))
    ranked = closed.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "latency_ms").join(report.select("day", "p_latency_ms"), "day").groupBy("day").agg(
        (F.count_if(F.col("latency_ms") < F.col("p_latency_ms")) / F.count("latency_ms")).alias("below"),
        (F.count_if(F.col("latency_ms") <= F.col("p_latency_ms")) / F.count("latency_ms")).alias("up_to"))
    close = (F.col("below") <= 0.95 + SW.RANK_ERROR) & (F.col("up_to") >= 0.95 - SW.RANK_ERROR)
    return report.join(ranked, "day").select("day", "n", "errors", "latency_sum", close.alias("p95_close"))


def stream_late_rows(spark, d):
    """The rows that came after their window had closed, by day."""
    late = SW.late_rows(spark, _closed(spark, d))
    return late.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("latency_ms"), 4).alias("latency_sum"))


def stream_recent_drift(spark, d):
    """Drift of the last 200 event hours of a stream in four files against the first half of the month."""
    halves = table(spark, d, "events").filter(F.col("ts") < "2024-01-15").select("event_id", F.col("value").alias("v"), F.col("user_id").alias("u"))
    reference = D.build_reference(halves, ["v", "u"], row_key=["event_id"])
    out = scratch_path(spark, "recent-drift")
    RC.start_recent_drift(M.stream_predictions(spark, _delayed_log(spark, d), max_files=1), reference, RC.Last(hours=200), f"{out}/ring", f"{out}/report",
                          f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/report").select("feature", "n_current", r6("psi"), r6("ks_stat"), "status", r6("ref_mean"), r6("cur_mean"))


def stream_uptime(spark, d):
    path, out = scratch_path(spark, "health-log"), scratch_path(spark, "stream-uptime")
    probes = _probes(spark, d).select(F.to_json(F.struct(
        F.concat_ws("#", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("timestamp"),
        "up", "response_time_ms", F.when(F.col("up"), "fine").otherwise("unreachable").alias("detail"))).alias("value"))
    probes.repartition(3).write.text(path)
    stream = M.running_uptime(logs.health_events(M.stream_lines(spark, path, max_files=1)))
    M.start_table(stream, out, scratch_path(spark, "stream-checkpoint")).awaitTermination()
    return spark.read.parquet(out).select("probes", "uptime_pct", "avg_response_ms", "last_status")


def stream_http(spark, d):
    """Request counters over a stream of HTTP log files."""
    path, out = scratch_path(spark, "http-log"), scratch_path(spark, "stream-http")
    _requests(spark, d).select(F.to_json(F.struct("path", "status_code", "latency_ms")).alias("value")).repartition(3).write.text(path)
    stream = O.http_counters(logs.http_events(M.stream_lines(spark, path, max_files=1)))
    M.start_table(stream, out, scratch_path(spark, "stream-checkpoint")).awaitTermination()
    return spark.read.parquet(out).select(
        "requests_total", "predict_requests_total", "predict_errors_total", F.round("latency_sum_ms", 4).alias("latency_sum_ms"),
        "latency_count", r6("latency_avg_ms"))


def stream_drift(spark, d):
    """The streamed log against the first half of the month as reference."""
    events = table(spark, d, "events")
    halves = events.filter(F.col("ts") < "2024-01-15").select("event_id", F.col("value").alias("v"), F.col("user_id").alias("u"))
    reference = D.build_reference(halves, ["v", "u"], row_key=["event_id"])
    path, out = _streamed_log(spark, d), scratch_path(spark, "stream-drift")
    M.start_drift(M.stream_predictions(spark, path, max_files=2), reference, scratch_path(spark, "stream-counts"), out,
                  scratch_path(spark, "stream-checkpoint")).awaitTermination()
    return spark.read.parquet(out).select("feature", "n_current", r6("psi"), r6("ks_stat"), "status", r6("ref_mean"), r6("cur_mean"))


def dashboard(spark, d):
    """The dashboard record from stored logs, its main numbers laid out flat."""
    from cohortline.plans import monitor
    log, health, out = _streamed_log(spark, d), scratch_path(spark, "health-log"), scratch_path(spark, "reports")
    _probes(spark, d).select(F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"), "up", "response_time_ms")).alias("value")).write.text(health)
    halves = table(spark, d, "events").filter(F.col("ts") < "2024-01-15").select("event_id", F.col("value").alias("v"), F.col("user_id").alias("u"))
    monitor.rebuild_reference(halves, ["v", "u"], None, out, row_key=["event_id"])
    monitor.check_drift(spark, log, out)
    record = monitor.build_dashboard(spark, log, health, out)
    return record.select(
        "api_metrics.total_predictions", "api_metrics.errors", "api_metrics.error_rate_pct", "api_metrics.avg_latency_ms",
        "api_metrics.p50_latency_ms", "api_metrics.p95_latency_ms", "api_metrics.p99_latency_ms",
        F.size("api_metrics.latency_trend").alias("trend_length"), F.size("model_metrics.class_distribution").alias("n_classes"),
        "health.probes", "health.uptime_pct", "drift.overall_status", "drift.n_samples", F.size("drift.features").alias("n_features"))


MODEL_QUERIES = {
    "split": split,
    "folds": folds,
    "standardize": standardize,
    "scaler_stats": scaler_stats,
    "class_weights": class_weights,
    "classification_metrics": classification_metrics,
    "class_report": class_report,
    "confusion": confusion,
    "roc_auc": roc_auc,
    "roc_auc_bucketed": roc_auc,
    "roc_curve": roc_curve,
    "champion": champion,
    "metric_comparison": metric_comparison,
    "nearest_neighbours": nearest_neighbours,
    "nearest_neighbours_pivoted": nearest_neighbours_pivoted,
    "smote": smote,
    "edited_neighbours": edited_neighbours,
    "edited_half_spaces": edited_half_spaces,
    "nearest_of_twentieth": nearest_of_twentieth,
    "neighbour_recall": neighbour_recall,
    "forest_metrics": forest_metrics,
    "svc_metrics": svc_metrics,
    "poly_roc": poly_roc,
    "poly_sketch_roc": poly_sketch_roc,
    "poly_sketch": poly_sketch,
    "landmark_metrics": landmark_metrics,
    "kernel_estimates": kernel_estimates,
    "cross_validation": cross_validation,
    "learning_curve": learning_curve,
    "feature_elimination": feature_elimination,
    "input_validation": input_validation,
    "input_ranges": input_ranges,
    "scored_rows": scored_rows,
    "batch_score": batch_score,
    "stream_totals": stream_totals,
    "stream_windows": stream_windows,
    "stream_windows_p95": stream_windows_p95,
    "stream_closed_windows": stream_closed_windows,
    "stream_late_rows": stream_late_rows,
    "stream_recent_drift": stream_recent_drift,
    "stream_uptime": stream_uptime,
    "stream_http": stream_http,
    "stream_drift": stream_drift,
    "dashboard": dashboard,
}
