"""The operators applied to the driver's tables. Each query takes (spark, dir) and
reads whole tables; ``driver_oracles`` holds the same questions as plain SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from cohortline.functions import numeric as N
from cohortline.functions import variant as V
from cohortline.functions.status import is_predict_path, severity
from cohortline.functions.text import LabelRule, follow_up_tag, normalise_label, ordinal_encode, stable_hash
from cohortline.functions.timefn import event_time
from cohortline.operators import checks as C
from cohortline.operators import columns as K
from cohortline.operators import drift as D
from cohortline.operators import ops_metrics as O
from cohortline.operators import prep
from cohortline.operators import profile as P
from cohortline.operators import ranked as R
from cohortline.plans import layers as L
from cohortline.session import cut_lineage, ensure_checkpoint_dir
from cohortline.sources import logs, records

CUT_DATE = "1998-01-01"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")
ITEM_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

SEGMENT_RULES = (
    LabelRule("AUTOMOBILE", "automobile", case_sensitive=True),
    LabelRule("Building", "building"),
    LabelRule("Furniture", "furniture"),
    LabelRule("machinery", "machinery", case_sensitive=True),
)
SEGMENT_CODES = {"automobile": 0, "building": 1, "furniture": 2}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def r6(name: str, places: int = 6):
    return F.round(name, places).alias(name)


# -- cleaning and encoding -------------------------------------------------------------------------------------

def label_normalize(spark, d):
    labelled = table(spark, d, "customer").select(normalise_label(F.col("c_mktsegment"), SEGMENT_RULES, "other").alias("label"))
    return P.value_counts(labelled, "label").select(F.col("value").alias("label"), "n", r6("share"), r6("pct"))


def ordinal_encode_query(spark, d):
    customer = table(spark, d, "customer")
    label = normalise_label(F.col("c_mktsegment"), SEGMENT_RULES, "other")
    fitted = prep.fit_label_codes(customer, "c_mktsegment")
    return customer.select(
        "c_custkey", ordinal_encode(label, SEGMENT_CODES).alias("fixed_code"),
        ordinal_encode(F.col("c_mktsegment"), fitted).alias("fitted_code"))


def star_exclude_log1p(spark, d):
    item = K.star_exclude(table(spark, d, "lineitem"), ["l_shipdate", "l_tax", "l_discount"])
    return K.replace_at_end(item, {"l_extendedprice": F.round(N.log1p(F.col("l_extendedprice")), 6)})


def _flags(item):
    return item.withColumns({
        "f1": (F.col("l_quantity") > 25).cast("bigint"),
        "f2": (F.col("l_discount") > 0.05).cast("bigint"),
        "f3": F.when(F.col("l_tax") > 0, (F.col("l_tax") > 0.04).cast("bigint")),
    })


def flag_sum_query(spark, d):
    flags = ["f1", "f2", "f3"]
    summed = _flags(table(spark, d, "lineitem")).select(
        "l_returnflag", N.flag_sum(flags).alias("strict_sum"), N.flag_sum(flags, skip_nulls=True).alias("filled_sum"))
    return summed.groupBy("l_returnflag", "strict_sum", "filled_sum").agg(F.count(F.lit(1)).alias("n"))


def _item_layers(spark, d) -> L.LayerConfig:
    flag_names = {"A": "accepted", "N": "none", "R": "returned"}
    return L.LayerConfig(
        source_columns=("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                        "l_linestatus", "l_returnflag", "f1", "f2", "f3"),
        folded_text=("l_linestatus",),
        label_column="l_returnflag",
        label_rules=(LabelRule("A", "accepted", case_sensitive=True), LabelRule("r", "returned")),
        label_default="other",
        constant_columns=("l_tax",),
        log_columns=("l_extendedprice",),
        correlated_columns=("l_discount",),
        flag_columns=("f1", "f2", "f3"),
        flag_sum_column="flag_count",
        id_columns=("l_orderkey",),
        encoders={"l_linestatus": {"f": 0, "o": 1}, "l_returnflag": {v: i for i, v in enumerate(flag_names.values()) if v != "none"}},
        renames=(("l_quantity", "Quantity"), ("l_extendedprice", "Price")),
        contract=StructType([
            StructField("Quantity", DoubleType()), StructField("Price", DoubleType()), StructField("l_partkey", LongType()),
            StructField("l_linenumber", IntegerType()), StructField("f1", LongType()), StructField("f2", LongType()),
            StructField("f3", LongType()), StructField("flag_count", LongType()), StructField("l_linestatus", IntegerType()),
            StructField("l_returnflag", IntegerType()),
        ]),
        layer_checks={
            "staged": (C.ColumnCheck("not_null", "l_orderkey"),
                       C.ColumnCheck("accepted_values", "l_returnflag", ("accepted", "returned"), severity="warn")),
            "features": (C.ColumnCheck("not_null", "flag_count", severity="warn"),),
            "model": (C.ColumnCheck("not_null", "l_returnflag", severity="warn"), C.ColumnCheck("accepted_values", "l_linestatus", (0, 1))),
        },
        fingerprint_columns=("l_linenumber", "l_linestatus", "l_returnflag"),
        duplicate_band=(0.40, 0.60),
        id_band=("l_orderkey", 500, 800),
    )


def layer_pipeline(spark, d):
    cfg = _item_layers(spark, d)
    model = L.layer_chain(_flags(table(spark, d, "lineitem")), cfg)["model"]
    return model.groupBy("l_returnflag", "l_linestatus", "flag_count").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("Price"), 6).alias("avg_log_price"), F.sum("Quantity").alias("sum_quantity"))


def layer_checks(spark, d):
    cfg = _item_layers(spark, d)
    raw = _flags(table(spark, d, "lineitem"))
    return L.check_layers(raw, L.layer_chain(raw, cfg), cfg).select(
        "check", "layer", "column", "severity", "n_violations", "passed")


def contract_check(spark, d):
    expected = StructType([
        StructField("o_orderkey", LongType()), StructField("o_totalprice", DoubleType()), StructField("o_orderstatus", StringType()),
    ])
    orders = K.project(table(spark, d, "orders"), ["o_orderkey", "o_totalprice", "o_orderstatus"])
    return C.enforce_schema(orders, expected).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("max_key"))


def rename_pipeline(spark, d):
    renamed = K.rename_first(table(spark, d, "supplier"), [("s_acctbal", "Balance"), ("s_nationkey", "Nation")])
    features, target = K.split_target(renamed, "Nation")
    return K.project(features, ["Balance", "s_suppkey", "s_name"])


# -- checks ----------------------------------------------------------------------------------------------------

def not_null_accepted(spark, d):
    orders = C.run_column_checks(table(spark, d, "orders"), "orders", [
        C.ColumnCheck("not_null", "o_orderkey"), C.ColumnCheck("not_null", "o_custkey"),
        C.ColumnCheck("accepted_values", "o_orderstatus", ("F", "O")),
        C.ColumnCheck("accepted_values", "o_orderpriority", ("1-URGENT", "2-HIGH", "5-LOW"), severity="warn"),
    ])
    events = C.run_column_checks(table(spark, d, "events"), "events", [
        C.ColumnCheck("not_null", "value"),
        C.ColumnCheck("accepted_values", "event_type", ("view", "click", "purchase", "signup")),
        C.ColumnCheck("in_range", "value", (0, 300)),
    ])
    return orders.unionByName(events).select("check", "layer", "column", "severity", "n_violations", "passed")


def row_preservation(spark, d):
    cfg = _item_layers(spark, d)
    return C.layer_counts(L.layer_chain(_flags(table(spark, d, "lineitem")), cfg))


def row_loss(spark, d):
    item = table(spark, d, "lineitem")
    counts = C.layer_counts({"raw": item, "staged": item, "filtered": item.filter("l_quantity > 10")})
    return C.row_loss(counts, "raw")


def duplicate_rate(spark, d):
    rate = C.duplicate_rate(table(spark, d, "lineitem"), ["l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"])
    return C.outside_band(rate, "duplicate_rate", 0.40, 0.60).select("total_rows", "distinct_rows", r6("duplicate_rate"))


def id_cardinality(spark, d):
    found = C.id_cardinality(table(spark, d, "events"), "user_id")
    return C.outside_band(found, "distinct_ids", 200, 800)


def unmapped_labels(spark, d):
    part = table(spark, d, "part")
    rules = (LabelRule("economy", "economy"), LabelRule("Large", "large"), LabelRule("small", "small", case_sensitive=True))
    labelled = part.withColumns({"raw_label": F.trim("p_type"), "kind": normalise_label(F.col("p_type"), rules, "other")})
    return C.unmapped_labels(labelled, "raw_label", "kind", "other")


# -- profile ---------------------------------------------------------------------------------------------------

def _gappy_items(spark, d):
    return table(spark, d, "lineitem").withColumns({
        "l_tax": F.when(F.col("l_tax") > 0.02, F.col("l_tax")),
        "l_returnflag": F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")),
        "fixed": F.lit(0),
        "always_null": F.lit(None).cast("double"),
    })


def null_profile(spark, d):
    return P.null_profile(_gappy_items(spark, d))


def constant_columns(spark, d):
    df = _gappy_items(spark, d)
    kinds = K.distinct_classes(df, df.columns)
    return spark.createDataFrame(sorted(kinds.items()), "column_name string, kind string")


def column_choice(spark, d):
    df = _flags(table(spark, d, "lineitem"))
    chosen = [(c, "continuous") for c in K.continuous_columns(df)] + [(c, "binary") for c in K.binary_columns(df)]
    return spark.createDataFrame(chosen, "column_name string, role string")


def skew_profile(spark, d):
    orders = P.skew_profile(table(spark, d, "orders"), ["o_totalprice", "o_custkey"])
    items = P.skew_profile(table(spark, d, "lineitem"), MEASURES)
    events = P.skew_profile(table(spark, d, "events").withColumn("log_value", N.log1p(F.col("value"))), ["value", "log_value"])
    return orders.unionByName(items).unionByName(events).select("column_name", r6("skewness"))


CORR_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "double_price", "gap_tax"]


def _corr_items(spark, d):
    return table(spark, d, "lineitem").withColumns({
        "double_price": F.col("l_extendedprice") * 2 + F.col("l_quantity"),
        "gap_tax": F.when(F.col("l_quantity") > 10, F.col("l_tax") + F.col("l_discount")),
    })


def corr_pairs(spark, d):
    return P.corr_pairs(_corr_items(spark, d), CORR_COLUMNS).select("left_col", "right_col", r6("r"))


def corr_prune(spark, d):
    return P.corr_prune(P.corr_pairs(_corr_items(spark, d), CORR_COLUMNS), 0.85).select("column_name", r6("max_abs_r"))


def corr_missing(spark, d):
    """NaN counts as missing, pair by pair."""
    nan = F.lit(float("nan"))
    item = table(spark, d, "lineitem").select(
        F.when(F.col("l_linenumber") == 1, nan).otherwise(F.col("l_quantity")).alias("quantity"), "l_extendedprice",
        F.when(F.col("l_tax") > 0.05, nan).otherwise(F.col("l_extendedprice") + 100 * F.col("l_quantity")).alias("mixed"))
    return P.corr_pairs(item).select("left_col", "right_col", r6("r"))


DUP_COLUMNS = ["l_linenumber", "l_quantity", "l_discount", "l_returnflag", "l_linestatus"]


def duplicate_rows(spark, d):
    listed = P.duplicate_rows(table(spark, d, "lineitem").select(*DUP_COLUMNS))
    return listed.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("is_repeat").alias("n_repeats"), F.sum("l_quantity").alias("sum_quantity"))


def duplicate_groups(spark, d):
    return P.duplicate_groups(table(spark, d, "lineitem").select(*DUP_COLUMNS))


def duplicate_columns(spark, d):
    item = table(spark, d, "lineitem").select(
        "l_orderkey", "l_quantity", "l_tax", F.col("l_quantity").alias("qty_copy"), F.col("l_returnflag"),
        F.col("l_quantity").cast("bigint").alias("qty_whole"), F.upper("l_returnflag").alias("flag_copy"),
        (F.col("l_quantity") + F.when(F.col("l_orderkey") == 1, 1).otherwise(0)).alias("qty_almost"))
    return P.duplicate_columns(item)


def value_counts(spark, d):
    return P.value_counts(table(spark, d, "orders"), "o_orderstatus").select("value", "n", r6("share"), r6("pct"))


def distinct_values(spark, d):
    return P.distinct_values(table(spark, d, "orders"), "o_orderpriority")


def crosstab(spark, d):
    return P.crosstab(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O"])


def stage_sizes(spark, d):
    item = table(spark, d, "lineitem")
    return P.stage_sizes({"raw": item, "staged": K.star_exclude(item, ["l_shipdate"]), "kept": item.filter("l_quantity > 10")})


def column_catalogue(spark, d):
    return records.column_catalogue({n: table(spark, d, n) for n in TABLES})


# -- distributions and drift -----------------------------------------------------------------------------------

def _price_sides(spark, d):
    orders = table(spark, d, "orders").select(F.lit("o_totalprice").alias("feature"), F.col("o_totalprice").alias("value"), "o_orderdate")
    return orders.filter(F.col("o_orderdate") < CUT_DATE), orders.filter(F.col("o_orderdate") >= CUT_DATE)


def _edges_out(edges):
    return edges.select("feature", "n", F.posexplode("edges").alias("pos", "edge")).select("feature", "n", "pos", r6("edge"))


def quantile_edges(spark, d):
    ref, _ = _price_sides(spark, d)
    return _edges_out(D.quantile_edges(ref))


def quantile_edges_bucketed(spark, d):
    item = K.long_form(table(spark, d, "lineitem"), MEASURES, "feature")
    return _edges_out(D.quantile_edges(item))


def histogram(spark, d):
    ref, cur = _price_sides(spark, d)
    return D.histogram(cur, D.quantile_edges(ref)).select("feature", "bin", "n", r6("share"))


def psi(spark, d):
    ref, cur = _price_sides(spark, d)
    edges = D.quantile_edges(ref)
    return D.psi(D.histogram(ref, edges), D.histogram(cur, edges)).select("feature", r6("psi"))


def ks_stat(spark, d):
    ref, cur = _price_sides(spark, d)
    return D.ks_two_sample(ref, cur).select("feature", r6("ks_stat"), "n_left", "n_right")


def _item_sides(spark, d):
    item = table(spark, d, "lineitem")
    shifted = item.filter(F.col("l_shipdate") >= CUT_DATE).withColumn("l_quantity", F.col("l_quantity") * 0.6)
    return item.filter(F.col("l_shipdate") < CUT_DATE), shifted


def _item_drift(spark, d):
    ref, cur = _item_sides(spark, d)
    reference = D.build_reference(ref, MEASURES, row_key=ITEM_KEY)
    return D.feature_drift(K.long_form(cur, MEASURES, "feature"), reference)


def drift_report(spark, d):
    return _item_drift(spark, d).select("feature", "n_current", r6("psi"), r6("ks_stat"), "status", r6("ref_mean"), r6("cur_mean"))


def drift_own_reference(spark, d):
    """Data against its own reference of 20 bins and 5,000 sample points: no drift."""
    item = table(spark, d, "lineitem")
    reference = D.build_reference(item, MEASURES, row_key=ITEM_KEY, n_bins=20, sample_size=5000)
    found = D.feature_drift(K.long_form(item, MEASURES, "feature"), reference)
    return found.select("feature", "n_current", r6("psi"), (F.col("ks_stat") < 0.05).alias("ks_close"), "status")


def drift_summary(spark, d):
    _, cur = _item_sides(spark, d)
    n = cur.agg(F.count(F.lit(1))).scalar()
    return D.drift_summary(_item_drift(spark, d), n).select("n_production_samples", "drifted", "watch", "stable", "overall_status")


def reference_sample(spark, d):
    ref, _ = _item_sides(spark, d)
    keyed = K.long_form(ref.withColumn("h", stable_hash(*ITEM_KEY)), MEASURES, "feature", keep=["h", *ITEM_KEY])
    return R.bottom_k_sample(keyed, ["feature"], "h", ITEM_KEY, 2000).drop("h")


def label_distribution(spark, d):
    return D.label_distribution(table(spark, d, "embeddings"), "label").select("label", r6("share"))


def segment_drift(spark, d):
    """Flagship: normalise and encode the customer segment, log the order price,
    then per segment compare orders before and after the cut date."""
    customer = table(spark, d, "customer").select(
        "c_custkey", normalise_label(F.col("c_mktsegment"), SEGMENT_RULES, "other").alias("feature"))
    orders = table(spark, d, "orders").select(
        F.col("o_custkey").alias("c_custkey"), N.log1p(F.col("o_totalprice")).alias("value"), "o_orderdate")
    # read by the edges and by both histograms
    joined = cut_lineage(orders.join(customer, "c_custkey").select("feature", "value", "o_orderdate"))
    ref, cur = joined.filter(F.col("o_orderdate") < CUT_DATE), joined.filter(F.col("o_orderdate") >= CUT_DATE)
    edges = D.quantile_edges(ref.select("feature", "value"))
    index = D.psi(D.histogram(ref, edges), D.histogram(cur, edges))
    status = F.when(F.col("psi") > 0.25, "DRIFT").when(F.col("psi") > 0.10, "WATCH").otherwise("STABLE")
    return index.select(
        "feature", ordinal_encode(F.col("feature"), SEGMENT_CODES).alias("segment_code"), r6("psi"), status.alias("status"),
        severity(status).alias("severity"),
    ).orderBy(F.desc("psi"), "feature")


# -- operations ------------------------------------------------------------------------------------------------

def _prediction_like(spark, d):
    """Events as predictions: value is the latency, errors fail, the type is the label."""
    return table(spark, d, "events").select(
        event_time(F.col("ts")).alias("ts"), "event_id", "user_id",
        F.when(F.col("event_type") != "error", "success").when(F.col("user_id") % 2 == 0, "error").alias("status"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("prediction"), F.col("value").alias("latency_ms"))


def latency_metrics(spark, d):
    return O.api_metrics(_prediction_like(spark, d))


def latency_percentiles(spark, d):
    return O.latency_percentiles(_prediction_like(spark, d))


def class_counts(spark, d):
    return O.class_counts(_prediction_like(spark, d))


def latency_trend(spark, d):
    trend = O.latency_trend(_prediction_like(spark, d), ["ts", "event_id"])
    return trend.select(F.posexplode("latency_trend").alias("pos", "latency_ms"))


def _probes(spark, d):
    return table(spark, d, "events").select(
        (F.col("event_type") != "error").alias("up"), F.when(F.col("event_type") != "signup", F.col("value")).alias("response_time_ms"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("checked_at"), "ts", "event_id", "user_id")


def uptime(spark, d):
    return O.uptime(_probes(spark, d), ["ts", "event_id"]).select(
        "probes", "uptime_pct", "avg_response_ms", "last_status", "last_check", severity(F.col("last_status")).alias("severity"))


def uptime_window(spark, d):
    return O.uptime(_probes(spark, d), ["ts", "event_id"], window=500)


def uptime_by_user(spark, d):
    return O.uptime(_probes(spark, d), ["ts", "event_id"], keys=["user_id"])


def _requests(spark, d):
    kind = F.col("event_type")
    return table(spark, d, "events").select(
        F.when(kind == "purchase", "/api/predict/").when(kind == "click", "/predict").when(kind == "error", "/predict")
        .otherwise(F.concat(F.lit("/"), kind)).alias("path"),
        F.when(kind == "error", F.lit(None)).when(kind == "purchase", F.when(F.col("user_id") % 5 == 0, 422).otherwise(200))
        .otherwise(200).cast("int").alias("status_code"),
        F.col("value").alias("latency_ms"))


def http_counters(spark, d):
    return O.http_counters(_requests(spark, d)).select(
        "requests_total", "predict_requests_total", "predict_errors_total", F.round("latency_sum_ms", 4).alias("latency_sum_ms"),
        "latency_count", r6("latency_avg_ms"))


def requests_by_status(spark, d):
    return O.requests_by_status(_requests(spark, d))


def predict_paths(spark, d):
    return _requests(spark, d).groupBy("path").agg(
        F.first(is_predict_path(F.col("path"))).alias("is_predict"), F.count(F.lit(1)).alias("n"))


def json_props(spark, d):
    parsed = table(spark, d, "events").select("event_type", V.parse_line(F.col("props")).alias("e"))
    return parsed.groupBy("event_type").agg(
        F.count_if(F.col("e").isNotNull()).alias("n"), F.sum(V.number_field(F.col("e"), "k")).alias("k_sum"),
        F.max(V.number_field(F.col("e"), "k")).alias("k_max"))


def _log_lines(spark, d) -> DataFrame:
    """Events as a prediction log with the odd lines a real one has."""
    record = F.to_json(F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"), F.lit("prediction").alias("event"), "status",
        "prediction", F.col("latency_ms").alias("latency_ms"), F.struct(F.col("latency_ms").alias("v"), F.col("user_id").alias("u")).alias("features")))
    key = F.col("event_id") % 50
    line = F.when(key == 7, "").when(key == 11, "{not json").when(key == 13, F.regexp_replace(record, r'"latency_ms":[0-9.E]+', '"latency_ms":"slow"'))
    line = line.when(key == 17, '{"status":"success","prediction":"","latency_ms":true}').when(key == 19, '{"latency_ms":null,"features":3}')
    return _prediction_like(spark, d).select(line.otherwise(record).alias("value"))


def log_scan(spark, d):
    path = scratch_path(spark, "prediction-log")
    _log_lines(spark, d).write.text(path)
    events = logs.prediction_events(logs.read_lines(spark, path))
    return events.groupBy("status", "prediction").agg(
        F.count(F.lit(1)).alias("n"), F.count("latency_ms").alias("n_latency"), F.count_if(F.col("features").isNotNull()).alias("n_features"),
        F.round(F.sum("latency_ms"), 4).alias("latency_sum"))


def log_features(spark, d):
    path = scratch_path(spark, "prediction-log")
    _log_lines(spark, d).write.text(path)
    values = logs.feature_values(logs.prediction_events(logs.read_lines(spark, path)))
    return values.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


def windowed_metrics(spark, d):
    from cohortline.streaming.metrics import window_metrics
    return window_metrics(_prediction_like(spark, d), "1 hour", percentile=False).select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n", "errors", r6("avg_latency_ms"))


def windowed_p95(spark, d):
    """With the approximate p95 of each window, which the SQL twin of ``windowed_metrics`` leaves out."""
    from cohortline.streaming.metrics import window_metrics
    return window_metrics(_prediction_like(spark, d), "1 hour").select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n", "errors", r6("avg_latency_ms"), "p95_latency_ms")


def last_n(spark, d):
    return R.last_n(table(spark, d, "events").select("event_id", "event_type", "value", "ts"), 200, ["ts", "event_id"]).drop("ts")


def head_orders(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return R.head(orders, 100, ["o_orderpriority", F.desc("o_totalprice"), "o_orderkey"])


def dedup_first(spark, d):
    return R.first_per_key(table(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select(
        "user_id", "event_type", "event_id", "value")


def follow_up(spark, d):
    named = table(spark, d, "part").select(follow_up_tag(F.col("p_name"), "widget").alias("tag"), "p_size")
    return named.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("size_sum"))


def csv_load(spark, d):
    """Round trip through CSV: odd headers, normalised names, inferred types."""
    path = scratch_path(spark, "customer-csv")
    customer = table(spark, d, "customer").select(
        F.col("c_custkey").alias("Cust-Key"), F.col("c_acctbal").alias("AcctBal (EUR)"), F.col("c_mktsegment").alias("mktSegment"),
        F.col("c_nationkey").alias("Nation_Key"), F.lit(1).alias("Nation-Key"))
    records.write_csv(customer, path)
    loaded = records.load_csv(spark, path).data
    return loaded.groupBy("mkt_segment").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cust_key").alias("key_sum"), F.round(F.sum("acct_bal_eur"), 2).alias("balance"),
        F.sum("nation_key").alias("nation_sum"), F.count_distinct(records.ROW_ID).alias("n_row_ids"))


def csv_reordered(spark, d):
    """A schema whose columns stand in another order than the file's header."""
    path = scratch_path(spark, "supplier-csv")
    records.write_csv(table(spark, d, "supplier").select("s_acctbal", "s_name", "s_nationkey", "s_suppkey"), path)
    return records.read_csv(spark, path, "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")


QUERIES = {
    "segment_drift": segment_drift,
    "label_normalize": label_normalize,
    "ordinal_encode": ordinal_encode_query,
    "star_exclude_log1p": star_exclude_log1p,
    "flag_sum": flag_sum_query,
    "layer_pipeline": layer_pipeline,
    "layer_checks": layer_checks,
    "contract_check": contract_check,
    "rename_pipeline": rename_pipeline,
    "not_null_accepted": not_null_accepted,
    "row_preservation": row_preservation,
    "row_loss": row_loss,
    "duplicate_rate": duplicate_rate,
    "id_cardinality": id_cardinality,
    "unmapped_labels": unmapped_labels,
    "null_profile": null_profile,
    "constant_columns": constant_columns,
    "column_choice": column_choice,
    "skew_profile": skew_profile,
    "corr_pairs": corr_pairs,
    "corr_missing": corr_missing,
    "corr_prune": corr_prune,
    "duplicate_rows": duplicate_rows,
    "duplicate_groups": duplicate_groups,
    "duplicate_columns": duplicate_columns,
    "value_counts": value_counts,
    "distinct_values": distinct_values,
    "crosstab": crosstab,
    "stage_sizes": stage_sizes,
    "column_catalogue": column_catalogue,
    "quantile_edges": quantile_edges,
    "quantile_edges_bucketed": quantile_edges_bucketed,
    "histogram": histogram,
    "psi": psi,
    "ks_stat": ks_stat,
    "ks_stat_bucketed": ks_stat,
    "drift_report": drift_report,
    "drift_own_reference": drift_own_reference,
    "drift_summary": drift_summary,
    "reference_sample": reference_sample,
    "label_distribution": label_distribution,
    "latency_metrics": latency_metrics,
    "latency_percentiles": latency_percentiles,
    "latency_percentiles_bucketed": latency_percentiles,
    "class_counts": class_counts,
    "latency_trend": latency_trend,
    "uptime": uptime,
    "uptime_window": uptime_window,
    "uptime_by_user": uptime_by_user,
    "http_counters": http_counters,
    "requests_by_status": requests_by_status,
    "predict_paths": predict_paths,
    "json_props": json_props,
    "log_scan": log_scan,
    "log_features": log_features,
    "windowed_metrics": windowed_metrics,
    "windowed_p95": windowed_p95,
    "last_n": last_n,
    "head_orders": head_orders,
    "dedup_first": dedup_first,
    "follow_up": follow_up,
    "csv_load": csv_load,
    "csv_reordered": csv_reordered,
}
