"""Plain-SQL twins of ``driver_queries``, for a second engine on the same files."""

_SEGMENT = """CASE WHEN trim(c_mktsegment) = 'AUTOMOBILE' THEN 'automobile'
    WHEN lower(trim(c_mktsegment)) = 'building' THEN 'building'
    WHEN lower(trim(c_mktsegment)) = 'furniture' THEN 'furniture'
    WHEN trim(c_mktsegment) = 'machinery' THEN 'machinery' ELSE 'other' END"""

_FLAGGED = """SELECT *, (l_quantity > 25)::BIGINT AS f1, (l_discount > 0.05)::BIGINT AS f2,
    CASE WHEN l_tax > 0 THEN (l_tax > 0.04)::BIGINT END AS f3 FROM lineitem"""

_STAGED = f"""SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, lower(trim(l_linestatus)) AS status,
    CASE WHEN trim(l_returnflag) = 'A' THEN 'accepted' WHEN lower(trim(l_returnflag)) = 'r' THEN 'returned' ELSE 'other' END AS flag,
    f1, f2, f3 FROM ({_FLAGGED})"""

_PRICES = """SELECT 'o_totalprice' AS feature, o_totalprice AS value, o_orderdate < TIMESTAMP '1998-01-01' AS is_ref FROM orders"""

_ITEMS_LONG = """SELECT feature, value FROM (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
    UNPIVOT (value FOR feature IN (l_quantity, l_extendedprice, l_discount, l_tax))"""

_TENTHS = "[0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]"


def _edges(source: str) -> str:
    return f"""SELECT feature, count(*) AS n, list_sort(list_distinct(quantile_cont(value, {_TENTHS}))) AS edges
        FROM ({source}) GROUP BY feature"""


def _bins(values: str, edges: str) -> str:
    """Counts and shares of every bin, zeros included."""
    return f"""SELECT b.feature, b.bin, b.n_bins, count(v.value) AS n,
            coalesce(count(v.value) / nullif(sum(count(v.value)) OVER (PARTITION BY b.feature), 0), 0) AS share
        FROM (SELECT feature, unnest(range(1, len(edges))) AS bin, len(edges) - 1 AS n_bins, edges FROM ({edges})) b
        LEFT JOIN ({values}) v ON v.feature = b.feature AND v.value >= b.edges[b.bin]
            AND (v.value < b.edges[b.bin + 1] OR (b.bin = b.n_bins AND v.value = b.edges[b.bin + 1]))
        GROUP BY b.feature, b.bin, b.n_bins"""


_REF = f"SELECT feature, value FROM ({_PRICES}) WHERE is_ref"
_CUR = f"SELECT feature, value FROM ({_PRICES}) WHERE NOT is_ref"


def _psi(ref: str, cur: str) -> str:
    edges = _edges(ref)
    return f"""SELECT r.feature, sum((greatest(c.share, 1e-6) - greatest(r.share, 1e-6))
            * ln(greatest(c.share, 1e-6) / greatest(r.share, 1e-6))) AS psi
        FROM ({_bins(ref, edges)}) r JOIN ({_bins(cur, edges)}) c USING (feature, bin) GROUP BY r.feature"""


def _ks(ref: str, cur: str) -> str:
    return f"""SELECT feature, max(abs(a_cum / n_left - b_cum / n_right)) AS ks_stat, max(n_left)::BIGINT AS n_left, max(n_right)::BIGINT AS n_right
        FROM (SELECT feature, value, sum(sum(a)) OVER w AS a_cum, sum(sum(b)) OVER w AS b_cum,
                sum(sum(a)) OVER (PARTITION BY feature) AS n_left, sum(sum(b)) OVER (PARTITION BY feature) AS n_right
            FROM (SELECT feature, value, 1 AS a, 0 AS b FROM ({ref}) UNION ALL SELECT feature, value, 0, 1 FROM ({cur}))
            GROUP BY feature, value WINDOW w AS (PARTITION BY feature ORDER BY value))
        GROUP BY feature"""


_ITEM_SIDES = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax,
    CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN l_quantity ELSE l_quantity * 0.6 END AS l_quantity,
    l_shipdate < TIMESTAMP '1998-01-01' AS is_ref FROM lineitem"""
_SIDES_LONG = f"""SELECT * FROM ({_ITEM_SIDES}) UNPIVOT (value FOR feature IN (l_quantity, l_extendedprice, l_discount, l_tax))"""
_ITEM_REF = f"SELECT feature, value, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM ({_SIDES_LONG}) WHERE is_ref"
_ITEM_CUR = f"SELECT feature, value FROM ({_SIDES_LONG}) WHERE NOT is_ref"
_HASH = "('0x' || substr(md5({key}), 1, 8))::BIGINT"
_SAMPLE = f"""SELECT feature, value, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
    SELECT *, row_number() OVER (PARTITION BY feature ORDER BY {_HASH.format(key="concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, '42')")}, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn
    FROM ({_ITEM_REF})) WHERE rn <= 2000"""

_DRIFT = f"""SELECT feature, n AS n_current, psi, ks_stat,
        CASE WHEN psi > 0.25 OR (psi > 0.10 AND p < 0.05) THEN 'DRIFT' WHEN psi > 0.10 THEN 'WATCH' ELSE 'STABLE' END AS status, ref_mean, cur_mean
    FROM ({_psi(_ITEM_REF, _ITEM_CUR)})
    JOIN (SELECT feature, ks_stat, CASE WHEN lam < 0.02 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * (SELECT sum((CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * k * k * lam)) FROM range(1, 101) r(k)))) END AS p
        FROM (SELECT *, ks_stat * ks_stat * n_left * n_right / (n_left + n_right) AS lam FROM ({_ks(f"SELECT feature, value FROM ({_SAMPLE})", _ITEM_CUR)}))) USING (feature)
    JOIN (SELECT feature, avg(value) AS ref_mean FROM ({_ITEM_REF}) GROUP BY feature) USING (feature)
    JOIN (SELECT feature, count(*) AS n, avg(value) AS cur_mean FROM ({_ITEM_CUR}) GROUP BY feature) USING (feature)"""

_PREDICTIONS = """SELECT ts, event_id, user_id, value AS latency_ms,
    CASE WHEN event_type <> 'error' THEN 'success' WHEN user_id % 2 = 0 THEN 'error' END AS status,
    CASE WHEN event_type <> 'error' THEN event_type END AS prediction FROM events"""

_PROBES = """SELECT event_type <> 'error' AS up, CASE WHEN event_type <> 'signup' THEN value END AS response_time_ms,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS checked_at, ts, event_id, user_id FROM events"""
_UPTIME = """count(*) AS probes, round(100.0 * avg(up::INT), 2) AS uptime_pct, round(avg(response_time_ms), 2) AS avg_response_ms,
    arg_max(CASE WHEN up THEN 'UP' ELSE 'DOWN' END, (ts, event_id)) AS last_status, arg_max(checked_at, (ts, event_id)) AS last_check"""

_REQUESTS = """SELECT CASE event_type WHEN 'purchase' THEN '/api/predict/' WHEN 'click' THEN '/predict' WHEN 'error' THEN '/predict'
        ELSE '/' || event_type END AS path,
    CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'purchase' AND user_id % 5 = 0 THEN 422 ELSE 200 END AS status_code,
    value AS latency_ms FROM events"""
_PREDICT_PATH = "ends_with(rtrim(path, '/'), '/predict')"

_LOG = f"""SELECT status, prediction, latency_ms, latency_ms AS v, user_id AS u, event_id % 50 AS key FROM ({_PREDICTIONS})
    WHERE event_id % 50 NOT IN (7, 11)"""
_LOG_EVENTS = f"""SELECT
    CASE key WHEN 17 THEN 'success' WHEN 19 THEN NULL ELSE status END AS status,
    CASE key WHEN 17 THEN '' WHEN 19 THEN NULL ELSE prediction END AS prediction,
    CASE key WHEN 13 THEN NULL WHEN 17 THEN 1.0 WHEN 19 THEN NULL ELSE latency_ms END AS latency_ms,
    key NOT IN (17, 19) AS has_features, v, u FROM ({_LOG})"""

_GAPPY = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
    CASE WHEN l_tax > 0.02 THEN l_tax END AS l_tax, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS l_returnflag,
    l_linestatus, l_shipdate, 0 AS fixed, NULL::DOUBLE AS always_null FROM lineitem"""
_GAPPY_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                  "l_returnflag", "l_linestatus", "l_shipdate", "fixed", "always_null"]

_CORR_ITEMS = """SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_extendedprice * 2 + l_quantity AS double_price,
    CASE WHEN l_quantity > 10 THEN l_tax + l_discount END AS gap_tax FROM lineitem"""
_CORR_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "double_price", "gap_tax"]
_CORR = " UNION ALL ".join(
    f"SELECT {j} AS pos, '{a}' AS left_col, '{b}' AS right_col, corr({a}, {b}) AS r FROM ({_CORR_ITEMS})"
    for i, a in enumerate(_CORR_COLUMNS) for j, b in enumerate(_CORR_COLUMNS) if i < j)

_DUP = "SELECT l_linenumber, l_quantity, l_discount, l_returnflag, l_linestatus, count(*) AS n_copies FROM lineitem GROUP BY ALL HAVING count(*) > 1"


def _check(check, source, column, severity, violated, layer):
    return f"""SELECT '{check}' AS "check", '{layer}' AS layer, {f"'{column}'" if column else "NULL::VARCHAR"} AS "column", '{severity}' AS severity,
        count(*) FILTER (WHERE {violated}) AS n_violations, count(*) FILTER (WHERE {violated}) = 0 AS passed FROM ({source})"""


_SEGMENT_VALUES = f"""SELECT feature, value, is_ref FROM (SELECT {_SEGMENT} AS feature, ln(o_totalprice + 1) AS value,
    o_orderdate < TIMESTAMP '1998-01-01' AS is_ref FROM orders JOIN customer ON o_custkey = c_custkey)"""

ORACLES = {
    "segment_drift": f"""SELECT feature, CASE feature WHEN 'automobile' THEN 0 WHEN 'building' THEN 1 WHEN 'furniture' THEN 2 END::INT AS segment_code,
        round(psi, 6) AS psi, CASE WHEN psi > 0.25 THEN 'DRIFT' WHEN psi > 0.10 THEN 'WATCH' ELSE 'STABLE' END AS status,
        CASE WHEN psi > 0.25 THEN 'alert' WHEN psi > 0.10 THEN 'warn' ELSE 'ok' END AS severity
        FROM ({_psi(f"SELECT feature, value FROM ({_SEGMENT_VALUES}) WHERE is_ref", f"SELECT feature, value FROM ({_SEGMENT_VALUES}) WHERE NOT is_ref")})
        ORDER BY psi DESC, feature""",
    "label_normalize": f"""SELECT label, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share,
        round(100 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM (SELECT {_SEGMENT} AS label FROM customer) GROUP BY label""",
    "ordinal_encode": f"""SELECT c_custkey, CASE {_SEGMENT} WHEN 'automobile' THEN 0 WHEN 'building' THEN 1 WHEN 'furniture' THEN 2 END::INT AS fixed_code,
        (dense_rank() OVER (ORDER BY c_mktsegment) - 1)::INT AS fitted_code FROM customer""",
    "star_exclude_log1p": """SELECT * EXCLUDE (l_shipdate, l_tax, l_discount, l_extendedprice), round(ln(l_extendedprice + 1), 6) AS l_extendedprice FROM lineitem""",
    "flag_sum": f"""SELECT l_returnflag, f1 + f2 + f3 AS strict_sum, coalesce(f1, 0) + coalesce(f2, 0) + coalesce(f3, 0) AS filled_sum, count(*) AS n
        FROM ({_FLAGGED}) GROUP BY ALL""",
    "layer_pipeline": f"""SELECT CASE flag WHEN 'accepted' THEN 0 WHEN 'returned' THEN 2 END::INT AS l_returnflag,
        CASE status WHEN 'f' THEN 0 WHEN 'o' THEN 1 END::INT AS l_linestatus, f1 + f2 + f3 AS flag_count, count(*) AS n,
        round(avg(ln(l_extendedprice + 1)), 6) AS avg_log_price, sum(l_quantity) AS sum_quantity FROM ({_STAGED}) GROUP BY flag, status, flag_count""",
    "layer_checks": " UNION ALL ".join([
        _check("not_null", _STAGED, "l_orderkey", "error", "l_orderkey IS NULL", "staged"),
        _check("accepted_values", _STAGED, "l_returnflag", "warn", "flag NOT IN ('accepted', 'returned')", "staged"),
        _check("not_null", _STAGED, "flag_count", "warn", "f1 + f2 + f3 IS NULL", "features"),
        _check("not_null", _STAGED, "l_returnflag", "warn", "flag NOT IN ('accepted', 'returned')", "model"),
        _check("accepted_values", _STAGED, "l_linestatus", "error", "status NOT IN ('f', 'o')", "model"),
        _check("row_loss", _STAGED, None, "error", "false", "all"),
        _check("duplicate_rate", f"SELECT 1 - count(DISTINCT (l_linenumber, status, flag)) / count(*) AS rate FROM ({_STAGED})", None, "warn",
               "rate < 0.4 OR rate > 0.6", "staged"),
        _check("id_cardinality", f"SELECT count(DISTINCT l_orderkey) AS ids FROM ({_STAGED})", "l_orderkey", "error", "ids < 500 OR ids > 800", "staged"),
        _check("unmapped_labels", "SELECT DISTINCT trim(l_returnflag) AS raw FROM lineitem WHERE trim(l_returnflag) <> 'A' AND lower(trim(l_returnflag)) <> 'r'",
               "l_returnflag", "error", "true", "staged"),
    ]),
    "contract_check": "SELECT o_orderstatus, count(*) AS n, max(o_orderkey) AS max_key FROM orders GROUP BY o_orderstatus",
    "rename_pipeline": 'SELECT s_acctbal AS "Balance", s_suppkey, s_name FROM supplier',
    "not_null_accepted": " UNION ALL ".join([
        _check("not_null", "FROM orders", "o_orderkey", "error", "o_orderkey IS NULL", "orders"),
        _check("not_null", "FROM orders", "o_custkey", "error", "o_custkey IS NULL", "orders"),
        _check("accepted_values", "FROM orders", "o_orderstatus", "error", "o_orderstatus NOT IN ('F', 'O')", "orders"),
        _check("accepted_values", "FROM orders", "o_orderpriority", "warn", "o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '5-LOW')", "orders"),
        _check("not_null", "FROM events", "value", "error", "value IS NULL", "events"),
        _check("accepted_values", "FROM events", "event_type", "error", "event_type NOT IN ('view', 'click', 'purchase', 'signup')", "events"),
        _check("in_range", "FROM events", "value", "error", "value NOT BETWEEN 0 AND 300", "events"),
    ]),
    "row_preservation": """SELECT layer, (SELECT count(*) FROM lineitem) AS row_count
        FROM (VALUES ('raw'), ('staged'), ('cleaned'), ('features'), ('model')) t(layer)""",
    "row_loss": """WITH counts AS (SELECT 'raw' AS layer, count(*) AS row_count FROM lineitem UNION ALL SELECT 'staged', count(*) FROM lineitem
        UNION ALL SELECT 'filtered', count(*) FROM lineitem WHERE l_quantity > 10)
        SELECT layer, row_count FROM counts WHERE row_count <> (SELECT row_count FROM counts WHERE layer = 'raw')""",
    "duplicate_rate": """SELECT * FROM (SELECT count(*) AS total_rows, count(DISTINCT fp) AS distinct_rows, round(1.0 - count(DISTINCT fp)::DOUBLE / nullif(count(*), 0), 6) AS duplicate_rate
        FROM (SELECT md5(concat_ws('|', l_linenumber, l_quantity, l_returnflag, l_linestatus)) AS fp FROM lineitem))
        WHERE duplicate_rate < 0.40 OR duplicate_rate > 0.60""",
    "id_cardinality": """SELECT * FROM (SELECT count(DISTINCT user_id) AS distinct_ids FROM events) WHERE distinct_ids < 200 OR distinct_ids > 800""",
    "unmapped_labels": """SELECT 'other' AS label, trim(p_type) AS raw_label, count(*) AS row_count FROM part
        WHERE NOT (lower(trim(p_type)) IN ('economy', 'large') OR trim(p_type) = 'small') GROUP BY raw_label""",
    "null_profile": f"SELECT * FROM ({' UNION ALL '.join(f'''SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM ({_GAPPY})''' for c in _GAPPY_COLUMNS)}) WHERE null_count > 0",
    "constant_columns": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CASE count(DISTINCT {c}) WHEN 0 THEN 'empty' WHEN 1 THEN 'constant' WHEN 2 THEN 'binary' ELSE 'many' END AS kind FROM ({_GAPPY})"""
        for c in _GAPPY_COLUMNS),
    "column_choice": "SELECT * FROM (" + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CASE WHEN count(DISTINCT {c}) > 2 THEN 'continuous' WHEN count(DISTINCT {c}) = 2 THEN 'binary' END AS role FROM ({_FLAGGED})"""
        for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "f1", "f2", "f3"]) + ") WHERE role IS NOT NULL",
    "skew_profile": " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, round(skewness({expr}), 6) AS skewness FROM {source}"
        for name, expr, source in [("o_totalprice", "o_totalprice", "orders"), ("o_custkey", "o_custkey", "orders"), ("l_quantity", "l_quantity", "lineitem"),
                                   ("l_extendedprice", "l_extendedprice", "lineitem"), ("l_discount", "l_discount", "lineitem"), ("l_tax", "l_tax", "lineitem"),
                                   ("value", "value", "events"), ("log_value", "ln(value + 1)", "events")]),
    "corr_pairs": f"SELECT left_col, right_col, round(r, 6) AS r FROM ({_CORR})",
    "corr_prune": f"SELECT right_col AS column_name, round(max(abs(r)), 6) AS max_abs_r FROM ({_CORR}) GROUP BY right_col HAVING max(abs(r)) > 0.85",
    "duplicate_rows": f"SELECT l_returnflag, l_linestatus, sum(n_copies)::BIGINT AS n_rows, sum(n_copies - 1)::BIGINT AS n_repeats, sum(l_quantity * n_copies) AS sum_quantity FROM ({_DUP}) GROUP BY ALL",
    "duplicate_groups": _DUP,
    "duplicate_columns": """SELECT column_name, same_as FROM (
        SELECT 'qty_copy' AS column_name, 'l_quantity' AS same_as, bool_and(l_quantity IS NOT DISTINCT FROM l_quantity) AS same FROM lineitem
        UNION ALL SELECT 'qty_whole', 'l_quantity', bool_and(l_quantity IS NOT DISTINCT FROM l_quantity::BIGINT) FROM lineitem
        UNION ALL SELECT 'flag_copy', 'l_returnflag', bool_and(l_returnflag IS NOT DISTINCT FROM upper(l_returnflag)) FROM lineitem
        UNION ALL SELECT 'qty_almost', 'l_quantity', bool_and(l_quantity IS NOT DISTINCT FROM l_quantity + CASE WHEN l_orderkey = 1 THEN 1 ELSE 0 END) FROM lineitem
        UNION ALL SELECT 'l_tax', 'l_quantity', bool_and(l_quantity IS NOT DISTINCT FROM l_tax) FROM lineitem) WHERE same""",
    "value_counts": """SELECT o_orderstatus AS value, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share,
        round(100 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM orders GROUP BY o_orderstatus""",
    "distinct_values": "SELECT DISTINCT o_orderpriority FROM orders",
    "crosstab": """SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS "F", count(*) FILTER (WHERE o_orderstatus = 'O') AS "O",
        count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS other FROM orders GROUP BY o_orderpriority""",
    "stage_sizes": """SELECT 'raw' AS stage, count(*) AS n_rows, 11::INT AS n_columns FROM lineitem UNION ALL SELECT 'staged', count(*), 10 FROM lineitem
        UNION ALL SELECT 'kept', count(*), 11 FROM lineitem WHERE l_quantity > 10""",
    "column_catalogue": """SELECT table_name, column_name, ordinal_position::INT AS position,
        CASE data_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>'
        ELSE lower(data_type) END AS data_type FROM information_schema.columns
        WHERE table_name IN ('region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem', 'events', 'documents', 'embeddings', 'pages',
            'benchmark', 'labels', 'conversations')""",
    "quantile_edges": f"SELECT feature, n, unnest(range(0, len(edges)))::INT AS pos, round(unnest(edges), 6) AS edge FROM ({_edges(_REF)})",
    "quantile_edges_bucketed": f"SELECT feature, n, unnest(range(0, len(edges)))::INT AS pos, round(unnest(edges), 6) AS edge FROM ({_edges(_ITEMS_LONG)})",
    "histogram": f"SELECT feature, bin::INT AS bin, n, round(share, 6) AS share FROM ({_bins(_CUR, _edges(_REF))})",
    "psi": f"SELECT feature, round(psi, 6) AS psi FROM ({_psi(_REF, _CUR)})",
    "ks_stat": f"SELECT feature, round(ks_stat, 6) AS ks_stat, n_left, n_right FROM ({_ks(_REF, _CUR)})",
    "ks_stat_bucketed": f"SELECT feature, round(ks_stat, 6) AS ks_stat, n_left, n_right FROM ({_ks(_REF, _CUR)})",
    "drift_report": f"""SELECT feature, n_current, round(psi, 6) AS psi, round(ks_stat, 6) AS ks_stat, status, round(ref_mean, 6) AS ref_mean,
        round(cur_mean, 6) AS cur_mean FROM ({_DRIFT})""",
    "drift_summary": f"""SELECT (SELECT count(*) FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01') AS n_production_samples,
        coalesce(list(feature ORDER BY feature) FILTER (WHERE status = 'DRIFT'), []) AS drifted,
        coalesce(list(feature ORDER BY feature) FILTER (WHERE status = 'WATCH'), []) AS watch,
        coalesce(list(feature ORDER BY feature) FILTER (WHERE status = 'STABLE'), []) AS stable,
        CASE WHEN bool_or(status = 'DRIFT') THEN 'DRIFT' WHEN bool_or(status = 'WATCH') THEN 'WATCH' ELSE 'STABLE' END AS overall_status FROM ({_DRIFT})""",
    "reference_sample": _SAMPLE,
    "label_distribution": "SELECT label::VARCHAR AS label, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM embeddings GROUP BY label",
    "latency_metrics": f"""SELECT count(*) AS total_predictions, count(*) FILTER (WHERE status IS DISTINCT FROM 'success') AS errors,
        round(100.0 * count(*) FILTER (WHERE status IS DISTINCT FROM 'success') / count(*), 2) AS error_rate_pct, round(avg(latency_ms), 2) AS avg_latency_ms FROM ({_PREDICTIONS})""",
    "class_counts": f"SELECT prediction, count(*) AS n FROM ({_PREDICTIONS}) WHERE status = 'success' AND prediction <> '' GROUP BY prediction",
    "latency_trend": """SELECT (row_number() OVER (ORDER BY ts, event_id) - 1)::INT AS pos, value AS latency_ms
        FROM (SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 50)""",
    "uptime": f"SELECT {_UPTIME}, CASE arg_max(up, (ts, event_id)) WHEN true THEN 'ok' ELSE 'alert' END AS severity FROM ({_PROBES})",
    "uptime_window": f"SELECT {_UPTIME} FROM (SELECT * FROM ({_PROBES}) ORDER BY ts DESC, event_id DESC LIMIT 500)",
    "uptime_by_user": f"SELECT user_id, {_UPTIME} FROM ({_PROBES}) GROUP BY user_id",
    "http_counters": f"""SELECT count(*) AS requests_total, count(*) FILTER (WHERE {_PREDICT_PATH}) AS predict_requests_total,
        count(*) FILTER (WHERE {_PREDICT_PATH} AND coalesce(status_code, 500) >= 400) AS predict_errors_total, round(sum(latency_ms), 4) AS latency_sum_ms,
        count(latency_ms) AS latency_count, round(avg(latency_ms), 6) AS latency_avg_ms FROM ({_REQUESTS})""",
    "requests_by_status": f"SELECT coalesce(status_code, 500)::VARCHAR AS status_code, count(*) AS n FROM ({_REQUESTS}) GROUP BY ALL",
    "predict_paths": f"SELECT path, {_PREDICT_PATH} AS is_predict, count(*) AS n FROM ({_REQUESTS}) GROUP BY path",
    "json_props": """SELECT event_type, count(*) AS n, sum((props->>'$.k')::DOUBLE) AS k_sum, max((props->>'$.k')::DOUBLE) AS k_max FROM events GROUP BY event_type""",
    "log_scan": f"""SELECT status, prediction, count(*) AS n, count(latency_ms) AS n_latency, count(*) FILTER (WHERE has_features) AS n_features,
        round(sum(latency_ms), 4) AS latency_sum FROM ({_LOG_EVENTS}) GROUP BY status, prediction""",
    "log_features": f"""SELECT feature, count(*) AS n, round(sum(value), 4) AS total
        FROM (SELECT 'v' AS feature, v AS value FROM ({_LOG_EVENTS}) WHERE has_features UNION ALL SELECT 'u', u FROM ({_LOG_EVENTS}) WHERE has_features) GROUP BY feature""",
    "windowed_metrics": f"""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n, count(*) FILTER (WHERE status IS DISTINCT FROM 'success') AS errors,
        round(avg(latency_ms), 6) AS avg_latency_ms FROM ({_PREDICTIONS}) GROUP BY window_start""",
    "last_n": "SELECT event_id, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 200",
    "head_orders": "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 100",
    "csv_reordered": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
    "corr_missing": """SELECT 'quantity' AS left_col, 'l_extendedprice' AS right_col, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem WHERE l_linenumber <> 1
        UNION ALL SELECT 'quantity', 'mixed', round(corr(l_quantity, l_extendedprice + 100 * l_quantity), 6) FROM lineitem WHERE l_linenumber <> 1 AND l_tax <= 0.05
        UNION ALL SELECT 'l_extendedprice', 'mixed', round(corr(l_extendedprice, l_extendedprice + 100 * l_quantity), 6) FROM lineitem WHERE l_tax <= 0.05""",
    "drift_own_reference": f"""SELECT feature, count(*) AS n_current, 0.0::DOUBLE AS psi, true AS ks_close, 'STABLE' AS status FROM ({_ITEMS_LONG}) GROUP BY feature""",
    "dedup_first": """SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""",
    "follow_up": """SELECT CASE WHEN contains(lower(p_name), 'widget') THEN 'specialist' ELSE 'general' END AS tag, count(*) AS n, sum(p_size)::BIGINT AS size_sum FROM part GROUP BY tag""",
    "csv_load": """SELECT c_mktsegment AS mkt_segment, count(*) AS n, sum(c_custkey)::BIGINT AS key_sum, round(sum(c_acctbal), 2) AS balance,
        sum(c_nationkey)::BIGINT AS nation_sum, count(*) AS n_row_ids FROM customer GROUP BY c_mktsegment""",
}
for _name in ("latency_percentiles", "latency_percentiles_bucketed"):
    ORACLES[_name] = f"""SELECT round(quantile_cont(latency_ms, 0.5), 2) AS p50_latency_ms, round(quantile_cont(latency_ms, 0.95), 2) AS p95_latency_ms,
        round(quantile_cont(latency_ms, 0.99), 2) AS p99_latency_ms FROM ({_PREDICTIONS})"""
