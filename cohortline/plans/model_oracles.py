"""Plain-SQL twins of ``model_queries``, where SQL can express them."""

from cohortline.plans.driver_oracles import _HASH, _LOG_EVENTS, _PROBES, ORACLES, _ks, _psi

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_TEST_LIMIT = int(0.2 * 2 ** 32)
_ORDER_HASH = _HASH.format(key="concat_ws('|', o_orderkey, '42')")
_ITEM_HASH = _HASH.format(key="concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, '42')")

_JUDGED = "SELECT quality AS label, 1 - toxic AS prediction FROM labels"


def _report(source: str) -> str:
    return f"""SELECT class, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS precision, CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall,
            CASE WHEN hits > 0 THEN 2.0 * hits / (predicted + support) ELSE 0 END AS f1, support
        FROM (SELECT class, count(*) FILTER (WHERE label = class) AS support, count(*) FILTER (WHERE prediction = class) AS predicted,
                count(*) FILTER (WHERE label = class AND prediction = class) AS hits
            FROM ({source}) CROSS JOIN (VALUES (0), (1)) c(class) GROUP BY class) WHERE support + predicted > 0"""


def _metrics(source: str) -> str:
    return f"""SELECT sum(recall * support) / sum(support) AS accuracy, avg(recall) FILTER (WHERE support > 0) AS balanced_accuracy,
        sum(f1 * support) / sum(support) AS f1_weighted, (avg(recall) FILTER (WHERE support > 0) + sum(f1 * support) / sum(support)) / 2 AS composite_score
        FROM ({_report(source)})"""


_SCORED = """SELECT class, positive, n_chars::DOUBLE AS score FROM (SELECT quality, toxic, n_chars FROM labels JOIN documents USING (doc_id)),
    LATERAL (SELECT unnest(['quality', 'toxic']) AS class, unnest([quality, toxic]) AS positive)"""
_AUC = f"""SELECT class, round((sum(rank) FILTER (WHERE positive = 1) - p * (p + 1) / 2.0) / (p * n), 6) AS auc
    FROM (SELECT class, positive, rank() OVER (PARTITION BY class ORDER BY score) + (count(*) OVER (PARTITION BY class, score) - 1) / 2.0 AS rank,
        sum(positive) OVER (PARTITION BY class) AS p, sum(1 - positive) OVER (PARTITION BY class) AS n FROM ({_SCORED})) GROUP BY class, p, n"""

_RUNS = f"SELECT 'inverted' AS model, * FROM ({_metrics(_JUDGED)}) UNION ALL SELECT 'constant', * FROM ({_metrics('SELECT quality AS label, 1 AS prediction FROM labels')})"


def _neighbours(k: int, same_label: bool) -> str:
    """Brute force over all pairs, for the small second engine only."""
    return f"""SELECT * FROM (SELECT a_id, b_id, a_label, b_label, av, bv, dist, row_number() OVER (PARTITION BY a_id ORDER BY dist, b_id) AS rank
        FROM (SELECT a.vec_id AS a_id, b.vec_id AS b_id, a.label AS a_label, b.label AS b_label, a.v AS av, b.v AS bv, list_distance(a.v, b.v) AS dist
            FROM (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings) a JOIN (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings) b
            ON a.vec_id <> b.vec_id {"AND a.label = b.label" if same_label else ""})) WHERE rank <= {k}"""


_NEAREST = f"SELECT a_id AS id, (rank - 1)::INT AS pos, b_id AS neighbour, round(dist, 6) AS dist FROM ({_neighbours(3, False)})"

_SIDE_NEIGHBOURS = """SELECT a_id AS id, any_value(a_side) AS label, round(list_sum(any_value(av)), 6) AS total
    FROM (SELECT a.vec_id AS a_id, a.side AS a_side, b.side AS b_side, a.v AS av, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS rank
        FROM (SELECT vec_id, embedding::DOUBLE[] AS v, (embedding[1] > 0)::INT AS side FROM embeddings) a
        JOIN (SELECT vec_id, embedding::DOUBLE[] AS v, (embedding[1] > 0)::INT AS side FROM embeddings) b ON a.vec_id <> b.vec_id)
    WHERE rank <= 3 GROUP BY a_id HAVING bool_and(a_side = b_side)"""

_DRAW_HASH = "('0x' || substr(md5(concat_ws('|', id, draw, '{seed}')), 1, 8))::BIGINT"
_SMOTE = f"""WITH sized AS (SELECT vec_id AS id, label, count(*) OVER (PARTITION BY label) AS n,
        row_number() OVER (PARTITION BY label ORDER BY {_HASH.format(key="concat_ws('|', vec_id, '42')")}, vec_id) - 1 AS i FROM embeddings),
    needed AS (SELECT *, (SELECT max(n) FROM sized) - n AS need FROM sized),
    drawn AS (SELECT id, label, unnest(range(0, (floor((i + 1) * need / n) - floor(i * need / n))::BIGINT)) AS draw FROM needed),
    picked AS (SELECT *, {_DRAW_HASH.format(seed=43)} % 5 + 1 AS pick, {_DRAW_HASH.format(seed=44)} / 4294967296.0 AS u FROM drawn),
    made AS (SELECT id, draw, b_id, u, label, list_transform(list_zip(av, bv), lambda p: p[1] + (p[2] - p[1]) * u) AS vec
        FROM picked JOIN ({_neighbours(5, True)}) ON a_id = id AND rank = pick)
    SELECT id AS base_id, draw, b_id AS nn_id, round(u, 6) AS u, label, round(vec[1], 6) AS first, round(list_sum(vec), 6) AS total FROM made"""

_HALF = "SELECT event_id, 'v' AS feature, value AS value FROM events WHERE ts < TIMESTAMP '2024-01-15' UNION ALL SELECT event_id, 'u', user_id FROM events WHERE ts < TIMESTAMP '2024-01-15'"
_HALF_SAMPLE = f"""SELECT feature, value FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY {_HASH.format(key="concat_ws('|', event_id, '42')")}, event_id) AS rn
    FROM ({_HALF})) WHERE rn <= 2000"""
_LOGGED = f"SELECT 'v' AS feature, v AS value FROM ({_LOG_EVENTS}) WHERE has_features UNION ALL SELECT 'u', u FROM ({_LOG_EVENTS}) WHERE has_features"

def _drift_of(rows: str) -> str:
    """Report of ``rows`` (feature, value) against the first half of the month."""
    return f"""SELECT feature, n_current, round(psi, 6) AS psi, round(ks_stat, 6) AS ks_stat,
        CASE WHEN psi > 0.25 THEN 'DRIFT' WHEN psi > 0.10 THEN 'WATCH' ELSE 'STABLE' END AS status, round(ref_mean, 6) AS ref_mean, round(cur_mean, 6) AS cur_mean
    FROM ({_psi(f"SELECT feature, value FROM ({_HALF})", rows)}) JOIN (SELECT feature, ks_stat FROM ({_ks(_HALF_SAMPLE, rows)})) USING (feature)
    JOIN (SELECT feature, avg(value) AS ref_mean FROM ({_HALF}) GROUP BY feature) USING (feature)
    JOIN (SELECT feature, count(*) AS n_current, avg(value) AS cur_mean FROM ({rows}) GROUP BY feature) USING (feature)"""


_STREAM_DRIFT = _drift_of(_LOGGED)

_SCALED = ", ".join(f"({m} - avg({m}) FILTER (WHERE NOT test) OVER ()) / stddev_pop({m}) FILTER (WHERE NOT test) OVER () AS {m}" for m in _MEASURES)

_NODE_HASH = "('0x' || substr(md5(concat_ws('|', tree, node, '{seed}')), 1, 8))::BIGINT"
_WALK = """{name}_walk AS (
        SELECT r.*, t.tree, 0 AS node, 0 AS level FROM {rows} r CROSS JOIN (SELECT DISTINCT tree FROM splits) t
        UNION ALL SELECT w.* EXCLUDE (node, level), 2 * w.node + CASE WHEN w.x[s.feature + 1] <= s.threshold THEN 1 ELSE 2 END, w.level + 1
        FROM {name}_walk w JOIN splits s ON s.tree = w.tree AND s.node = w.node)"""
# numbered as in a complete binary tree: the children of node i are 2 i + 1 and 2 i + 2
_SCORED_ROWS = f"""WITH RECURSIVE bounds AS (
        SELECT 0 AS feature, min(l_quantity) AS low, max(l_quantity) AS high FROM lineitem UNION ALL SELECT 1, min(l_extendedprice), max(l_extendedprice) FROM lineitem
        UNION ALL SELECT 2, min(l_discount), max(l_discount) FROM lineitem),
    splits AS (SELECT tree, node, feature, low + (high - low) * ({_NODE_HASH.format(seed=43)} / 4294967296.0::DOUBLE) AS threshold
        FROM (SELECT tree, node, ({_NODE_HASH.format(seed=42)} % 3)::INT AS feature
            FROM (SELECT unnest(range(9)) AS tree) CROSS JOIN (SELECT unnest(range(31)) AS node)) JOIN bounds USING (feature)),
    items AS (SELECT row_number() OVER () AS row, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_tax, [l_quantity, l_extendedprice, l_discount]::DOUBLE[] AS x,
            CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS label, {_ITEM_HASH} >= {_TEST_LIMIT} AS train,
            CASE WHEN l_linenumber = 1 THEN 'l_quantity: missing' WHEN l_linenumber = 2 THEN 'l_extendedprice: not a number'
                WHEN l_linenumber = 3 THEN 'l_discount: not a number' END AS reason FROM lineitem),
    {_WALK.format(name="train", rows="(SELECT x, label FROM items WHERE train)")},
    votes AS (SELECT tree, node, [(count(*) FILTER (WHERE label = 0)) / count(*), (count(*) FILTER (WHERE label = 1)) / count(*), (count(*) FILTER (WHERE label = 2)) / count(*)] AS v
        FROM train_walk WHERE level = 5 GROUP BY tree, node),
    {_WALK.format(name="row", rows="(SELECT * EXCLUDE (train, label) FROM items WHERE reason IS NULL)")},
    shares AS (SELECT row, l_orderkey, l_linenumber, l_partkey, l_suppkey, any_value(l_tax) AS l_tax,
            [coalesce(sum(v[1]), 0) / 9, coalesce(sum(v[2]), 0) / 9, coalesce(sum(v[3]), 0) / 9] AS p
        FROM row_walk LEFT JOIN votes USING (tree, node) WHERE level = 5 GROUP BY ALL),
    best AS (SELECT *, list_position(list_transform(p, lambda q: round(q, 12)), round(list_max(p), 12)) - 1 AS code FROM shares)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE code WHEN 0 THEN 'accepted' WHEN 1 THEN 'none' END AS diagnosis,
        CASE WHEN code < 2 THEN round(round(100 * list_max(p), 2), 1) END AS confidence, CASE WHEN code < 2 THEN 'success' ELSE 'error' END AS status,
        CASE WHEN code = 2 THEN 'no label for code 2' END AS error, CASE WHEN l_tax > 0.02 THEN l_tax ELSE 0 END AS l_tax FROM best
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, NULL, NULL, 'error', reason, NULL FROM items WHERE reason IS NOT NULL"""

_IN_TIME = """(SELECT * FROM (SELECT *, CASE WHEN event_type <> 'error' THEN 'success' WHEN user_id % 2 = 0 THEN 'error' END AS status,
        event_id % 29 = 0 AND ts < TIMESTAMP '2024-01-15' AS delayed FROM events) WHERE NOT delayed)"""
_RECENT = """SELECT * FROM (SELECT *, floor(epoch(ts) / 3600) AS hour, max(floor(epoch(ts) / 3600)) OVER () AS newest FROM events) WHERE hour > newest - 200"""
_RECENT_LONG = f"SELECT 'v' AS feature, value FROM ({_RECENT}) UNION ALL SELECT 'u', user_id FROM ({_RECENT})"

_RAW = """SELECT *, l_linenumber = 1 AS no_quantity, l_linenumber = 2 AS bad_price, l_linenumber = 3 AS bad_discount FROM lineitem"""
_ERRORS = "count(*) FILTER (WHERE status IS DISTINCT FROM 'success')"

_SKETCH = """WITH entries AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
    draws AS (SELECT f, i, ('0x' || substr(h, 1, 8))::BIGINT % 1024 AS place, CASE WHEN substr(h, 9, 1) < '8' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS sign
        FROM (SELECT f, i, md5(concat('42:', f, ':', i)) AS h FROM range(3) a(f), range(64) b(i))),
    counted AS (SELECT vec_id, f, place, sum(sign * x) AS v FROM entries JOIN draws USING (i) GROUP BY ALL),
    two AS (SELECT a.vec_id, (a.place + b.place) % 1024 AS place, sum(a.v * b.v) AS v FROM counted a JOIN counted b USING (vec_id)
        WHERE a.f = 0 AND b.f = 1 GROUP BY ALL),
    three AS (SELECT a.vec_id, (a.place + b.place) % 1024 AS place, sum(a.v * b.v) AS v FROM two a JOIN counted b USING (vec_id)
        WHERE b.f = 2 GROUP BY ALL),
    kernels AS (SELECT vec_id, pow(sum(x * x), 3) AS kernel FROM entries GROUP BY vec_id)
    SELECT vec_id, arg_max(place, v)::INT AS top_place, round(max(v), 6) AS top_value, round(any_value(kernel), 6) AS kernel, round(sum(v * v), 6) AS estimate
    FROM three JOIN kernels USING (vec_id) GROUP BY vec_id"""
_KERNEL_PAIRS = """SELECT exp(-0.05 * pow(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 2)) AS radial,
    pow(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 3) AS cubic FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"""

MODEL_ORACLES = {
    "split": f"""SELECT CASE WHEN {_ORDER_HASH} < {_TEST_LIMIT} THEN 'test' ELSE 'train' END AS side, o_orderstatus, count(*) AS n, sum(o_orderkey)::BIGINT AS key_sum
        FROM orders GROUP BY ALL""",
    "folds": f"""SELECT o_orderstatus, ((rn - 1) % 5)::INT AS fold, count(*) AS n, sum(o_orderkey)::BIGINT AS key_sum
        FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_ORDER_HASH}, o_orderkey) AS rn FROM orders) GROUP BY ALL""",
    "standardize": f"""SELECT l_returnflag, {", ".join(f"round(avg({m}), 6) AS avg_{m}, round(max({m}), 6) AS max_{m}" for m in _MEASURES)}
        FROM (SELECT l_returnflag, test, {_SCALED} FROM (SELECT *, {_ITEM_HASH} < {_TEST_LIMIT} AS test FROM lineitem)) WHERE test GROUP BY l_returnflag""",
    "scaler_stats": " UNION ALL ".join(f"SELECT '{m}' AS column_name, round(avg({m}), 6) AS mean, round(stddev_pop({m}), 6) AS std FROM lineitem" for m in _MEASURES)
        + " UNION ALL SELECT 'fixed', 3.0::DOUBLE, 1.0::DOUBLE",
    "class_weights": "SELECT label, count(*) AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight FROM embeddings GROUP BY label",
    "classification_metrics": f"SELECT round(accuracy, 6) AS accuracy, round(balanced_accuracy, 6) AS balanced_accuracy, round(f1_weighted, 6) AS f1_weighted, round(composite_score, 6) AS composite_score FROM ({_metrics(_JUDGED)})",
    "class_report": f"SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM ({_report(_JUDGED)})",
    "confusion": f"""SELECT label, count(*) FILTER (WHERE prediction = 0) AS predicted_0, count(*) FILTER (WHERE prediction = 1) AS predicted_1,
        count(*) FILTER (WHERE prediction NOT IN (0, 1)) AS other FROM ({_JUDGED}) GROUP BY label""",
    "roc_auc": _AUC,
    "roc_auc_bucketed": _AUC,
    "roc_curve": f"""SELECT class, score AS threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, round(tp / sum(p) OVER c, 6) AS tpr, round(fp / sum(q) OVER c, 6) AS fpr
        FROM (SELECT class, score, p, q, sum(p) OVER w AS tp, sum(q) OVER w AS fp FROM (SELECT class, score, sum(positive) AS p, sum(1 - positive) AS q FROM ({_SCORED}) GROUP BY ALL)
            WINDOW w AS (PARTITION BY class ORDER BY score DESC)) WINDOW c AS (PARTITION BY class)""",
    "champion": f"SELECT model, round(composite_score, 6) AS composite_score FROM ({_RUNS}) ORDER BY round(composite_score, 6) DESC, model DESC LIMIT 1",
    "metric_comparison": f"""SELECT model, metric, round(score, 6) AS score FROM ({_RUNS}) UNPIVOT (score FOR metric IN (accuracy, balanced_accuracy, f1_weighted, composite_score))""",
    "nearest_neighbours": _NEAREST,
    "nearest_neighbours_pivoted": _NEAREST,
    "smote": _SMOTE,
    "edited_neighbours": f"SELECT a_id AS id, any_value(a_label) AS label, 64::INT AS n_dims FROM ({_neighbours(3, False)}) GROUP BY a_id HAVING bool_and(a_label = b_label)",
    "edited_half_spaces": _SIDE_NEIGHBOURS,
    "nearest_of_twentieth": f"SELECT * FROM ({_NEAREST}) WHERE id % 20 = 0",
    "neighbour_recall": """SELECT count(*) AS n_queries, 5 * count(*) AS n_pairs, true AS recalled FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey % 20 = 0)""",
    "scored_rows": _SCORED_ROWS,
    "stream_closed_windows": f"""SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, {_ERRORS} AS errors, round(sum(value), 4) AS latency_sum, true AS p95_close
        FROM {_IN_TIME} WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 DAY FROM {_IN_TIME}) GROUP BY day""",
    "stream_late_rows": """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, round(sum(value), 4) AS latency_sum FROM events
        WHERE event_id % 29 = 0 AND ts < TIMESTAMP '2024-01-15' GROUP BY day""",
    "input_validation": f"""SELECT 'accepted' AS outcome, count(*) AS n, round(sum(CASE WHEN l_tax > 0.02 THEN l_tax ELSE 0 END), 4) AS tax_sum, 0.0::DOUBLE AS absent_sum
        FROM ({_RAW}) WHERE NOT (no_quantity OR bad_price OR bad_discount)
        UNION ALL SELECT CASE WHEN no_quantity THEN 'l_quantity: missing' WHEN bad_price THEN 'l_extendedprice: not a number' ELSE 'l_discount: not a number' END AS outcome,
            count(*), NULL, NULL FROM ({_RAW}) WHERE no_quantity OR bad_price OR bad_discount GROUP BY outcome""",
    "poly_sketch": _SKETCH,
    "kernel_estimates": f"""SELECT map, count(*) AS n, round(sum(CASE WHEN map = 'sketch' THEN cubic ELSE radial END), 4) AS kernel_sum, true AS close
        FROM ({_KERNEL_PAIRS}), (VALUES ('fourier'), ('landmarks'), ('sketch')) m(map) GROUP BY map""",
    "input_ranges": "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {lo}::DOUBLE AS low, {hi}::DOUBLE AS high, count(*) FILTER (WHERE {c} NOT BETWEEN {lo} AND {hi}) AS n FROM lineitem"
        for c, lo, hi in [("l_quantity", 0, 45), ("l_discount", 0.0, 0.08), ("l_tax", 0, 1), ("l_extendedprice", 1000, 100000)]) + ") WHERE n > 0",
    "stream_totals": f"SELECT status, count(*) AS n, round(sum(latency_ms), 4) AS latency_sum_ms, count(latency_ms) AS latency_count FROM ({_LOG_EVENTS}) GROUP BY status",
    "stream_windows": f"""SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, {_ERRORS} AS errors,
        round(avg(CASE WHEN event_id % 50 = 13 THEN NULL ELSE value END), 6) AS avg_latency_ms
        FROM (SELECT *, CASE WHEN event_type <> 'error' THEN 'success' WHEN user_id % 2 = 0 THEN 'error' END AS status FROM events)
        WHERE event_id % 50 NOT IN (7, 11, 17, 19) GROUP BY day""",
    "stream_uptime": f"""SELECT count(*) AS probes, round(100.0 * avg(up::INT), 2) AS uptime_pct, round(avg(response_time_ms), 2) AS avg_response_ms,
        arg_max(CASE WHEN up THEN 'UP' ELSE 'DOWN' END, (ts, event_id)) AS last_status FROM ({_PROBES})""",
    "stream_http": ORACLES["http_counters"],
    "stream_drift": _STREAM_DRIFT,
    "stream_recent_drift": _drift_of(_RECENT_LONG),
    "dashboard": f"""SELECT count(*) AS total_predictions, {_ERRORS} AS errors, round(100.0 * {_ERRORS} / count(*), 2) AS error_rate_pct, round(avg(latency_ms), 2) AS avg_latency_ms,
        round(quantile_cont(latency_ms, 0.5), 2) AS p50_latency_ms, round(quantile_cont(latency_ms, 0.95), 2) AS p95_latency_ms, round(quantile_cont(latency_ms, 0.99), 2) AS p99_latency_ms,
        50::INT AS trend_length, (count(DISTINCT prediction) FILTER (WHERE status = 'success' AND prediction <> ''))::INT AS n_classes,
        (SELECT count(*) FROM events) AS probes, (SELECT round(100.0 * avg(up::INT), 2) FROM ({_PROBES})) AS uptime_pct,
        (SELECT CASE WHEN bool_or(status = 'DRIFT') THEN 'DRIFT' WHEN bool_or(status = 'WATCH') THEN 'WATCH' ELSE 'STABLE' END FROM ({_STREAM_DRIFT})) AS overall_status,
        count(*) FILTER (WHERE has_features) AS n_samples, 2::INT AS n_features FROM ({_LOG_EVENTS})""",
}
