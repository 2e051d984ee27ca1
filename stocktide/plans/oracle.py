"""Checking SQL for the named queries: shared common table expressions and their assembly.

The statements state the expected result from the test tables directly, with plain per-key windows, and share
no code with the operators.
"""

from __future__ import annotations

import re

W = 21_600_000_000  # short window in microseconds
LW = 604_800_000_000  # weekly window in microseconds


def start_of(ts: str, width: int = W) -> str:
    return f"make_timestamp((epoch_us({ts}) // {width}) * {width})"


_ISO = "strftime(sent, '%Y-%m-%dT%H:%M:%S.%fZ')"
_PRICE = "(CAST(value AS DECIMAL(18,2)) - CAST(1 AS DECIMAL(18,2)))"

# Messages that are not exactly one JSON object, and what becomes of the quantity of an order message as it is written.
_NOT_JSON = "event_id % 97 = 0 OR event_id % 109 = 0"
_WRITTEN = """CASE WHEN event_id % 61 = 0 THEN NULL WHEN event_id % 101 = 0 THEN 3e9 WHEN event_id % 103 = 0 THEN 0.4
    WHEN event_id % 107 = 0 THEN CAST('inf' AS DOUBLE) ELSE CAST(quantity AS DOUBLE) END"""

CTES: dict[str, str] = {
    "dim_sku": """SELECT p_brand AS sku_id, min(p_name) AS name, min(p_type) AS category,
        max(p_retailprice) AS unit_price, CAST(sum(p_size) % 60 + 10 AS INTEGER) AS reorder_point
        FROM part GROUP BY p_brand""",
    "dim_store": """SELECT 'DS_' || lpad(CAST(r_regionkey AS VARCHAR), 3, '0') AS store_id, r_name AS region,
        CAST(count(n_nationkey) * 400 AS INTEGER) AS capacity
        FROM region LEFT JOIN nation ON r_regionkey = n_regionkey GROUP BY r_regionkey, r_name""",
    "clock": "SELECT max(ts) AS now FROM events",
    "base": """SELECT event_id, ts, event_type, value,
        'DS_' || lpad(CAST(user_id % 6 AS VARCHAR), 3, '0') AS store_id,
        'Brand#' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 26 AS VARCHAR) AS sku_id,
        CASE WHEN event_id % 79 = 0 THEN ts + INTERVAL 3650 DAY ELSE ts END AS sent FROM events""",
    "order_text": f"""SELECT *, CAST(event_id % 10 AS INTEGER) AS quantity, {_PRICE} AS price,
        CASE WHEN event_id % 83 = 0 THEN 'not-a-date' ELSE {_ISO} END AS stamp FROM base
        WHERE event_type IN ('purchase', 'view', 'click')""",
    "order_full": """SELECT *, '{"event_id":"evt-' || event_id || '","event_time":"' || stamp || '","store_id":"' || store_id
        || '","sku_id":"' || sku_id || '","category":"' || event_type || '","quantity":'
        || CASE WHEN event_id % 61 = 0 THEN '"' || quantity || '"' WHEN event_id % 101 = 0 THEN '3000000000'
          WHEN event_id % 103 = 0 THEN '0.4' WHEN event_id % 107 = 0 THEN '1e400' ELSE CAST(quantity AS VARCHAR) END
        || ',"unit_price":' || price
        || CASE WHEN event_id % 89 = 0 THEN '' ELSE ',"order_id":"ord-' || event_id || '"' END
        || CASE WHEN value > 200 THEN ',"is_injected_anomaly":true' ELSE '' END || '}' AS whole FROM order_text""",
    "order_raw": f"""SELECT *, {_NOT_JSON} AS not_json, {_WRITTEN} AS written, CASE WHEN event_id % 97 = 0 THEN left(whole, length(whole) - 1)
          WHEN event_id % 109 = 0 THEN whole || '] junk' ELSE whole END AS text,
        CASE WHEN {_NOT_JSON} THEN 'json_parse_error'
          WHEN event_id % 89 = 0 THEN 'missing fields: order_id'
          WHEN event_id % 61 = 0 OR event_id % 101 = 0 OR event_id % 107 = 0 THEN 'invalid type: quantity'
          WHEN event_id % 103 = 0 THEN 'quantity must be > 0, got 0.4'
          WHEN quantity <= 0 THEN 'quantity must be > 0, got ' || quantity
          WHEN price < 0 THEN 'unit_price must be >= 0, got ' || CAST(price AS DOUBLE)
          WHEN store_id NOT IN (SELECT store_id FROM dim_store) THEN 'unknown store_id: ' || store_id
          WHEN sku_id NOT IN (SELECT sku_id FROM dim_sku) THEN 'unknown sku_id: ' || sku_id
          WHEN event_id % 83 = 0 THEN 'unparseable event_time: not-a-date'
          WHEN sent > (SELECT now FROM clock) + INTERVAL 60 SECOND THEN 'event_time too far in future: '
            || strftime(sent, '%Y-%m-%d %H:%M:%S.%f') || '+00:00' END AS reason FROM order_full""",
    "vorders": """SELECT 'evt-' || event_id AS event_id, store_id, sku_id, ts AS event_time, quantity,
        CAST(price AS DOUBLE) AS unit_price, value > 200 AS is_injected_anomaly FROM order_raw WHERE reason IS NULL""",
    "inv_text": f"""SELECT *, event_id % 10 AS n,
        CASE WHEN event_id % 73 = 0 THEN 'steal' WHEN event_type = 'purchase' THEN 'sale'
          WHEN event_type = 'signup' THEN 'restock' ELSE 'adjustment' END AS movement_type,
        CASE WHEN event_type = 'signup' OR (event_type = 'error' AND event_id % 2 = 0) THEN event_id % 10
          ELSE -(event_id % 10) END AS delta_units,
        CASE WHEN event_id % 67 = 0 THEN -1 ELSE event_id * 37 % 120 END AS on_hand_after,
        CASE WHEN event_id % 83 = 0 THEN 'not-a-date' ELSE {_ISO} END AS stamp FROM base
        WHERE event_type IN ('purchase', 'signup', 'error')""",
    "inv_full": """SELECT *, '{"event_id":"inv-' || event_id || '","event_time":"' || stamp || '","store_id":"' || store_id
        || '","sku_id":"' || sku_id || '","movement_type":"' || movement_type || '"'
        || CASE WHEN event_id % 89 = 0 THEN '' ELSE ',"delta_units":' || CASE WHEN event_id % 101 = 0 THEN -3000000000 ELSE delta_units END END
        || ',"on_hand_after":' || on_hand_after || '}' AS whole FROM inv_text""",
    "inv_raw": f"""SELECT *, {_NOT_JSON} AS not_json, CASE WHEN event_id % 97 = 0 THEN left(whole, length(whole) - 1)
          WHEN event_id % 109 = 0 THEN whole || '] junk' ELSE whole END AS text,
        CASE WHEN {_NOT_JSON} THEN 'json_parse_error'
          WHEN event_id % 89 = 0 THEN 'missing fields: delta_units'
          WHEN event_id % 101 = 0 THEN 'invalid type: delta_units'
          WHEN on_hand_after < 0 THEN 'on_hand_after must be >= 0, got ' || on_hand_after
          WHEN movement_type = 'steal' THEN 'unknown movement_type: steal'
          WHEN store_id NOT IN (SELECT store_id FROM dim_store) THEN 'unknown store_id: ' || store_id
          WHEN sku_id NOT IN (SELECT sku_id FROM dim_sku) THEN 'unknown sku_id: ' || sku_id
          WHEN event_id % 83 = 0 THEN 'unparseable event_time: not-a-date'
          WHEN sent > (SELECT now FROM clock) + INTERVAL 60 SECOND THEN 'event_time too far in future: '
            || strftime(sent, '%Y-%m-%d %H:%M:%S.%f') || '+00:00' END AS reason FROM inv_full""",
    "vinv": """SELECT 'inv-' || event_id AS event_id, store_id, sku_id, ts AS event_time, movement_type,
        CAST(delta_units AS INTEGER) AS delta_units, CAST(on_hand_after AS INTEGER) AS on_hand_after
        FROM inv_raw WHERE reason IS NULL""",
    "order_cells": f"""SELECT store_id, sku_id, {start_of('event_time')} AS pane, count(*) AS order_count,
        CAST(sum(quantity) AS BIGINT) AS total_units, avg(quantity) AS avg_basket_size
        FROM vorders GROUP BY ALL""",
    "inv_cells": f"""SELECT store_id, sku_id, {start_of('event_time')} AS pane,
        CAST(coalesce(sum(-delta_units) FILTER (delta_units < 0), 0) AS BIGINT) AS depletion_units,
        CAST(coalesce(sum(delta_units) FILTER (movement_type = 'restock'), 0) AS BIGINT) AS restock_units,
        arg_max(on_hand_after, (event_time, event_id)) AS on_hand_latest FROM vinv GROUP BY ALL""",
    "cells": f"""SELECT store_id, sku_id, pane, coalesce(order_count, 0) AS order_count,
        coalesce(total_units, 0) AS total_units, coalesce(depletion_units, 0) AS depletion_units,
        coalesce(restock_units, 0) AS restock_units, on_hand_latest
        FROM order_cells FULL JOIN inv_cells USING (store_id, sku_id, pane)""",
    "assembled_all": f"""SELECT *, sum(order_count) OVER (PARTITION BY store_id, sku_id ORDER BY epoch_us(pane)
          RANGE BETWEEN {4 * W} PRECEDING AND CURRENT ROW) AS long_count,
        last_value(on_hand_latest IGNORE NULLS) OVER (PARTITION BY store_id, sku_id ORDER BY pane
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS on_hand FROM cells""",
    "assembled": """SELECT store_id, sku_id, pane AS window_start, pane + INTERVAL 6 HOUR AS window_end, order_count,
        total_units, depletion_units, restock_units, on_hand,
        CASE WHEN on_hand_latest IS NOT NULL THEN 'window' WHEN on_hand IS NOT NULL THEN 'carried' ELSE 'none' END
          AS on_hand_source,
        order_count / 1.0::DOUBLE AS short_rate, CAST(long_count AS DOUBLE) / 5.0 AS long_rate
        FROM assembled_all WHERE order_count > 0""",
    "features": """SELECT store_id, sku_id, window_start, window_end, round_even(CAST(short_rate AS DOUBLE), 4) AS order_rate,
        round_even(CAST(depletion_units AS DOUBLE), 4) AS depletion_vel,
        round_even(CAST(short_rate AS DOUBLE) / greatest(CAST(long_rate AS DOUBLE), CAST(0.01 AS DOUBLE)), 4) AS demand_momentum,
        CAST(coalesce(on_hand, 0) AS INTEGER) AS on_hand_est, window_end AS updated_at, on_hand_source FROM assembled""",
    "alert_rows": """SELECT f.store_id, f.sku_id, 'stockout_risk' AS alert_type, window_end AS triggered_at,
          CAST(on_hand_est AS DOUBLE) AS metric_value, CAST(coalesce(reorder_point, 20) AS DOUBLE) AS threshold, window_start
        FROM features f LEFT JOIN dim_sku d ON f.sku_id = d.sku_id
        WHERE on_hand_source <> 'none' AND on_hand_est <= coalesce(reorder_point, 20)
        UNION ALL
        SELECT store_id, sku_id, 'surge', window_end, demand_momentum, 2.5, window_start FROM features WHERE demand_momentum >= 2.5""",
    "alerts_all": """SELECT store_id, sku_id, alert_type, sha256(store_id || '|' || sku_id || '|'
        || strftime(window_start, '%Y-%m-%d %H:%M:%S') || '|' || alert_type) AS alert_id, triggered_at,
        metric_value, CAST(threshold AS DOUBLE) AS threshold, FALSE AS resolved FROM alert_rows""",
    "alert_state": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY store_id, sku_id, alert_type
        ORDER BY triggered_at DESC, alert_id DESC) AS rn FROM alerts_all) WHERE rn = 1""",
    "latest_feat": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY store_id, sku_id
        ORDER BY window_end DESC) AS rn FROM features) WHERE rn = 1""",
    # State after auto-resolve: what the dashboard queries read.
    "alerts": """SELECT a.* EXCLUDE (resolved), CASE WHEN alert_type = 'stockout_risk'
          THEN f.on_hand_est > coalesce(d.reorder_point, 20) ELSE f.demand_momentum < 2.5 END AS resolved
        FROM alert_state a JOIN latest_feat f USING (store_id, sku_id) LEFT JOIN dim_sku d USING (sku_id)""",
    "serving_now": "SELECT now + INTERVAL 6 HOUR AS now FROM clock",
    "lagged": "SELECT *, " + ", ".join(
        f"lag(order_rate, {i}) OVER (PARTITION BY store_id, sku_id ORDER BY window_start) AS order_rate_lag{i}"
        for i in range(1, 7)
    ) + " FROM features",
    "rolled": """SELECT *, (order_rate_lag1 + order_rate_lag2 + order_rate_lag3) / 3 AS order_rate_roll3_mean,
        CASE WHEN order_rate_lag3 IS NULL THEN 0 ELSE sqrt((
          pow(order_rate_lag1 - (order_rate_lag1 + order_rate_lag2 + order_rate_lag3) / 3, 2)
          + pow(order_rate_lag2 - (order_rate_lag1 + order_rate_lag2 + order_rate_lag3) / 3, 2)
          + pow(order_rate_lag3 - (order_rate_lag1 + order_rate_lag2 + order_rate_lag3) / 3, 2)) / 2) END AS order_rate_roll3_std,
        (order_rate_lag1 + order_rate_lag2 + order_rate_lag3 + order_rate_lag4 + order_rate_lag5 + order_rate_lag6) / 6
          AS order_rate_roll6_mean FROM lagged""",
    "forecast": """SELECT *, CAST(hour(window_start) AS INTEGER) AS hour_of_day,
        CAST(isodow(window_start) - 1 AS INTEGER) AS day_of_week,
        CAST(isodow(window_start) >= 6 AS INTEGER) AS is_weekend
        FROM rolled WHERE order_rate_lag6 IS NOT NULL""",
    "zscores": """SELECT *, """ + ", ".join(
        f"""CASE WHEN coalesce(stddev_samp({c}) OVER k, 0) = 0 THEN 0
          ELSE ({c} - avg({c}) OVER k) / stddev_samp({c}) OVER k END AS {c}_zscore"""
        for c in ("order_rate", "depletion_vel")
    ) + " FROM features WINDOW k AS (PARTITION BY store_id, sku_id)",
    "holdout": """SELECT *, row_number() OVER (ORDER BY window_start, store_id, sku_id)
        <= floor((SELECT count(*) FROM features) * 0.8) AS is_train FROM features""",
    "labels_gt": """SELECT CASE WHEN event_type = 'error' THEN 'stockout_risk' ELSE 'surge' END AS anomaly_type, store_id,
        sku_id, ts AS injected_at, CASE WHEN event_type = 'error' THEN 0 ELSE 20 END AS surge_extra_events,
        5 AS stockout_target_units FROM base WHERE value > 120 AND event_type <> 'signup'""",
    # Deterministic stand-in for model output: a row far from its key's mean is anomalous.
    "predicted": "SELECT *, CASE WHEN abs(order_rate_zscore) >= 1.5 OR abs(depletion_vel_zscore) >= 2 THEN -1 ELSE 1 END AS prediction FROM zscores",
    "offline": """SELECT CASE WHEN demand_momentum >= 2.0 THEN 'surge' ELSE 'stockout_risk' END AS alert_type, store_id, sku_id,
        window_end AS triggered_at FROM predicted WHERE prediction = -1""",
    "drift_split": """SELECT *, CASE WHEN window_end >= (SELECT max(window_end) FROM features) - INTERVAL 5 DAY THEN 'current'
        ELSE 'reference' END AS side FROM features
        WHERE window_end >= (SELECT max(window_end) FROM features) - INTERVAL 30 DAY""",
    "drift_long": " UNION ALL ".join(
        f"SELECT side, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM drift_split"
        for f in ("order_rate", "depletion_vel", "demand_momentum", "on_hand_est")
    ),
    "drift_ranges": """SELECT feature, min(value) AS lo, max(value) AS hi, count(*) FILTER (side = 'current') AS n_current,
        count(*) FILTER (side = 'reference') AS n_reference FROM drift_long GROUP BY feature""",
    "drift_bins": """SELECT g.feature, g.bin, n_reference, n_current,
        count(*) FILTER (side = 'reference') AS reference, count(*) FILTER (side = 'current') AS current
        FROM (SELECT *, CAST(unnest(range(1, 11)) AS INTEGER) AS bin FROM drift_ranges WHERE lo < hi) g
        LEFT JOIN drift_long v ON v.feature = g.feature
          AND (g.bin = 1 OR value >= lo + (g.bin - 1) * ((hi - lo) / 10))
          AND (g.bin = 10 OR value < lo + g.bin * ((hi - lo) / 10))
        GROUP BY ALL""",
    "drift_psi": """SELECT feature, round(abs(sum((c - r) * ln(c / r))), 6) AS psi FROM (SELECT feature,
        CASE WHEN reference = 0 THEN 1e-4 ELSE reference / n_reference END AS r,
        CASE WHEN current = 0 THEN 1e-4 ELSE current / n_current END AS c FROM drift_bins) GROUP BY feature""",
    "drift_js": """SELECT feature, round(least(abs(
          0.5 * sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) * 0.5)) ELSE 0 END)
          + 0.5 * sum(CASE WHEN q > 0 THEN q * log2(q / ((p + q) * 0.5)) ELSE 0 END)), 1.0), 6) AS js_div
        FROM (SELECT feature, reference / n_reference AS p, current / n_current AS q FROM drift_bins) GROUP BY feature""",
    "drift_ks": """SELECT feature, max(abs(r / n_reference - c / n_current)) AS ks, n_reference, n_current
        FROM (SELECT feature, value, n_reference, n_current,
            sum(nr) OVER (PARTITION BY feature ORDER BY value) AS r, sum(nc) OVER (PARTITION BY feature ORDER BY value) AS c
          FROM (SELECT feature, value, count(*) FILTER (side = 'reference') AS nr, count(*) FILTER (side = 'current') AS nc
            FROM drift_long GROUP BY ALL) JOIN drift_ranges USING (feature)) GROUP BY feature, n_reference, n_current""",
    "drift_kstest": """SELECT feature, round(ks, 6) AS ks_stat, round(CASE WHEN ks <= 0 THEN 1.0 ELSE greatest(0.0, least(1.0,
        2 * list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END)
          * exp(-2.0 * k * k * (n_reference * n_current / (n_reference + n_current)) * ks * ks))))) END, 6) AS ks_pval
        FROM drift_ks""",
    "drift_metrics": """SELECT feature, psi, ks_stat, ks_pval, js_div, CAST(psi > 0.25 AS DOUBLE) AS drifted
        FROM drift_psi JOIN drift_kstest USING (feature) JOIN drift_js USING (feature)""",
    "drift_summary": """SELECT n_current, n_reference, skip_reason, skip_reason IS NOT NULL AS skipped,
        skip_reason IS NULL AND n_drifted > 0 AS any_drift,
        CASE WHEN skip_reason IS NULL THEN n_drifted ELSE 0 END AS n_features_drifted,
        CASE WHEN skip_reason IS NULL THEN top_psi ELSE 0.0 END AS max_psi,
        CASE WHEN skip_reason IS NULL THEN names ELSE '' END AS drifted_features
        FROM (SELECT *, CASE WHEN n_reference < 10 THEN 'insufficient_reference_data'
              WHEN n_current < 5 THEN 'insufficient_current_data' END AS skip_reason
          FROM (SELECT count(*) FILTER (side = 'current') AS n_current, count(*) FILTER (side = 'reference') AS n_reference
              FROM drift_split),
            (SELECT CAST(coalesce(sum(drifted), 0) AS BIGINT) AS n_drifted, coalesce(max(psi), 0) AS top_psi,
              coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (drifted > 0), '') AS names FROM drift_metrics))""",
    "daily": """SELECT o_orderdate AS ts, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f,
        count(*) FILTER (o_orderstatus = 'P') AS p, max(o_totalprice) AS top FROM orders GROUP BY 1""",
    "daily_label": """SELECT o_orderdate AS ts, o_orderpriority AS label, max(o_totalprice) AS top, min(o_totalprice) AS low
        FROM orders GROUP BY ALL""",
    "metric_log": """SELECT ts, 'feature_freshness_lag_seconds' AS metric, '' AS label, n * 40.0::DOUBLE AS value FROM daily
        UNION ALL SELECT ts, 'active_alerts', 'stockout_risk', f * 2.0::DOUBLE FROM daily
        UNION ALL SELECT ts, 'active_alerts', 'surge', p * 1.0::DOUBLE FROM daily
        UNION ALL SELECT ts, 'drift_detected', '', CAST(top > 450000 AS DOUBLE) FROM daily
        UNION ALL SELECT ts, 'psi', label, low / 1000000 FROM daily_label
        UNION ALL SELECT ts, 'ks_stat', label, top / 1000000 FROM daily_label
        UNION ALL SELECT ts, 'mae', label, top / 400000 FROM daily_label
        UNION ALL SELECT ts, 'f1', label, top / 500000 FROM daily_label""",
    "runs": """SELECT model_name, epoch(start_time)::BIGINT // 604800 AS version,
        'run-' || left(model_name, 1) || '-' || (epoch(start_time)::BIGINT // 604800) AS run_id, start_time,
        CASE WHEN left(model_name, 1) IN ('1', '2') THEN 'mae' ELSE 'f1' END AS metric,
        CASE WHEN n % 7 <> 0 THEN top / 500000 END AS value, n
        FROM (SELECT o_orderpriority AS model_name, CAST(date_trunc('week', o_orderdate) AS TIMESTAMP) AS start_time,
          count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY ALL)""",
    "registry": """SELECT model_name, version, run_id, 'None' AS stage, start_time AS event_ts FROM runs
        UNION ALL SELECT model_name, version, run_id, 'Production', start_time + INTERVAL 1 DAY FROM runs WHERE n % 2 = 0
        UNION ALL SELECT model_name, version, run_id, 'Archived', start_time + INTERVAL 35 DAY FROM runs
          WHERE n % 2 = 0 AND start_time + INTERVAL 35 DAY <= (SELECT max(start_time) FROM runs)""",
    "reg_state": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY model_name, version
        ORDER BY event_ts DESC, stage DESC) AS rn FROM registry) WHERE rn = 1""",
    "incumbents": """SELECT p.model_name, p.version, p.run_id, metric, value AS incumbent_value
        FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY version DESC) AS rn FROM reg_state
          WHERE stage = 'Production') p JOIN runs r ON p.run_id = r.run_id AND p.rn = 1 WHERE r.value IS NOT NULL""",
    "latest_runs": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY model_name
        ORDER BY start_time DESC, run_id DESC) AS rn FROM runs) WHERE rn = 1""",
    "cooldowns": """SELECT job_name, cooldown_min, last_triggered,
        (epoch_us((SELECT max(o_orderdate) + INTERVAL 90 MINUTE FROM orders)) - epoch_us(last_triggered)) / 1000000.0 / 60 AS elapsed_min
        FROM (VALUES ('detector_retrain', 60), ('forecaster_retrain', 120), ('never_triggered', 30)) l(job_name, cooldown_min)
        LEFT JOIN (SELECT CASE left(o_orderpriority, 1) WHEN '1' THEN 'detector_retrain' WHEN '2' THEN 'forecaster_retrain' END
          AS job_name, max(o_orderdate) AS last_triggered FROM orders WHERE left(o_orderpriority, 1) IN ('1', '2') GROUP BY 1)
        USING (job_name)""",
    "drift_runs": """SELECT 'drift-' || strftime(run_ts, '%Y%m%d') AS run_id, run_ts, sum(n) % 11 = 0 AS skipped,
        count(*) FILTER (psi > 0.25) > 0 AS any_drift, max(psi) AS max_psi,
        coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (psi > 0.25), '') AS names
        FROM (SELECT CAST(date_trunc('week', o_orderdate) AS TIMESTAMP) AS run_ts, o_orderpriority AS feature, count(*) AS n,
          min(o_totalprice) / 200000 AS psi FROM orders GROUP BY ALL) GROUP BY run_ts""",
    "retrain": """SELECT *, go AND NOT det AS trigger_detector, go AND NOT fc AS trigger_forecaster FROM
        (SELECT *, NOT skipped AND any_drift AS go,
          (SELECT coalesce(elapsed_min < cooldown_min, FALSE) FROM cooldowns WHERE job_name = 'detector_retrain') AS det,
          (SELECT coalesce(elapsed_min < cooldown_min, FALSE) FROM cooldowns WHERE job_name = 'forecaster_retrain') AS fc
        FROM drift_runs)""",
    "line_orders": """SELECT 'DS_' || lpad(CAST(n_regionkey AS VARCHAR), 3, '0') AS store_id, p_brand AS sku_id,
        l_shipdate AS event_time, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS event_id,
        CAST(l_quantity AS INTEGER) AS quantity, l_returnflag FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey""",
    "line_cells": f"""SELECT store_id, sku_id, {start_of('event_time', LW)} AS window_start, count(*) AS order_count,
        CAST(sum(quantity) AS BIGINT) AS total_units,
        CAST(coalesce(sum(quantity) FILTER (l_returnflag <> 'R'), 0) AS BIGINT) AS depletion_units,
        arg_max(quantity, (event_time, event_id, quantity)) AS on_hand FROM line_orders GROUP BY ALL""",
    "line_features": f"""SELECT store_id, sku_id, window_start, window_start + INTERVAL 7 DAY AS window_end,
        round_even(CAST(order_count AS DOUBLE), 4) AS order_rate, round_even(CAST(depletion_units AS DOUBLE), 4) AS depletion_vel,
        round_even(CAST(order_count AS DOUBLE) / greatest(CAST(long_count AS DOUBLE) / 5.0, 0.01), 4) AS demand_momentum, on_hand AS on_hand_est
        FROM (SELECT *, sum(order_count) OVER (PARTITION BY store_id, sku_id ORDER BY epoch_us(window_start)
          RANGE BETWEEN {4 * LW} PRECEDING AND CURRENT ROW) AS long_count FROM line_cells)""",
}

CTES["metric_log_closed"] = "SELECT * FROM metric_log WHERE ts <= (SELECT max(ts) FROM metric_log) - INTERVAL 1 DAY"
# Orders of which every thirteenth is stamped forty hours back, in eight files of equal time.
CTES["late_orders"] = """SELECT store_id, sku_id, (epoch_us(event_time) - low) // width AS b,
    CASE WHEN CAST(substr(event_id, 5) AS BIGINT) % 13 = 0 THEN event_time - INTERVAL 40 HOUR ELSE event_time END AS event_time
    FROM vorders, (SELECT epoch_us(min(event_time)) AS low, (epoch_us(max(event_time)) - epoch_us(min(event_time))) // 8 + 1 AS width FROM vorders)"""
# The same from the windows that a stream has closed when its input ends, both inputs an hour behind their newest event.
CTES["closed_features"] = """SELECT * FROM features WHERE window_end <= least((SELECT max(event_time) FROM vorders),
    (SELECT max(event_time) FROM vinv)) - INTERVAL 1 HOUR"""
_STATE = ("features", "alert_rows", "alerts_all", "alert_state", "latest_feat", "alerts")
for _name in _STATE[1:]:
    CTES[f"closed_{_name}"] = re.sub(rf"\b(FROM|JOIN) ({'|'.join(_STATE)})\b", r"\1 closed_\2", CTES[_name])

_TABLE = re.compile(r"\b(?:FROM|JOIN)\s+([a-z_]+)")


def statement(select: str) -> str:
    """``select`` preceded by the expressions it uses, directly or through others, in dependency order."""
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in _TABLE.findall(sql):
            if name in CTES and name not in ordered:
                visit(CTES[name])
                ordered.append(name)

    visit(select)
    if not ordered:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered) + "\n" + select
