"""Dashboard queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.operators import serving
from stocktide.plans.catalog import query, rounded
from stocktide.plans.retail_tables import Retail
from stocktide.sources import retail
from stocktide.streaming import stateful, sustained

_LAG = "(epoch_us((SELECT now FROM serving_now)) - epoch_us(max({c}))) / CAST(1000000 AS DOUBLE)"


@query(
    "freshness",
    f"""SELECT latest, lag_s, CASE WHEN lag_s < 43200 THEN 'healthy' WHEN lag_s < 108000 THEN 'stale' ELSE 'down' END AS status,
      CASE WHEN lag_s < 60 THEN printf('%.0fs ago', lag_s) ELSE printf('%.1fm ago', lag_s / 60) END AS lag_text
    FROM (SELECT max(window_end) AS latest, {_LAG.format(c='window_end')} AS lag_s FROM features)""",
)
def freshness(r: Retail) -> DataFrame:
    return serving.freshness(
        r.features, r.serving_clock, healthy_s=120 * retail.SCALE, stale_s=300 * retail.SCALE
    )


@query("write_freshness", f"SELECT {_LAG.format(c='updated_at')} AS lag_s FROM features")
def write_freshness(r: Retail) -> DataFrame:
    return serving.write_freshness(r.features, r.serving_clock)


@query(
    "active_alerts",
    """SELECT t AS alert_type, count(a.alert_type) AS n FROM (VALUES ('stockout_risk'), ('surge')) v(t)
      LEFT JOIN (SELECT * FROM alerts WHERE NOT resolved) a ON a.alert_type = t GROUP BY t""",
)
def active_alerts(r: Retail) -> DataFrame:
    return serving.active_alerts(r.alerts)


@query(
    "stockout_risks",
    """SELECT store_id, sku_id, on_hand_est, depletion_vel, order_rate, demand_momentum, window_end,
      sku_id || ' / ' || store_id AS label, CASE WHEN on_hand_est <= 20 THEN 'low' WHEN on_hand_est <= 50 THEN 'mid' ELSE 'ok' END
        AS stock_band
    FROM features WHERE on_hand_est <= 40 ORDER BY depletion_vel DESC, store_id, sku_id, window_end LIMIT 50""",
)
def stockout_risks(r: Retail) -> DataFrame:
    return serving.stockout_risks(r.features, 40, 50)


@query(
    "surge_alerts",
    """SELECT a.store_id, a.sku_id, a.metric_value, a.threshold, a.triggered_at, f.order_rate, f.demand_momentum, f.on_hand_est
    FROM alerts a LEFT JOIN latest_feat f ON f.store_id = a.store_id AND f.sku_id = a.sku_id
    WHERE a.alert_type = 'surge' AND NOT a.resolved ORDER BY a.metric_value DESC, a.store_id, a.sku_id LIMIT 30""",
)
def surge_alerts(r: Retail) -> DataFrame:
    return serving.surge_alerts(r.alerts, r.features, 30)


_VELOCITY = """SELECT store_id, sku_id, round(avg(order_rate), 3) AS avg_order_rate, round(avg(depletion_vel), 3) AS avg_depletion
    FROM features WHERE window_end > (SELECT now FROM serving_now) - INTERVAL 60 HOUR GROUP BY ALL"""


@query("sku_velocity", f"{_VELOCITY} ORDER BY avg_order_rate DESC, store_id, sku_id LIMIT 60")
def sku_velocity(r: Retail) -> DataFrame:
    return serving.sku_velocity(r.features, r.serving_clock, 600 * retail.SCALE, 60)


_HEALTH = """SELECT f.*, CAST(coalesce(n, 0) AS BIGINT) AS recent_alerts FROM
    (SELECT store_id, round(avg(on_hand_est), 1) AS avg_on_hand, round(avg(order_rate), 3) AS avg_order_rate,
      round(avg(demand_momentum), 2) AS avg_momentum, count(DISTINCT sku_id) AS active_skus FROM {rows} GROUP BY store_id) f
    LEFT JOIN (SELECT store_id, count(*) AS n FROM alerts WHERE triggered_at > (SELECT now FROM serving_now) - INTERVAL 90 HOUR
      GROUP BY store_id) a USING (store_id)"""


@query("store_health", _HEALTH.format(rows="features"))
def store_health(r: Retail) -> DataFrame:
    return serving.store_health(r.features, r.alerts, r.serving_clock, 900 * retail.SCALE)


@query("store_health_latest", _HEALTH.format(rows="latest_feat"))
def store_health_latest(r: Retail) -> DataFrame:
    return serving.store_health(r.features, r.alerts, r.serving_clock, 900 * retail.SCALE, latest_only=True)


@query(
    "alert_log",
    """SELECT alert_type, store_id, sku_id, metric_value, threshold, resolved, triggered_at FROM alerts
      ORDER BY triggered_at DESC, store_id, sku_id, alert_type LIMIT 100""",
)
def alert_log(r: Retail) -> DataFrame:
    return serving.alert_log(r.alerts)


def _stores(r: Retail) -> list[str]:
    """All stores of the dimension; a pivot has one column each."""
    return sorted(row["store_id"] for row in r.dim_store.select("store_id").distinct().toLocalIterator())


# The test tables' stores, for the checking SQL, whose columns cannot be computed.
STORES = ["DS_000", "DS_001", "DS_002", "DS_003", "DS_004"]


@query(
    "velocity_pivot",
    "SELECT sku_id, "
    + ", ".join(f"round(coalesce(avg(avg_order_rate) FILTER (store_id = '{s}'), 0), 3) AS \"{s}\"" for s in STORES)
    + f" FROM ({_VELOCITY}) GROUP BY sku_id",
)
def velocity_pivot(r: Retail) -> DataFrame:
    return serving.velocity_pivot(r.velocity, _stores(r))


@query(
    "depletion_pivot",
    "SELECT sku_id, "
    + ", ".join(f"round(coalesce(avg(avg_depletion) FILTER (store_id = '{s}'), 0), 3) AS \"{s}\"" for s in STORES)
    + f" FROM ({_VELOCITY}) GROUP BY sku_id",
)
def depletion_pivot(r: Retail) -> DataFrame:
    return serving.velocity_pivot(r.velocity, _stores(r), "avg_depletion")


@query(
    "top_skus",
    f"""SELECT sku_id, round(sum(avg_order_rate), 3) AS total_order_rate FROM ({_VELOCITY}) GROUP BY sku_id
      ORDER BY total_order_rate DESC, sku_id LIMIT 20""",
)
def top_skus(r: Retail) -> DataFrame:
    return serving.top_skus(r.velocity)


@query("latest_order_rate", "SELECT store_id, sku_id, order_rate FROM latest_feat")
def latest_order_rate(r: Retail) -> DataFrame:
    return serving.latest_order_rate(r.features)


@query(
    "stock_bands",
    """SELECT store_id, CASE WHEN on_hand_est <= 20 THEN 'low' WHEN on_hand_est <= 50 THEN 'mid' ELSE 'ok' END AS stock_band,
      count(*) AS n FROM features GROUP BY ALL""",
)
def stock_bands(r: Retail) -> DataFrame:
    return serving.stock_bands(r.features)


# One minute of the alert rules is one day of the metric log.
_DAY = 1440


def _threshold_sql(log: str) -> str:
    return f"""SELECT rule, since, until, held_s FROM (
      SELECT rule, for_s, min(ts) AS since, min(next_ts) FILTER (last_of) AS until,
        (epoch_us(coalesce(min(next_ts) FILTER (last_of), max(ts))) - epoch_us(min(ts))) / CAST(1000000 AS DOUBLE) AS held_s
      FROM (SELECT *, next_ts IS NULL OR NOT next_holds AS last_of, sum(CAST(prev_holds IS DISTINCT FROM TRUE AS INTEGER))
          OVER (PARTITION BY rule ORDER BY ts) AS island
        FROM (SELECT *, lag(holds) OVER k AS prev_holds, lead(holds) OVER k AS next_holds, lead(ts) OVER k AS next_ts
          FROM (SELECT rule, for_s, ts, CASE WHEN op = '>' THEN value > threshold ELSE value = threshold END AS holds
            FROM {log} JOIN (VALUES ('FeatureStaleness', 'feature_freshness_lag_seconds', '', '>', 300.0, {120 * _DAY}),
              ('DataDriftDetected', 'drift_detected', '', '==', 1.0, 0),
              ('HighStockoutAlertVolume', 'active_alerts', 'stockout_risk', '>', 5.0, {300 * _DAY}),
              ('SurgeAlertSpike', 'active_alerts', 'surge', '>', 3.0, {120 * _DAY})) t(rule, metric, label, op, threshold, for_s)
            USING (metric, label)) WINDOW k AS (PARTITION BY rule ORDER BY ts))
        WHERE holds) GROUP BY rule, for_s, island) WHERE held_s >= for_s"""


@query("threshold_rules", _threshold_sql("metric_log"))
def threshold_rules(r: Retail) -> DataFrame:
    return serving.threshold_rules(r.metric_log(), time_scale=_DAY, chunk_s=365 * 86400)


@query("stream_threshold_rules", _threshold_sql("metric_log_closed"))
def stream_threshold_rules(r: Retail) -> DataFrame:
    """The same rules over a running metric stream; spans that are still open end at the last sample the stream has passed."""
    stateful.use_rocksdb(r.spark)
    log, path = r.metric_log(), r.path(f"metrics-{uuid.uuid4().hex}")
    for year in [y[0] for y in log.select(F.year("ts")).distinct().orderBy(F.year("ts")).collect()]:
        log.filter(F.year("ts") == year).coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = r.spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in").withWatermark("ts", "1 day")
    alerts = sustained.threshold_stream(stream, time_scale=_DAY)
    query = (
        alerts.writeStream.format("parquet").outputMode("append").option("path", f"{path}/alerts")
        .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    told = r.spark.read.schema(alerts.schema).parquet(f"{path}/alerts")
    spans = told.groupBy("rule", "since").agg(F.max("until").alias("until"))
    last = log.agg(F.max("ts")).scalar() - F.expr("interval 1 day")
    held = F.unix_micros(F.coalesce("until", last)) - F.unix_micros("since")
    return spans.withColumn("held_s", held / 1e6)


@query("max_psi", "SELECT label, round(max(value), 9) AS max_psi FROM metric_log WHERE metric = 'psi' GROUP BY label")
def max_psi(r: Retail) -> DataFrame:
    return rounded(serving.max_psi(r.metric_log()), "max_psi", digits=9)


@query(
    "metric_bands",
    """SELECT ts, metric, label, round(value, 9) AS value, CASE metric
        WHEN 'mae' THEN CASE WHEN value < 0.5 THEN 'green' WHEN value < 1.0 THEN 'yellow' ELSE 'red' END
        WHEN 'f1' THEN CASE WHEN value < 0.5 THEN 'red' WHEN value < 0.7 THEN 'yellow' ELSE 'green' END
        WHEN 'ks_stat' THEN CASE WHEN value < 0.3 THEN 'green' ELSE 'red' END
        WHEN 'psi' THEN CASE WHEN value < 0.10 THEN 'green' WHEN value < 0.25 THEN 'yellow' ELSE 'red' END
        WHEN 'feature_freshness_lag_seconds' THEN CASE WHEN value < 120 THEN 'green' WHEN value < 300 THEN 'yellow' ELSE 'red' END
        ELSE CASE WHEN value < 3 THEN 'green' WHEN value < 10 THEN 'yellow' ELSE 'red' END END AS band
    FROM metric_log WHERE metric <> 'drift_detected'""",
)
def metric_bands(r: Retail) -> DataFrame:
    return rounded(serving.metric_bands(r.metric_log()), "value", digits=9)


@query(
    "metric_series",
    """SELECT metric, label, make_timestamp((epoch_us(ts) // 2592000000000) * 2592000000000) AS step_start,
      round(arg_max(value, ts), 9) AS value FROM metric_log GROUP BY ALL""",
)
def metric_series(r: Retail) -> DataFrame:
    return rounded(serving.metric_series(r.metric_log(), "30 days"), "value", digits=9)
