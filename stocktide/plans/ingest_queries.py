"""Sources, sinks and validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktide import schemas
from stocktide.operators import evaluate, registry, scoring, validation
from stocktide.plans.catalog import query, rounded
from stocktide.plans.retail_tables import Retail
from stocktide.sources import retail, streams, tables
from stocktide.storage import path_exists
from stocktide.streaming import pipeline, sinks


def _once(r: Retail, name: str, write) -> str:
    """Path of an output that this session writes once."""
    path = r.path(name)
    if not path_exists(r.spark, f"{path}/_SUCCESS"):
        write(path)
    return path


def _text(r: Retail, kind: str) -> str:
    raw = r.raw_orders if kind == "orders" else r.raw_inventory
    return _once(r, f"raw_{kind}_text", lambda p: raw.select("value").write.mode("overwrite").text(p))


@query("src_orders", "SELECT text AS value FROM order_raw")
def src_orders(r: Retail) -> DataFrame:
    return streams.file_events_batch(r.spark, _text(r, "orders"))


@query("src_inventory", "SELECT text AS value FROM inv_raw")
def src_inventory(r: Retail) -> DataFrame:
    return streams.file_events_batch(r.spark, _text(r, "inventory"))


def _csv(r: Retail, name: str, df: DataFrame) -> str:
    return _once(r, name, lambda p: df.write.mode("overwrite").option("header", True).csv(p))


@query("src_dim_sku", "SELECT * FROM dim_sku")
def src_dim_sku(r: Retail) -> DataFrame:
    return tables.dim_sku(r.spark, _csv(r, "dim_sku_csv", r.dim_sku.select(*schemas.DIM_SKU.names)))


@query("src_dim_store", "SELECT * FROM dim_store")
def src_dim_store(r: Retail) -> DataFrame:
    return tables.dim_store(r.spark, _csv(r, "dim_store_csv", r.dim_store.select(*schemas.DIM_STORE.names)))


@query(
    "seed_summary",
    """SELECT (SELECT count(*) FROM dim_sku) AS n_skus, (SELECT count(DISTINCT category) FROM dim_sku) AS n_categories,
    (SELECT count(*) FROM dim_store) AS n_stores""",
)
def seed_summary(r: Retail) -> DataFrame:
    return tables.seed_summary(r.dim_sku, r.dim_store)


_FEATURES = "store_id, sku_id, window_start, window_end, order_rate, depletion_vel, demand_momentum, on_hand_est, updated_at"


def _exported(r: Retail) -> str:
    stored = r.features.select(*schemas.WINDOWED_FEATURES.names)
    return _once(r, "exported_features", lambda p: sinks.export_features(stored, p))


@query("export_features", f"SELECT {_FEATURES}, CAST(window_start AS DATE) AS day FROM features")
def export_features(r: Retail) -> DataFrame:
    schema = schemas.WINDOWED_FEATURES.fields
    return r.spark.read.schema(T.StructType([*schema, T.StructField("day", T.DateType())])).parquet(_exported(r))


@query("src_features", f"SELECT {_FEATURES} FROM features")
def src_features(r: Retail) -> DataFrame:
    return tables.feature_history(r.spark, _exported(r))


@query("scan_features_ordered", f"SELECT {_FEATURES} FROM features ORDER BY updated_at, store_id, sku_id, window_start")
def scan_features_ordered(r: Retail) -> DataFrame:
    return tables.features_ordered(r.features.select(*schemas.WINDOWED_FEATURES.names))


@query(
    "feature_availability",
    "SELECT count(DISTINCT CAST(window_start AS DATE)) AS n_files, count(*) AS n_rows FROM features",
)
def feature_availability(r: Retail) -> DataFrame:
    # One file per day: the day folder stands for the file.
    return tables.feature_availability(tables.feature_history(r.spark, _exported(r)), r"day=[0-9-]+")


@query("feature_files")
def feature_files(r: Retail) -> DataFrame:
    return tables.feature_availability(tables.feature_history(r.spark, _exported(r)))


@query(
    "src_labels",
    "SELECT anomaly_type, store_id, sku_id, injected_at, surge_extra_events, stockout_target_units FROM labels_gt",
)
def src_labels(r: Retail) -> DataFrame:
    labels = retail.anomaly_labels(r.spark, r.sf_dir)
    path = _once(r, "labels_json", lambda p: labels.write.mode("overwrite").json(p))
    return tables.anomaly_labels(r.spark, path)


@query(
    "upsert_features",
    """SELECT store_id, sku_id, window_start, window_end,
      CASE WHEN restated THEN order_rate + 1 ELSE order_rate END AS order_rate, depletion_vel, demand_momentum, on_hand_est,
      CASE WHEN restated THEN updated_at + INTERVAL 1 DAY ELSE updated_at END AS updated_at
    FROM (SELECT *, window_end > (SELECT now FROM clock) - INTERVAL 10 DAY AS restated FROM features)""",
)
def upsert_features(r: Retail) -> DataFrame:
    """All rows as one batch, the last ten days again with later values as another."""
    table = pipeline.StreamTables(r.spark, r.path("upserted")).features
    rows = r.features.select(*schemas.WINDOWED_FEATURES.names)
    later = rows.filter(F.col("window_end") > r.clock - F.expr("interval 10 days")).withColumns({
        "order_rate": F.col("order_rate") + 1,
        "updated_at": F.col("updated_at") + F.expr("interval 1 day"),
    })
    table.upsert(rows, 0)
    table.upsert(later, 1)
    table.upsert(later, 1)  # a retried batch changes nothing
    return table.read()


@query("upsert_alerts", "SELECT * FROM alert_state")
def upsert_alerts(r: Retail) -> DataFrame:
    table = pipeline.StreamTables(r.spark, r.path("upserted")).alerts
    alerts = r.all_alerts()
    early = F.col("triggered_at") < r.clock - F.expr("interval 15 days")
    table.upsert(alerts.filter(early), 0)
    table.upsert(alerts.filter(~early), 1)
    return table.read()


@query(
    "route_alerts",
    """SELECT CASE WHEN alert_type = 'stockout_risk' THEN 'stockout-alerts' ELSE 'surge-alerts' END AS topic,
      alert_id, store_id, sku_id, alert_type, metric_value FROM alerts_all""",
)
def route_alerts(r: Retail) -> DataFrame:
    routed = scoring.route_alerts(r.all_alerts())
    body = F.from_json("value", "alert_id STRING, store_id STRING, sku_id STRING, alert_type STRING, metric_value DOUBLE")
    return routed.select("topic", body.alias("b")).select("topic", "b.*")


@query(
    "dead_letters",
    """SELECT 'raw-orders' AS source_topic, reason, (SELECT now FROM clock) AS failed_at, text AS original_event
      FROM order_raw WHERE reason IS NOT NULL
    UNION ALL SELECT 'raw-inventory', reason, (SELECT now FROM clock), text FROM inv_raw WHERE reason IS NOT NULL""",
)
def dead_letters(r: Retail) -> DataFrame:
    return validation.dead_letters(r.validated("orders"), "raw-orders", r.clock).unionByName(
        validation.dead_letters(r.validated("inventory"), "raw-inventory", r.clock)
    )


@query("order_event_count", "SELECT count(*) AS order_events FROM order_raw WHERE reason IS NULL")
def order_event_count(r: Retail) -> DataFrame:
    return pipeline.counted(r.live_orders()).agg(F.count("*").alias("order_events"))


_LAG1_METRICS = """SELECT round(avg(abs(order_rate - order_rate_lag1)), 6) AS mae,
    round(sqrt(avg(pow(order_rate - order_rate_lag1, 2))), 6) AS rmse,
    round(avg(abs((order_rate - order_rate_lag1) / order_rate)) FILTER (order_rate <> 0) * 100, 6) AS mape FROM forecast"""


@query(
    "run_metric_log",
    f"""SELECT 'demand-forecaster' AS experiment, 'run-1' AS run_id, metric, value FROM
    (UNPIVOT ({_LAG1_METRICS}) ON mae, rmse, mape INTO NAME metric VALUE value)""",
)
def run_metric_log(r: Retail) -> DataFrame:
    quality = evaluate.forecast_metrics(r.forecast(), "order_rate", "order_rate_lag1")
    rows = registry.run_metric_rows(quality, "demand-forecaster", "run-1", r.clock)
    sinks.append_metrics(rows, r.path("metric_runs"), "run-1")
    log = sinks.read_metrics(r.spark, r.path("metric_runs"))
    return rounded(log.select("experiment", "run_id", "metric", "value"), "value")


@query("forecast_metrics", _LAG1_METRICS)
def forecast_metrics(r: Retail) -> DataFrame:
    """Quality of the naive forecast that repeats the preceding window."""
    return rounded(evaluate.forecast_metrics(r.forecast(), "order_rate", "order_rate_lag1"), "mae", "rmse", "mape")


@query(
    "parse_events",
    """SELECT ts AS arrived_at, not_json AS parse_error, CASE WHEN NOT not_json THEN 'evt-' || event_id END AS event_id,
      CASE WHEN NOT not_json THEN written END AS quantity, CASE WHEN NOT not_json THEN CAST(price AS DOUBLE) END AS unit_price,
      CASE WHEN NOT not_json AND event_id % 89 <> 0 THEN 'ord-' || event_id END AS order_id FROM order_raw""",
)
def parse_events(r: Retail) -> DataFrame:
    parsed = validation.parse_events(r.raw_orders, "orders")
    return parsed.select(
        "arrived_at", F.col("event").isNull().alias("parse_error"),
        "event.event_id", "event.quantity", "event.unit_price", "event.order_id",
    )


@query(
    "validate_required",
    """SELECT ts AS arrived_at, 'orders' AS kind, CASE WHEN event_id % 89 = 0 THEN 'order_id' ELSE '' END AS missing
      FROM order_raw WHERE NOT not_json
    UNION ALL SELECT ts, 'inventory', CASE WHEN event_id % 89 = 0 THEN 'delta_units' ELSE '' END
      FROM inv_raw WHERE NOT not_json""",
)
def validate_required(r: Retail) -> DataFrame:
    def missing(raw: DataFrame, kind: str) -> DataFrame:
        parsed = validation.parse_events(raw, kind).filter(F.col("event").isNotNull())
        return parsed.select(
            "arrived_at", F.lit(kind).alias("kind"),
            F.array_join(validation.missing_fields(kind), ",").alias("missing"),
        )

    return missing(r.raw_orders, "orders").unionByName(missing(r.raw_inventory, "inventory"))


def _rule(name: str, text: str) -> str:
    return f"regexp_extract(reason, '^([a-z_]+( [a-z_]+)*)', 1) AS {name} FROM {text}"


def _rules_sql(raw: str) -> str:
    return f"""SELECT rule, count(*) AS n FROM (SELECT {_rule('rule', raw)} WHERE reason IS NOT NULL) GROUP BY rule"""


@query("validate_orders", _rules_sql("order_raw"))
def validate_orders(r: Retail) -> DataFrame:
    return validation.reject_counts(r.validated("orders"))


@query("validate_inventory", _rules_sql("inv_raw"))
def validate_inventory(r: Retail) -> DataFrame:
    return validation.reject_counts(r.validated("inventory"))


@query(
    "ref_integrity_anti",
    """SELECT ts AS arrived_at, store_id, sku_id, store_id IN (SELECT store_id FROM dim_store) AS store_known,
      sku_id IN (SELECT sku_id FROM dim_sku) AS sku_known FROM order_raw WHERE NOT not_json AND NOT
      (store_id IN (SELECT store_id FROM dim_store) AND sku_id IN (SELECT sku_id FROM dim_sku))""",
)
def ref_integrity_anti(r: Retail) -> DataFrame:
    parsed = validation.parse_events(r.raw_orders, "orders").filter(F.col("event").isNotNull())
    known = validation.with_known_ids(parsed, r.dim_store, r.dim_sku)
    return known.filter(~(F.col("store_known") & F.col("sku_known"))).select(
        "arrived_at", "event.store_id", "event.sku_id", "store_known", "sku_known"
    )


@query(
    "validate_time",
    """SELECT ts AS arrived_at, CASE WHEN event_id % 83 <> 0 THEN sent END AS event_ts,
      coalesce(event_id % 83 <> 0 AND sent > (SELECT now FROM clock) + INTERVAL 60 SECOND, FALSE) AS in_future
      FROM order_raw WHERE NOT not_json""",
)
def validate_time(r: Retail) -> DataFrame:
    parsed = validation.parse_events(r.raw_orders, "orders").filter(F.col("event").isNotNull())
    stamped = parsed.withColumn("event_ts", validation.event_timestamp(F.col("event.event_time")))
    late = F.col("event_ts") > r.clock + F.expr("interval 60 seconds")
    return stamped.select("arrived_at", "event_ts", F.coalesce(late, F.lit(False)).alias("in_future"))


@query(
    "validation_reasons",
    """SELECT ts AS arrived_at, 'orders' AS kind, reason FROM order_raw
    UNION ALL SELECT ts, 'inventory', reason FROM inv_raw""",
)
def validation_reasons(r: Retail) -> DataFrame:
    parts = [
        r.validated(kind).select("arrived_at", F.lit(kind).alias("kind"), "reason") for kind in ("orders", "inventory")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "split_valid",
    """SELECT 'orders' AS kind, reason IS NULL AS valid, count(*) AS n FROM order_raw GROUP BY ALL
    UNION ALL SELECT 'inventory', reason IS NULL, count(*) FROM inv_raw GROUP BY ALL""",
)
def split_valid(r: Retail) -> DataFrame:
    both = validation_reasons(r)
    return both.groupBy("kind", F.col("reason").isNull().alias("valid")).agg(F.count("*").alias("n"))


@query(
    "project_orders",
    """SELECT event_id, store_id, sku_id, event_time, epoch_us(event_time) // 1000 AS event_ms, quantity, unit_price,
      is_injected_anomaly FROM vorders""",
)
def project_orders(r: Retail) -> DataFrame:
    return r.live_orders()


@query(
    "project_inventory",
    """SELECT event_id, store_id, sku_id, event_time, epoch_us(event_time) // 1000 AS event_ms, movement_type, delta_units,
      on_hand_after FROM vinv""",
)
def project_inventory(r: Retail) -> DataFrame:
    return r.live_inventory()


@query(
    "constraint_violations",
    """SELECT 'windowed_features' AS table_name, 'primary_key:store_id,sku_id,window_start' AS rule,
        count(*) - count(DISTINCT (store_id, sku_id, window_start)) AS n FROM features
    UNION ALL SELECT 'windowed_features', 'not_null:' || c, 0 FROM (SELECT unnest(['store_id', 'sku_id', 'window_start',
        'window_end', 'order_rate', 'depletion_vel', 'demand_momentum', 'on_hand_est', 'updated_at']) AS c)
    UNION ALL SELECT 'alerts', 'primary_key:store_id,sku_id,alert_type',
        count(*) - count(DISTINCT (store_id, sku_id, alert_type)) FROM alerts_all
    UNION ALL SELECT 'alerts', 'enum:alert_type', count(*) FILTER (alert_type NOT IN ('stockout_risk', 'surge')) FROM alerts_all
    UNION ALL SELECT 'alerts', 'not_null:' || c, 0 FROM (SELECT unnest(['store_id', 'sku_id', 'alert_type', 'alert_id',
        'triggered_at', 'metric_value', 'threshold', 'resolved']) AS c)
    UNION ALL SELECT 'dim_store', 'primary_key:store_id', count(*) - count(DISTINCT store_id) FROM dim_store""",
)
def constraint_violations(r: Retail) -> DataFrame:
    """The alert rows before the upsert break their key, which is what the upsert is for."""
    features = validation.constraint_violations(
        r.features, "windowed_features", schemas.WINDOWED_FEATURES.names, schemas.FEATURE_KEY
    )
    alerts = validation.constraint_violations(
        r.all_alerts(), "alerts", schemas.ALERTS.names, schemas.ALERT_KEY, {"alert_type": schemas.ALERT_TYPES}
    )
    stores = validation.constraint_violations(r.dim_store, "dim_store", [], ["store_id"])
    return features.unionByName(alerts).unionByName(stores)
