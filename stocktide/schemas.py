"""Declared schemas. Nothing in the package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

ORDER_EVENT = (
    "event_id STRING, event_time STRING, store_id STRING, sku_id STRING, category STRING, "
    "quantity DOUBLE, unit_price DOUBLE, order_id STRING, is_injected_anomaly BOOLEAN"
)
INVENTORY_EVENT = (
    "event_id STRING, event_time STRING, store_id STRING, sku_id STRING, movement_type STRING, "
    "delta_units DOUBLE, on_hand_after DOUBLE, is_injected_anomaly BOOLEAN"
)

# The fields an event must carry, and the movements a stock event may name.
ORDER_REQUIRED = [
    "category", "event_id", "event_time", "order_id", "quantity", "sku_id", "store_id", "unit_price",
]
INVENTORY_REQUIRED = [
    "delta_units", "event_id", "event_time", "movement_type", "on_hand_after", "sku_id", "store_id",
]
MOVEMENT_TYPES = ["sale", "restock", "adjustment"]
ALERT_TYPES = ["stockout_risk", "surge"]

DIM_SKU = T.StructType([
    T.StructField("sku_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("reorder_point", T.IntegerType()),
])
DIM_STORE = T.StructType([
    T.StructField("store_id", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("capacity", T.IntegerType()),
])
WINDOWED_FEATURES = T.StructType([
    T.StructField("store_id", T.StringType()),
    T.StructField("sku_id", T.StringType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("order_rate", T.DoubleType()),
    T.StructField("depletion_vel", T.DoubleType()),
    T.StructField("demand_momentum", T.DoubleType()),
    T.StructField("on_hand_est", T.IntegerType()),
    T.StructField("updated_at", T.TimestampType()),
])
ALERTS = T.StructType([
    T.StructField("store_id", T.StringType()),
    T.StructField("sku_id", T.StringType()),
    T.StructField("alert_type", T.StringType()),
    T.StructField("alert_id", T.StringType()),
    T.StructField("triggered_at", T.TimestampType()),
    T.StructField("metric_value", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("resolved", T.BooleanType()),
])
ANOMALY_LABEL = T.StructType([
    T.StructField("anomaly_type", T.StringType()),
    T.StructField("store_id", T.StringType()),
    T.StructField("sku_id", T.StringType()),
    T.StructField("injected_at", T.StringType()),
    T.StructField("surge_extra_events", T.IntegerType()),
    T.StructField("stockout_target_units", T.IntegerType()),
])

KEYS = ["store_id", "sku_id"]
FEATURE_KEY = ["store_id", "sku_id", "window_start"]
ALERT_KEY = ["store_id", "sku_id", "alert_type"]

# The model input columns, in model order.
FORECAST_COLUMNS = [
    "order_rate_lag1", "order_rate_lag2", "order_rate_lag3",
    "order_rate_roll3_mean", "order_rate_roll3_std", "order_rate_roll6_mean",
    "depletion_vel", "demand_momentum", "on_hand_est",
    "hour_of_day", "day_of_week", "is_weekend",
]
FORECAST_TARGET = "order_rate"
FORECAST_CODES = ["store_enc", "sku_enc"]
ANOMALY_COLUMNS = [
    "order_rate", "depletion_vel", "demand_momentum", "on_hand_est",
    "order_rate_zscore", "depletion_vel_zscore",
]
