"""Alerts from feature rows, by rule or gated by the anomaly model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.config import ScoringSpec
from stocktide.operators.chunks import latest_wins
from stocktide.operators.joins import lookup_join
from stocktide.schemas import ALERT_KEY, KEYS

_ALERT_COLUMNS = [
    "store_id", "sku_id", "alert_type", "alert_id", "triggered_at", "metric_value", "threshold", "resolved",
]


def with_reorder_point(features: DataFrame, dim_sku: DataFrame, spec: ScoringSpec = ScoringSpec()) -> DataFrame:
    """Add the product's reorder point, the default where the product is unknown."""
    points = dim_sku.select("sku_id", F.col("reorder_point").alias("_point"))
    return (
        lookup_join(features, points, ["sku_id"], KEYS)
        .withColumn("reorder_point", F.coalesce("_point", F.lit(spec.default_reorder_point)))
        .drop("_point")
    )


def _stockout(spec: ScoringSpec) -> tuple[Column, Column]:
    limit = F.col("reorder_point") * spec.stockout_ratio
    fires = F.coalesce(F.col("on_hand_est"), F.lit(0)) <= limit
    return fires, F.struct(
        F.lit("stockout_risk").alias("alert_type"),
        F.coalesce(F.col("on_hand_est"), F.lit(0)).cast("double").alias("metric_value"),
        limit.cast("double").alias("threshold"),
    )


def _surge(spec: ScoringSpec) -> tuple[Column, Column]:
    level = F.coalesce(F.col("demand_momentum"), F.lit(1.0))
    return level >= spec.surge_momentum, F.struct(
        F.lit("surge").alias("alert_type"),
        level.alias("metric_value"),
        F.lit(spec.surge_momentum).alias("threshold"),
    )


def _emit(
    rows: DataFrame, candidates: list[tuple[Column, Column]], triggered_at: Column | None, alert_id: Column | None
) -> DataFrame:
    """Explode the alerts that fire, in the given order, to rows of the alerts table."""
    triggered_at = F.current_timestamp() if triggered_at is None else triggered_at
    alert_id = F.uuid() if alert_id is None else alert_id
    fired = F.array_compact(F.array(*[F.when(cond, alert) for cond, alert in candidates]))
    exploded = rows.select("*", F.posexplode(fired).alias("alert_seq", "_alert"))
    with_fields = exploded.select(
        *[c for c in exploded.columns if c != "_alert"], "_alert.*"
    )
    return with_fields.withColumns({
        "triggered_at": triggered_at,
        "alert_id": alert_id,
        "resolved": F.lit(False),
    }).select(*_ALERT_COLUMNS, "alert_seq")


def stable_alert_id() -> Column:
    """Repeatable id from the alert's key and window, so a replayed batch writes the same rows."""
    return F.sha2(
        F.concat_ws("|", "store_id", "sku_id", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"), "alert_type"), 256
    )


def score_rules(
    features: DataFrame,
    dim_sku: DataFrame,
    spec: ScoringSpec = ScoringSpec(),
    triggered_at: Column | None = None,
    alert_id: Column | None = None,
) -> DataFrame:
    """Zero to two alerts per row: stock-out first, then surge.

    A row whose stock level was never observed (``on_hand_source`` none) raises no stock-out.
    """
    rows = with_reorder_point(features, dim_sku, spec)
    low, stockout = _stockout(spec)
    if "on_hand_source" in features.columns:
        low = low & (F.col("on_hand_source") != "none")
    return _emit(rows, [(low, stockout), _surge(spec)], triggered_at, alert_id)


def score_with_model(
    predicted: DataFrame,
    dim_sku: DataFrame,
    spec: ScoringSpec = ScoringSpec(),
    triggered_at: Column | None = None,
    alert_id: Column | None = None,
) -> DataFrame:
    """Alerts for rows the model calls anomalous (``prediction`` −1): surge first, then stock-out."""
    rows = with_reorder_point(predicted.filter(F.col("prediction") == -1), dim_sku, spec)
    return _emit(rows, [_surge(spec), _stockout(spec)], triggered_at, alert_id)


def offline_alerts(predicted: DataFrame, spec: ScoringSpec = ScoringSpec()) -> DataFrame:
    """One alert per anomalous row for evaluation: surge at high momentum, else stock-out, at the window end."""
    return predicted.filter(F.col("prediction") == -1).select(
        F.when(F.col("demand_momentum") >= spec.offline_surge_momentum, "surge")
        .otherwise("stockout_risk")
        .alias("alert_type"),
        *KEYS,
        F.col("window_end").alias("triggered_at"),
    )


def current_alerts(alerts: DataFrame) -> DataFrame:
    """Alert state: the last alert per store, product and type."""
    return latest_wins(alerts.select(*_ALERT_COLUMNS), ALERT_KEY, ["triggered_at", "alert_id"])


def auto_resolve(
    state: DataFrame, latest_features: DataFrame, dim_sku: DataFrame, spec: ScoringSpec = ScoringSpec()
) -> DataFrame:
    """Set ``resolved`` when the newest feature row of the key is back on the safe side of the threshold."""
    now = with_reorder_point(latest_features, dim_sku, spec).select(
        *KEYS,
        F.col("on_hand_est").alias("_on_hand"),
        F.col("demand_momentum").alias("_momentum"),
        F.col("reorder_point").alias("_point"),
    )
    safe = F.when(
        F.col("alert_type") == "stockout_risk", F.col("_on_hand") > F.col("_point") * spec.stockout_ratio
    ).otherwise(F.col("_momentum") < spec.surge_momentum)
    return (
        state.join(now.hint("merge"), KEYS, "left")  # as many rows as keys, so never broadcast
        .withColumn("resolved", F.col("resolved") | F.coalesce(safe, F.lit(False)))
        .drop("_on_hand", "_momentum", "_point")
    )


def route_alerts(
    alerts: DataFrame, stockout_topic: str = "stockout-alerts", surge_topic: str = "surge-alerts"
) -> DataFrame:
    """Topic and JSON value per alert; everything that is not a stock-out goes to the surge topic."""
    topic = F.when(F.col("alert_type") == "stockout_risk", stockout_topic).otherwise(surge_topic)
    body = [c for c in alerts.columns if c != "alert_seq"]
    return alerts.select(topic.alias("topic"), F.to_json(F.struct(*body)).alias("value"))
