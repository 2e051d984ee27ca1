"""Dashboard queries over the feature and alert tables.

``as_of`` is the clock of a query: a literal, a scalar sub-query, or the current time when left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide import schemas
from stocktide.functions import expr
from stocktide.operators.chunks import neighbours
from stocktide.schemas import KEYS
from stocktide.storage import staged


def _clock(as_of: Column | None) -> Column:
    return F.current_timestamp() if as_of is None else as_of


def newest(df: DataFrame, column: str) -> Column:
    return df.agg(F.max(column)).scalar()


def freshness(
    features: DataFrame, as_of: Column | None = None, column: str = "window_end", healthy_s: float = 120,
    stale_s: float = 300,
) -> DataFrame:
    """One row: newest ``column``, its lag in seconds, the lag as text, and the status."""
    return (
        features.agg(F.max(column).alias("latest"))
        .withColumn("lag_s", expr.seconds_between(_clock(as_of), F.col("latest")))
        .withColumns({
            "status": expr.lag_status("lag_s", healthy_s, stale_s),
            "lag_text": expr.lag_text("lag_s"),
        })
    )


def write_freshness(features: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Seconds since the last feature row was written."""
    return features.agg(F.max("updated_at").alias("_last")).select(
        expr.seconds_between(_clock(as_of), F.col("_last")).alias("lag_s")
    )


def active_alerts(alerts: DataFrame) -> DataFrame:
    """Unresolved alerts per type; both types have a row even at zero."""
    counts = alerts.filter(~F.col("resolved")).agg(
        *[F.count_if(F.col("alert_type") == t).alias(t) for t in schemas.ALERT_TYPES]
    )
    return counts.unpivot([], schemas.ALERT_TYPES, "alert_type", "n")


def stockout_risks(features: DataFrame, threshold: int = 40, limit: int = 50) -> DataFrame:
    """Rows at or below the stock threshold, the fastest depleting first."""
    return (
        features.filter(F.col("on_hand_est") <= threshold)
        .select(*KEYS, "on_hand_est", "depletion_vel", "order_rate", "demand_momentum", "window_end")
        .orderBy(F.desc("depletion_vel"), *KEYS, "window_end")
        .limit(limit)
        .withColumns({"label": expr.key_label(), "stock_band": expr.stock_band("on_hand_est")})
    )


def latest_features(features: DataFrame) -> DataFrame:
    """The newest feature row per key.

    Column by column, so that the buffers have a fixed width and rows are hashed, not sorted. A key has one row per
    window, so all columns come from the same row.
    """
    rest = [c for c in features.columns if c not in KEYS]
    return features.groupBy(*KEYS).agg(*[F.max_by(c, "window_end").alias(c) for c in rest])


def surge_alerts(alerts: DataFrame, features: DataFrame, limit: int = 30) -> DataFrame:
    """Open surges with the newest features of their key, the strongest first.

    The top rows are taken before the features come in, which are then only aggregated for those keys.
    """
    top = (
        alerts.filter((F.col("alert_type") == "surge") & ~F.col("resolved"))
        .select(*KEYS, "metric_value", "threshold", "triggered_at")
        .orderBy(F.desc("metric_value"), *KEYS)
        .limit(limit)
    )
    wanted = features.join(F.broadcast(top.select(*KEYS)), KEYS, "left_semi")  # at most ``limit`` rows
    now = latest_features(wanted).select(*KEYS, "order_rate", "demand_momentum", "on_hand_est")
    return top.join(now, KEYS, "left").orderBy(F.desc("metric_value"), *KEYS)


def sku_velocity(
    features: DataFrame, as_of: Column | None = None, window_s: int = 600, limit: int | None = 60
) -> DataFrame:
    """Mean order rate and depletion per key over the last ``window_s`` seconds, the fastest first."""
    recent = features.filter(F.col("window_end") > _clock(as_of) - F.expr(f"interval {int(window_s)} seconds"))
    rates = recent.groupBy(*KEYS).agg(
        F.round(F.avg("order_rate"), 3).alias("avg_order_rate"),
        F.round(F.avg("depletion_vel"), 3).alias("avg_depletion"),
    )
    return rates if limit is None else rates.orderBy(F.desc("avg_order_rate"), *KEYS).limit(limit)


def store_health(
    features: DataFrame, alerts: DataFrame, as_of: Column | None = None, alert_window_s: int = 900,
    latest_only: bool = False,
) -> DataFrame:
    """Per store: mean stock, rate and momentum, products seen, and alerts of the last ``alert_window_s``.

    Keys are aggregated first and stores from keys, so counting distinct products needs no second
    pass over the rows. ``latest_only`` looks at the newest window of each key instead of all windows.
    """
    rows = latest_features(features) if latest_only else features
    means = ["on_hand_est", "order_rate", "demand_momentum"]
    per_key = rows.groupBy(*KEYS).agg(
        *[F.sum(F.col(c).cast("double")).alias(f"_s_{c}") for c in means],
        *[F.count(c).alias(f"_n_{c}") for c in means],
    )

    def mean(c: str, digits: int) -> Column:
        return F.round(F.sum(f"_s_{c}") / F.sum(f"_n_{c}"), digits)

    per_store = per_key.groupBy("store_id").agg(
        mean("on_hand_est", 1).alias("avg_on_hand"),
        mean("order_rate", 3).alias("avg_order_rate"),
        mean("demand_momentum", 2).alias("avg_momentum"),
        F.count("*").alias("active_skus"),
    )
    recent = (
        alerts.filter(F.col("triggered_at") > _clock(as_of) - F.expr(f"interval {int(alert_window_s)} seconds"))
        .groupBy("store_id")
        .agg(F.count("*").alias("_alerts"))
    )
    return (
        per_store.join(recent, "store_id", "left")
        .withColumn("recent_alerts", F.coalesce("_alerts", F.lit(0)))
        .drop("_alerts")
        .orderBy(F.desc("recent_alerts"), "store_id")
    )


def alert_log(alerts: DataFrame, limit: int = 100) -> DataFrame:
    """The newest alerts."""
    return (
        alerts.select("alert_type", *KEYS, "metric_value", "threshold", "resolved", "triggered_at")
        .orderBy(F.desc("triggered_at"), *KEYS, "alert_type")
        .limit(limit)
    )


def velocity_pivot(velocity: DataFrame, stores: list[str], value: str = "avg_order_rate") -> DataFrame:
    """Products by stores: mean of ``value``, 0 where a product has no row.

    The stores are named by the caller, which saves the job that would list them.
    """
    return (
        velocity.groupBy("sku_id")
        .pivot("store_id", stores)
        .agg(F.avg(value))
        .fillna(0.0, subset=stores)
        .select("sku_id", *[F.round(F.col(f"`{s}`"), 3).alias(s) for s in stores])
    )


def top_skus(velocity: DataFrame, limit: int = 20) -> DataFrame:
    """Products by summed order rate over stores."""
    return (
        velocity.groupBy("sku_id")
        .agg(F.round(F.sum("avg_order_rate"), 3).alias("total_order_rate"))
        .orderBy(F.desc("total_order_rate"), "sku_id")
        .limit(limit)
    )


def latest_order_rate(features: DataFrame) -> DataFrame:
    return features.groupBy(*KEYS).agg(F.max_by("order_rate", "window_end").alias("order_rate"))


def stock_bands(features: DataFrame) -> DataFrame:
    """Rows per store and stock colour."""
    return features.groupBy("store_id", expr.stock_band("on_hand_est").alias("stock_band")).agg(
        F.count("*").alias("n")
    )


# Alert rules over the metric log as (rule, metric, label, comparison, threshold, seconds held).
THRESHOLD_RULES = [
    ("FeatureStaleness", "feature_freshness_lag_seconds", "", ">", 300.0, 120),
    ("DataDriftDetected", "drift_detected", "", "==", 1.0, 0),
    ("HighStockoutAlertVolume", "active_alerts", "stockout_risk", ">", 5.0, 300),
    ("SurgeAlertSpike", "active_alerts", "surge", ">", 3.0, 120),
]


def rule_samples(metric_log: DataFrame, rules: list[tuple], time_scale: float) -> DataFrame:
    """(rule, ts, for_s, holds): every sample that a rule looks at, and whether its condition holds there."""
    table = F.broadcast(  # as many rows as there are rules in the settings
        metric_log.sparkSession.createDataFrame(
            [(*r[:5], float(r[5]) * time_scale) for r in rules],
            "rule STRING, metric STRING, label STRING, op STRING, threshold DOUBLE, for_s DOUBLE",
        )
    )
    holds = F.when(F.col("op") == ">", F.col("value") > F.col("threshold")).otherwise(
        F.col("value") == F.col("threshold")
    )
    return metric_log.join(table, ["metric", "label"]).select("rule", "ts", "for_s", holds.alias("holds"))


def threshold_rules(
    metric_log: DataFrame, rules: list[tuple] | None = None, time_scale: float = 1.0, chunk_s: int = 7 * 86400
) -> DataFrame:
    """Spans during which a rule's condition held for its duration or longer.

    Samples whose condition differs from the sample before are kept; each start is paired with the next
    kept sample of its series. ``held_s`` runs to the end of the span, or to the last sample of a span that is
    still open. ``metric_log`` is (ts, metric, label, value), one sample per series and time.
    """
    series = ["rule"]
    samples = rule_samples(metric_log, rules or THRESHOLD_RULES, time_scale)
    last = samples.groupBy(*series).agg(F.max("ts").alias("last_ts"))
    turned = staged(
        neighbours(samples, series, ["ts"], "holds", 1, chunk_s, "_was").filter(
            F.coalesce(F.col("_was1"), F.lit(False)) != F.col("holds")
        )
    )
    paired = neighbours(turned.drop("_was1"), series, ["ts"], "ts", 1, chunk_s, "_next", forward=False)
    return (
        paired.filter("holds")
        .join(F.broadcast(last), series)
        .select(
            "rule",
            F.col("ts").alias("since"),
            F.col("_next1").alias("until"),
            expr.seconds_between(F.coalesce("_next1", "last_ts"), F.col("ts")).alias("held_s"),
            "for_s",
        )
        .filter(F.col("held_s") >= F.col("for_s"))
        .drop("for_s")
    )


def max_psi(metric_log: DataFrame) -> DataFrame:
    """Largest PSI per feature label."""
    return metric_log.filter(F.col("metric") == "psi").groupBy("label").agg(F.max("value").alias("max_psi"))


# Fixed values: (metric, [(upper bound, band)], band above). Bounds are exclusive.
METRIC_BANDS = {
    "mae": ([(0.5, "green"), (1.0, "yellow")], "red"),
    "f1": ([(0.5, "red"), (0.7, "yellow")], "green"),
    "ks_stat": ([(0.3, "green")], "red"),
    "psi": ([(0.10, "green"), (0.25, "yellow")], "red"),
    "feature_freshness_lag_seconds": ([(120.0, "green"), (300.0, "yellow")], "red"),
    "active_alerts": ([(3.0, "green"), (10.0, "yellow")], "red"),
}


def metric_bands(metric_log: DataFrame) -> DataFrame:
    """Colour band of every sample whose metric has bands."""
    band = F.lit(None).cast("string")
    for name, (bands, above) in METRIC_BANDS.items():
        band = F.when(F.col("metric") == name, expr.banded("value", bands, above)).otherwise(band)
    return metric_log.filter(F.col("metric").isin(list(METRIC_BANDS))).withColumn("band", band)


def metric_series(metric_log: DataFrame, step: str) -> DataFrame:
    """Last value per metric, label and step: the points a chart draws."""
    return (
        metric_log.groupBy("metric", "label", F.window("ts", step).alias("w"))
        .agg(F.max_by("value", "ts").alias("value"))
        .select("metric", "label", F.col("w.start").alias("step_start"), "value")
    )
