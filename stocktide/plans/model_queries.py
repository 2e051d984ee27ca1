"""Feature engineering, models, evaluation and the model registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide import schemas
from stocktide.config import ForestSpec
from stocktide.operators import evaluate, features, forecast, iforest, registry, scoring
from stocktide.operators.boosting import Boosted
from stocktide.plans.catalog import query, rounded
from stocktide.plans.retail_tables import Retail
from stocktide.schemas import FEATURE_KEY, KEYS
from stocktide.sources import retail
from stocktide.storage import path_exists

_KEY = "store_id, sku_id, window_start"
_LAGS = ", ".join(f"order_rate_lag{i}" for i in (1, 2, 3))
_ROLLS = """round(order_rate_roll3_mean, 6) AS order_rate_roll3_mean, round(order_rate_roll3_std, 6) AS order_rate_roll3_std,
    round(order_rate_roll6_mean, 6) AS order_rate_roll6_mean"""
_ROLL_NAMES = ["order_rate_roll3_mean", "order_rate_roll3_std", "order_rate_roll6_mean"]
_REST = "depletion_vel, demand_momentum, on_hand_est, hour_of_day, day_of_week, is_weekend"


@query("lag_features", f"SELECT {_KEY}, order_rate, {_LAGS} FROM lagged")
def lag_features(r: Retail) -> DataFrame:
    lagged = features.lag_features(r.features, retail.SPEC.chunk_s, depth=3)
    return lagged.select(*FEATURE_KEY, "order_rate", *[f"order_rate_lag{i}" for i in (1, 2, 3)])


@query("rolling_features", f"SELECT {_KEY}, {_ROLLS} FROM rolled")
def rolling_features(r: Retail) -> DataFrame:
    rolled = features.rolling_features(features.lag_features(r.features, retail.SPEC.chunk_s))
    return rounded(rolled.select(*FEATURE_KEY, *_ROLL_NAMES), *_ROLL_NAMES)


@query(
    "calendar_features",
    f"""SELECT {_KEY}, CAST(hour(window_start) AS INTEGER) AS hour_of_day, CAST(isodow(window_start) - 1 AS INTEGER) AS day_of_week,
      CAST(isodow(window_start) >= 6 AS INTEGER) AS is_weekend FROM features""",
)
def calendar_features(r: Retail) -> DataFrame:
    return features.calendar_features(r.features.select(*FEATURE_KEY))


@query("forecast_features", f"SELECT {_KEY}, order_rate, {_LAGS}, {_ROLLS}, {_REST} FROM forecast")
def forecast_features(r: Retail) -> DataFrame:
    return rounded(r.forecast().select(*FEATURE_KEY, "order_rate", *schemas.FORECAST_COLUMNS), *_ROLL_NAMES)


@query(
    "forecast_features_lagged_domain",
    f"""SELECT {_KEY}, order_rate, prev_vel AS depletion_vel, prev_momentum AS demand_momentum, prev_hand AS on_hand_est FROM (
      SELECT *, lag(depletion_vel) OVER k AS prev_vel, lag(demand_momentum) OVER k AS prev_momentum, lag(on_hand_est) OVER k AS prev_hand
      FROM lagged WINDOW k AS (PARTITION BY store_id, sku_id ORDER BY window_start)) WHERE order_rate_lag6 IS NOT NULL""",
)
def forecast_features_lagged_domain(r: Retail) -> DataFrame:
    built = features.forecast_features(r.features, retail.SPEC.chunk_s, lag_domain=True)
    return built.select(*FEATURE_KEY, "order_rate", "depletion_vel", "demand_momentum", "on_hand_est")


@query(
    "parse_window_start",
    f"SELECT store_id, sku_id, 'ms' AS kind, window_start FROM features UNION ALL SELECT store_id, sku_id, 'iso', window_start FROM features",
)
def parse_window_start(r: Retail) -> DataFrame:
    """Starts stored as epoch milliseconds and as ISO text, read back."""
    base = r.features.select(*KEYS, "window_start")
    ms = base.withColumn("window_start", F.unix_millis("window_start"))
    iso = base.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    parsed = [
        features.with_parsed_start(df).select(*KEYS, F.lit(kind).alias("kind"), "window_start")
        for kind, df in (("ms", ms), ("iso", iso))
    ]
    return parsed[0].unionByName(parsed[1])


_Z = ["order_rate_zscore", "depletion_vel_zscore"]


@query(
    "anomaly_features",
    f"""SELECT {_KEY}, order_rate, depletion_vel, demand_momentum, on_hand_est,
      round(order_rate_zscore, 6) AS order_rate_zscore, round(depletion_vel_zscore, 6) AS depletion_vel_zscore FROM zscores""",
)
def anomaly_features(r: Retail) -> DataFrame:
    built = features.anomaly_features(r.features, retail.SPEC.chunk_s)
    return rounded(built.select(*FEATURE_KEY, *schemas.ANOMALY_COLUMNS), *_Z)


@query(
    "online_forecast_features",
    f"""SELECT {_KEY}, {_LAGS}, {_ROLLS}, {_REST} FROM (SELECT *, row_number() OVER (PARTITION BY store_id, sku_id
      ORDER BY window_start DESC) AS rn FROM forecast) WHERE rn = 1""",
)
def online_forecast_features(r: Retail) -> DataFrame:
    return rounded(features.online_forecast_features(r.features, retail.SPEC.chunk_s), *_ROLL_NAMES)


@query(
    "online_anomaly_features",
    f"""SELECT {_KEY}, order_rate, CASE WHEN depletion_vel > 0 THEN depletion_vel ELSE 0.0 END AS depletion_vel,
      CAST(1.0 AS DOUBLE) AS demand_momentum, CASE WHEN on_hand_source = 'none' THEN 0 ELSE on_hand_est END AS on_hand_est,
      CAST(0 AS DOUBLE) AS order_rate_zscore, CAST(0 AS DOUBLE) AS depletion_vel_zscore FROM features""",
)
def online_anomaly_features(r: Retail) -> DataFrame:
    """Rows with gaps: momentum missing throughout, depletion and stock in places."""
    gaps = r.features.withColumns({
        "depletion_vel": F.when(F.col("depletion_vel") > 0, F.col("depletion_vel")),
        "on_hand_est": F.when(F.col("on_hand_source") != "none", F.col("on_hand_est")),
    }).drop("demand_momentum")
    return features.online_anomaly_features(gaps).select(*FEATURE_KEY, *schemas.ANOMALY_COLUMNS)


@query(
    "label_encode",
    f"""SELECT {_KEY}, CAST(dense_rank() OVER (ORDER BY store_id) - 1 AS INTEGER) AS store_enc,
      CAST(dense_rank() OVER (ORDER BY sku_id) - 1 AS INTEGER) AS sku_enc FROM features""",
)
def label_encode(r: Retail) -> DataFrame:
    return features.label_encode(r.features.select(*FEATURE_KEY))


@query("forecast_matrix", f"SELECT {_LAGS}, {_ROLLS}, {_REST}, order_rate AS target FROM forecast")
def forecast_matrix(r: Retail) -> DataFrame:
    return rounded(features.forecast_matrix(r.forecast()), *_ROLL_NAMES)


@query("holdout_split", f"SELECT {_KEY}, is_train FROM holdout")
def holdout_split(r: Retail) -> DataFrame:
    return features.holdout_split(r.features.select(*FEATURE_KEY))


@query(
    "union_features",
    f"""SELECT {_KEY}, order_rate, demand_momentum FROM features
    UNION ALL SELECT {_KEY}, order_rate, NULL FROM features""",
)
def union_features(r: Retail) -> DataFrame:
    wide = r.features.select("demand_momentum", *FEATURE_KEY, "order_rate")
    narrow = r.features.select("order_rate", *FEATURE_KEY)
    return features.union_features([wide, narrow]).select(*FEATURE_KEY, "order_rate", "demand_momentum")


def _train_rows(r: Retail) -> DataFrame:
    return r.stored("detector_training", features.holdout_split(r.zscores).filter("is_train").drop("is_train"))


def _forest(r: Retail) -> iforest.Forest:
    path = r.path("forest")
    if not path_exists(r.spark, f"{path}/_SUCCESS"):
        iforest.Forest.fit(_train_rows(r)).save(r.spark, path)
    return iforest.Forest.load(r.spark, path)


@query("iforest_fit")
def iforest_fit(r: Retail) -> DataFrame:
    return iforest.fit_forest(_train_rows(r))


@query(
    "iforest_invariants",
    """SELECT CAST(100 AS BIGINT) AS trees, CAST(least(256, count(*) FILTER (is_train)) AS INTEGER) AS least_root,
      CAST(least(256, count(*) FILTER (is_train)) AS INTEGER) AS most_root, count(*) AS n_scored, TRUE AS share_holds FROM holdout""",
)
def iforest_invariants(r: Retail) -> DataFrame:
    """What the tables say about any forest: trees, rows per tree, scored rows, and a flagged share about as set."""
    roots = iforest.fit_forest(_train_rows(r)).filter("node = 0").agg(
        F.count("*").alias("trees"), F.min("size").alias("least_root"), F.max("size").alias("most_root")
    )
    forest, spec = _forest(r), ForestSpec()
    scored = forest.score(r.zscores).agg(F.count_if(F.col("anomaly_score").between(0, 1)).alias("n_scored"))
    flagged = forest.predict(_train_rows(r)).agg(F.avg((F.col("prediction") == -1).cast("double"))).scalar()
    return roots.select(
        "trees", "least_root", "most_root", scored.scalar().alias("n_scored"),
        flagged.between(0.5 * spec.contamination, 1.1 * spec.contamination).alias("share_holds"),
    )


@query("iforest_score")
def iforest_score(r: Retail) -> DataFrame:
    return _forest(r).predict(r.zscores).select(*FEATURE_KEY, "anomaly_score", "prediction")


@query("alerts_ml")
def alerts_ml(r: Retail) -> DataFrame:
    return scoring.score_with_model(
        _forest(r).predict_online(r.features), r.dim_sku, triggered_at=F.col("window_end"),
        alert_id=scoring.stable_alert_id(),
    )


@query("offline_alerts", "SELECT * FROM offline")
def offline_alerts(r: Retail) -> DataFrame:
    return scoring.offline_alerts(r.flagged())


_NEAR = "abs(epoch_us(p.triggered_at) - epoch_us(l.injected_at)) <= 43200000000"
_SAME = "p.alert_type = l.anomaly_type AND p.store_id = l.store_id AND p.sku_id = l.sku_id"


@query(
    "detector_metrics",
    f"""SELECT round_even(p, 4) AS precision, round_even(r, 4) AS recall,
      round_even(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 4) AS f1, round_even(found / CAST(n_labels AS DOUBLE), 4) AS label_recall,
      n_predictions, n_labels
    FROM (SELECT *, tp / CAST(n_predictions AS DOUBLE) AS p, tp / CAST(n_labels AS DOUBLE) AS r FROM (SELECT
      (SELECT count(*) FROM offline p WHERE EXISTS (SELECT 1 FROM labels_gt l WHERE {_SAME} AND {_NEAR})) AS tp,
      (SELECT count(*) FROM labels_gt l WHERE EXISTS (SELECT 1 FROM offline p WHERE {_SAME} AND {_NEAR})) AS found,
      (SELECT count(*) FROM offline) AS n_predictions, (SELECT count(*) FROM labels_gt) AS n_labels))""",
)
def detector_metrics(r: Retail) -> DataFrame:
    return r.detector_metrics()


@query("detector_metrics_ml")
def detector_metrics_ml(r: Retail) -> DataFrame:
    """The forest's alerts on the holdout rows against the labels."""
    holdout = features.holdout_split(r.zscores).filter(~F.col("is_train"))
    alerts = scoring.offline_alerts(_forest(r).predict(holdout))
    return evaluate.detector_metrics(alerts, r.labels(), evaluate.MATCH_WINDOW_S * retail.SCALE)


def _frame(r: Retail) -> DataFrame:
    return r.stored("forecast_training", forecast.training_frame(r.features, retail.SPEC.chunk_s))


def _forecaster(r: Retail) -> Boosted:
    """Fitted once per table set and stored; held while the session lasts."""
    path = r.path("forecaster.json")
    if "forecaster" not in r.models:
        if not path_exists(r.spark, path):
            forecast.fit_forecaster(_frame(r).filter("is_train")).save(r.spark, path)
        r.models["forecaster"] = Boosted.load(r.spark, path)
    return r.models["forecaster"]


@query("forecast_fit")
def forecast_fit(r: Retail) -> DataFrame:
    """Input importances of the fitted forecaster."""
    return forecast.importances(_forecaster(r), r.spark)


@query("forecast_predict")
def forecast_predict(r: Retail) -> DataFrame:
    rows = forecast.predict(_forecaster(r), _frame(r).filter(~F.col("is_train")))
    return rows.select(*FEATURE_KEY, "order_rate", "predicted")


@query("forecast_quality")
def forecast_quality(r: Retail) -> DataFrame:
    return forecast.evaluate(_forecaster(r), _frame(r))


@query(
    "forecast_invariants",
    """SELECT CAST(floor(count(*) * 0.8) AS BIGINT) AS n_train, count(*) - CAST(floor(count(*) * 0.8) AS BIGINT) AS n_test,
      TRUE AS finite, TRUE AS beats_last_rate FROM forecast""",
)
def forecast_invariants(r: Retail) -> DataFrame:
    """What the tables say about any forecaster: rows per side, finite predictions, an error below the last rate's."""
    rows = forecast.predict(_forecaster(r), _frame(r).filter(~F.col("is_train")))
    target, finite = F.col(schemas.FORECAST_TARGET), ~F.isnan("predicted") & (F.abs("predicted") < float("inf"))
    return rows.agg(
        F.count("*").alias("n_test"),
        F.every(finite).alias("finite"),
        (F.avg(F.abs(F.col("predicted") - target)) < F.avg(F.abs(F.col("order_rate_lag1") - target))).alias("beats_last_rate"),
    ).withColumn("n_train", _frame(r).agg(F.count_if("is_train")).scalar())


@query("registry_state", "SELECT model_name, version, run_id, stage, event_ts FROM reg_state")
def registry_state(r: Retail) -> DataFrame:
    return registry.registry_state(r.registry_events())


def _primary(r: Retail) -> DataFrame:
    return r.runs().select("model_name", F.col("metric").alias("primary_metric")).distinct()


def _incumbents(r: Retail) -> DataFrame:
    log = r.runs().filter(F.col("value").isNotNull()).select("run_id", "metric", "value")
    return registry.incumbent_metrics(registry.registry_state(r.registry_events()), log, _primary(r))


@query("incumbent_metrics", "SELECT model_name, version, run_id, metric, round(incumbent_value, 9) AS incumbent_value FROM incumbents")
def incumbent_metrics(r: Retail) -> DataFrame:
    return rounded(_incumbents(r), "incumbent_value", digits=9)


@query(
    "cooldown_state",
    """SELECT job_name, cooldown_min, last_triggered, round(elapsed_min, 6) AS elapsed_min,
      coalesce(elapsed_min < cooldown_min, FALSE) AS in_cooldown FROM cooldowns""",
)
def cooldown_state(r: Retail) -> DataFrame:
    state = registry.cooldown_state(retail.trigger_log(r.spark, r.sf_dir), r.cooldown_limits(), r.orders_clock())
    return rounded(state, "elapsed_min")


def _decisions(r: Retail) -> DataFrame:
    """Every weekly run as a candidate against today's incumbent, two days after the newest promotion of its model."""
    candidates = r.runs().select(
        "model_name", "run_id", "value", (F.col("metric") == "f1").alias("higher_is_better")
    )
    last = r.registry_events().filter("stage = 'Production'").groupBy("model_name").agg(
        F.max("event_ts").alias("promoted_at")
    )
    as_of = r.registry_events().agg(F.max("event_ts")).scalar()
    return registry.promotion_gate(candidates, _incumbents(r), last, as_of, cooldown_min=7 * 24 * 60)


_GATE = """SELECT r.model_name, r.run_id, r.value, i.incumbent_value,
      coalesce(CASE WHEN r.metric = 'f1' THEN r.value > i.incumbent_value ELSE r.value < i.incumbent_value END, FALSE) AS better,
      (epoch_us((SELECT max(event_ts) FROM registry)) - epoch_us(p.promoted_at)) / 1000000.0 / 60 < 10080 AS waiting,
      i.model_name IS NULL AS alone
    FROM runs r LEFT JOIN incumbents i ON r.model_name = i.model_name
    LEFT JOIN (SELECT model_name, max(event_ts) AS promoted_at FROM registry WHERE stage = 'Production' GROUP BY 1) p
      ON p.model_name = r.model_name"""
_REASON = """CASE WHEN coalesce(waiting, FALSE) THEN 'cooldown' WHEN alone THEN 'no_incumbent'
    WHEN value IS NULL OR incumbent_value IS NULL THEN 'metric_missing' WHEN better THEN 'better' ELSE 'not_better' END"""


@query(
    "promotion_gate",
    f"""SELECT model_name, run_id, round(value, 9) AS value, round(incumbent_value, 9) AS incumbent_value,
      better AS beats_incumbent, reason IN ('no_incumbent', 'better') AS promote, reason
    FROM (SELECT *, {_REASON} AS reason FROM ({_GATE}))""",
)
def promotion_gate(r: Retail) -> DataFrame:
    return rounded(_decisions(r), "value", "incumbent_value", digits=9)


@query(
    "registry_transitions",
    f"""SELECT a.model_name, (SELECT max(version) FROM reg_state s WHERE s.model_name = a.model_name) + 1 AS version, a.run_id,
        'Production' AS stage, (SELECT max(o_orderdate) + INTERVAL 90 MINUTE FROM orders) AS event_ts
      FROM (SELECT model_name, max(run_id) AS run_id FROM (SELECT *, {_REASON} AS reason FROM ({_GATE}))
        WHERE reason IN ('no_incumbent', 'better') GROUP BY model_name) a
    UNION ALL SELECT model_name, version, run_id, 'Archived', (SELECT max(o_orderdate) + INTERVAL 90 MINUTE FROM orders)
      FROM reg_state WHERE stage = 'Production' AND model_name IN (SELECT model_name FROM
        (SELECT *, {_REASON} AS reason FROM ({_GATE})) WHERE reason IN ('no_incumbent', 'better'))""",
)
def registry_transitions(r: Retail) -> DataFrame:
    """Events that promoting the newest accepted run per model appends."""
    accepted = _decisions(r).filter("promote").groupBy("model_name").agg(F.max("run_id").alias("run_id"))
    state = registry.registry_state(r.registry_events())
    return registry.transitions(state, accepted.withColumn("promote", F.lit(True)), r.orders_clock())


@query(
    "latest_model_metrics",
    "SELECT model_name AS experiment, run_id, metric, round(value, 9) AS value, start_time FROM latest_runs",
)
def latest_model_metrics(r: Retail) -> DataFrame:
    log = r.runs().select(F.col("model_name").alias("experiment"), "run_id", "metric", "value", "start_time")
    return rounded(registry.latest_run_metrics(log), "value", digits=9)
