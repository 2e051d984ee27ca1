"""Drift and retraining."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.functions.expr import psi_band
from stocktide.operators import drift, registry, retrain
from stocktide.plans.catalog import query, rounded
from stocktide.plans.retail_tables import Retail
from stocktide.schemas import FEATURE_KEY, KEYS
from stocktide.sources import retail
from stocktide.streaming import loop, sinks


@query("drift_split", "SELECT store_id, sku_id, window_start, side FROM drift_split")
def drift_split(r: Retail) -> DataFrame:
    return r.split().select(*FEATURE_KEY, "side")


@query(
    "drift_split_pct",
    "SELECT store_id, sku_id, window_start, CASE WHEN is_train THEN 'reference' ELSE 'current' END AS side FROM holdout",
)
def drift_split_pct(r: Retail) -> DataFrame:
    return drift.fraction_split(r.features, retail.DRIFT).select(*FEATURE_KEY, "side")


@query(
    "drift_sides",
    "SELECT store_id, sku_id, window_start, CASE WHEN is_train THEN 'reference' ELSE 'current' END AS side FROM holdout",
)
def drift_sides(r: Retail) -> DataFrame:
    """A split of no time against one second finds too few windows, so the row-share split applies."""
    return drift.drift_sides(r.features, drift.DriftSpec(current_s=0, reference_s=1)).select(*FEATURE_KEY, "side")


@query("drift_histogram", "SELECT feature, bin, reference, current FROM drift_bins")
def drift_histogram(r: Retail) -> DataFrame:
    bins = drift.histogram(drift.value_counts(r.split(), retail.DRIFT), retail.DRIFT)
    return bins.select("feature", "bin", "reference", "current")


@query("drift_psi", "SELECT feature, psi FROM drift_psi")
def drift_psi(r: Retail) -> DataFrame:
    return drift.psi(drift.histogram(drift.value_counts(r.split(), retail.DRIFT), retail.DRIFT))


@query("drift_js", "SELECT feature, js_div FROM drift_js")
def drift_js(r: Retail) -> DataFrame:
    return drift.js_divergence(drift.histogram(drift.value_counts(r.split(), retail.DRIFT), retail.DRIFT))


@query("drift_ks", "SELECT feature, round(ks, 6) AS ks_stat, n_reference, n_current FROM drift_ks")
def drift_ks(r: Retail) -> DataFrame:
    stat = drift.ks_statistic(drift.value_counts(r.split(), retail.DRIFT), retail.DRIFT)
    return stat.select("feature", F.round("ks", 6).alias("ks_stat"), "n_reference", "n_current")


@query("drift_ks_pvalue", "SELECT feature, ks_stat, ks_pval FROM drift_kstest")
def drift_ks_pvalue(r: Retail) -> DataFrame:
    return drift.ks_test(drift.value_counts(r.split(), retail.DRIFT), retail.DRIFT, "asymptotic")


@query("drift_ks_exact")
def drift_ks_exact(r: Retail) -> DataFrame:
    """Per store, product and feature, whose samples are short."""
    return drift.exact_ks_by_key(r.split(), retail.DRIFT)


_BY_KEY = """SELECT store_id, sku_id, feature, round(max(abs(r / n_reference - c / n_current)), 6) AS ks_stat, n_reference, n_current
    FROM (SELECT store_id, sku_id, feature, sum(nr) OVER upto AS r, sum(nc) OVER upto AS c,
        sum(nr) OVER k AS n_reference, sum(nc) OVER k AS n_current
      FROM (SELECT store_id, sku_id, feature, value, count(*) FILTER (side = 'reference') AS nr, count(*) FILTER (side = 'current') AS nc
        FROM (UNPIVOT (SELECT store_id, sku_id, side, CAST(order_rate AS DOUBLE) AS order_rate, CAST(depletion_vel AS DOUBLE) AS depletion_vel,
            CAST(demand_momentum AS DOUBLE) AS demand_momentum, CAST(on_hand_est AS DOUBLE) AS on_hand_est FROM drift_split)
          ON order_rate, depletion_vel, demand_momentum, on_hand_est INTO NAME feature VALUE value) GROUP BY ALL)
      WINDOW k AS (PARTITION BY store_id, sku_id, feature),
        upto AS (PARTITION BY store_id, sku_id, feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    WHERE n_reference > 0 AND n_current > 0 GROUP BY ALL"""


@query("drift_ks_by_key", f"SELECT store_id, sku_id, feature, ks_stat FROM ({_BY_KEY})")
def drift_ks_by_key(r: Retail) -> DataFrame:
    """The statistics behind ``drift_ks_exact``."""
    return drift.exact_ks_by_key(r.split(), retail.DRIFT).drop("ks_pval")


@query(
    "drift_run_outcomes",
    """SELECT 'fallback' AS run, count(*) FILTER (NOT is_train) AS n_current, count(*) FILTER (is_train) AS n_reference,
      FALSE AS skipped, CAST(NULL AS VARCHAR) AS skip_reason, 4 AS n_features FROM holdout
    UNION ALL SELECT 'thin', count(*) FILTER (NOT is_train), count(*) FILTER (is_train), TRUE, 'insufficient_reference_data', 0
    FROM holdout""",
)
def drift_run_outcomes(r: Retail) -> DataFrame:
    """A run whose time split is thin falls back to row shares; one that asks for more rows than there are is skipped."""
    specs = {
        "fallback": drift.DriftSpec(current_s=0, reference_s=1),
        "thin": drift.DriftSpec(current_s=0, reference_s=1, min_reference=1 << 60),
    }
    out = None
    for name, spec in specs.items():
        metrics, summary = drift.drift_run(r.features, spec)
        row = summary.select(F.lit(name).alias("run"), "n_current", "n_reference", "skipped", F.col("reason").alias("skip_reason"))
        row = row.withColumn("n_features", metrics.agg(F.count("*")).scalar())
        out = row if out is None else out.unionAll(row)
    return out


@query("drift_metrics", "SELECT feature, psi, ks_stat, ks_pval, js_div, drifted FROM drift_metrics")
def drift_metrics(r: Retail) -> DataFrame:
    return r.drift_metrics()


@query("drift_report", "SELECT feature, psi, ks_stat, ks_pval, js_div, drifted FROM drift_metrics")
def drift_report(r: Retail) -> DataFrame:
    """The drift table through its report file."""
    path = r.path("drift_report")
    sinks.write_drift_report(r.drift_metrics(), path)
    return sinks.read_drift_report(r.spark, path)


@query(
    "drift_bands",
    """SELECT feature, psi, CASE WHEN psi < 0.10 THEN 'stable' WHEN psi <= 0.25 THEN 'moderate' ELSE 'significant' END AS band
      FROM drift_psi""",
)
def drift_bands(r: Retail) -> DataFrame:
    return r.drift_metrics().select("feature", "psi", psi_band("psi").alias("band"))


@query(
    "drift_summary",
    """SELECT n_current, n_reference, skip_reason, skipped, any_drift, n_features_drifted, max_psi, drifted_features,
      (SELECT max(window_end) FROM features) AS run_ts FROM drift_summary""",
)
def drift_summary(r: Retail) -> DataFrame:
    return r.drift_summary().withColumnRenamed("reason", "skip_reason").withColumn(
        "drifted_features", F.array_join("drifted_features", ",")
    )


@query(
    "drift_metrics_long",
    """SELECT feature || '_' || metric AS metric, value FROM (UNPIVOT (SELECT * FROM drift_metrics)
        ON psi, ks_stat, ks_pval, js_div, drifted INTO NAME metric VALUE value)
    UNION ALL SELECT 'n_current_rows', CAST(n_current AS DOUBLE) FROM drift_summary
    UNION ALL SELECT 'n_reference_rows', CAST(n_reference AS DOUBLE) FROM drift_summary
    UNION ALL SELECT 'n_features_drifted', CAST(n_features_drifted AS DOUBLE) FROM drift_summary""",
)
def drift_metrics_long(r: Retail) -> DataFrame:
    return drift.metrics_long(r.drift_metrics(), r.drift_summary())


_QUOTED = "'[''' || replace(names, ',', ''', ''') || ''']'"


def _decisions(r: Retail) -> DataFrame:
    state = registry.cooldown_state(retail.trigger_log(r.spark, r.sf_dir), r.cooldown_limits(), r.orders_clock())
    return retrain.retrain_decision(retail.drift_runs(r.spark, r.sf_dir), state, retail.DRIFT)


@query(
    "retrain_decision",
    f"""SELECT run_id, run_ts, trigger_detector OR trigger_forecaster AS should_trigger, trigger_detector, trigger_forecaster,
      CASE WHEN go THEN names ELSE '' END AS drifted_features, CASE WHEN skipped THEN 0 ELSE round(max_psi, 9) END AS max_psi,
      CASE WHEN skipped THEN 'drift_job skipped: insufficient_current_data'
        WHEN NOT any_drift THEN 'No drift detected (all PSI below threshold).'
        WHEN det AND fc THEN 'Drift detected on ' || {_QUOTED} || ' (max PSI=' || printf('%.4f', max_psi) || ') but both jobs are in cooldown.'
        ELSE 'Drift detected on features ' || {_QUOTED} || ' (max PSI=' || printf('%.4f', max_psi)
          || ' > threshold=0.25). Triggering: [' || CASE WHEN NOT det AND NOT fc THEN '''detector'', ''forecaster'''
          WHEN det THEN '''forecaster''' ELSE '''detector''' END || '].' END AS reason
    FROM retrain""",
)
def retrain_decision(r: Retail) -> DataFrame:
    """A decision for every weekly drift run, with the cooldowns that hold now."""
    decided = _decisions(r).withColumn("drifted_features", F.array_join("drifted_features", ","))
    return rounded(decided, "max_psi", digits=9)


@query(
    "retrain_pending",
    "SELECT run_id, run_ts FROM drift_runs WHERE NOT EXISTS (SELECT 1 FROM retrain t WHERE t.run_id = drift_runs.run_id AND t.skipped)",
)
def retrain_pending(r: Retail) -> DataFrame:
    """Weekly drift runs still to decide on; skipped ones count as handled."""
    runs = retail.drift_runs(r.spark, r.sf_dir)
    return retrain.pending_runs(runs, runs.filter("skipped")).select("run_id", "run_ts")


@query(
    "retrain_requests",
    """SELECT job_name || '_' || run_id AS run_key, job_name, names AS drifted_features, printf('%.4f', max_psi) AS max_psi
    FROM (SELECT *, 'detector_retrain' AS job_name FROM retrain WHERE trigger_detector
      UNION ALL SELECT *, 'forecaster_retrain' FROM retrain WHERE trigger_forecaster)""",
)
def retrain_requests(r: Retail) -> DataFrame:
    return retrain.run_requests(_decisions(r))


_WANTED = "SELECT run_id FROM drift_runs WHERE NOT skipped AND any_drift"


@query(
    "retrain_passes",
    f"""SELECT 'first' AS pass, job_name, count(*) AS started FROM ({_WANTED}),
      (SELECT unnest(['detector_retrain', 'forecaster_retrain']) AS job_name) GROUP BY job_name""",
)
def retrain_passes(r: Retail) -> DataFrame:
    """Two passes over the weekly drift runs, ten minutes apart: the cooldown that the first one writes refuses the second."""
    runs, limits, at = retail.drift_runs(r.spark, r.sf_dir), r.cooldown_limits(), r.orders_clock()
    state = loop.LoopState(r.spark, r.path("retrain_loop"))
    later = at + F.expr("interval 10 minutes")
    found = [
        loop.retrain_pass(state, runs, limits, name, now, retail.DRIFT).select(F.lit(name).alias("pass"), "job_name")
        for name, now in (("first", at), ("second", later))
    ]
    return found[0].unionAll(found[1]).groupBy("pass", "job_name").agg(F.count("*").alias("started"))


@query("stream_retrain_requests", """SELECT job_name || '_' || run_id AS run_key, job_name, run_id FROM
    (SELECT *, 'detector_retrain' AS job_name FROM retrain WHERE trigger_detector
      UNION ALL SELECT *, 'forecaster_retrain' FROM retrain WHERE trigger_forecaster)""")
def stream_retrain_requests(r: Retail) -> DataFrame:
    """Summaries arrive as a stream and all of them twice; each is decided on once, with the cooldowns that hold now."""
    runs, path = retail.drift_runs(r.spark, r.sf_dir), r.path(f"drift-stream-{uuid.uuid4().hex}")
    for _ in range(2):
        runs.coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = r.spark.readStream.schema(runs.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    state = registry.cooldown_state(retail.trigger_log(r.spark, r.sf_dir), r.cooldown_limits(), r.orders_clock())
    query = loop.start_decisions(stream, lambda: state, f"{path}/requests", f"{path}/checkpoint", "3650 days", retail.DRIFT, {"availableNow": True})
    query.awaitTermination()
    return loop.read_requests(r.spark, f"{path}/requests").select("run_key", "job_name", "run_id")


@query(
    "drift_decision",
    """SELECT any_drift AS should_trigger, drifted_features, max_psi FROM drift_summary""",
)
def drift_decision(r: Retail) -> DataFrame:
    """The decision on the feature table's own drift run, with no job in cooldown."""
    idle = registry.cooldown_state(
        retail.trigger_log(r.spark, r.sf_dir), r.cooldown_limits().withColumn("cooldown_min", F.lit(0)), r.orders_clock()
    )
    decision = retrain.retrain_decision(r.drift_summary(), idle, retail.DRIFT)
    return decision.select("should_trigger", F.array_join("drifted_features", ",").alias("drifted_features"), "max_psi")


def _line_drift_sql() -> str:
    split = """(SELECT order_rate AS value, CASE WHEN window_end >= (SELECT max(window_end) FROM line_features) - INTERVAL 182 DAY
        THEN 'current' ELSE 'reference' END AS side FROM line_features
        WHERE window_end >= (SELECT max(window_end) FROM line_features) - INTERVAL 910 DAY)"""
    return f"""SELECT count(*) FILTER (side = 'current') AS n_current, count(*) FILTER (side = 'reference') AS n_reference,
        min(value) AS lo, max(value) AS hi FROM {split}"""


@query("line_drift_ranges", _line_drift_sql())
def line_drift_ranges(r: Retail) -> DataFrame:
    """Half a year of weekly line features against the two years before."""
    values = drift.value_counts(drift.time_split(r.line_features, retail.LINE_DRIFT), retail.LINE_DRIFT)
    ranges = drift.value_ranges(values).filter(F.col("feature") == "order_rate")
    return ranges.select("n_current", "n_reference", "lo", "hi")
