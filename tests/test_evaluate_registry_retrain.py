import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stocktide.operators import evaluate, registry, retrain

NOW = datetime(2024, 5, 1, 12, 0, 0)


def test_forecast_metrics(spark):
    df = spark.createDataFrame([(2.0, 1.0), (4.0, 5.0), (0.0, 2.0)], "y DOUBLE, p DOUBLE")
    m = evaluate.forecast_metrics(df, "y", "p").first()
    assert m.mae == pytest.approx(4 / 3) and m.rmse == pytest.approx(math.sqrt(2)) and m.mape == pytest.approx(37.5)
    zeros = evaluate.forecast_metrics(spark.createDataFrame([(0.0, 2.0)], "y DOUBLE, p DOUBLE"), "y", "p").first()
    assert math.isnan(zeros.mape) and zeros.mae == 2.0


PRED = "alert_type STRING, store_id STRING, sku_id STRING, triggered_at TIMESTAMP"
LABEL = "anomaly_type STRING, store_id STRING, sku_id STRING, injected_at TIMESTAMP"


def score(spark, preds, labels, window=120):
    return evaluate.detector_metrics(
        spark.createDataFrame(preds, PRED), spark.createDataFrame(labels, LABEL), window
    ).first()


def test_detector_match_and_miss(spark):
    label = [("surge", "DS_1", "A", NOW)]
    hit = score(spark, [("surge", "DS_1", "A", NOW + timedelta(seconds=120))], label)
    assert (hit.precision, hit.recall, hit.f1, hit.n_predictions, hit.n_labels) == (1.0, 1.0, 1.0, 1, 1)
    for miss in (
        ("surge", "DS_1", "A", NOW + timedelta(seconds=120, microseconds=1)),
        ("surge", "DS_1", "A", NOW - timedelta(seconds=121)),
        ("stockout_risk", "DS_1", "A", NOW), ("surge", "DS_2", "A", NOW), ("surge", "DS_1", "B", NOW),
    ):
        assert score(spark, [miss], label).f1 == 0.0


def test_detector_empty_sides(spark):
    none = score(spark, [], [("surge", "DS_1", "A", NOW)])
    assert (none.precision, none.recall, none.f1, none.n_predictions, none.n_labels) == (0, 0, 0, 0, 1)
    none = score(spark, [("surge", "DS_1", "A", NOW)], [])
    assert (none.precision, none.recall, none.f1, none.n_predictions, none.n_labels) == (0, 0, 0, 1, 0)


def test_recall_counts_predictions(spark):
    preds = [("surge", "DS_1", "A", NOW + timedelta(seconds=s)) for s in (0, 0, 30)]
    got = score(spark, preds, [("surge", "DS_1", "A", NOW)])
    assert (got.recall, got.label_recall, got.precision, got.n_predictions) == (3.0, 1.0, 1.0, 3)


def test_detector_matches_nested_loops(spark):
    rng = random.Random(7)

    def some(n, hot):
        return [
            (rng.choice(["surge", "stockout_risk"]), "DS_1", "A" if rng.random() < hot else rng.choice("BC"),
             NOW + timedelta(milliseconds=rng.randrange(0, 6_000_000)))
            for _ in range(n)
        ]

    preds, labels = some(120, 0.6), some(25, 0.6)
    near = lambda p, x: p[:3] == x[:3] and abs((p[3] - x[3]).total_seconds()) <= 120
    tp = sum(any(near(p, x) for x in labels) for p in preds)
    found = sum(any(near(p, x) for p in preds) for x in labels)
    got = score(spark, preds, labels)
    assert got.precision == round(tp / 120, 4) and got.recall == round(tp / 25, 4)
    assert got.label_recall == round(found / 25, 4)


def gate(spark, value, incumbent, higher=True, minutes_ago=None):
    candidates = spark.createDataFrame([("m", "r9", value, higher)], "model_name STRING, run_id STRING, value DOUBLE, higher_is_better BOOLEAN")
    known = [] if incumbent == "none" else [("m", incumbent)]
    incumbents = spark.createDataFrame(known, "model_name STRING, incumbent_value DOUBLE")
    last = [] if minutes_ago is None else [("m", NOW - timedelta(minutes=minutes_ago))]
    promoted = spark.createDataFrame(last, "model_name STRING, promoted_at TIMESTAMP")
    row = registry.promotion_gate(candidates, incumbents, promoted, F.lit(NOW)).first()
    return row.promote, row.reason


def test_promotion_gate(spark):
    assert gate(spark, 0.8, 0.7) == (True, "better")
    assert gate(spark, 0.7, 0.7) == (False, "not_better")
    assert gate(spark, 0.6, 0.7, higher=False) == (True, "better")
    assert gate(spark, 0.8, 0.7, higher=False) == (False, "not_better")
    assert gate(spark, None, "none") == (True, "no_incumbent")
    assert gate(spark, None, 0.7) == (False, "metric_missing")
    assert gate(spark, 0.9, 0.1, minutes_ago=29) == (False, "cooldown")
    assert gate(spark, 0.9, 0.1, minutes_ago=30) == (True, "better")


def test_registry_round_trip(spark):
    events = spark.createDataFrame(
        [("m", 1, "r1", "None", NOW), ("m", 1, "r1", "Production", NOW + timedelta(minutes=1)), ("m", 2, "r2", "None", NOW)],
        registry.REGISTRY_EVENT,
    )
    state = registry.registry_state(events)
    assert {(r.version, r.stage) for r in state.collect()} == {(1, "Production"), (2, "None")}
    decisions = spark.createDataFrame([("m", "r9", True)], "model_name STRING, run_id STRING, promote BOOLEAN")
    added = registry.transitions(state, decisions, F.lit(NOW + timedelta(hours=1)))
    after = registry.registry_state(events.unionByName(added.select(*events.columns)))
    assert {(r.version, r.stage) for r in after.collect()} == {(1, "Archived"), (2, "None"), (3, "Production")}
    assert registry.production_versions(after).first().run_id == "r9"


def test_incumbent_needs_the_metric(spark):
    state = spark.createDataFrame(
        [("a", 1, "ra", "Production", NOW), ("b", 1, "rb", "Production", NOW), ("c", 1, "rc", "None", NOW)], registry.REGISTRY_EVENT
    )
    log = spark.createDataFrame([("ra", "mae", 0.4), ("rb", "rmse", 0.4)], "run_id STRING, metric STRING, value DOUBLE")
    primary = spark.createDataFrame([(m, "mae") for m in "abc"], "model_name STRING, primary_metric STRING")
    rows = registry.incumbent_metrics(state, log, primary).collect()
    assert [(r.model_name, r.incumbent_value) for r in rows] == [("a", 0.4)]


def cooldowns(spark, detector_ago=None, forecaster_ago=None, limits=(60, 120)):
    log = [(j, NOW - timedelta(minutes=m)) for j, m in (("detector_retrain", detector_ago), ("forecaster_retrain", forecaster_ago)) if m is not None]
    triggers = spark.createDataFrame(log, "job_name STRING, triggered_at TIMESTAMP")
    table = spark.createDataFrame([("detector_retrain", limits[0]), ("forecaster_retrain", limits[1])], "job_name STRING, cooldown_min INT")
    return registry.cooldown_state(triggers, table, F.lit(NOW))


def test_cooldown(spark):
    got = {r.job_name: r.in_cooldown for r in cooldowns(spark, 59, 120).collect()}
    assert got == {"detector_retrain": True, "forecaster_retrain": False}
    assert not any(r.in_cooldown for r in cooldowns(spark).collect())
    assert not any(r.in_cooldown for r in cooldowns(spark, 0, 0, limits=(0, 0)).collect())


def decide(spark, cool, skipped=False, any_drift=True, names=("order_rate",), psi=0.4, reason=None):
    summary = spark.createDataFrame(
        [("run-1", skipped, reason, any_drift, list(names), psi)],
        "run_id STRING, skipped BOOLEAN, reason STRING, any_drift BOOLEAN, drifted_features ARRAY<STRING>, max_psi DOUBLE",
    )
    return retrain.retrain_decision(summary, cool)


def test_retrain_decision(spark):
    free = cooldowns(spark)
    row = decide(spark, free).first()
    assert row.should_trigger and row.trigger_detector and row.trigger_forecaster
    assert row.reason == (
        "Drift detected on features ['order_rate'] (max PSI=0.4000 > threshold=0.25). Triggering: ['detector', 'forecaster']."
    )
    row = decide(spark, cooldowns(spark, 10)).first()
    assert row.should_trigger and not row.trigger_detector and row.trigger_forecaster
    row = decide(spark, cooldowns(spark, 10, 10)).first()
    assert not row.should_trigger and row.drifted_features == ["order_rate"] and row.reason.endswith("both jobs are in cooldown.")
    row = decide(spark, free, any_drift=False, names=(), psi=0.1).first()
    assert not row.should_trigger and row.max_psi == 0.1 and row.reason.startswith("No drift")
    row = decide(spark, free, skipped=True, reason="insufficient_current_data").first()
    assert not row.should_trigger and row.max_psi == 0.0 and row.reason == "drift_job skipped: insufficient_current_data"


def test_run_requests_and_pending(spark):
    decisions = decide(spark, cooldowns(spark, 10))
    (request,) = retrain.run_requests(decisions).collect()
    assert (request.run_key, request.drifted_features, request.max_psi) == ("forecaster_retrain_run-1", "order_rate", "0.4000")
    runs = spark.createDataFrame([("run-1",), ("run-2",)], "run_id STRING")
    assert [r.run_id for r in retrain.pending_runs(runs, runs.filter("run_id = 'run-1'")).collect()] == ["run-2"]


def test_latest_run_and_metric_rows(spark):
    log = spark.createDataFrame(
        [("e", "r1", "mae", 0.5, NOW), ("e", "r2", "rmse", 0.1, NOW + timedelta(1)), ("f", "r3", "f1", 0.9, NOW)],
        "experiment STRING, run_id STRING, metric STRING, value DOUBLE, start_time TIMESTAMP",
    )
    got = {(r.experiment, r.run_id, r.metric) for r in registry.latest_run_metrics(log).collect()}
    assert got == {("e", "r2", "rmse"), ("f", "r3", "f1")}
    wide = spark.createDataFrame([(0.5, 7)], "f1 DOUBLE, n INT")
    rows = registry.run_metric_rows(wide, "exp", "run", F.lit(NOW)).collect()
    assert {(r.metric, r.value) for r in rows} == {("f1", 0.5), ("n", 7.0)}
