from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stocktide.config import DriftSpec
from stocktide.operators import drift
from stocktide.storage import shared_dir
from stocktide.streaming import loop

NOW = datetime(2024, 5, 1, 12, 0, 0)
LIMITS = [("detector_retrain", 60), ("forecaster_retrain", 120)]


@pytest.fixture
def state(spark, request):
    return loop.LoopState(spark, f"{shared_dir(spark)}/loop-{request.node.name}")


def summary(spark):
    row = [("r1", False, None, True, ["order_rate"], 0.4)]
    return spark.createDataFrame(row, "run_id STRING, skipped BOOLEAN, reason STRING, any_drift BOOLEAN, drifted_features ARRAY<STRING>, max_psi DOUBLE")


def started(spark, state, name, minutes):
    limits = spark.createDataFrame(LIMITS, "job_name STRING, cooldown_min INT")
    at = F.lit(NOW + timedelta(minutes=minutes)).cast("timestamp")
    return sorted(r["job_name"] for r in loop.retrain_pass(state, summary(spark), limits, name, at).collect())


def test_cooldown_refuses_the_next_pass(spark, state):
    both = ["detector_retrain", "forecaster_retrain"]
    assert started(spark, state, "a", 0) == both
    assert started(spark, state, "a", 0) == both  # a retry of the pass
    assert started(spark, state, "b", 30) == []
    assert started(spark, state, "c", 90) == ["detector_retrain"]
    state.clear_cooldown("detector_retrain", "x", F.lit(NOW + timedelta(minutes=95)).cast("timestamp"))
    assert started(spark, state, "d", 100) == ["detector_retrain"]
    assert state.triggers().count() == 2


def test_promotions_are_remembered(spark, state):
    assert state.production("detector") is None
    decide = lambda run: spark.createDataFrame([("detector", run, True)], "model_name STRING, run_id STRING, promote BOOLEAN")
    at = lambda m: F.lit(NOW + timedelta(minutes=m)).cast("timestamp")
    state.promote(decide("run1"), "p1", at(0))
    assert state.production("detector") == (1, "run1")
    state.promote(decide("run2"), "p2", at(5))
    assert state.production("detector", lambda v, run: f"models/{run}") == (2, "models/run2")
    stages = {(r["version"], r["stage"]) for r in state.events().collect()}
    assert stages == {(1, "Production"), (1, "Archived"), (2, "Production")}


def test_parameters_are_remembered(spark, state):
    for _ in range(2):
        state.record_parameters("detector", "run1", {"trees": 100, "contamination": 0.05})
    assert {tuple(r) for r in state.parameters().collect()} == {("detector", "trees", "100", "run1"), ("detector", "contamination", "0.05", "run1")}


def test_drift_run_falls_back_and_skips(spark):
    stamp = lambda i: NOW + timedelta(hours=i)
    rows = [(f"S{i}", "A", stamp(i), stamp(i + 1), float(i % 7), 0.5 * i, 1.0, i, stamp(i)) for i in range(60)]
    schema = "store_id STRING, sku_id STRING, window_start TIMESTAMP, window_end TIMESTAMP, order_rate DOUBLE, depletion_vel DOUBLE, demand_momentum DOUBLE, on_hand_est INT, updated_at TIMESTAMP"
    df = spark.createDataFrame(rows, schema)
    metrics, summary = drift.drift_run(df, DriftSpec(current_s=0, reference_s=1))
    got = summary.first()
    assert (got["n_current"], got["n_reference"], got["skipped"]) == (12, 48, False) and metrics.count() == 4
    metrics, summary = drift.drift_run(df.limit(6), DriftSpec())
    got = summary.first()
    assert got["skipped"] and got["reason"] == "insufficient_reference_data" and metrics.count() == 0 and not got["any_drift"]
