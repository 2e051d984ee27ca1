import itertools
import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stocktide.config import DriftSpec
from stocktide.operators import drift

NOW = datetime(2024, 5, 2, 12, 0, 0)
SPEC = DriftSpec()


def numpy_psi(ref, cur, bins=10):
    edges = np.linspace(min(ref.min(), cur.min()), max(ref.max(), cur.max()), bins + 1)
    r, c = np.histogram(ref, edges)[0] / len(ref), np.histogram(cur, edges)[0] / len(cur)
    r, c = np.where(r == 0, 1e-4, r), np.where(c == 0, 1e-4, c)
    return round(abs(float(np.sum((c - r) * np.log(c / r)))), 6)


def numpy_js(ref, cur, bins=10):
    edges = np.linspace(min(ref.min(), cur.min()), max(ref.max(), cur.max()), bins + 1)
    p, q = np.histogram(ref, edges)[0] / len(ref), np.histogram(cur, edges)[0] / len(cur)
    m = (p + q) / 2
    kl = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m) if x > 0)
    return round(min(abs(0.5 * kl(p) + 0.5 * kl(q)), 1.0), 6)


def numpy_ks(ref, cur):
    grid = np.unique(np.concatenate([ref, cur]))
    f = np.searchsorted(np.sort(ref), grid, side="right") / len(ref)
    g = np.searchsorted(np.sort(cur), grid, side="right") / len(cur)
    return float(np.abs(f - g).max())


def split_frame(spark, ref, cur):
    """One monitored feature on both sides; the others are absent."""
    rows = [("reference", float(v)) for v in ref] + [("current", float(v)) for v in cur]
    return spark.createDataFrame(rows, "side STRING, order_rate DOUBLE").withColumn("window_end", F.lit(NOW))


def metrics(spark, ref, cur, method="asymptotic"):
    rows = drift.drift_metrics(split_frame(spark, ref, cur), SPEC, method).collect()
    return rows[0] if rows else None


@pytest.mark.parametrize("shift,scale,n", [(0, 1, 300), (0.5, 1, 120), (5, 1, 60), (0, 4, 200)])
def test_metrics_match_numpy(spark, shift, scale, n):
    rng = np.random.default_rng(int(shift * 10 + scale))
    ref, cur = np.round(rng.normal(0, 1, 400), 3), np.round(rng.normal(shift, scale, n), 3)
    m = metrics(spark, ref, cur)
    assert m.psi == pytest.approx(numpy_psi(ref, cur), abs=2e-6)
    assert m.js_div == pytest.approx(numpy_js(ref, cur), abs=2e-6)
    assert m.ks_stat == pytest.approx(numpy_ks(ref, cur), abs=1e-6)
    assert m.drifted == float(m.psi > 0.25) and 0 <= m.js_div <= 1 and 0 <= m.ks_pval <= 1


def test_identical_and_constant(spark):
    same = np.arange(50.0)
    m = metrics(spark, same, same, "exact")
    assert (m.psi, m.js_div, m.ks_stat, m.ks_pval, m.drifted) == (0, 0, 0, 1, 0)
    m = metrics(spark, np.full(20, 3.0), np.full(10, 3.0))
    assert (m.psi, m.js_div, m.ks_stat, m.drifted) == (0, 0, 0, 0)


def test_too_few_values_have_no_row(spark):
    assert metrics(spark, np.arange(100.0), np.arange(4.0)) is None


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=5, max_size=40), st.lists(st.integers(-50, 50), min_size=5, max_size=40))
def test_bounds(spark, ref, cur):
    ref, cur = np.array(ref, float), np.array(cur, float)
    m = metrics(spark, ref, cur)
    assert m.psi >= 0 and 0 <= m.js_div <= 1 and 0 <= m.ks_stat <= 1
    assert m.ks_stat == pytest.approx(numpy_ks(ref, cur), abs=1e-6)


def exact_by_enumeration(n1, n2, d):
    hits = total = 0
    for taken in itertools.combinations(range(n1 + n2), n1):
        chosen, i, worst = set(taken), 0, 0.0
        for k in range(n1 + n2):
            i += k in chosen
            worst = max(worst, abs(i / n1 - (k + 1 - i) / n2))
        total += 1
        hits += worst >= d - 1e-12
    return hits / total


@pytest.mark.parametrize("n1,n2", [(3, 4), (5, 5), (2, 7), (6, 4)])
def test_exact_pvalue_matches_enumeration(n1, n2):
    values = {abs(i / n1 - j / n2) for i in range(n1 + 1) for j in range(n2 + 1)}
    for d in sorted(values):
        if d > 0:
            assert drift.exact_ks_pvalue(d, n1, n2) == pytest.approx(exact_by_enumeration(n1, n2, d), abs=1e-12)


def test_exact_pvalue_stays_inside_the_band(monkeypatch):
    cells, plain = [], np.arange
    monkeypatch.setattr(drift.np, "arange", lambda *a: cells.append(len(plain(*a))) or plain(*a))
    assert 0.1 < drift.exact_ks_pvalue(0.03, 3000, 3000) < 0.2
    assert len(cells) == 6000 and max(cells) <= 92  # of 3001
    assert drift.exact_ks_pvalue(0.5, 10**6, 10**6 - 1) == 0.0


def test_exact_and_asymptotic_agree_for_large_samples(spark):
    for d in (0.02, 0.04, 0.06):
        df = spark.range(1).select(drift.kolmogorov_pvalue(F.lit(d), F.lit(3000), F.lit(3000)).alias("p"))
        assert df.first().p == pytest.approx(drift.exact_ks_pvalue(d, 3000, 3000), abs=0.01)


def feature_frame(spark, rows):
    pdf = pd.DataFrame(rows, columns=["window_end", "order_rate"])
    pdf["store_id"] = [f"DS_{i % 3}" for i in range(len(pdf))]
    pdf["sku_id"] = [f"S{i}" for i in range(len(pdf))]
    pdf["depletion_vel"], pdf["demand_momentum"], pdf["on_hand_est"] = 1.0, 1.0, 50
    pdf["window_start"] = pdf["window_end"] - timedelta(minutes=1)
    return spark.createDataFrame(pdf)


def sampled(rng, hours, n, mean, sd):
    return [(NOW - timedelta(hours=float(h)), round(float(v), 4)) for h, v in zip(hours(n), rng.normal(mean, sd, n))]


def test_time_split_is_disjoint_and_bounded(spark):
    rows = [(NOW - timedelta(hours=h), 1.0) for h in (0, 0.5, 1, 1.01, 20, 25, 25.01, 60)]
    got = drift.time_split(feature_frame(spark, rows), SPEC, F.lit(NOW))
    sides = sorted((round((NOW - r.window_end).total_seconds() / 3600, 2), r.side) for r in got.collect())
    assert sides == [
        (0.0, "current"), (0.5, "current"), (1.0, "current"), (1.01, "reference"), (20.0, "reference"), (25.0, "reference"),
    ]


def test_stable_and_drifted_runs(spark):
    rng = np.random.default_rng(42)
    old = lambda n: rng.uniform(1.1, 24, n)
    new = lambda n: rng.uniform(0, 0.9, n)
    stable = feature_frame(spark, sampled(rng, old, 400, 2.0, 0.3) + sampled(rng, new, 300, 2.0, 0.3))
    moved = feature_frame(spark, sampled(rng, old, 160, 2.0, 0.2) + sampled(rng, new, 40, 8.0, 0.5))
    for frame, expected in ((stable, False), (moved, True)):
        split = drift.drift_sides(frame, SPEC, F.lit(NOW))
        run = drift.drift_summary(split, drift.drift_metrics(split, SPEC), SPEC).first()
        assert (run.skipped, run.any_drift) == (False, expected)
        assert run.drifted_features == (["order_rate"] if expected else [])
        assert run.n_features_drifted == len(run.drifted_features)


def test_share_split_replaces_a_thin_time_split(spark):
    rows = [(NOW - timedelta(seconds=10 * i), float(i)) for i in range(100)]  # all within the current hour
    got = drift.drift_sides(feature_frame(spark, rows), SPEC, F.lit(NOW))
    counts = drift.side_counts(got).first()
    assert (counts.n_current, counts.n_reference) == (20, 80)
    oldest = got.filter("side = 'current'").agg(F.min("window_end")).first()[0]
    assert oldest == NOW - timedelta(seconds=190)


@pytest.mark.parametrize("n,reason", [(11, "insufficient_reference_data"), (12, "insufficient_reference_data"), (20, "insufficient_current_data")])
def test_skips_when_there_is_too_little(spark, n, reason):
    rows = [(NOW - timedelta(seconds=i), float(i)) for i in range(n)]
    split = drift.drift_sides(feature_frame(spark, rows), SPEC, F.lit(NOW))
    run = drift.drift_summary(split, drift.drift_metrics(split, SPEC), SPEC).first()
    assert run.skipped and run.reason == reason and not run.any_drift and run.drifted_features == []


def test_long_form_names(spark):
    rng = np.random.default_rng(1)
    split = split_frame(spark, rng.normal(0, 1, 50), rng.normal(3, 1, 50))
    m = drift.drift_metrics(split, SPEC)
    names = {r.metric for r in drift.metrics_long(m, drift.drift_summary(split, m, SPEC)).collect()}
    assert {"order_rate_psi", "order_rate_ks_stat", "order_rate_drifted", "n_current_rows", "n_features_drifted"} <= names
