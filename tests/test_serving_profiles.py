import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from stocktide import schemas
from stocktide.functions import expr
from stocktide.operators import ledger, profiles, serving

NOW = datetime(2024, 5, 1, 12, 0, 0)


@pytest.fixture(scope="module")
def feats(spark):
    rows = []
    for k, (store, sku) in enumerate([("DS_1", "A"), ("DS_1", "B"), ("DS_2", "A")]):
        for i in range(20):
            end = NOW - timedelta(minutes=i)
            rows.append((store, sku, end - timedelta(minutes=1), end, float(k + i % 3), float(i), 1.0 + k, 10 * k + i, end))
    return spark.createDataFrame(rows, schemas.WINDOWED_FEATURES)


@pytest.fixture(scope="module")
def alerts(spark):
    rows = [
        ("DS_1", "A", "surge", "a1", NOW - timedelta(minutes=1), 4.0, 2.5, False),
        ("DS_2", "Z", "surge", "a2", NOW - timedelta(minutes=2), 9.0, 2.5, False),
        ("DS_2", "A", "surge", "a3", NOW - timedelta(minutes=30), 3.0, 2.5, True),
    ]
    return spark.createDataFrame(rows, schemas.ALERTS)


@pytest.mark.parametrize("lag,status,text", [
    (0, "healthy", "0s ago"), (59, "healthy", "59s ago"), (119, "healthy", "2.0m ago"), (120, "stale", "2.0m ago"), (300, "down", "5.0m ago"),
])
def test_freshness(feats, lag, status, text):
    row = serving.freshness(feats, F.lit(NOW + timedelta(seconds=lag))).first()
    assert (row.latest, row.lag_s, row.status, row.lag_text) == (NOW, float(lag), status, text)


def test_freshness_without_rows(feats):
    row = serving.freshness(feats.limit(0), F.lit(NOW)).first()
    assert (row.lag_s, row.status, row.lag_text) == (None, "no_data", "—")
    assert serving.write_freshness(feats, F.lit(NOW + timedelta(seconds=7))).first().lag_s == 7.0


def test_alert_queries(feats, alerts):
    assert {tuple(r) for r in serving.active_alerts(alerts).collect()} == {("stockout_risk", 0), ("surge", 2)}
    top = serving.surge_alerts(alerts, feats).collect()
    assert [(r.store_id, r.sku_id, r.on_hand_est) for r in top] == [("DS_2", "Z", None), ("DS_1", "A", 0)]
    assert [r.triggered_at for r in serving.alert_log(alerts, 2).collect()] == [NOW - timedelta(minutes=1), NOW - timedelta(minutes=2)]


def test_tables(feats, alerts):
    risks = serving.stockout_risks(feats, 5, 3).collect()
    assert [r.on_hand_est for r in risks] == [5, 4, 3] and risks[0].label == "A / DS_1" and risks[0].stock_band == "low"
    speed = {(r.store_id, r.sku_id): r.avg_order_rate for r in serving.sku_velocity(feats, F.lit(NOW)).collect()}
    assert speed["DS_1", "A"] == round(sum(i % 3 for i in range(10)) / 10, 3)
    health = {r.store_id: r for r in serving.store_health(feats, alerts, F.lit(NOW)).collect()}
    assert (health["DS_1"].active_skus, health["DS_1"].recent_alerts, health["DS_2"].recent_alerts) == (2, 1, 1)
    latest = {r.store_id: r.avg_on_hand for r in serving.store_health(feats, alerts, F.lit(NOW), latest_only=True).collect()}
    assert latest == {"DS_1": 5.0, "DS_2": 20.0}
    velocity = serving.sku_velocity(feats, F.lit(NOW), limit=None)
    pivot = {r.sku_id: r for r in serving.velocity_pivot(velocity, ["DS_1", "DS_2"]).collect()}
    assert pivot["B"]["DS_2"] == 0.0 and pivot["A"]["DS_2"] > 0
    assert [r.sku_id for r in serving.top_skus(velocity, 1).collect()] == ["A"]


@pytest.mark.parametrize("chunk_s", [120, 10**6])
def test_threshold_rules(spark, chunk_s):
    values = [400, 400, 400, 100, 400, 100, 500, 500, 500, 500]
    log = spark.createDataFrame(
        [(NOW + timedelta(minutes=i), "feature_freshness_lag_seconds", "", float(v)) for i, v in enumerate(values)],
        "ts TIMESTAMP, metric STRING, label STRING, value DOUBLE",
    )
    got = serving.threshold_rules(log, chunk_s=chunk_s).orderBy("since").collect()
    at = lambda i: NOW + timedelta(minutes=i)
    assert [(r.rule, r.since, r.until, r.held_s) for r in got] == [
        ("FeatureStaleness", at(0), at(3), 180.0), ("FeatureStaleness", at(6), None, 180.0),
    ]


def test_bands(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.25,), (0.26,)], "v DOUBLE").select(expr.psi_band("v").alias("b"))
    assert [r.b for r in df.collect()] == ["stable", "moderate", "moderate", "significant"]
    df = spark.createDataFrame([(20,), (21,), (50,), (51,)], "v INT").select(expr.stock_band("v").alias("b"))
    assert [r.b for r in df.collect()] == ["low", "mid", "mid", "ok"]
    log = spark.createDataFrame([("mae", 0.5), ("mae", 0.4), ("f1", 0.7), ("f1", 0.1)], "metric STRING, value DOUBLE")
    assert [r.band for r in serving.metric_bands(log).collect()] == ["yellow", "green", "green", "red"]


def test_empty_and_time_to_empty(spark):
    df = spark.createDataFrame([(10, 0.0), (10, 4.0)], "h INT, v DOUBLE").select(expr.time_to_empty("h", "v").alias("t"))
    assert [r.t for r in df.collect()] == [None, 2.5]


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(11)
    rows, t = [], 0.0
    for i in range(900):
        t += rng.expovariate(1 / 120)
        sku = "S1" if rng.random() < 0.5 else f"S{rng.randrange(2, 40)}"
        rows.append((f"e{i:05d}", "DS_1" if rng.random() < 0.7 else "DS_2", sku, NOW + timedelta(microseconds=int(t * 1e6)), rng.randrange(1, 9)))
    return rows, spark.createDataFrame(rows, "event_id STRING, store_id STRING, sku_id STRING, event_time TIMESTAMP, quantity INT")


def test_popularity(events):
    rows, df = events
    counts = {}
    for r in rows:
        counts[r[2]] = counts.get(r[2], 0) + 1
    order = sorted(counts, key=lambda s: (-counts[s], s))
    got = profiles.sku_popularity(df).orderBy("rank").collect()
    assert [r.sku_id for r in got] == order and [r["rank"] for r in got] == list(range(1, len(order) + 1))
    assert got[-1].cum_share == pytest.approx(1.0) and got[0].share == counts[order[0]] / len(rows)


def test_slope_of_an_exact_power_law(spark):
    df = spark.createDataFrame([(i, i**-1.2) for i in range(1, 40)], "rank LONG, share DOUBLE")
    assert profiles.popularity_slope(df).first().slope == pytest.approx(-1.2)


def test_gaps(events):
    rows, df = events
    for r in profiles.interarrival_stats(df).collect():
        times = sorted((x[3], x[0]) for x in rows if x[1] == r.store_id)
        gaps = np.array([(b[0] - a[0]).total_seconds() for a, b in zip(times, times[1:])])
        assert r.n_gaps == len(gaps) and r.mean_gap_s == pytest.approx(gaps.mean())
        assert r.std_gap_s == pytest.approx(gaps.std(ddof=1))
        assert r.p95_gap_s == pytest.approx(np.sort(gaps)[math.ceil(len(gaps) * 0.95) - 1])


def test_demand_profile_counts_days(spark):
    rows = [(f"e{i}", datetime(2024, 5, 3, 10) + timedelta(days=d, minutes=i)) for d in range(4) for i in range(3 + d)]
    df = spark.createDataFrame(rows, "event_id STRING, event_time TIMESTAMP")
    got = {(r.hour_of_day, r.is_weekend): r for r in profiles.demand_profile(df).collect()}
    # Friday and Monday against Saturday and Sunday.
    assert got[10, False].orders_per_day == (3 + 6) / 2 and got[10, True].orders_per_day == (4 + 5) / 2
    assert got[10, True].weekend_uplift == pytest.approx(1.0)


def simulate(rows, initial, restock_to):
    level, out = {}, {}
    for event_id, store, sku, _, q in sorted(rows, key=lambda r: (r[3], r[0])):
        now = level.get((store, sku), initial)
        sold = now >= q
        level[store, sku] = now - q if sold else restock_to
        out[event_id] = (level[store, sku], sold)
    return out


@pytest.mark.parametrize("chunk_s,initial,restock_to,hot_rows", [
    (600, 100, 90, 0), (3600, 10, 25, 100), (10**7, 3, 5, 0), (600, 20, 15, 10**6),
])
def test_ledger_matches_simulation(events, chunk_s, initial, restock_to, hot_rows):
    rows, df = events
    got = ledger.ledger_replay(df, initial, restock_to, chunk_s, hot_rows).collect()
    assert {r.event_id: (r.level_after, r.sold) for r in got} == simulate(rows, initial, restock_to)
    assert len(got) == len(rows)


def test_exit_levels_of_every_entry():
    rng = np.random.default_rng(2)
    for _ in range(50):
        q = rng.integers(1, 12, rng.integers(0, 30))
        got = ledger.exit_levels(q, np.arange(21), 20)
        for entry in range(21):
            level = entry
            for x in q:
                level = level - x if level >= x else 20
            assert got[entry] == level


def test_latest_features_hash_the_history(spark):
    from stocktide import schemas
    from stocktide.operators import serving

    empty = spark.createDataFrame([], schemas.WINDOWED_FEATURES)
    plan = serving.latest_features(empty.repartition(2))._jdf.queryExecution().sparkPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
