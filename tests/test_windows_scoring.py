from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stocktide.config import WindowSpec
from stocktide.operators import scoring, windows

T0 = datetime(2024, 5, 1, 12, 0, 0)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


@pytest.fixture(scope="module")
def orders(spark):
    rows = [
        ("e1", "DS_1", "A", at(5), 2, 1.0), ("e2", "DS_1", "A", at(50), 1, 1.0), ("e3", "DS_1", "A", at(65), 3, 1.0),
        ("e4", "DS_1", "A", at(290), 1, 1.0), ("e5", "DS_1", "B", at(10), 1, 1.0), ("e6", "DS_1", "A", at(300), 1, 1.0),
    ]
    return spark.createDataFrame(
        rows, "event_id STRING, store_id STRING, sku_id STRING, event_time TIMESTAMP, quantity INT, unit_price DOUBLE"
    )


@pytest.fixture(scope="module")
def inventory(spark):
    rows = [
        ("i1", "DS_1", "A", at(6), "sale", -2, 48), ("i2", "DS_1", "A", at(51), "sale", -1, 47),
        ("i0", "DS_1", "A", at(51), "restock", 10, 99), ("i3", "DS_1", "A", at(130), "adjustment", -5, 30),
    ]
    return spark.createDataFrame(
        rows,
        "event_id STRING, store_id STRING, sku_id STRING, event_time TIMESTAMP, movement_type STRING, "
        "delta_units INT, on_hand_after INT",
    )


def test_tumbling(orders, inventory):
    got = {(r.sku_id, r.window_start): r for r in windows.tumbling_orders(orders).collect()}
    first = got["A", T0]
    assert (first.order_count, first.total_units, first.short_rate, first.avg_basket_size) == (2, 3, 2.0, 1.5)
    assert first.window_end == at(60) and len(got) == 5
    stock = {r.window_start: r for r in windows.tumbling_inventory(inventory).collect()}
    # Equal stamps are ordered by id, so i2 is the last movement of the first minute.
    assert (stock[T0].depletion_units, stock[T0].restock_units, stock[T0].on_hand_latest) == (3, 10, 47)
    assert stock[at(120)].depletion_units == 5


def test_sliding_rate_counts_five_minutes(orders):
    got = {r.window_end: r.long_rate for r in windows.sliding_orders(orders).collect() if r.sku_id == "A"}
    assert got[at(60)] == 2 / 5 and got[at(300)] == 4 / 5 and got[at(360)] == 3 / 5


@pytest.mark.parametrize("chunk_s", [300, 600, 86400])
def test_assembly_joins_and_carries_levels(orders, inventory, chunk_s):
    spec = WindowSpec(chunk_s=chunk_s)
    got = {(r.sku_id, r.window_start): r for r in windows.feature_assembly(orders, inventory, spec).collect()}
    assert len(got) == 5
    a0, a1, a4, a5, b0 = got["A", T0], got["A", at(60)], got["A", at(240)], got["A", at(300)], got["B", T0]
    assert (a0.on_hand, a0.on_hand_source, a0.depletion_units, a0.long_rate) == (47, "window", 3, 0.4)
    assert (a1.on_hand, a1.on_hand_source, a1.long_rate) == (47, "carried", 0.6)
    assert (a4.on_hand, a4.on_hand_source, a4.long_rate) == (30, "carried", 0.8)
    assert (a5.on_hand, a5.long_rate) == (30, 0.6)  # reaches back over a chunk border when chunk_s is 300
    assert (b0.on_hand, b0.on_hand_source) == (None, "none")


def test_stub_mode(orders, inventory):
    rows = windows.feature_rows(windows.feature_assembly(orders, inventory, mode="stub"), F.lit(T0)).collect()
    assert all(r.depletion_vel == 0 and r.on_hand_est == 0 and r.demand_momentum == r.order_rate for r in rows)


def assembled(spark, short, long, depletion=3, on_hand=80):
    return spark.createDataFrame(
        [("DS_1", "A", T0, at(60), depletion, on_hand, short, long)],
        "store_id STRING, sku_id STRING, window_start TIMESTAMP, window_end TIMESTAMP, depletion_units INT, on_hand INT, "
        "short_rate DOUBLE, long_rate DOUBLE",
    )


def test_feature_row(spark):
    row = windows.feature_rows(assembled(spark, 10.0, 2.0), F.lit(T0)).first()
    assert (row.order_rate, row.depletion_vel, row.demand_momentum, row.on_hand_est) == (10.0, 3.0, 5.0, 80)
    assert windows.feature_rows(assembled(spark, 1.0, 0.0)).first().demand_momentum == 100.0
    # Half-even: 5 / 32 has a tie at the fourth decimal.
    assert windows.feature_rows(assembled(spark, 5.0, 32.0)).first().demand_momentum == 0.1562


def feature(spark, on_hand, momentum, sku="A"):
    return spark.createDataFrame(
        [("DS_1", sku, T0, at(60), 1.0, 1.0, momentum, on_hand)],
        "store_id STRING, sku_id STRING, window_start TIMESTAMP, window_end TIMESTAMP, order_rate DOUBLE, "
        "depletion_vel DOUBLE, demand_momentum DOUBLE, on_hand_est INT",
    )


@pytest.fixture(scope="module")
def dim_sku(spark):
    return spark.createDataFrame([("A", 40)], "sku_id STRING, reorder_point INT")


def test_rules(spark, dim_sku):
    def alerts(on_hand, momentum, sku="A"):
        return scoring.score_rules(feature(spark, on_hand, momentum, sku), dim_sku).orderBy("alert_seq").collect()

    assert alerts(100, 1.0) == []
    (low,) = alerts(40, 1.0)
    assert (low.alert_type, low.metric_value, low.threshold, low.resolved) == ("stockout_risk", 40.0, 40.0, False)
    (surge,) = alerts(100, 2.5)
    assert (surge.alert_type, surge.metric_value, surge.threshold) == ("surge", 2.5, 2.5)
    both = alerts(1, 9.0)
    assert [a.alert_type for a in both] == ["stockout_risk", "surge"]
    assert both[0].alert_id != both[1].alert_id
    # Unknown product: default reorder point 20.
    assert alerts(21, 1.0, "Z") == [] and alerts(20, 1.0, "Z")[0].threshold == 20.0


def test_unobserved_level_raises_no_stockout(spark, dim_sku):
    rows = feature(spark, 0, 1.0).withColumn("on_hand_source", F.lit("none"))
    assert scoring.score_rules(rows, dim_sku).count() == 0


def test_model_gate(spark, dim_sku):
    def alerts(prediction, on_hand, momentum):
        rows = feature(spark, on_hand, momentum).withColumn("prediction", F.lit(prediction))
        return [a.alert_type for a in scoring.score_with_model(rows, dim_sku).orderBy("alert_seq").collect()]

    assert alerts(1, 0, 9.0) == []
    assert alerts(-1, 0, 9.0) == ["surge", "stockout_risk"]
    assert alerts(-1, 100, 1.0) == []


def test_offline_type_uses_the_lower_cut(spark):
    rows = feature(spark, 5, 2.0).unionByName(feature(spark, 5, 1.9)).withColumn("prediction", F.lit(-1))
    assert sorted(r.alert_type for r in scoring.offline_alerts(rows).collect()) == ["stockout_risk", "surge"]


def test_state_resolve_and_routing(spark, dim_sku):
    alerts = scoring.score_rules(
        feature(spark, 10, 9.0), dim_sku, triggered_at=F.col("window_end"), alert_id=scoring.stable_alert_id()
    )
    later = scoring.score_rules(
        feature(spark, 12, 3.0).withColumn("window_start", F.lit(at(60))), dim_sku,
        triggered_at=F.lit(at(120)), alert_id=scoring.stable_alert_id(),
    )
    state = scoring.current_alerts(alerts.unionByName(later))
    got = {r.alert_type: r for r in state.collect()}
    assert got["stockout_risk"].metric_value == 12.0 and got["surge"].metric_value == 3.0 and len(got) == 2
    resolved = {r.alert_type: r.resolved for r in scoring.auto_resolve(state, feature(spark, 41, 2.6), dim_sku).collect()}
    assert resolved == {"stockout_risk": True, "surge": False}
    routed = {r.topic for r in scoring.route_alerts(alerts).collect()}
    assert routed == {"stockout-alerts", "surge-alerts"}


def test_late_rows_are_marked(spark):
    spec = WindowSpec(short_s=60, long_s=300, watermark_s=5)
    rows = [("DS_1", "A", at(10), at(10)), ("DS_1", "A", at(200), at(200)), ("DS_1", "A", at(100), at(260)), ("DS_1", "A", at(190), at(261))]
    df = spark.createDataFrame(rows, "store_id STRING, sku_id STRING, event_time TIMESTAMP, arrived TIMESTAMP")
    got = {r.event_time: r.is_late for r in windows.late_data_split(df, spec, "arrived").collect()}
    assert got == {at(10): False, at(200): False, at(100): True, at(190): False}


def test_panes_hash_the_events_and_take_the_last_movement(spark, orders, inventory, monkeypatch):
    built = []

    def keep(df):
        built.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(windows, "staged", keep)
    keyless = inventory.limit(1).select(F.lit(None).cast("string").alias("store_id"), *[c for c in inventory.columns if c != "store_id"])
    moves = inventory.unionByName(keyless)
    rows = {(r.store_id, r.window_start): r for r in windows.panes(windows.merged_events(orders, moves)).collect() if r.sku_id == "A"}
    # the aggregation over all events must not sort them: its memory would grow with a task's rows
    assert "HashAggregate" in built[0] and "SortAggregate" not in built[0]
    # equal stamps are ordered by id; a pane without a movement has no level; NULL keys are a group like any other
    assert rows["DS_1", T0].on_hand_latest == 47 and rows["DS_1", at(120)].on_hand_latest == 30
    assert rows["DS_1", at(60)].on_hand_latest is None and rows[None, T0].on_hand_latest is not None
