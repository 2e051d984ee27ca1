import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from stocktide.operators import validation

NOW = datetime(2024, 5, 1, 12, 0, 0)


def order(**changes):
    event = {
        "event_id": "o#7f", "event_time": "2024-05-01T11:58:12Z", "store_id": "DS_001", "sku_id": "SKU_001",
        "category": "garden hoses", "quantity": 5, "unit_price": 13.49, "order_id": "basket-88",
    } | changes
    return json.dumps({k: v for k, v in event.items() if v != "DROP"})


def move(**changes):
    event = {
        "event_id": "m#3c", "event_time": "2024-05-01T11:58:12Z", "store_id": "DS_001", "sku_id": "SKU_001",
        "movement_type": "sale", "delta_units": -3, "on_hand_after": 91,
    } | changes
    return json.dumps({k: v for k, v in event.items() if v != "DROP"})


@pytest.fixture(scope="module")
def dims(spark):
    stores = spark.createDataFrame([("DS_001",), ("DS_002",)], "store_id STRING")
    skus = spark.createDataFrame([("SKU_001",), ("SKU_002",), ("SKU_003",)], "sku_id STRING")
    return stores, skus


def reasons(spark, dims, kind, texts):
    raw = spark.createDataFrame(list(enumerate(texts)), "i INT, value STRING")
    out = validation.validate(validation.parse_events(raw, kind), kind, *dims, now=F.lit(NOW))
    return [r.reason for r in out.orderBy("i").collect()]


def test_order_rules(spark, dims):
    cases = [
        (order(), None),
        (order(quantity="DROP"), "missing fields: quantity"),
        (order(quantity="DROP", category="DROP"), "missing fields: category, quantity"),
        (order(quantity=0), "quantity must be > 0, got 0"),
        (order(unit_price=-5), "unit_price must be >= 0, got -5"),
        (order(store_id="DS_999"), "unknown store_id: DS_999"),
        (order(sku_id="SKU_999"), "unknown sku_id: SKU_999"),
        (order(event_time="2024-05-01T12:05:00Z"), "event_time too far in future: 2024-05-01 12:05:00.000000+00:00"),
        (order(event_time="2024-05-01T12:00:59Z"), None),
        (order(event_time="not-a-date"), "unparseable event_time: not-a-date"),
        (order(event_time="2024-05-01T17:00:00+05:30"), None),
        (order(event_time="2024-05-01 11:00:00"), None),
        (order(event_time=""), "unparseable event_time: "),
        (order(quantity=None), "invalid type: quantity"),
        (order(quantity="2"), "invalid type: quantity"),
        (order(store_id=None), "unknown store_id: None"),
        (order(is_injected_anomaly=True), None),
        (order(quantity=3_000_000_000), "invalid type: quantity"),
        (order().replace('"quantity": 5', '"quantity": 1e400'), "invalid type: quantity"),
        (order(quantity=float("nan")), "invalid type: quantity"),
        (order(quantity="NaN"), "invalid type: quantity"),
        (order(quantity=0.4), "quantity must be > 0, got 0.4"),
        (order(unit_price=float("inf")), "invalid type: unit_price"),
    ]
    assert reasons(spark, dims, "orders", [c[0] for c in cases]) == [c[1] for c in cases]


def test_inventory_rules(spark, dims):
    cases = [
        (move(), None),
        (move(on_hand_after=-1), "on_hand_after must be >= 0, got -1"),
        (move(movement_type="steal"), "unknown movement_type: steal"),
        (move(movement_type=None), "unknown movement_type: None"),
        (move(store_id="DS_999"), "unknown store_id: DS_999"),
        (move(delta_units="DROP"), "missing fields: delta_units"),
        (move(movement_type="restock", delta_units=40), None),
        (move(delta_units=-3_000_000_000), "invalid type: delta_units"),
        (move(on_hand_after=float("nan")), "invalid type: on_hand_after"),
    ]
    assert reasons(spark, dims, "inventory", [c[0] for c in cases]) == [c[1] for c in cases]


def test_only_whole_objects_parse(spark, dims):
    broken = ['{"a": 1', "[1, 2]", "5", "null", "", order() + " trailing", order() + order(), order() + "," + order(), None]
    broken += [order() + "] junk", order() + "],[1", order() + "],{}", order() + "} junk", order() + '],{"a":[1]}']
    assert reasons(spark, dims, "orders", broken) == [validation.PARSE_ERROR] * len(broken)
    assert reasons(spark, dims, "orders", [order(category="a ] b"), " " + order(note=[1, {"x": "}]"}]) + " "]) == [None, None]


def test_first_failing_rule_wins(spark, dims):
    text = order(quantity=0, unit_price=-1, store_id="DS_999", event_time="x")
    assert reasons(spark, dims, "orders", [text]) == ["quantity must be > 0, got 0"]


def test_dead_letter_envelope_keeps_the_text(spark, dims):
    texts = [order(quantity=0), "{oops", order()]
    raw = spark.createDataFrame([(t,) for t in texts], "value STRING")
    checked = validation.validate(validation.parse_events(raw, "orders"), "orders", *dims, now=F.lit(NOW))
    rows = validation.dead_letters(checked, "raw-orders", F.lit(NOW)).collect()
    assert {r.original_event for r in rows} == set(texts[:2])
    assert all(r.source_topic == "raw-orders" and r.failed_at == NOW and r.reason for r in rows)
    message = validation.as_message(validation.dead_letters(checked, "raw-orders")).first().value
    assert set(json.loads(message)) == {"source_topic", "reason", "failed_at", "original_event"}


def test_projection_types(spark, dims):
    raw = spark.createDataFrame([(order(quantity=2.9),)], "value STRING")
    checked = validation.validate(validation.parse_events(raw, "orders"), "orders", *dims, now=F.lit(NOW))
    row = validation.project_orders(validation.valid_events(checked)).first()
    stamp = datetime(2024, 5, 1, 11, 58, 12, tzinfo=timezone.utc)
    assert (row.quantity, row.unit_price, row.is_injected_anomaly) == (2, 13.49, False)
    assert row.event_ms == int(stamp.timestamp() * 1000)


def test_salted_and_broadcast_lookups_agree(spark):
    from stocktide.operators.joins import lookup_join

    facts = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), "id")
    table = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small = lookup_join(facts, table, ["k"], ["id"])
    key = lambda r: (r.id, r.k, r.v)
    want = sorted(map(key, small.collect()))
    for hot_rows, salted in ((10**6, True), (100, True), (3, True)):
        large = lookup_join(facts, table, ["k"], ["id"], broadcast_rows=5, hot_rows=hot_rows)
        assert ("_salt" in large._jdf.queryExecution().optimizedPlan().toString()) == salted
        assert sorted(map(key, large.collect())) == want


def test_hot_keys_get_tasks_by_size(spark):
    from stocktide.operators.joins import hot_keys

    df = spark.range(1000).select(F.when(F.col("id") < 700, 1).otherwise(F.col("id")).alias("k"))
    assert [tuple(r) for r in hot_keys(df, ["k"], 100).collect()] == [(1, 7)]


def test_rows_without_a_key_are_spread(spark):
    from stocktide.operators.joins import lookup_join

    facts = spark.range(2000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 7).alias("k"), "id")
    table = spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(facts, table, ["k"], ["id"], broadcast_rows=5)
        parts = [r["n"] for r in joined.filter("k IS NULL").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(parts) == 1000 and max(parts) < 500
        assert joined.count() == 2000 and joined.filter("v <> 2 * k").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_wide_tables_are_not_broadcast(spark, monkeypatch):
    from stocktide.operators import joins

    table = spark.range(10).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("v"))
    assert joins._fits(table, 10) and not joins._fits(table, 9)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 5000)
    assert not joins._fits(table, 10)


def test_constraints_are_counted(spark):
    df = spark.createDataFrame(
        [("a", "surge", 1.0), ("a", "surge", None), ("b", "other", 2.0)], "k STRING, kind STRING, v DOUBLE"
    )
    got = {
        (r.rule, r.n)
        for r in validation.constraint_violations(df, "t", ["k", "v"], ["k"], {"kind": ["surge"]}).collect()
    }
    assert got == {("not_null:k", 0), ("not_null:v", 1), ("enum:kind", 1), ("primary_key:k", 1)}


def test_future_limit_is_exclusive(spark, dims):
    edge = (NOW + timedelta(seconds=60)).isoformat() + "Z"
    past = (NOW + timedelta(seconds=60, microseconds=1)).isoformat() + "Z"
    got = reasons(spark, dims, "orders", [order(event_time=edge), order(event_time=past)])
    assert got[0] is None and got[1].startswith("event_time too far in future")


def test_streams_salt_all_keys_alike(spark):
    from stocktide.operators.joins import salted_join

    stream = spark.readStream.format("rate").load().select((F.col("value") % 3).alias("k"), "value")
    table = spark.range(3).select(F.col("id").alias("k"), (F.col("id") + 10).alias("v"))
    joined = salted_join(stream, table, ["k"], ["value"])
    assert joined.isStreaming and joined.columns == ["k", "value", "v"]
