import json
import time
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktide import schemas
from stocktide.config import BoostSpec, ForestSpec, WindowSpec
from stocktide.operators import forecast, iforest, validation, windows
from stocktide.sources import streams, tables
from stocktide.storage import listed, shared_dir
from stocktide.streaming import ledger as stream_ledger
from stocktide.streaming import pipeline, sinks

NOW = datetime(2024, 5, 1, 12, 0, 0)


@pytest.fixture(scope="module")
def folder(spark):
    return f"{shared_dir(spark)}/test-{time.time_ns()}"


def feature_rows(n=300, seed=0):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({
        "store_id": [f"DS_{i % 2}" for i in range(n)],
        "sku_id": [f"S{i % 5}" for i in range(n)],
        "window_start": [NOW + timedelta(minutes=i) for i in range(n)],
    })
    for c in schemas.ANOMALY_COLUMNS:
        pdf[c] = rng.normal(10, 1, n)
    pdf["on_hand_est"] = pdf["on_hand_est"].round().astype(int)
    return pdf


def test_average_path_values():
    assert [float(iforest.average_path(n)) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert float(iforest.average_path(256)) == pytest.approx(2 * (np.log(255) + 0.5772156649) - 2 * 255 / 256)


def test_forest_finds_outliers(spark, folder):
    pdf = feature_rows()
    far = pdf.tail(6).index
    pdf.loc[far, ["order_rate", "demand_momentum"]] += 15
    df = spark.createDataFrame(pdf)
    spec = ForestSpec(trees=30, max_samples=64, contamination=0.05)
    forest = iforest.Forest.fit(df, spec)
    got = forest.predict(df).toPandas().sort_values("anomaly_score", ascending=False)
    assert (got["prediction"] == -1).mean() == pytest.approx(0.05, abs=0.01)
    flagged = set(got.loc[got["prediction"] == -1, "window_start"])
    assert len(flagged & set(pdf.loc[far, "window_start"])) >= 5
    assert got["anomaly_score"].between(0, 1).all()
    nodes = forest.nodes
    assert nodes["tree"].nunique() == 30 and (nodes[nodes.node == 0]["size"] == 64).all()
    assert nodes["depth"].max() <= 6
    inner = nodes[nodes.feature >= 0]
    sizes = nodes.set_index(["tree", "node"])["size"]
    assert all(sizes[t, a] + sizes[t, b] == n for t, a, b, n in zip(inner.tree, inner.left, inner.right, inner["size"]))
    again = iforest.Forest.fit(df, spec)
    assert again.cut == forest.cut
    forest.save(spark, f"{folder}/forest")
    loaded = iforest.Forest.load(spark, f"{folder}/forest")
    assert loaded.cut == forest.cut and loaded.predict(df).filter("prediction = -1").count() == (got["prediction"] == -1).sum()


def test_trees_draw_from_all_rows(spark):
    spec = ForestSpec(trees=8, max_samples=16)
    rows = spark.range(5000).withColumn("v", F.rand(1))
    got = iforest.tree_draws(rows, spec, ["id"], 4 * 16 / 5000)
    assert got.count() < 3 * 8 * 4 * 16
    u = {r["id"]: r["u"] for r in rows.select("id", iforest._unit_hash(spec.seed, ["id"]).alias("u")).collect()}
    for tree in range(spec.trees):
        draws = sorted(((u[i] * 8 + tree) % 8 / 8, i) for i in u)[:16]
        mine = sorted((r["_draw"], r["id"]) for r in got.filter(F.col("tree") == tree).collect())[:16]
        assert [i for _, i in mine] == [i for _, i in draws]
    every = iforest.tree_draws(rows.limit(40), spec, ["id"], 99.0)
    assert every.groupBy("id").agg(F.countDistinct("tree").alias("n")).filter("n = 8").count() == 40


def test_bad_dimension_files_fail_when_pruned(spark, folder):
    spark.createDataFrame([("DS_1", "r", -5)], "store_id STRING, region STRING, capacity INT").write.option("header", True).csv(f"{folder}/bad_store")
    stores = tables.dim_store(spark, f"{folder}/bad_store")
    for action in (lambda: stores.select("store_id").collect(), stores.count):
        with pytest.raises(Exception, match="capacity"):
            action()


def test_flagged_rows_are_not_trained_on(spark):
    pdf = feature_rows()
    pdf["is_injected_anomaly"] = pdf.index < 20
    pdf.loc[pdf.index < 20, "order_rate"] = 1e6
    nodes = iforest.fit_forest(spark.createDataFrame(pdf), ForestSpec(trees=5, max_samples=512)).toPandas()
    assert (nodes[nodes.node == 0]["size"] == 280).all() and nodes["split"].max() < 1e5


def test_forecaster_learns(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({c: rng.uniform(0, 1, 400) for c in forecast.INPUTS})
    pdf["order_rate"] = 3 * pdf["order_rate_lag1"] + pdf["is_weekend"]
    pdf["is_train"] = pdf.index < 320
    df = spark.createDataFrame(pdf)
    model = forecast.fit_forecaster(df.filter("is_train"), BoostSpec(rounds=15, learning_rate=0.3))
    quality = forecast.evaluate(model, df).first()
    assert quality.mae < 0.25 < pdf["order_rate"].std()
    top = forecast.importances(model, spark).orderBy(F.desc("importance")).first()
    assert top.input == "order_rate_lag1"


def feature_frame(spark, rows):
    return spark.createDataFrame(rows, schemas.WINDOWED_FEATURES)


def frow(sku, minute, rate, updated):
    start = NOW + timedelta(minutes=minute)
    return ("DS_1", sku, start, start + timedelta(minutes=1), rate, 0.0, 1.0, 5, NOW + timedelta(hours=updated))


def test_upsert_table(spark, folder):
    table = pipeline.StreamTables(spark, f"{folder}/upsert").features
    assert table.read().count() == 0
    table.upsert(feature_frame(spark, [frow("A", 0, 1.0, 0), frow("A", 0, 2.0, 1), frow("B", 0, 3.0, 0)]), 0, "q")
    later = feature_frame(spark, [frow("A", 0, 9.0, 2), frow("A", 1, 4.0, 2)])
    for _ in range(2):  # the second write is a retry
        table.upsert(later, 1, "q")
    want = {("A", NOW, 9.0), ("B", NOW, 3.0), ("A", NOW + timedelta(minutes=1), 4.0)}
    current = lambda t: {(r.sku_id, r.window_start, r.order_rate) for r in t.read().collect()}
    assert current(table) == want
    assert {r.order_rate for r in table.read(without=("q", 1)).collect()} == {2.0, 3.0}
    assert table.read().count() == 3


def test_upserts_read_as_much_after_many_batches(spark, folder):
    """Fifty batches of two keys: no more files to read than before, one row per key, retries of the last batch included."""
    table = pipeline.StreamTables(spark, f"{folder}/many").alerts
    levels = pipeline.StreamTables(spark, f"{folder}/many").levels
    rows = lambda i: spark.createDataFrame(
        [("DS_1", s, NOW + timedelta(minutes=i), i) for s in "AB"], levels.schema
    )
    sizes, folders = [], []
    for i in range(50):
        levels.upsert(rows(i), i, "q")
        if i % 10 == 9:
            levels.upsert(rows(i), i, "q")
            sizes.append(len(levels.read().inputFiles()))
            folders.append(len(listed(spark, f"{levels.path}/data")))
    assert len(set(sizes)) == 1 and max(folders) <= 4
    assert {(r.sku_id, r.on_hand_latest) for r in levels.read().collect()} == {("A", 49), ("B", 49)}
    assert {(r.sku_id, r.on_hand_latest) for r in levels.read(without=("q", 49)).collect()} == {("A", 48), ("B", 48)}
    assert table.read().count() == 0


def test_export_scan_and_errors(spark, folder):
    df = feature_frame(spark, [frow("A", m, 1.0, 0) for m in (0, 60 * 24, 60 * 48)])
    sinks.export_features(df, f"{folder}/export")
    scan = tables.feature_history(spark, f"{folder}/export")
    assert scan.count() == 3
    found = tables.feature_availability(scan).first()
    assert (found.n_files, found.n_rows) == (3, 3)
    with pytest.raises(sinks.EmptyExportError):
        sinks.export_features(df.limit(0), f"{folder}/none")
    with pytest.raises(tables.NoFeaturesError):
        tables.feature_history(spark, f"{folder}/missing")


def test_seed_and_label_scans(spark, folder):
    skus = spark.createDataFrame([("S1", "Milk", "dairy", 27.0, 40)], schemas.DIM_SKU)
    skus.write.option("header", True).csv(f"{folder}/sku")
    assert tables.dim_sku(spark, f"{folder}/sku").first() == skus.first()
    skus.withColumn("unit_price", F.lit(-1.0)).write.option("header", True).csv(f"{folder}/bad")
    with pytest.raises(Exception, match="unit_price"):
        tables.dim_sku(spark, f"{folder}/bad").collect()
    assert tables.anomaly_labels(spark, f"{folder}/nolabels").count() == 0
    lines = ['{"anomaly_type": "surge", "store_id": "D", "sku_id": "S", "injected_at": "2024-05-01T12:00:00+00:00"}', ""]
    spark.createDataFrame([(x,) for x in lines], "value STRING").coalesce(1).write.text(f"{folder}/labels")
    (label,) = tables.anomaly_labels(spark, f"{folder}/labels").collect()
    assert label.injected_at == NOW and label.surge_extra_events is None


def test_metric_log_is_idempotent(spark, folder):
    rows = spark.createDataFrame([("e", "r1", NOW, "mae", 0.5)], "experiment STRING, run_id STRING, start_time TIMESTAMP, metric STRING, value DOUBLE")
    for _ in range(2):
        sinks.append_metrics(rows, f"{folder}/metrics", "r1")
    sinks.append_metrics(rows, f"{folder}/metrics", "r2")
    assert sorted(r.run_id for r in sinks.read_metrics(spark, f"{folder}/metrics").collect()) == ["r1", "r2"]


STORES, SKUS = ["DS_1", "DS_2"], ["A", "B", "C"]


@pytest.fixture(scope="module")
def dims(spark):
    stores = spark.createDataFrame([(s,) for s in STORES], "store_id STRING")
    skus = spark.createDataFrame([(s, 30) for s in SKUS], "sku_id STRING, reorder_point INT")
    return stores, skus


def messages(seed=4, n=400):
    """Orders and movements in event-time order; the hot product takes most of them."""
    rng = np.random.default_rng(seed)
    orders, moves, t = [], [], 0.0
    for i in range(n):
        t += float(rng.exponential(8))
        base = {
            "event_time": (NOW + timedelta(seconds=t)).isoformat() + "Z",
            "store_id": STORES[int(rng.random() < 0.3)],
            "sku_id": "A" if rng.random() < 0.6 else str(rng.choice(SKUS)),
        }
        q = int(rng.integers(0, 4))
        orders.append(json.dumps({"event_id": f"e{i:04d}", "category": "x", "quantity": q, "unit_price": 1.0, "order_id": f"o{i}"} | base))
        if rng.random() < 0.4:
            moves.append(json.dumps({"event_id": f"i{i:04d}", "movement_type": "sale", "delta_units": -q, "on_hand_after": int(rng.integers(0, 90))} | base))
    return orders, moves


def write_parts(spark, path, texts, parts):
    step = -(-len(texts) // parts)
    for k in range(parts):
        chunk = texts[k * step : (k + 1) * step]
        spark.createDataFrame([(x,) for x in chunk], "value STRING").coalesce(1).write.mode("append").text(path)
        time.sleep(0.02)


@pytest.mark.parametrize("parts", [1, 4])
def test_stream_equals_batch_on_closed_windows(spark, folder, dims, parts):
    stores, skus = dims
    spec = WindowSpec(watermark_s=5, chunk_s=600)
    orders, moves = messages()
    root = f"{folder}/stream{parts}"
    write_parts(spark, f"{root}/orders", orders, parts)
    write_parts(spark, f"{root}/moves", moves, parts)
    now = F.lit(NOW + timedelta(hours=3))
    sent = []
    for q in pipeline.start_pipeline(
        spark, streams.file_events(spark, f"{root}/orders", 1), streams.file_events(spark, f"{root}/moves", 1),
        stores, skus, f"{root}/out", spec, now=now, clock=lambda: F.col("window_end"), trigger={"availableNow": True},
        send=lambda df: sent.extend(df.collect()),
    ):
        q.awaitTermination()
    out = pipeline.StreamTables(spark, f"{root}/out")

    def checked(path, kind):
        raw = streams.file_events_batch(spark, path)
        return pipeline.validated_events(raw, kind, stores, skus, now)

    good_orders = validation.project_orders(validation.valid_events(checked(f"{root}/orders", "orders")))
    good_moves = validation.project_inventory(validation.valid_events(checked(f"{root}/moves", "inventory")))
    batch = windows.feature_rows(windows.feature_assembly(good_orders, good_moves, spec), F.col("window_end"))
    last = min(f.agg(F.max("event_time")).first()[0] for f in (good_orders, good_moves)) - timedelta(seconds=5)
    closed = batch.filter(F.col("window_end") <= F.lit(last)).drop("on_hand_source")
    got = out.features.read().select(*closed.columns)
    assert closed.count() > 50
    assert got.exceptAll(closed).count() == 0 and closed.exceptAll(got).count() == 0
    dead = spark.read.parquet(f"{root}/out/dead_letters")
    assert dead.count() == sum('"quantity": 0' in x for x in orders)
    assert {r.topic for r in sent} <= {"stockout-alerts", "surge-alerts"} and sent
    keys = out.alerts.read().groupBy(*schemas.ALERT_KEY).count()
    assert keys.filter("count > 1").count() == 0 and keys.count() > 0


def test_levels_survive_between_batches_and_retries(spark, folder, dims):
    _, skus = dims
    spec = WindowSpec()
    tabs = pipeline.StreamTables(spark, f"{folder}/retry")
    schema = (
        "store_id STRING, sku_id STRING, window_start TIMESTAMP, window_end TIMESTAMP, order_count LONG, total_units LONG, "
        "depletion_units LONG, restock_units LONG, on_hand_latest INT, long_count LONG"
    )

    def batch(minute, level):
        start = NOW + timedelta(minutes=minute)
        return spark.createDataFrame([("DS_1", "A", start, start + timedelta(minutes=1), 1, 1, 0, 0, level, 1)], schema)

    write = pipeline.batch_writer(tabs, skus, spec, clock=lambda: F.col("window_end"))
    write(batch(0, 55), 0)
    for _ in range(2):
        write(batch(1, None), 1)
    write(batch(2, 40), 2)
    write(batch(2, 40), 2)
    got = {r.window_start: r.on_hand_est for r in tabs.features.read().collect()}
    assert got == {NOW: 55, NOW + timedelta(minutes=1): 55, NOW + timedelta(minutes=2): 40}


def test_hot_swap(spark, folder):
    pdf = feature_rows(120)
    first = iforest.Forest.fit(spark.createDataFrame(pdf), ForestSpec(trees=3, max_samples=16))
    first.save(spark, f"{folder}/v1")
    first.cut = 0.0  # everything is anomalous in version 2
    first.save(spark, f"{folder}/v2")
    pointer = {"now": None}
    slot = pipeline.ModelSlot(spark, lambda: pointer["now"], poll_s=0)
    assert slot.refresh() is None
    pointer["now"] = (1, f"{folder}/v1")
    assert slot.refresh() is not None and slot.version == 1
    pointer["now"] = (2, f"{folder}/v2")
    assert slot.refresh().cut == 0.0 and slot.version == 2
    pointer["now"] = (3, f"{folder}/gone")
    assert slot.refresh().cut == 0.0 and slot.version == 2 and slot.last_error
    slow = pipeline.ModelSlot(spark, lambda: (1, f"{folder}/v1"), poll_s=1000)
    slow.refresh()
    slow.current = lambda: (2, f"{folder}/v2")
    assert slow.refresh() is not None and slow.version == 1


def test_scoring_uses_the_model_when_there_is_one(spark, folder, dims):
    _, skus = dims
    features = feature_frame(spark, [frow("A", m, 1.0, 0) for m in range(3)])
    ruled = pipeline.score_batch(features, skus, pipeline.ScoringSpec(), None)
    assert {r.alert_type for r in ruled.collect()} == {"stockout_risk"}
    pdf = feature_rows(120)
    forest = iforest.Forest.fit(spark.createDataFrame(pdf), ForestSpec(trees=3, max_samples=16))
    forest.cut = 2.0  # nothing is anomalous
    slot = pipeline.ModelSlot(spark, lambda: None, forest=forest)
    assert pipeline.score_batch(features, skus, pipeline.ScoringSpec(), slot).count() == 0


def test_stream_ledger(spark, folder):
    rows = [("DS_1", "A", NOW + timedelta(seconds=i), f"e{i}", 4) for i in range(10)]
    path = f"{folder}/ledger_in"
    df = spark.createDataFrame(rows, "store_id STRING, sku_id STRING, event_time TIMESTAMP, event_id STRING, quantity INT")
    for k in range(2):
        df.filter(F.substring("event_id", 2, 5).cast("int").between(5 * k, 5 * k + 4)).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    q = (
        stream_ledger.ledger_stream(stream, 10, 9)
        .writeStream.format("parquet").outputMode("append").option("path", f"{folder}/ledger_out")
        .option("checkpointLocation", f"{folder}/ledger_cp").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    got = spark.read.parquet(f"{folder}/ledger_out").orderBy("event_time").collect()
    want, level = [], 10
    for _ in rows:
        level, sold = (level - 4, True) if level >= 4 else (9, False)
        want.append((level, sold))
    assert [(r.level_after, r.sold) for r in got] == want


def test_trees_grow_on_nearly_equal_values():
    step = np.nextafter(1.0, 2.0)
    for seed in range(30):
        nodes = iforest.grow_tree(np.array([[1.0], [step], [1.0], [step]]), seed)
        leaves = [n for n in nodes if n[1] < 0]
        assert sum(n[5] for n in leaves) == 4 and all(n[5] > 0 for n in leaves)


def test_flat_walk_equals_the_tree(spark):
    rng = np.random.default_rng(9)
    nodes = iforest.fit_forest(spark.createDataFrame(feature_rows(80)), ForestSpec(trees=4, max_samples=32)).toPandas()
    x = rng.normal(10, 2, (25, len(schemas.ANOMALY_COLUMNS)))
    by_id = {(n.tree, n.node): n for n in nodes.itertuples()}
    want = []
    for row in x:
        lengths = []
        for tree in nodes["tree"].unique():
            n = by_id[tree, 0]
            while n.feature >= 0:
                n = by_id[tree, n.left if row[n.feature] <= n.split else n.right]
            lengths.append(n.depth + float(iforest.average_path(n.size)))
        want.append(2 ** (-np.mean(lengths) / float(iforest.average_path(32))))
    np.testing.assert_allclose(iforest.NodeArrays(nodes).scores(x), want)


def test_touched_days_are_broadcast_by_a_whole_number(spark, folder):
    table = pipeline.StreamTables(spark, str(folder)).features
    rows = spark.createDataFrame([("s", "p", None)], "store_id STRING, sku_id STRING, window_start TIMESTAMP")
    parts = rows.select(table._part().alias("_part"))
    assert parts.schema["_part"].dataType == table.stored["_part"].dataType == T.LongType()
    assert parts.first()[0] is not None  # rows without a day have a partition too


def test_upsert_reads_only_the_touched_days(spark, folder, monkeypatch):
    schema = T.StructType.fromDDL("k STRING, day TIMESTAMP, v INT, at INT")
    table = sinks.UpsertTable(spark, str(folder), schema, ["k", "day"], ["at"], day_of="day")
    days = [datetime(2024, 1, 1) + timedelta(days=i) for i in range(5)]
    rows = lambda v, at, *days: spark.createDataFrame([("a", d, v, at) for d in days], schema)
    table.upsert(rows(1, 1, *days, None), 0)
    monkeypatch.setattr(sinks.UpsertTable, "_rows", lambda self: pytest.fail("the whole table is listed"))
    table.upsert(rows(2, 2, days[1], None, datetime(2025, 1, 1)), 1)
    table.upsert(rows(2, 2, days[1], None, datetime(2025, 1, 1)), 1)
    monkeypatch.undo()
    monkeypatch.setattr(sinks, "LISTED", 1)
    table.upsert(rows(3, 3, days[2], days[3]), 2)  # more than are named one by one
    want = {(None, 2), (datetime(2025, 1, 1), 2), *zip(days, (1, 2, 3, 3, 1))}
    assert {(r["day"], r["v"]) for r in table.read().collect()} == want
    assert table.read().count() == len(want)
