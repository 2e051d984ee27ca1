"""Boosting, exact selection and the stateful streams against brute force."""

import math
import time
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stocktide import schemas
from stocktide.config import BoostSpec, ForestSpec, WindowSpec
from stocktide.operators import boosting, drift, iforest, retrain, selection, windows
from stocktide.storage import path_exists, shared_dir
from stocktide.streaming import ledger, loop, pipeline, stateful, sustained

NOW = datetime(2024, 5, 1, 12, 0, 0)
INPUTS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def folder(spark):
    return f"{shared_dir(spark)}/streams-{time.time_ns()}"


# --- boosting


def boosting_rows(n=500, seed=3):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.integers(0, 9, n).astype(float), "c": rng.uniform(size=n)})
    pdf.loc[::17, "c"] = np.nan
    pdf["y"] = 2 * pdf.a + (pdf.b > 4) + rng.normal(0, 0.1, n)
    return pdf


def brute_boosting(x, y, ids, edges, spec):
    """Second-order boosting by trying every cut of every input in every node; returns the predictions."""
    bins = boosting.binned(x, edges)
    margin = np.full(len(y), y.mean())
    base = y.mean()
    for tree in range(spec.rounds):
        use = boosting.drawn(ids, tree, spec.seed, spec.subsample) if spec.subsample < 1 else np.ones(len(y), bool)
        columns = boosting.columns_of(tree, x.shape[1], spec)
        g = margin - y
        value = np.zeros(len(y))

        def leaf(rows):
            inside = rows & use
            return -spec.learning_rate * g[inside].sum() / (inside.sum() + spec.l2)

        def split(rows, depth):
            inside, best = rows & use, (1e-12, None)
            if depth < spec.depth:
                score = lambda r: g[r].sum() ** 2 / (r.sum() + spec.l2)
                for f in columns:
                    for cut in range(spec.bins - 1):
                        left, right = inside & (bins[:, f] <= cut), inside & (bins[:, f] > cut)
                        if min(left.sum(), right.sum()) < spec.least_weight:
                            continue
                        gain = score(left) + score(right) - score(inside)
                        if gain > best[0] * (1 + 1e-9):
                            best = (gain, (f, cut))
            if best[1] is None:
                value[rows] = leaf(rows)
                return
            f, cut = best[1]
            split(rows & (bins[:, f] <= cut), depth + 1)
            split(rows & (bins[:, f] > cut), depth + 1)

        split(np.ones(len(y), bool), 0)
        margin = margin + value
    return margin, base


@pytest.mark.parametrize("share", [1.0, 0.8])
def test_boosting_equals_brute_force_in_one_block_and_many(spark, share):
    pdf = boosting_rows()
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double, c double, y double")
    spec = BoostSpec(rounds=4, depth=3, learning_rate=0.3, subsample=share, colsample=0.7, bins=16)
    edges = boosting.bin_edges(df, INPUTS, spec.bins)
    one = boosting.fit(df, INPUTS, "y", spec, edges)
    many = boosting.fit(df.repartition(3), INPUTS, "y", spec, edges, block_rows=100)
    for k in ("feature", "cut"):
        assert (getattr(one, k) == getattr(many, k)).all()
    np.testing.assert_allclose(one.weight, many.weight, atol=1e-12)
    rows = df.select("*", F.xxhash64("a", "b", "c", "y").alias("id")).toPandas()
    want, _ = brute_boosting(rows[INPUTS].to_numpy(float), rows["y"].to_numpy(), rows["id"].to_numpy(), edges, spec)
    got = {r.id: r.predicted for r in one.predict(df.withColumn("id", F.xxhash64("a", "b", "c", "y"))).collect()}
    np.testing.assert_allclose([got[i] for i in rows["id"]], want, atol=1e-9)


def test_boosting_of_no_rows_and_its_store(spark, folder):
    df = spark.createDataFrame(boosting_rows(60)[["a", "b", "y"]])
    model = boosting.fit(df, ["a", "b"], "y", BoostSpec(rounds=3))
    model.save(spark, f"{folder}/model.json")
    again = boosting.Boosted.load(spark, f"{folder}/model.json")
    assert [r.predicted for r in again.predict(df).collect()] == [r.predicted for r in model.predict(df).collect()]
    assert sum(model.importances().values()) == pytest.approx(1)
    empty = boosting.fit(df.limit(0), ["a", "b"], "y")
    assert {r.predicted for r in empty.predict(df).collect()} == {0.0}
    flat = boosting.fit(df.withColumn("y", F.lit(2.0)), ["a", "b"], "y", BoostSpec(rounds=2))
    assert {r.predicted for r in flat.predict(df).collect()} == {2.0}


# --- exact selection


def test_kth_smallest_is_that_of_a_sort(spark):
    rng = np.random.default_rng(0)
    values = [*rng.normal(size=700).tolist(), *[0.25] * 300, 1e300, -1e300, float("nan"), None, float(np.nextafter(0.25, 1))]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ordered = sorted(v for v in values if v is not None and not math.isnan(v))
    for k in (1, 2, 350, 500, 640, len(ordered) - 1, len(ordered)):
        assert selection.kth_smallest(df, "v", k, ranges=8, few=5) == ordered[k - 1]
    assert selection.kth_smallest(df, "v", 0) is None and selection.kth_smallest(df, "v", len(ordered) + 1) is None


def test_forest_cut_is_the_exact_rank(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({c: rng.normal(10, 1, 301) for c in schemas.ANOMALY_COLUMNS})
    pdf["store_id"], pdf["sku_id"], pdf["window_start"] = "s", "k", [NOW + timedelta(minutes=i) for i in range(301)]
    df = spark.createDataFrame(pdf)
    forest = iforest.Forest.fit(df, ForestSpec(trees=5, max_samples=32))
    scores = sorted(r.anomaly_score for r in forest.score(df).collect())
    spec = ForestSpec()
    assert forest.cut == pytest.approx(scores[math.ceil(round((1 - spec.contamination) * 301, 6)) - 1], abs=1e-12)


def test_exact_ks_by_key_equals_the_single_test(spark):
    rng = np.random.default_rng(5)
    rows = [("s", k, side, float(v)) for k in "ab" for side, n, m in (("reference", 14, 0), ("current", 6, 1)) for v in rng.normal(m, 1, n).round(1)]
    rows += [("s", "lonely", "current", 1.0)]
    df = spark.createDataFrame(rows, "store_id string, sku_id string, side string, order_rate double")
    got = {r.sku_id: r for r in drift.exact_ks_by_key(df).collect()}
    assert set(got) == {"a", "b"}
    for k, r in got.items():
        sides = [sorted(v for _, s, d, v in rows if s == k and d == side) for side in ("reference", "current")]
        ks = max(abs(sum(v <= x for v in sides[0]) / 14 - sum(v <= x for v in sides[1]) / 6) for s in sides for x in s)
        assert r.ks_stat == pytest.approx(ks, abs=1e-6) and r.ks_pval == pytest.approx(drift.exact_ks_pvalue(ks, 14, 6), abs=1e-6)


# --- upserts


def test_a_replayed_and_a_cut_off_write_leave_the_same_table(spark, folder, monkeypatch):
    table = pipeline.StreamTables(spark, f"{folder}/upserts").levels
    make = lambda level, skus: spark.createDataFrame([("S", k, NOW + timedelta(minutes=level), level) for k in skus], table.schema)
    table.upsert(make(1, "abc"), 0, "q")
    table.upsert(make(2, "bd"), 1, "q")
    state = lambda t: sorted(tuple(r) for r in t.read().collect())
    once = state(table)
    table.upsert(make(2, "bd"), 1, "q")
    assert state(table) == once and sorted(r.on_hand_latest for r in table.read(("q", 1)).collect()) == [1, 1, 1]
    # the driver is lost after the merged rows are stored and before they replace anything
    finish = type(table)._finish
    with monkeypatch.context() as m:
        m.setattr(type(table), "_finish", lambda self: None)
        table.upsert(make(3, "a"), 2, "q")
    assert path_exists(spark, f"{table.path}/merged/_SUCCESS") and type(table)._finish is finish
    assert ("S", "a", NOW + timedelta(minutes=3), 3) in state(table) and len(state(table)) == 4
    table.upsert(make(3, "a"), 2, "q")
    assert len(state(table)) == 4 and not path_exists(spark, f"{table.path}/merged")


def alert_batch(spark, rows):
    schema = (
        "store_id STRING, sku_id STRING, window_start TIMESTAMP, window_end TIMESTAMP, order_count LONG, total_units LONG, "
        "depletion_units LONG, restock_units LONG, on_hand_latest INT, long_count LONG"
    )
    made = [("S", k, NOW + timedelta(minutes=m), NOW + timedelta(minutes=m + 1), 1, 1, 0, 0, level, 1) for k, m, level in rows]
    return spark.createDataFrame(made, schema)


def test_the_stream_resolves_alerts(spark, folder):
    skus = spark.createDataFrame([("A", 30), ("B", 30)], "sku_id STRING, reorder_point INT")
    out = pipeline.StreamTables(spark, f"{folder}/resolve")
    write = pipeline.batch_writer(out, skus, WindowSpec(), clock=lambda: F.col("window_end"))
    stockouts = lambda: {r.sku_id: (r.resolved, r.metric_value) for r in out.alerts.read().filter("alert_type = 'stockout_risk'").collect()}
    write(alert_batch(spark, [("A", 0, 5), ("B", 0, 6)]), 0)
    assert stockouts() == {"A": (False, 5.0), "B": (False, 6.0)}
    for _ in range(2):  # a retry leaves the same
        write(alert_batch(spark, [("A", 1, 80)]), 1)
        assert stockouts() == {"A": (True, 5.0), "B": (False, 6.0)}
    write(alert_batch(spark, [("A", 2, 7), ("B", 2, 90), ("B", 3, 4)]), 2)  # within one batch the newest window counts
    assert stockouts() == {"A": (False, 7.0), "B": (False, 4.0)}


# --- state


def parts_of(spark, path, frames):
    for df in frames:
        df.coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)


def finished(rows, path):
    q = (
        rows.writeStream.format("parquet").outputMode("append").option("path", f"{path}/out")
        .option("checkpointLocation", f"{path}/cp").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{path}/out")


def test_ledger_in_event_time_order_for_shuffled_arrival_and_a_restart(spark, folder):
    stateful.use_rocksdb(spark)
    rng = np.random.default_rng(1)
    rows = [("S", "ab"[i % 3 == 0], NOW + timedelta(seconds=10 * i), f"e{i:03d}", int(rng.integers(1, 9))) for i in range(60)]
    df = spark.createDataFrame(rows, "store_id STRING, sku_id STRING, event_time TIMESTAMP, event_id STRING, quantity INT")
    arrival = sorted(rows, key=lambda r: r[2] + timedelta(seconds=float(rng.uniform(0, 100))))
    make = lambda part: spark.createDataFrame(part, df.schema)
    path = f"{folder}/ordered_ledger"
    for cut in (slice(0, 20), slice(20, 40), slice(40, 60)):  # a run that ends and starts again for each part
        parts_of(spark, f"{path}/in", [make(arrival[cut])])
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in").withWatermark("event_time", "100 seconds")
        found = finished(ledger.ordered_ledger_stream(stream, 20, 18), path)
    want = []
    for k in "ab":
        level = 20
        for r in rows:
            if r[1] == k:
                level, sold = (level - r[4], True) if level >= r[4] else (18, False)
                if r[2] <= rows[-1][2] - timedelta(seconds=100):
                    want.append((r[3], level, sold))
    assert sorted((r.event_id, r.level_after, r.sold) for r in found.collect()) == sorted(want)


class _Held:
    """A key's state in a dictionary; ``sent`` counts the values that pass between Python and Spark."""

    def __init__(self):
        self.values, self.timers, self.level, self.sent = [], [], None, 0

    getListState = getValueState = lambda self, name, schema: self if name == "waiting" else _Level()

    def appendValue(self, value):
        self.values.append(value)
        self.sent += 1

    def appendList(self, values):
        for v in values:
            self.appendValue(v)

    def put(self, values):
        self.clear()
        self.appendList(values)

    def clear(self):
        self.values = []

    def get(self):
        self.sent += len(self.values)
        return iter(self.values)

    def listTimers(self):
        return iter(self.timers)

    def registerTimer(self, ms):
        self.timers.append(ms)


class _Level:
    value = None
    exists = lambda self: self.value is not None
    get = lambda self: self.value

    def update(self, value):
        self.value = value


class _Mark:
    def __init__(self, ms):
        self.getCurrentWatermarkInMs = lambda: ms


def test_waiting_rows_travel_in_blocks(spark):
    n, start = 25_000, 1_700_000_000
    at = np.random.default_rng(5).permutation(n) // 2  # equal times go by id
    pdf = pd.DataFrame({"event_time": pd.to_datetime(start + at, unit="s"), "event_id": [f"e{i}" for i in range(n)], "quantity": np.full(n, 3, "int32")})
    held, key = _Held(), ("s", "p")
    processor = ledger._Ledger(20, 18)
    processor.init(held)
    assert list(processor.handleInputRows(key, iter([pdf[:9_000], pdf[9_000:]]), _Mark(0))) == []
    cut = start + 5_000
    first = pd.concat(processor.handleExpiredTimer(key, _Mark(cut * 1000), None))
    assert held.timers[-1] == (cut + 1) * 1000
    rest = pd.concat(processor.handleExpiredTimer(key, _Mark((start + n) * 1000), None))
    assert held.values == [] and held.sent <= 10  # one value a row before
    want = pdf.assign(at=at).sort_values(["at", "event_id"])
    got = pd.concat([first, rest])
    assert len(first) == 10_002 and got["event_id"].tolist() == want["event_id"].tolist()
    assert got["level_after"].tolist() == ledger.replay(np.full(n, 3), 20, 18)[0].tolist()


def test_a_range_of_many_rows_is_several_files(spark, tmp_path, monkeypatch):
    from stocktide.plans import window_queries

    class Folder:
        path = staticmethod(lambda name: f"{tmp_path}/{name}")

    rows = spark.range(900).select(F.timestamp_micros(F.col("id") * 7).alias("t"), F.col("id"))
    for size, files in ((100, 3), (1000, 1)):
        monkeypatch.setattr(window_queries, "FILE_ROWS", size)
        path, each = window_queries._in_parts(Folder, rows, F.col("t"), 3)
        at = spark.read.parquet(path).groupBy("_metadata.file_modification_time", "_metadata.file_path").agg(F.min("id"), F.max("id"), F.count("*"))
        found = sorted(map(tuple, at.collect()))
        assert each == files and len(found) == 3 * files and sum(f[4] for f in found) == 900
        assert [f[2] // 300 for f in found] == [f[3] // 300 for f in found] == [i // files for i in range(3 * files)]


def test_threshold_alerts_fire_when_the_condition_has_held(spark, folder):
    stateful.use_rocksdb(spark)
    rules = [("Late", "lag", "", ">", 10.0, 120)]
    value = [5, 20, 20, 5, 20, 20, 20, 20, 5, 20, 5, 20, 20]  # one sample a minute
    rows = [(NOW + timedelta(minutes=i), "lag", "", float(v)) for i, v in enumerate(value)] + [(NOW + timedelta(minutes=40), "other", "", 1.0)]
    schema = "ts TIMESTAMP, metric STRING, label STRING, value DOUBLE"
    path = f"{folder}/rules"
    mixed = [rows[1], rows[0], *rows[2:5], rows[6], rows[5], *rows[7:]]
    parts_of(spark, f"{path}/in", [spark.createDataFrame(mixed[a:a + 5], schema) for a in range(0, len(mixed), 5)])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in").withWatermark("ts", "3 minutes")
    found = finished(sustained.threshold_stream(stream, rules), path).collect()
    at = lambda m: NOW + timedelta(minutes=m)
    # the span from minute 11 has no later sample: the watermark alone makes it fire
    assert sorted((r.since, r.fired_at, r.until) for r in found if r.until) == [(at(1), at(3), at(3)), (at(4), at(6), at(8))]
    assert (at(11), at(13), None) in {(r.since, r.fired_at, r.until) for r in found}
    assert len({r.since for r in found}) == 3


def test_joined_windows_equal_the_single_aggregation_and_survive_a_restart(spark, folder):
    stateful.use_rocksdb(spark)
    spec = WindowSpec(watermark_s=5, chunk_s=600)
    rng = np.random.default_rng(8)
    t = np.cumsum(rng.exponential(8, 200))
    orders = spark.createDataFrame(
        [("S", "AB"[i % 2], NOW + timedelta(seconds=float(s)), f"o{i}", int(rng.integers(1, 4)), 1.0, False) for i, s in enumerate(t)],
        "store_id STRING, sku_id STRING, event_time TIMESTAMP, event_id STRING, quantity INT, unit_price DOUBLE, is_injected_anomaly BOOLEAN",
    )
    moves = spark.createDataFrame(
        [("S", "AB"[i % 2], NOW + timedelta(seconds=float(s)), f"m{i}", "sale", -1, int(rng.integers(0, 50))) for i, s in enumerate(t[::3])],
        "store_id STRING, sku_id STRING, event_time TIMESTAMP, event_id STRING, movement_type STRING, delta_units INT, on_hand_after INT",
    )
    path, half = f"{folder}/join", NOW + timedelta(seconds=float(t[100]))
    early = F.col("event_time") <= F.lit(half)
    for part in (early, ~early):  # stopped after the first half, started again from the checkpoint
        parts_of(spark, f"{path}/orders", [orders.filter(part)])
        parts_of(spark, f"{path}/moves", [moves.filter(part)])
        read = lambda df, name: spark.readStream.schema(df.schema).parquet(f"{path}/{name}").withWatermark("event_time", "5 seconds")
        closed = finished(pipeline.joined_windows(read(orders, "orders"), read(moves, "moves"), spec), path)
    nothing = spark.createDataFrame([], pipeline.LEVELS)
    columns = ["store_id", "sku_id", "window_start", "window_end", "order_count", "total_units", "depletion_units", "on_hand", "short_rate", "long_rate"]
    got = pipeline.assemble_batch(closed, nothing, spec).select(*columns)
    last = NOW + timedelta(seconds=float(min(t[-1], t[::3][-1])) - 5)
    want = windows.feature_assembly(orders, moves, spec).filter(F.col("window_end") <= F.lit(last)).select(*columns)
    assert want.count() > 30 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_totals_count_rows_and_late_windows(spark, folder):
    rows = [("S", "A", NOW + timedelta(minutes=m), f"e{m}", 1) for m in (0, 1, 50, 2, 51, 3, 52)]
    schema = "store_id STRING, sku_id STRING, event_time TIMESTAMP, event_id STRING, quantity INT"
    path, totals = f"{folder}/totals", pipeline.Totals()
    parts_of(spark, f"{path}/in", [spark.createDataFrame([r], schema) for r in rows])
    spark.streams.addListener(totals)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in").withWatermark("event_time", "1 second")
    q = (
        windows.tumbling_orders(pipeline.counted(stream), WindowSpec()).writeStream.format("noop").outputMode("append")
        .option("checkpointLocation", f"{path}/cp").trigger(availableNow=True).start()
    )
    totals.finished(q)
    spark.streams.removeListener(totals)
    assert totals.events("orders", str(q.runId)) == len(rows) and totals.events("other") == 0
    # minutes 2 and 3 come after minute 50, but the batch right after it still uses the watermark before
    assert {b: n for b, n in totals.late(str(q.runId)).items() if n} == {5: 1}


def test_a_summary_sent_twice_gives_one_decision(spark, folder):
    schema = "run_id STRING, run_ts TIMESTAMP, skipped BOOLEAN, reason STRING, any_drift BOOLEAN, drifted_features ARRAY<STRING>, max_psi DOUBLE"
    rows = [(f"drift-{i}", NOW + timedelta(hours=i), False, None, i != 1, ["order_rate"], 0.5) for i in range(3)]
    path = f"{folder}/decisions"
    parts_of(spark, f"{path}/in", [spark.createDataFrame(rows[:2], schema), spark.createDataFrame(rows, schema)])
    idle = spark.createDataFrame([(j, False) for j in retrain.JOBS], "job_name STRING, in_cooldown BOOLEAN")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    loop.start_decisions(stream, lambda: idle, f"{path}/requests", f"{path}/cp", trigger={"availableNow": True}).awaitTermination()
    got = [(r.job_name, r.run_id) for r in loop.read_requests(spark, f"{path}/requests").collect()]
    assert sorted(got) == sorted((j, f"drift-{i}") for j in retrain.JOBS for i in (0, 2))
