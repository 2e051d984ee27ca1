from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stocktide import schemas
from stocktide.operators import chunks, features, joins

BASE = datetime(2024, 5, 3, 22, 0, 0)  # a Friday evening


def history(keys=(("DS_001", "SKU_001"), ("DS_001", "SKU_002"), ("DS_002", "SKU_001")), n=20):
    rows = []
    for store, sku in keys:
        for i in range(n):
            start = BASE + timedelta(minutes=i * (1 + (i % 3)))
            rows.append((store, sku, start, start + timedelta(minutes=1), 2 + 0.1 * i, 1.5 + 0.05 * i, 1 + 0.1 * (i % 5),
                         max(0, 80 - 2 * i), start))
    return pd.DataFrame(rows, columns=schemas.WINDOWED_FEATURES.names).drop_duplicates(schemas.FEATURE_KEY)


@pytest.fixture(scope="module")
def hist():
    return history()


@pytest.fixture(scope="module")
def df(spark, hist):
    return spark.createDataFrame(hist, schemas.WINDOWED_FEATURES)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows; gaps are irregular and some values are NULL."""
    rng = np.random.default_rng(3)
    rows = []
    for k, n in (("hot", 400), ("b", 30), ("c", 1)):
        t = 0
        for i in range(n):
            t += int(rng.integers(1, 4000))
            rows.append((k, BASE + timedelta(seconds=t), i, None if rng.random() < 0.3 else float(rng.normal())))
    return spark.createDataFrame(rows, "k STRING, ts TIMESTAMP, i INT, v DOUBLE")


@pytest.mark.parametrize("chunk_s", [600, 7200, 10**7])
def test_neighbours_equal_plain_windows(skewed, chunk_s):
    plain = Window.partitionBy("k").orderBy("ts", "i")
    for forward, fn in ((True, F.lag), (False, F.lead)):
        got = chunks.neighbours(skewed, ["k"], ["ts", "i"], "v", 5, chunk_s, "n", forward=forward)
        want = skewed.withColumns({f"n{i}": fn("v", i).over(plain) for i in range(1, 6)})
        assert got.count() == skewed.count()
        assert got.exceptAll(want).count() == 0


@pytest.mark.parametrize("chunk_s", [600, 7200, 10**7])
def test_carry_forward_equals_plain_window(skewed, chunk_s):
    plain = Window.partitionBy("k").orderBy("ts", "i").rowsBetween(Window.unboundedPreceding, 0)
    got = chunks.carry_forward(skewed, ["k"], ["ts", "i"], "v", chunk_s, "seen")
    want = skewed.withColumn("seen", F.last("v", ignorenulls=True).over(plain))
    assert got.exceptAll(want).count() == 0 and got.count() == skewed.count()


@pytest.mark.parametrize("chunk_s", [600, 10**7])
def test_standardise_equals_plain_moments(skewed, chunk_s):
    got = chunks.standardise(skewed, ["k"], "ts", {"v": "z"}, chunk_s).toPandas().sort_values(["k", "i"])
    pdf = skewed.toPandas().sort_values(["k", "i"])
    want = pdf.groupby("k")["v"].transform(lambda s: (s - s.mean()) / s.std() if s.std() > 0 else s * 0)
    np.testing.assert_allclose(got["z"].to_numpy(float), want.to_numpy(float), rtol=1e-9, atol=1e-12)


def test_running_totals(spark):
    rng = np.random.default_rng(5)
    rows = [(("g1", "g2")[int(rng.random() < 0.3)], float(rng.integers(0, 60)), int(rng.integers(0, 5))) for _ in range(500)]
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE, n INT")
    got = chunks.running_totals(df, ["g"], "v", ["n"]).toPandas()
    pdf = pd.DataFrame(rows, columns=["g", "v", "n"]).groupby(["g", "v"], as_index=False)["n"].sum()
    pdf["cum"] = pdf.groupby("g")["n"].cumsum()
    merged = got.merge(pdf, on=["g", "v"])
    assert len(merged) == len(pdf) == len(got)
    assert (merged["cum_n"] == merged["cum"]).all()
    assert (merged["all_n"] == merged.groupby("g")["n_x"].transform("sum")).all()


def test_latest_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("a", 2, "z"), ("b", 1, "q")], "k STRING, t INT, v STRING")
    assert {tuple(r) for r in chunks.latest_wins(df, ["k"], ["t"]).collect()} == {("a", 3, None), ("b", 1, "q")}


@pytest.mark.parametrize("chunk_s", [120, 86400])
def test_forecast_features_match_pandas(df, hist, chunk_s):
    got = features.forecast_features(df, chunk_s).toPandas().sort_values(schemas.FEATURE_KEY).reset_index(drop=True)
    parts = []
    for _, g in hist.groupby(["store_id", "sku_id"]):
        g = g.sort_values("window_start").copy()
        prior = g["order_rate"].shift(1)
        for i in (1, 2, 3):
            g[f"order_rate_lag{i}"] = g["order_rate"].shift(i)
        g["order_rate_roll3_mean"] = prior.rolling(3).mean()
        g["order_rate_roll3_std"] = prior.rolling(3).std().fillna(0)
        g["order_rate_roll6_mean"] = prior.rolling(6).mean()
        g["hour_of_day"], g["day_of_week"] = g["window_start"].dt.hour, g["window_start"].dt.dayofweek
        g["is_weekend"] = (g["day_of_week"] >= 5).astype(int)
        parts.append(g.dropna(subset=["order_rate_lag3", "order_rate_roll6_mean"]))
    want = pd.concat(parts).sort_values(schemas.FEATURE_KEY).reset_index(drop=True)
    assert len(got) == len(want) == len(hist) - 3 * 6  # six rows per key have no full history
    for c in schemas.FORECAST_COLUMNS:
        np.testing.assert_allclose(got[c].to_numpy(float), want[c].to_numpy(float), rtol=1e-9, atol=1e-9)


def test_lagged_domain_takes_the_preceding_row(df, hist):
    row = features.forecast_features(df, 3600, lag_domain=True).orderBy(*schemas.FEATURE_KEY).first()
    key = hist[(hist["store_id"] == "DS_001") & (hist["sku_id"] == "SKU_001")].sort_values("window_start")
    assert row.on_hand_est == key["on_hand_est"].iloc[5] and row.order_rate == key["order_rate"].iloc[6]


def test_zscores_have_mean_zero(df):
    got = features.anomaly_features(df, 600).groupBy("store_id", "sku_id").agg(
        F.avg("order_rate_zscore").alias("m"), F.stddev_samp("order_rate_zscore").alias("s")
    )
    assert all(abs(r.m) < 1e-9 and abs(r.s - 1) < 1e-9 for r in got.collect())


def test_constant_series_scores_zero(spark, hist):
    flat = hist.assign(order_rate=3.0)
    got = features.anomaly_features(spark.createDataFrame(flat, schemas.WINDOWED_FEATURES))
    assert got.filter("order_rate_zscore <> 0").count() == 0 and got.count() == len(hist)


@pytest.mark.parametrize("value", [1 / 3, 0.7])
def test_constant_fractions_score_zero(spark, value):
    flat = history(n=400).assign(order_rate=value)
    got = features.anomaly_features(spark.createDataFrame(flat, schemas.WINDOWED_FEATURES), 600)
    assert got.filter("order_rate_zscore <> 0").count() == 0 and got.count() == len(flat)


@pytest.mark.parametrize("holdout", [0.2, 0.5, 0.37])
def test_rows_without_a_stamp_are_kept(spark, holdout):
    hist = spark.createDataFrame(history(n=10), schemas.WINDOWED_FEATURES)
    bare = hist.limit(7).withColumn("window_start", F.lit(None).cast("timestamp"))
    rows = hist.unionByName(bare)
    got = features.holdout_split(rows, holdout)
    total = rows.count()
    assert got.count() == total and got.filter("is_train").count() == int(total * (1 - holdout))
    assert got.filter("window_start IS NULL AND NOT is_train").count() == 0


def test_online_builders(spark, df, hist):
    newest = features.online_forecast_features(df, 600).collect()
    assert len(newest) == 3 and {r.window_start for r in newest} == {hist["window_start"].max().to_pydatetime()}
    short = spark.createDataFrame(history(n=4), schemas.WINDOWED_FEATURES)
    assert features.online_forecast_features(short).count() == 0
    bare = spark.createDataFrame([("DS_1", None)], "store_id STRING, order_rate DOUBLE")
    row = features.online_anomaly_features(bare).select(*schemas.ANOMALY_COLUMNS).first()
    assert tuple(row) == (0.0, 0.0, 1.0, 0, 0.0, 0.0)


def largest_part(df, column):
    sizes = [r["n"] for r in df.groupBy(column).agg(F.count("*").alias("n")).collect()]
    return max(sizes) / sum(sizes)


@pytest.fixture
def uncoalesced(spark):
    """These rows are few enough for adaptive execution to put them into one part."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_parts_are_even_whatever_the_values(spark, uncoalesced):
    """Ids that share twenty characters, an outlier, and one store with nine tenths of all events within an hour."""
    ids = spark.range(4000).select(F.concat(F.lit("product-with-long-head-"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("id"))
    assert largest_part(chunks.ranged(ids, ["id"], "p"), "p") < 0.5
    values = spark.range(4000).select((1000 + F.col("id") / 1e4).alias("v")).unionAll(spark.sql("SELECT 1e9D AS v"))
    assert largest_part(chunks.ranged(values, ["v"], "p"), "p") < 0.5
    events = spark.range(4000).select(F.when(F.col("id") < 3600, "busy").otherwise("calm").alias("s"), F.col("id").alias("t"))
    assert largest_part(chunks.ranged(events, ["s", "t"], "p"), "p") < 0.5


@pytest.mark.parametrize("forward", [True, False])
def test_neighbours_in_parts_of_even_size(spark, uncoalesced, forward):
    rows = [("busy" if i % 10 else "calm", BASE, i) for i in range(500)]
    df = spark.createDataFrame(rows, "k STRING, ts TIMESTAMP, i LONG")
    got = chunks.neighbours(df, ["k"], ["ts", "i"], "i", 2, None, "n", forward=forward).collect()
    for k in ("busy", "calm"):
        ids = [i for s, _, i in rows if s == k]
        at = {i: j for j, i in enumerate(ids)}
        step = -1 if forward else 1
        find = lambda j: ids[j] if 0 <= j < len(ids) else None
        assert all((r.n1, r.n2) == (find(at[r.i] + step), find(at[r.i] + 2 * step)) for r in got if r.k == k)


def test_label_codes_are_dense_and_sorted(spark):
    ids = sorted({f"SKU_{i * 37 % 4000:05d}" for i in range(700)} | {"A", "SKU_00001X", "sku", "SKU_"})
    df = spark.createDataFrame([(x,) for x in ids * 2], "sku_id STRING")
    got = {r.sku_id: r.code for r in features.label_codes(df, "sku_id", "code").collect()}
    assert got == {x: i for i, x in enumerate(ids)}


@pytest.mark.parametrize("n,holdout", [(20, 0.2), (20, 0.5), (7, 0.2), (1, 0.2), (20, 0.0), (20, 1.0), (19, 0.37)])
def test_holdout_split(spark, n, holdout):
    hist = history(n=n)
    got = features.holdout_split(spark.createDataFrame(hist, schemas.WINDOWED_FEATURES), holdout)
    rows = got.toPandas().sort_values(["window_start", "store_id", "sku_id"])
    cut = int(len(hist) * (1 - holdout))
    assert rows["is_train"].tolist() == [True] * cut + [False] * (len(hist) - cut)


def test_union_fills_missing_columns(df):
    both = features.union_features([df, df.drop("on_hand_est")])
    assert both.count() == 2 * df.count() and both.filter("on_hand_est IS NULL").count() == df.count()


def test_window_start_forms(spark):
    ms = spark.createDataFrame([(int(BASE.timestamp() * 1000),)], "window_start LONG")
    iso = spark.createDataFrame([("2024-05-03T22:00:00+00:00",)], "window_start STRING")
    a, b = (features.with_parsed_start(x).first().window_start for x in (ms, iso))
    assert b == BASE and a.replace(tzinfo=None) is not None
    assert features.with_parsed_start(ms).select(F.unix_millis("window_start")).first()[0] == int(BASE.timestamp() * 1000)


def test_small_tables_are_broadcast_by_a_whole_number(spark):
    rows = spark.createDataFrame([("a", "x", 1), ("a", None, 2), ("b", "x", 3), (None, None, 4)], "k STRING, l STRING, n INT")
    table = spark.createDataFrame([("a", "x", 10), ("a", "x", 11), ("b", None, 12), (None, None, 13)], "k STRING, l STRING, m INT")
    for how in ("left", "inner"):
        got = joins.lookup_join(rows, table, ["k", "l"], ["n"], how)
        plan = got._jdf.queryExecution().executedPlan().toString()
        # by texts, the driver and every executor would set aside up to 64 MB for these four rows
        assert "HashedRelationBroadcastMode(List(input[0, bigint, false])" in plan
        want = rows.join(table, ["k", "l"], how)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_carried_levels_are_not_broadcast(spark):
    rows = spark.createDataFrame([("s", 1, 5), ("s", 20, None)], "k STRING, t INT, v INT").withColumn("t", F.timestamp_seconds("t"))
    plan = chunks.carry_forward(rows, ["k"], ["t"], "v", 10, "level")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan


def test_messages_of_one_row_group_are_made_by_all_tasks(spark, sf_dir):
    from stocktide.sources import retail

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        raw = retail.raw_orders(spark, sf_dir)
        filled = raw.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert filled == int(spark.conf.get("spark.sql.shuffle.partitions"))
