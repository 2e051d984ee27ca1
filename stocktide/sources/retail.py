"""The test tables seen as retail data.

``events`` gives the raw order and stock messages, ``part`` the products (one per brand), ``region`` and
``nation`` the stores, ``orders`` the run and metric logs. Whole tables are used. Messages are broken on
purpose by their event id (cut off text, missing fields, wrong types, bad stamps), so every validation
rule has something to reject. One event every few minutes calls for six-hour windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.config import DriftSpec, WindowSpec
from stocktide.operators.joins import lookup_join

SPEC = WindowSpec(short_s=21600, long_s=108000, rate_unit_s=21600, watermark_s=3600, chunk_s=7 * 86400)
DRIFT = DriftSpec(current_s=5 * 86400, reference_s=25 * 86400)
# One minute of the specified windows is one short window here.
SCALE = 360


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dim_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product per brand over the whole ``part`` table."""
    return (
        table(spark, sf_dir, "part")
        .groupBy(F.col("p_brand").alias("sku_id"))
        .agg(
            F.min("p_name").alias("name"),
            F.min("p_type").alias("category"),
            F.max("p_retailprice").alias("unit_price"),
            (F.sum("p_size") % 60 + 10).cast("int").alias("reorder_point"),
        )
    )


def dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One store per region; its capacity grows with the region's nations."""
    nations = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "region")
        .join(nations, F.col("r_regionkey") == F.col("n_regionkey"), "left")
        .groupBy("r_regionkey", F.col("r_name").alias("region"))
        .agg((F.count("n_nationkey") * 400).cast("int").alias("capacity"))
        .select(_store_id(F.col("r_regionkey")).alias("store_id"), "region", "capacity")
    )


def _store_id(n: Column) -> Column:
    return F.concat(F.lit("DS_"), F.lpad(n.cast("string"), 3, "0"))


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def _field(name: str, value: Column, quoted: bool = True) -> Column:
    quote = '"' if quoted else ""
    return F.concat(F.lit(f'"{name}":{quote}'), value, F.lit(quote))


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their retail identity and the stamp text they are sent with."""
    sent = F.when(_every(79), F.col("ts") + F.expr("interval 3650 days")).otherwise(F.col("ts"))
    stamp = F.concat(F.date_format(sent, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    brand = F.get_json_object("props", "$.k").cast("int") % 26
    # A scan gives a row group to one task; the messages cost far more than moving their columns, so all tasks share them.
    return table(spark, sf_dir, "events").repartition("event_id").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("arrived_at"),
        "event_type",
        "value",
        _store_id(F.col("user_id") % 6).alias("store_id"),
        F.concat(F.lit("Brand#"), brand.cast("string")).alias("sku_id"),
        F.when(_every(83), F.lit("not-a-date")).otherwise(stamp).alias("stamp"),
    )


def _message(fields: list[Column]) -> Column:
    text = F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))
    cut, closed = F.substring(text, F.lit(1), F.length(text) - 1), F.concat(text, F.lit("] junk"))
    return F.when(_every(97), cut).when(_every(109), closed).otherwise(text)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order messages from purchases, views and clicks: ``value`` text and the time it arrived."""
    base = _base(spark, sf_dir).filter(F.col("event_type").isin("purchase", "view", "click"))
    ident = F.col("event_id").cast("string")
    quantity = (F.col("event_id") % 10).cast("string")
    bad = F.when(_every(61), F.concat(F.lit('"'), quantity, F.lit('"'))).when(_every(101), F.lit("3000000000"))
    quantity = bad.when(_every(103), F.lit("0.4")).when(_every(107), F.lit("1e400")).otherwise(quantity)
    price = F.col("value").cast("decimal(18,2)") - F.lit("1.00").cast("decimal(18,2)")
    fields = [
        _field("event_id", F.concat(F.lit("evt-"), ident)),
        _field("event_time", F.col("stamp")),
        _field("store_id", F.col("store_id")),
        _field("sku_id", F.col("sku_id")),
        _field("category", F.col("event_type")),
        _field("quantity", quantity, quoted=False),
        _field("unit_price", price.cast("string"), quoted=False),
        F.when(~_every(89), _field("order_id", F.concat(F.lit("ord-"), ident))),
        F.when(F.col("value") > 200, F.lit('"is_injected_anomaly":true')),
    ]
    return base.select("arrived_at", _message(fields).alias("value"))


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock messages: purchases sell, sign-ups restock, errors adjust up or down."""
    base = _base(spark, sf_dir).filter(F.col("event_type").isin("purchase", "signup", "error"))
    kind, n = F.col("event_type"), F.col("event_id") % 10
    movement = F.when(kind == "purchase", "sale").when(kind == "signup", "restock").otherwise("adjustment")
    movement = F.when(_every(73), F.lit("steal")).otherwise(movement)
    delta = F.when((kind == "signup") | ((kind == "error") & (n % 2 == 0)), n).otherwise(-n)
    delta = F.when(_every(101), F.lit("-3000000000")).otherwise(delta.cast("string"))
    level = F.when(_every(67), F.lit(-1)).otherwise(F.col("event_id") * 37 % 120)
    fields = [
        _field("event_id", F.concat(F.lit("inv-"), F.col("event_id").cast("string"))),
        _field("event_time", F.col("stamp")),
        _field("store_id", F.col("store_id")),
        _field("sku_id", F.col("sku_id")),
        _field("movement_type", movement),
        F.when(~_every(89), _field("delta_units", delta, quoted=False)),
        _field("on_hand_after", level.cast("string"), quoted=False),
    ]
    return base.select("arrived_at", _message(fields).alias("value"))


def clock(spark: SparkSession, sf_dir: str) -> Column:
    """The time the queries run at: the newest event."""
    return table(spark, sf_dir, "events").agg(F.max("ts").cast("timestamp")).scalar()


def anomaly_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground truth: order events of high value are injected surges, high-value adjustments stock-outs."""
    base = _base(spark, sf_dir).filter((F.col("value") > 120) & (F.col("event_type") != "signup"))
    surge = F.col("event_type") != "error"
    return base.select(
        F.when(surge, "surge").otherwise("stockout_risk").alias("anomaly_type"),
        "store_id",
        "sku_id",
        F.concat(F.date_format("arrived_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("injected_at"),
        F.when(surge, 20).otherwise(0).alias("surge_extra_events"),
        F.lit(5).alias("stockout_target_units"),
    )


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gauge history (ts, metric, label, value), one sample per day, from the orders of the day."""
    orders = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("timestamp").alias("ts")
    daily = orders.groupBy(day).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("o_orderstatus") == "F").alias("f"),
        F.count_if(F.col("o_orderstatus") == "P").alias("p"),
        F.max("o_totalprice").alias("top"),
    )
    gauges = daily.select(
        "ts",
        F.explode(
            F.array(
                _gauge("feature_freshness_lag_seconds", "", F.col("n") * 40.0),
                _gauge("active_alerts", "stockout_risk", F.col("f") * 2.0),
                _gauge("active_alerts", "surge", F.col("p") * 1.0),
                _gauge("drift_detected", "", (F.col("top") > 450000).cast("double")),
            )
        ).alias("g"),
    ).select("ts", "g.*")
    per_label = orders.groupBy(day, F.col("o_orderpriority").alias("label")).agg(
        F.max("o_totalprice").alias("top"), F.min("o_totalprice").alias("low")
    )
    scores = per_label.select(
        "ts",
        "label",
        F.explode(
            F.array(
                F.struct(F.lit("psi").alias("metric"), (F.col("low") / 1000000).alias("value")),
                F.struct(F.lit("ks_stat").alias("metric"), (F.col("top") / 1000000).alias("value")),
                F.struct(F.lit("mae").alias("metric"), (F.col("top") / 400000).alias("value")),
                F.struct(F.lit("f1").alias("metric"), (F.col("top") / 500000).alias("value")),
            )
        ).alias("g"),
    ).select("ts", "g.metric", "label", "g.value")
    return gauges.unionByName(scores)


def _gauge(metric: str, label: str, value: Column) -> Column:
    return F.struct(F.lit(metric).alias("metric"), F.lit(label).alias("label"), value.alias("value"))


def model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly training runs: one model per order priority, its primary metric from the week's prices.

    Columns: model_name, version, run_id, start_time, metric, value, n.
    """
    week = F.date_trunc("week", "o_orderdate")
    weekly = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("model_name"), week.cast("timestamp").alias("start_time"))
        .agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))
    )
    version = F.unix_timestamp("start_time") / 604800
    return weekly.select(
        "model_name",
        F.floor(version).alias("version"),
        F.concat_ws("-", F.lit("run"), F.substring("model_name", 1, 1), F.floor(version).cast("string")).alias("run_id"),
        "start_time",
        F.when(F.substring("model_name", 1, 1).isin("1", "2"), "mae").otherwise("f1").alias("metric"),
        F.when(F.col("n") % 7 != 0, F.col("top") / 500000).alias("value"),
        "n",
    )


def registry_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run registers a version; even weeks go to Production and are archived five weeks later."""
    runs = model_runs(spark, sf_dir)
    newest = runs.agg(F.max("start_time")).scalar()
    made = runs.select("model_name", "version", "run_id", F.lit("None").alias("stage"), F.col("start_time").alias("event_ts"))
    even = F.col("n") % 2 == 0
    live = runs.filter(even).select(
        "model_name", "version", "run_id", F.lit("Production").alias("stage"),
        (F.col("start_time") + F.expr("interval 1 day")).alias("event_ts"),
    )
    gone = runs.filter(even & (F.col("start_time") + F.expr("interval 35 days") <= newest)).select(
        "model_name", "version", "run_id", F.lit("Archived").alias("stage"),
        (F.col("start_time") + F.expr("interval 35 days")).alias("event_ts"),
    )
    return made.unionByName(live).unionByName(gone)


def trigger_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each retrain job was last started: urgent orders start the detector, high ones the forecaster."""
    job = (
        F.when(F.col("o_orderpriority").startswith("1"), "detector_retrain")
        .when(F.col("o_orderpriority").startswith("2"), "forecaster_retrain")
    )
    return (
        table(spark, sf_dir, "orders")
        .select(job.alias("job_name"), F.col("o_orderdate").cast("timestamp").alias("triggered_at"))
        .filter(F.col("job_name").isNotNull())
    )


def drift_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One drift run per week of orders: a priority whose smallest order of the week is large has drifted.

    Runs whose order count is a multiple of eleven are skipped, like runs with too little data.
    """
    week = F.date_trunc("week", "o_orderdate").cast("timestamp")
    per_label = (
        table(spark, sf_dir, "orders")
        .groupBy(week.alias("run_ts"), F.col("o_orderpriority").alias("feature"))
        .agg(F.count("*").alias("n"), (F.min("o_totalprice") / 200000).alias("psi"))
    )
    drifted = F.when(F.col("psi") > 0.25, F.col("feature"))
    return per_label.groupBy("run_ts").agg(
        F.sum("n").alias("n_current"),
        F.max("psi").alias("max_psi"),
        F.array_sort(F.collect_list(drifted)).alias("drifted_features"),
    ).select(
        F.concat(F.lit("drift-"), F.date_format("run_ts", "yyyyMMdd")).alias("run_id"),
        "run_ts",
        (F.col("n_current") % 11 == 0).alias("skipped"),
        F.when(F.col("n_current") % 11 == 0, "insufficient_current_data").alias("reason"),
        (F.size("drifted_features") > 0).alias("any_drift"),
        "drifted_features",
        "max_psi",
    )


def line_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as events at scale: region of the supplier sells brand of the part on the ship date.

    A line is an order and the stock movement that follows from it (returned lines restock, the others sell), so
    one frame holds both.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_returnflag"
    )
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    suppliers = (
        table(spark, sf_dir, "supplier")
        .join(F.broadcast(nations), F.col("s_nationkey") == F.col("n_nationkey"))  # the 25 nations
        .select(F.col("s_suppkey").alias("l_suppkey"), _store_id(F.col("n_regionkey")).alias("store_id"))
    )
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("sku_id"))
    line = ["l_orderkey", "l_linenumber"]
    placed = lookup_join(lookup_join(lines, suppliers, ["l_suppkey"], line, "inner"), parts, ["l_partkey"], line, "inner")
    returned, units = F.col("l_returnflag") == "R", F.col("l_quantity").cast("int")
    return placed.select(
        "store_id",
        "sku_id",
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("event_id"),
        F.lit(True).alias("is_order"),
        F.lit(True).alias("is_move"),
        units.alias("quantity"),
        F.when(returned, units).otherwise(-units).alias("delta_units"),
        units.alias("on_hand_after"),
        F.when(returned, "restock").otherwise("sale").alias("movement_type"),
    )


# Weekly windows over day-resolution lines.
LINE_SPEC = WindowSpec(short_s=604800, long_s=5 * 604800, rate_unit_s=604800, watermark_s=86400, chunk_s=364 * 86400)
LINE_DRIFT = DriftSpec(current_s=26 * 604800, reference_s=104 * 604800)
