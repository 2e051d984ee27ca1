"""Windows, feature rows, alerts and demand profiles."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.functions import expr
from stocktide.operators import features, ledger, profiles, scoring, validation, windows
from stocktide.plans.catalog import query, rounded
from stocktide.plans.oracle import W, start_of
from stocktide.plans.retail_tables import Retail
from stocktide.schemas import KEYS
from stocktide.sources import retail
from stocktide.streaming import ledger as ledger_streams
from stocktide.streaming import pipeline, stateful


@query(
    "tumbling_orders",
    """SELECT store_id, sku_id, pane AS window_start, pane + INTERVAL 6 HOUR AS window_end, order_count, total_units,
      CAST(order_count AS DOUBLE) AS short_rate FROM order_cells""",
)
def tumbling_orders(r: Retail) -> DataFrame:
    return windows.tumbling_orders(r.orders, retail.SPEC).drop("avg_basket_size")


@query("window_basket", "SELECT store_id, sku_id, pane AS window_start, round(avg_basket_size, 6) AS avg_basket_size FROM order_cells")
def window_basket(r: Retail) -> DataFrame:
    baskets = windows.tumbling_orders(r.orders, retail.SPEC)
    return rounded(baskets.select(*KEYS, "window_start", "avg_basket_size"), "avg_basket_size")


@query(
    "tumbling_inventory",
    """SELECT store_id, sku_id, pane AS window_start, pane + INTERVAL 6 HOUR AS window_end, depletion_units, restock_units,
      on_hand_latest FROM inv_cells""",
)
def tumbling_inventory(r: Retail) -> DataFrame:
    return windows.tumbling_inventory(r.inventory, retail.SPEC)


@query(
    "sliding_orders",
    f"""SELECT store_id, sku_id, make_timestamp(s * {W}) AS window_start, make_timestamp((s + 5) * {W}) AS window_end,
      count(*) AS order_count, count(*) / CAST(5 AS DOUBLE) AS long_rate
    FROM (SELECT store_id, sku_id, epoch_us(event_time) // {W} - unnest(range(0, 5)) AS s FROM vorders) GROUP BY ALL""",
)
def sliding_orders(r: Retail) -> DataFrame:
    return windows.sliding_orders(r.orders, retail.SPEC)


_FEATURE_SQL = """SELECT store_id, sku_id, window_start, window_end, order_rate, depletion_vel, demand_momentum, on_hand_est,
    updated_at FROM features"""


@query(
    "feature_assembly",
    """SELECT store_id, sku_id, window_start, window_end, order_count, total_units, depletion_units, restock_units,
      on_hand, on_hand_source, CAST(short_rate AS DOUBLE) AS short_rate, CAST(long_rate AS DOUBLE) AS long_rate FROM assembled""",
)
def feature_assembly(r: Retail) -> DataFrame:
    return windows.feature_assembly(r.orders, r.inventory, retail.SPEC)


@query(
    "feature_assembly_stub",
    """SELECT store_id, sku_id, pane AS window_start, round_even(CAST(order_count AS DOUBLE), 4) AS order_rate,
      CAST(0 AS DOUBLE) AS depletion_vel, round_even(CAST(order_count AS DOUBLE), 4) AS demand_momentum, 0 AS on_hand_est
    FROM order_cells""",
)
def feature_assembly_stub(r: Retail) -> DataFrame:
    rows = windows.feature_rows(windows.feature_assembly(r.orders, r.inventory, retail.SPEC, mode="stub"))
    return rows.select(*KEYS, "window_start", "order_rate", "depletion_vel", "demand_momentum", "on_hand_est")


@query("feature_rows", _FEATURE_SQL)
def feature_rows(r: Retail) -> DataFrame:
    """From raw messages to feature rows in one job."""
    rows = windows.feature_assembly(r.live_orders(), r.live_inventory(), retail.SPEC)
    return windows.feature_rows(rows, F.col("window_end")).drop("on_hand_source")


_CLOSED = """window_end <= least((SELECT max(event_time) FROM vorders), (SELECT max(event_time) FROM vinv)) - INTERVAL 1 HOUR"""


@query("stream_features", f"{_FEATURE_SQL} WHERE {_CLOSED}")
def stream_features(r: Retail) -> DataFrame:
    """What the stream has stored when its input ends; windows past the watermark stay open."""
    return r.stream_run[0].features.read()


@query(
    "stream_alerts",
    "SELECT store_id, sku_id, alert_type, alert_id, triggered_at, metric_value, threshold, resolved FROM closed_alerts",
)
def stream_alerts(r: Retail) -> DataFrame:
    """The stream's alert state: the last alert per key and type, resolved once a later window of its key is safe."""
    return r.stream_run[0].alerts.read()


@query(
    "stream_open_windows",
    f"""SELECT store_id, sku_id, window_end - INTERVAL 6 HOUR AS window_start, window_end, count(*) FILTER (is_order) AS long_count,
      count(*) FILTER (is_order AND here) AS order_count, CAST(coalesce(sum(quantity) FILTER (here), 0) AS BIGINT) AS total_units,
      CAST(coalesce(sum(-delta_units) FILTER (here AND delta_units < 0), 0) AS BIGINT) AS depletion_units,
      CAST(coalesce(sum(delta_units) FILTER (here AND movement_type = 'restock'), 0) AS BIGINT) AS restock_units,
      arg_max(on_hand_after, (event_time, event_id)) FILTER (here AND NOT is_order) AS on_hand_latest
    FROM (SELECT *, i = 0 AS here, {start_of('event_time')} + (i + 1) * INTERVAL 6 HOUR AS window_end FROM
        (SELECT store_id, sku_id, event_time, event_id, TRUE AS is_order, quantity, NULL AS delta_units, NULL AS movement_type, NULL AS on_hand_after FROM vorders
          UNION ALL SELECT store_id, sku_id, event_time, event_id, FALSE, NULL, delta_units, movement_type, on_hand_after FROM vinv),
        (SELECT unnest(range(5)) AS i))
    WHERE NOT {_CLOSED} GROUP BY store_id, sku_id, window_end""",
)
def stream_open_windows(r: Retail) -> DataFrame:
    """What the stream still holds when its input ends, read back from its RocksDB state."""
    return pipeline.open_windows(r.spark, r.stream_run[2], retail.SPEC)


@query("stream_order_count", "SELECT count(*) AS order_events FROM vorders")
def stream_order_count(r: Retail) -> DataFrame:
    """The running total of valid orders as the stream reported it, batch by batch."""
    return r.spark.createDataFrame([(r.stream_run[1],)], "order_events LONG")


@query(
    "late_data_split",
    f"""SELECT store_id, sku_id, event_time, arrived_at, coalesce(window_end <= seen - INTERVAL 1 HOUR, FALSE) AS is_late
    FROM (SELECT v.*, {start_of('event_time')} + INTERVAL 6 HOUR AS window_end,
        {start_of('arrived_at')} AS batch FROM (SELECT store_id, sku_id, ts AS arrived_at,
          CASE WHEN event_id % 13 = 0 THEN ts - INTERVAL 40 HOUR ELSE ts END AS event_time FROM order_raw WHERE reason IS NULL) v) o
    LEFT JOIN (SELECT batch, max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
      FROM (SELECT {start_of('ts')} AS batch, max(CASE WHEN event_id % 13 = 0 THEN ts - INTERVAL 40 HOUR ELSE ts END) AS top
        FROM order_raw WHERE reason IS NULL GROUP BY 1)) s USING (batch)""",
)
def late_data_split(r: Retail) -> DataFrame:
    """Every thirteenth order is stamped forty hours before it arrives."""
    valid = validation.valid_events(r.validated("orders"))
    number = F.substring("event.event_id", 5, 20).cast("long")
    stamped = F.when(number % 13 == 0, F.col("event_ts") - F.expr("interval 40 hours")).otherwise(F.col("event_ts"))
    orders = valid.select("event.store_id", "event.sku_id", stamped.alias("event_time"), "arrived_at")
    return windows.late_data_split(orders, retail.SPEC, "arrived_at")


@query(
    "window_imbalance",
    """SELECT store_id, sku_id, window_start, round((order_count - restock_units) / CAST(total_units AS DOUBLE), 6) AS volume_imbalance
      FROM assembled""",
)
def window_imbalance(r: Retail) -> DataFrame:
    return rounded(windows.window_imbalance(r.assembled()), "volume_imbalance")


@query(
    "depletion_momentum",
    "SELECT store_id, sku_id, window_start, round(depletion_vel * demand_momentum, 6) AS depletion_momentum FROM features",
)
def depletion_momentum(r: Retail) -> DataFrame:
    value = F.round(expr.depletion_momentum("depletion_vel", "demand_momentum"), 6)
    return r.features.select(*KEYS, "window_start", value.alias("depletion_momentum"))


@query(
    "time_to_empty",
    """SELECT store_id, sku_id, window_start, CASE WHEN depletion_vel <> 0 THEN round(on_hand_est / depletion_vel, 6) END
      AS time_to_empty FROM features""",
)
def time_to_empty(r: Retail) -> DataFrame:
    value = F.round(expr.time_to_empty("on_hand_est", "depletion_vel"), 6)
    return r.features.select(*KEYS, "window_start", value.alias("time_to_empty"))


@query(
    "reorder_lookup",
    """SELECT store_id, f.sku_id, window_start, on_hand_est, coalesce(d.reorder_point, 20) AS reorder_point
      FROM features f LEFT JOIN (SELECT * FROM dim_sku WHERE category <> 'ECONOMY' OR unit_price > 1000) d ON f.sku_id = d.sku_id""",
)
def reorder_lookup(r: Retail) -> DataFrame:
    """Against a dimension that lacks some products, so that the default shows."""
    part = r.dim_sku.filter((F.col("category") != "ECONOMY") | (F.col("unit_price") > 1000))
    return scoring.with_reorder_point(r.features, part).select(
        *KEYS, "window_start", "on_hand_est", "reorder_point"
    )


@query("alerts_rules", "SELECT * FROM alerts_all")
def alerts_rules(r: Retail) -> DataFrame:
    return r.all_alerts().drop("alert_seq")


@query(
    "alerts_resolve",
    "SELECT store_id, sku_id, alert_type, alert_id, triggered_at, metric_value, threshold, resolved FROM alerts",
)
def alerts_resolve(r: Retail) -> DataFrame:
    return r.alerts


@query(
    "alerts_gated",
    """SELECT store_id, sku_id, 'surge' AS alert_type, window_end AS triggered_at, demand_momentum AS metric_value,
      CAST(2.5 AS DOUBLE) AS threshold, 0 AS alert_seq FROM predicted WHERE prediction = -1 AND demand_momentum >= 2.5
    UNION ALL SELECT store_id, p.sku_id, 'stockout_risk', window_end, CAST(on_hand_est AS DOUBLE),
      CAST(coalesce(reorder_point, 20) AS DOUBLE), CASE WHEN demand_momentum >= 2.5 THEN 1 ELSE 0 END
      FROM predicted p LEFT JOIN dim_sku d ON p.sku_id = d.sku_id
      WHERE prediction = -1 AND on_hand_est <= coalesce(reorder_point, 20)""",
)
def alerts_gated(r: Retail) -> DataFrame:
    """Model-gated alerts with the flags of a z-score rule in place of the model."""
    alerts = scoring.score_with_model(
        r.flagged(), r.dim_sku, triggered_at=F.col("window_end"), alert_id=scoring.stable_alert_id()
    )
    return alerts.drop("alert_id", "resolved")


@query(
    "demand_profile",
    """SELECT h AS hour_of_day, is_weekend, orders, round(per_day, 6) AS orders_per_day,
      round(max(per_day) FILTER (is_weekend) OVER (PARTITION BY h) / max(per_day) FILTER (NOT is_weekend) OVER (PARTITION BY h), 6)
        AS weekend_uplift
    FROM (SELECT h, is_weekend, orders, orders / CAST(days AS DOUBLE) AS per_day FROM
      (SELECT CAST(hour(event_time) AS INTEGER) AS h, isodow(event_time) >= 6 AS is_weekend, count(*) AS orders FROM vorders GROUP BY ALL)
      JOIN (SELECT isodow(event_time) >= 6 AS is_weekend, count(DISTINCT CAST(event_time AS DATE)) AS days FROM vorders GROUP BY ALL)
      USING (is_weekend))""",
)
def demand_profile(r: Retail) -> DataFrame:
    return rounded(profiles.demand_profile(r.orders), "orders_per_day", "weekend_uplift")


_RANKED = """SELECT sku_id, orders, row_number() OVER (ORDER BY orders DESC, sku_id) AS rank,
    orders / CAST(sum(orders) OVER () AS DOUBLE) AS share,
    sum(orders) OVER (ORDER BY orders DESC, sku_id) / CAST(sum(orders) OVER () AS DOUBLE) AS cum_share
    FROM (SELECT sku_id, count(*) AS orders FROM vorders GROUP BY sku_id)"""


@query("sku_popularity", f"SELECT sku_id, orders, rank, round(share, 6) AS share, round(cum_share, 6) AS cum_share FROM ({_RANKED})")
def sku_popularity(r: Retail) -> DataFrame:
    return rounded(profiles.sku_popularity(r.orders), "share", "cum_share")


@query("popularity_slope", f"SELECT round(regr_slope(ln(share), ln(rank)), 6) AS slope, count(*) AS n_skus FROM ({_RANKED})")
def popularity_slope(r: Retail) -> DataFrame:
    return rounded(profiles.popularity_slope(profiles.sku_popularity(r.orders)), "slope")


@query(
    "basket_distribution",
    """SELECT quantity, count(*) AS orders, round(count(*) / CAST((SELECT count(*) FROM vorders) AS DOUBLE), 6) AS share
      FROM vorders GROUP BY quantity""",
)
def basket_distribution(r: Retail) -> DataFrame:
    return rounded(profiles.basket_distribution(r.orders), "share")


@query(
    "interarrival_stats",
    """SELECT store_id, count(*) AS n_gaps, round(avg(gap), 6) AS mean_gap_s, round(stddev_samp(gap), 6) AS std_gap_s,
      round(quantile_disc(gap, 0.95), 6) AS p95_gap_s
    FROM (SELECT store_id, (epoch_us(event_time) - epoch_us(lag(event_time) OVER (PARTITION BY store_id
        ORDER BY event_time, event_id))) / 1000000.0::DOUBLE AS gap FROM vorders) WHERE gap IS NOT NULL GROUP BY store_id""",
)
def interarrival_stats(r: Retail) -> DataFrame:
    stats = profiles.interarrival_stats(r.orders)
    return rounded(stats, "mean_gap_s", "std_gap_s", "p95_gap_s")


_LEDGER_SQL = """SELECT store_id, sku_id, event_time, event_id, quantity, CAST(level_after AS INTEGER) AS level_after, sold FROM (
      WITH RECURSIVE numbered AS (SELECT *, row_number() OVER (PARTITION BY store_id, sku_id ORDER BY event_time, event_id) AS rn
          FROM vorders),
        steps AS (SELECT store_id, sku_id, event_time, event_id, quantity, rn,
            CASE WHEN 100 >= quantity THEN 100 - quantity ELSE 90 END AS level_after, 100 >= quantity AS sold
          FROM numbered WHERE rn = 1
          UNION ALL SELECT n.store_id, n.sku_id, n.event_time, n.event_id, n.quantity, n.rn,
            CASE WHEN s.level_after >= n.quantity THEN s.level_after - n.quantity ELSE 90 END, s.level_after >= n.quantity
          FROM steps s JOIN numbered n ON n.store_id = s.store_id AND n.sku_id = s.sku_id AND n.rn = s.rn + 1)
      SELECT * FROM steps)"""


@query("ledger_replay", _LEDGER_SQL)
def ledger_replay(r: Retail) -> DataFrame:
    return ledger.ledger_replay(r.orders, initial=100, restock_to=90, chunk_s=5 * 86400, hot_rows=40)


_LINE_SQL = """SELECT store_id, sku_id, window_start, window_end, order_rate, depletion_vel, demand_momentum, on_hand_est
    FROM line_features"""


@query("line_feature_rows", _LINE_SQL)
def line_feature_rows(r: Retail) -> DataFrame:
    return r.line_features.drop("updated_at")


@query(
    "line_anomaly_features",
    """SELECT store_id, sku_id, window_start, round(order_rate_zscore, 6) AS order_rate_zscore,
      round(depletion_vel_zscore, 6) AS depletion_vel_zscore FROM (SELECT *,
        coalesce((order_rate - avg(order_rate) OVER k) / nullif(stddev_samp(order_rate) OVER k, 0), 0) AS order_rate_zscore,
        coalesce((depletion_vel - avg(depletion_vel) OVER k) / nullif(stddev_samp(depletion_vel) OVER k, 0), 0) AS depletion_vel_zscore
      FROM line_features WINDOW k AS (PARTITION BY store_id, sku_id))""",
)
def line_anomaly_features(r: Retail) -> DataFrame:
    built = features.anomaly_features(r.line_features, retail.LINE_SPEC.chunk_s)
    return rounded(
        built.select(*KEYS, "window_start", "order_rate_zscore", "depletion_vel_zscore"),
        "order_rate_zscore",
        "depletion_vel_zscore",
    )


#: Rows of one file of a micro-batch, as one task writes and reads it.
FILE_ROWS = 250_000


def _in_parts(r: Retail, df: DataFrame, by: Column, parts: int) -> tuple[str, int]:
    """A folder of files to be read some a micro-batch, and how many: ``df`` cut into equal ranges of a time, range after range.

    Every range has the same number of files, so that a micro-batch is a range; the one of the fewest rows decides.
    """
    path = r.path(f"parts-{uuid.uuid4().hex}")
    timed = df.withColumn("_at", F.unix_micros(by)).persist()
    low, high = timed.agg(F.min("_at"), F.max("_at")).first()
    width = (high - low) // parts + 1
    part = F.expr(f"(_at - {low}L) div {width}L")
    sizes = {p["part"]: p["n"] for p in timed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    files = max(1, min(sizes.get(i, 0) for i in range(parts)) // FILE_ROWS)
    for i in range(parts):  # the file source reads files in the order of their times
        inside = (F.col("_at") >= low + i * width) & (F.col("_at") < low + (i + 1) * width)
        rows = timed.filter(inside).drop("_at")
        (rows.coalesce(1) if files == 1 else rows.repartition(files)).write.mode("append").parquet(path)
    timed.unpersist()
    return path, files


def _stream(r: Retail, df: DataFrame, by: Column, parts: int, delay: str, time: str = "event_time") -> DataFrame:
    """``df`` as a stream of as many micro-batches, under a watermark."""
    path, files = _in_parts(r, df, by, parts)
    return r.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path).withWatermark(time, delay)


def _run_out(r: Retail, rows: DataFrame, name: str) -> DataFrame:
    """Run a stream to the end of its input into a table of its own."""
    out = r.path(f"{name}-{uuid.uuid4().hex}")
    query = (
        rows.writeStream.format("parquet").outputMode("append").option("path", f"{out}/rows")
        .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return r.spark.read.schema(rows.schema).parquet(f"{out}/rows")


def _jitter(ident: str, width: str) -> Column:
    """A delay of arrival below ``width`` that a row's id decides."""
    most = F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00' + interval {width})")
    return F.timestamp_micros(F.unix_micros("event_time") + F.pmod(F.xxhash64(ident), most))


@query(
    "stream_join_assembly",
    f"""SELECT store_id, sku_id, window_start, window_end, order_count, total_units, depletion_units, restock_units,
      on_hand, on_hand_source, CAST(short_rate AS DOUBLE) AS short_rate, CAST(long_rate AS DOUBLE) AS long_rate FROM assembled
      WHERE {_CLOSED}""",
)
def stream_join_assembly(r: Retail) -> DataFrame:
    """Feature assembly as a stream-stream join of the three windowed aggregates, run to the end of its input."""
    delay = f"{retail.SPEC.watermark_s} seconds"
    orders, moves = (_stream(r, df, F.col("event_time"), 3, delay) for df in (r.orders, r.inventory))
    closed = _run_out(r, pipeline.joined_windows(orders, moves, retail.SPEC), "join_assembly")
    nothing = r.spark.createDataFrame([], pipeline.LEVELS)
    return pipeline.assemble_batch(closed, nothing, retail.SPEC).select(
        *KEYS, "window_start", "window_end", "order_count", "total_units", "depletion_units", "restock_units",
        "on_hand", "on_hand_source", "short_rate", "long_rate",
    )


@query("stream_ledger", f"{_LEDGER_SQL} WHERE event_time <= (SELECT max(event_time) FROM vorders) - INTERVAL 2 DAY")
def stream_ledger(r: Retail) -> DataFrame:
    """The ledger over a stream whose orders arrive up to two days late and mixed, replayed in event-time order."""
    stateful.use_rocksdb(r.spark)
    arrival = _jitter("event_id", "2 days")
    orders = _stream(r, r.orders, arrival, 4, "2 days")
    return _run_out(r, ledger_streams.ordered_ledger_stream(orders, 100, 90), "ledger")


@query(
    "stream_late_count",
    f"""SELECT CAST(b AS INTEGER) AS batch, count(DISTINCT (store_id, sku_id, pane)) FILTER (pane + INTERVAL 6 HOUR <= seen - INTERVAL 1 HOUR) AS late_windows
    FROM (SELECT *, {start_of('event_time')} AS pane FROM late_orders) LEFT JOIN
      (SELECT b, max(top) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) AS seen
        FROM (SELECT b, max(event_time) AS top FROM late_orders GROUP BY b)) USING (b) GROUP BY b""",
)
def stream_late_count(r: Retail) -> DataFrame:
    """Windows with late orders per micro-batch, as the running stream reported them; every thirteenth order is stamped forty hours back.

    A micro-batch drops what was behind the watermark that the one before it had used, that is, the newest time two batches back.
    """
    orders = r.orders.withColumn("arrived_at", F.col("event_time"))
    number = F.substring("event_id", 5, 20).cast("long")
    stamped = F.when(number % 13 == 0, F.col("event_time") - F.expr("interval 40 hours")).otherwise(F.col("event_time"))
    orders = orders.withColumn("event_time", stamped)
    stream = _stream(r, orders, F.col("arrived_at"), 8, f"{retail.SPEC.watermark_s} seconds")
    totals = pipeline.Totals()
    r.spark.streams.addListener(totals)
    try:
        query = (
            windows.tumbling_orders(stream, retail.SPEC).writeStream.outputMode("append").format("noop")
            .option("checkpointLocation", r.path(f"late-{uuid.uuid4().hex}")).trigger(availableNow=True).start()
        )
        totals.finished(query)
    finally:
        r.spark.streams.removeListener(totals)
    late = totals.late(str(query.runId))
    return r.spark.createDataFrame([(b, late.get(b, 0)) for b in range(8)], "batch INT, late_windows LONG")
