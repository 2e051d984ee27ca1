"""The stream: raw events → validation → windowed features → alerts.

Both inputs are validated with the batch operators and merged into one stateful aggregation: a sliding
window is as long as the long rate needs, and the short measures are taken from its last pane. State is one
row per key and open window; Spark aggregates partially before the shuffle, so a hot key stays cheap.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from stocktide import schemas
from stocktide.config import ScoringSpec, WindowSpec
from stocktide.operators import scoring, serving, validation, windows
from stocktide.operators.chunks import carry_forward
from stocktide.operators.iforest import Forest
from stocktide.schemas import KEYS
from stocktide.streaming.sinks import UpsertTable

LEVELS = T.StructType([
    T.StructField("store_id", T.StringType()),
    T.StructField("sku_id", T.StringType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("on_hand_latest", T.IntegerType()),
])


def validated_events(
    raw: DataFrame, kind: str, stores: DataFrame, skus: DataFrame, now: Column | None = None
) -> DataFrame:
    return validation.validate(validation.parse_events(raw, kind), kind, stores, skus, now)


def dead_letter_stream(
    orders: DataFrame, inventory: DataFrame, orders_topic: str = "raw-orders", inventory_topic: str = "raw-inventory"
) -> DataFrame:
    """Rejects of both validated inputs as one stream."""
    return validation.dead_letters(orders, orders_topic).unionByName(
        validation.dead_letters(inventory, inventory_topic)
    )


def window_stream(orders: DataFrame, inventory: DataFrame, spec: WindowSpec) -> DataFrame:
    """Closed windows of two validated streams: order and stock measures of the last pane, and the long rate.

    Each input carries its own watermark; the slower one decides when a window closes. Rows later than that
    are dropped.
    """
    delay = f"{spec.watermark_s} seconds"
    valid_orders = counted(validation.project_orders(validation.valid_events(orders))).withWatermark("event_time", delay)
    valid_moves = validation.project_inventory(validation.valid_events(inventory)).withWatermark("event_time", delay)
    merged = windows.merged_events(valid_orders, valid_moves).withColumn(
        "w", F.window("event_time", spec.long, spec.short)
    )
    last_pane = F.col("event_time") >= F.col("w.end") - F.expr(f"interval {spec.short}")
    return (
        merged.groupBy(*KEYS, "w")
        .agg(F.count_if("is_order").alias("long_count"), *windows.pane_measures(last_pane))
        .select(
            *KEYS,
            (F.col("w.end") - F.expr(f"interval {spec.short}")).alias("window_start"),
            F.col("w.end").alias("window_end"),
            "order_count", "total_units", "depletion_units", "restock_units", "on_hand_latest", "long_count",
        )
        .filter((F.col("order_count") > 0) | F.col("on_hand_latest").isNotNull())
    )


def open_windows(spark: SparkSession, checkpoint: str, spec: WindowSpec) -> DataFrame:
    """The windows that a stopped or running query of ``window_stream`` has not closed yet, read from its stored state."""
    measures = (
        "long_count: bigint, order_count: bigint, total_units: bigint, depletion_units: bigint, restock_units: bigint, on_hand_latest: int, "
        "at: struct<event_time: timestamp, event_id: string>"
    )
    state = spark.read.format("statestore").load(checkpoint).select("key", F.col("value").cast(f"struct<{measures}>").alias("v"))
    sums = [F.coalesce(f"v.{c}", F.lit(0)).alias(c) for c in ("long_count", "order_count", "total_units", "depletion_units", "restock_units")]
    return state.select(
        "key.store_id", "key.sku_id", (F.col("key.w.end") - F.expr(f"interval {spec.short}")).alias("window_start"),
        F.col("key.w.end").alias("window_end"), *sums, "v.on_hand_latest",
    )


def window_join_stream(orders: DataFrame, inventory: DataFrame, spec: WindowSpec) -> DataFrame:
    """The rows of ``window_stream`` as a stream-stream join of three windowed aggregates.

    Short order windows meet the long windows that end with them (left outer) and the stock windows (full outer, since
    a stock level without orders is carried on). All three are joined on the key and the window's time under the
    watermark, so a row leaves the state when its window has closed. Costs two more state stores than the
    single aggregation and is for aggregates that come from streams of their own.
    """
    delay = f"{spec.watermark_s} seconds"
    valid_orders = validation.project_orders(validation.valid_events(orders)).withWatermark("event_time", delay)
    valid_moves = validation.project_inventory(validation.valid_events(inventory)).withWatermark("event_time", delay)
    return joined_windows(valid_orders, valid_moves, spec)


def joined_windows(orders: DataFrame, moves: DataFrame, spec: WindowSpec) -> DataFrame:
    """The join of ``window_join_stream`` for valid rows that carry their watermarks."""
    delta = F.col("delta_units")
    short = orders.groupBy(*KEYS, F.window("event_time", spec.short).alias("w")).agg(
        F.count("*").alias("order_count"), F.sum("quantity").alias("total_units")
    )
    long = orders.groupBy(*KEYS, F.window("event_time", spec.long, spec.short).alias("w")).agg(F.count("*").alias("long_count"))
    stock = moves.groupBy(*KEYS, F.window("event_time", spec.short).alias("w")).agg(
        F.coalesce(F.sum(F.when(delta < 0, -delta)), F.lit(0)).alias("depletion_units"),
        F.coalesce(F.sum(F.when(F.col("movement_type") == "restock", delta)), F.lit(0)).alias("restock_units"),
        F.max_by("on_hand_after", F.struct("event_time", "event_id")).alias("on_hand_latest"),
    )
    # the last moment of a window keeps the watermark; it names short and long windows that end together
    short, long, stock = (f.withColumn("at", F.window_time("w")).drop("w") for f in (short, long, stock))
    joined = short.join(long, [*KEYS, "at"], "left_outer").join(stock, [*KEYS, "at"], "full_outer")
    end = F.col("at") + F.expr("interval 1 microsecond")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("order_count", "total_units", "depletion_units", "restock_units")]
    return joined.select(
        *KEYS, (end - F.expr(f"interval {spec.short}")).alias("window_start"), end.alias("window_end"), *zero,
        "on_hand_latest", F.coalesce("long_count", F.lit(0)).alias("long_count"),
    )


def assemble_batch(batch: DataFrame, levels: DataFrame, spec: WindowSpec) -> DataFrame:
    """Emitted windows plus the stored stock levels to assembled rows, like the batch operator's."""
    known = levels.select(*KEYS, "window_start", "on_hand_latest", F.lit(True).alias("_stored"))
    rows = batch.withColumn("_stored", F.lit(False)).unionByName(known, allowMissingColumns=True)
    carried = carry_forward(rows, KEYS, ["window_start", "_stored"], "on_hand_latest", spec.chunk_s, "on_hand")
    return (
        carried.filter(~F.col("_stored") & (F.col("order_count") > 0))
        .withColumns({
            "on_hand_source": F.when(F.col("on_hand_latest").isNotNull(), "window")
            .when(F.col("on_hand").isNotNull(), "carried")
            .otherwise("none"),
            "short_rate": F.col("order_count") / F.lit(spec.short_s / spec.rate_unit_s),
            "long_rate": F.col("long_count") / F.lit(spec.long_s / spec.rate_unit_s),
        })
        .drop("_stored", "long_count", "on_hand_latest")
    )


@dataclass
class ModelSlot:
    """The anomaly model in use; looks for a newer Production version once per poll interval.

    ``current`` returns (version, path) of the Production model or None. A failing look-up or load keeps
    the model that is in use.
    """

    spark: SparkSession
    current: Callable[[], tuple[int, str] | None]
    poll_s: float = 300.0
    version: int | None = None
    forest: Forest | None = None
    last_error: str = ""
    _looked_at: float = field(default=float("-inf"))

    def refresh(self) -> Forest | None:
        if time.monotonic() - self._looked_at >= self.poll_s:
            self._looked_at = time.monotonic()
            try:
                found = self.current()
                if found and found[0] != self.version:
                    self.forest = Forest.load(self.spark, found[1])
                    self.version = found[0]
            except Exception as error:  # a broken registry must not stop the stream
                self.last_error = str(error)
        return self.forest


@dataclass
class StreamTables:
    """Tables the stream keeps below one folder."""

    spark: SparkSession
    path: str

    @property
    def features(self) -> UpsertTable:
        return UpsertTable(self.spark, f"{self.path}/features", schemas.WINDOWED_FEATURES, schemas.FEATURE_KEY,
                           ["updated_at"], day_of="window_start")

    @property
    def alerts(self) -> UpsertTable:
        return UpsertTable(self.spark, f"{self.path}/alerts", schemas.ALERTS, schemas.ALERT_KEY, ["triggered_at"])

    @property
    def levels(self) -> UpsertTable:
        return UpsertTable(self.spark, f"{self.path}/levels", LEVELS, KEYS, ["window_start"])


def score_batch(
    features: DataFrame, dim_sku: DataFrame, spec: ScoringSpec, slot: ModelSlot | None,
    triggered_at: Column | None = None,
) -> DataFrame:
    """Alerts of a batch: gated by the model when one is loaded, by rule otherwise."""
    forest = slot.refresh() if slot else None
    ident = scoring.stable_alert_id()
    if forest is None:
        return scoring.score_rules(features, dim_sku, spec, triggered_at, ident)
    return scoring.score_with_model(forest.predict_online(features), dim_sku, spec, triggered_at, ident)


def settle(
    table: UpsertTable, alerts: DataFrame, features: DataFrame, dim_sku: DataFrame, spec: ScoringSpec, writer: str, batch_id: int
) -> None:
    """Upsert a batch's alerts, and resolve those of its keys, new or old, that its newest windows show to be over."""
    newest = serving.latest_features(features)
    known = table.read(without=(writer, batch_id)).join(newest.select(*KEYS).hint("merge"), KEYS, "left_semi")
    state = scoring.current_alerts(known.unionByName(alerts.select(*schemas.ALERTS.names)))
    table.upsert(scoring.auto_resolve(state, newest, dim_sku, spec), batch_id, writer)


def batch_writer(
    tables: StreamTables,
    dim_sku: DataFrame,
    spec: WindowSpec,
    scoring_spec: ScoringSpec = ScoringSpec(),
    slot: ModelSlot | None = None,
    send: Callable[[DataFrame], None] | None = None,
    clock: Callable[[], Column] | None = None,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: upsert features, levels and alerts, resolve alerts that are over; hand routed messages to ``send``.

    ``clock`` gives the write time as a column; the time at the start of the batch when left out. Alerts are computed
    once, so the table and the messages carry the same rows and stamps. If scoring by model fails, the batch is
    scored by rule.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = tables.spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        now = clock() if clock else F.lit(datetime.now(timezone.utc))
        batch = batch.persist()
        held = [batch]
        try:
            if batch.isEmpty():  # the batches that only move the watermark
                return
            # A retried batch must see the levels that held before its first attempt.
            levels = tables.levels.read(without=(writer, batch_id))
            features = windows.feature_rows(assemble_batch(batch, levels, spec), now).persist()
            held.append(features)
            tables.features.upsert(features.drop("on_hand_source"), batch_id, writer)
            try:
                alerts = score_batch(features, dim_sku, scoring_spec, slot, now).persist()
                held.append(alerts)
                settle(tables.alerts, alerts, features, dim_sku, scoring_spec, writer, batch_id)
            except Exception as error:
                if slot is None or slot.forest is None:
                    raise
                slot.last_error = str(error)
                alerts = scoring.score_rules(features, dim_sku, scoring_spec, now, scoring.stable_alert_id()).persist()
                held.append(alerts)
                settle(tables.alerts, alerts, features, dim_sku, scoring_spec, writer, batch_id)
            if send:
                send(scoring.route_alerts(alerts))
            tables.levels.upsert(batch.filter(F.col("on_hand_latest").isNotNull()), batch_id, writer)
        finally:
            for frame in reversed(held):
                frame.unpersist()

    return write


def start_features(
    windows_stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    return (
        windows_stream.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def start_dead_letters(dead: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Rejects to Parquet."""
    return (
        dead.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def start_dead_letter_topic(dead: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Rejects to a Kafka topic as JSON, at least once. Needs the connector on the class path."""
    return (
        validation.as_message(dead)
        .writeStream.outputMode("append")
        .format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def console_tap(df: DataFrame) -> StreamingQuery:
    """Print rows, for local work."""
    return df.writeStream.outputMode("append").format("console").start()


def counted(df: DataFrame, name: str = "orders") -> DataFrame:
    """Report the number of rows that pass per micro-batch under ``name`` in the query progress."""
    return df.observe(name, F.count(F.lit(1)).alias("events"))


class Totals(StreamingQueryListener):
    """Running totals read from the progress of running queries: observed rows, and groups that came behind the watermark.

    ``spark.streams.addListener(Totals())`` starts it. A batch that is reported again counts once. Of late rows Spark reports those
    that reach the state, which in an aggregation are the different (key, window) groups of a micro-batch.
    """

    def __init__(self):
        self._events: dict[tuple[str, int], dict[str, int]] = {}
        self._late: dict[tuple[str, int], int] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        batch = (str(progress.runId), progress.batchId)
        found = {name: row["events"] for name, row in progress.observedMetrics.items() if "events" in row.asDict()}
        if found:
            self._events[batch] = found
        self._late[batch] = max(self._late.get(batch, 0), sum(o.numRowsDroppedByWatermark for o in progress.stateOperators))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def finished(self, query: StreamingQuery, timeout: float = 60.0) -> None:
        """Wait until a query has ended and everything it reported has been counted."""
        query.awaitTermination()
        if not self._end(str(query.runId)).wait(timeout):
            raise TimeoutError("the query's progress did not arrive")

    def events(self, name: str = "orders", run_id: str | None = None) -> int:
        return sum(found.get(name, 0) for (run, _), found in list(self._events.items()) if run_id in (None, run))

    def late(self, run_id: str) -> dict[int, int]:
        """Late groups per micro-batch of one run."""
        return {batch: n for (run, batch), n in list(self._late.items()) if run == run_id}


def start_pipeline(
    spark: SparkSession,
    raw_orders: DataFrame,
    raw_inventory: DataFrame,
    stores: DataFrame,
    skus: DataFrame,
    path: str,
    spec: WindowSpec = WindowSpec(),
    scoring_spec: ScoringSpec = ScoringSpec(),
    slot: ModelSlot | None = None,
    send: Callable[[DataFrame], None] | None = None,
    now: Column | None = None,
    clock: Callable[[], Column] | None = None,
    trigger: dict | None = None,
) -> list[StreamingQuery]:
    """Start the feature and the dead-letter query; tables and checkpoints go below ``path``."""
    orders = validated_events(raw_orders, "orders", stores, skus, now)
    inventory = validated_events(raw_inventory, "inventory", stores, skus, now)
    write = batch_writer(StreamTables(spark, path), skus, spec, scoring_spec, slot, send, clock)
    closed = window_stream(orders, inventory, spec)
    return [
        start_features(closed, write, f"{path}/checkpoints/features", trigger),
        start_dead_letters(
            dead_letter_stream(orders, inventory), f"{path}/dead_letters", f"{path}/checkpoints/dead_letters", trigger
        ),
    ]
