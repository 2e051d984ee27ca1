"""The retail view of one data folder: shared inputs of the named queries.

Feature rows and alerts are stored tables, as in production: the first query that needs one writes it to the
session's shared folder, later ones scan it.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.operators import drift, evaluate, features, scoring, serving, validation, windows
from stocktide.schemas import WINDOWED_FEATURES
from stocktide.sources import retail, streams
from stocktide.storage import shared_dir, written
from stocktide.streaming import pipeline, stateful


class Retail:
    def __init__(self, spark: SparkSession, sf_dir: str, generation: int = 0):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        tag = hashlib.sha256(self.sf_dir.encode()).hexdigest()[:12]
        self.root = f"{shared_dir(spark)}/{tag}-{generation}"
        self.models: dict[str, object] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stored(self, name: str, df: DataFrame) -> DataFrame:
        return written(df, self.path(name))

    def table(self, name: str) -> DataFrame:
        return retail.table(self.spark, self.sf_dir, name)

    @property
    def clock(self) -> Column:
        return retail.clock(self.spark, self.sf_dir)

    @property
    def serving_clock(self) -> Column:
        return self.clock + F.expr("interval 6 hours")

    @cached_property
    def dim_sku(self) -> DataFrame:
        return retail.dim_sku(self.spark, self.sf_dir)

    @cached_property
    def dim_store(self) -> DataFrame:
        return retail.dim_store(self.spark, self.sf_dir)

    @cached_property
    def raw_orders(self) -> DataFrame:
        return retail.raw_orders(self.spark, self.sf_dir)

    @cached_property
    def raw_inventory(self) -> DataFrame:
        return retail.raw_inventory(self.spark, self.sf_dir)

    def validated(self, kind: str) -> DataFrame:
        raw = self.raw_orders if kind == "orders" else self.raw_inventory
        return validation.validate(
            validation.parse_events(raw, kind), kind, self.dim_store, self.dim_sku, self.clock
        )

    def live_orders(self) -> DataFrame:
        """Valid orders straight from the messages."""
        return validation.project_orders(validation.valid_events(self.validated("orders")))

    def live_inventory(self) -> DataFrame:
        return validation.project_inventory(validation.valid_events(self.validated("inventory")))

    @cached_property
    def orders(self) -> DataFrame:
        return self.stored("valid_orders", self.live_orders())

    @cached_property
    def inventory(self) -> DataFrame:
        return self.stored("valid_inventory", self.live_inventory())

    @cached_property
    def panes(self) -> DataFrame:
        return self.stored("panes", windows.panes(windows.merged_events(self.orders, self.inventory), retail.SPEC))

    def assembled(self) -> DataFrame:
        return windows.assemble_panes(self.panes, retail.SPEC)

    @cached_property
    def features(self) -> DataFrame:
        return self.stored(
            "windowed_features", windows.feature_rows(self.assembled(), updated_at=F.col("window_end"))
        )

    @cached_property
    def stream_run(self) -> tuple[pipeline.StreamTables, int, str]:
        """The whole stream over files of raw messages, run to the end: its tables, the orders it counted, its checkpoint."""
        run = f"stream-{uuid.uuid4().hex}"  # a run of its own: input, checkpoints and tables
        folders = {}
        for kind, raw in (("orders", self.raw_orders), ("inventory", self.raw_inventory)):
            folders[kind] = self.path(f"{run}/in_{kind}")
            raw.select("value").write.mode("overwrite").text(folders[kind])
        now = F.lit(self.table("events").agg(F.max("ts").cast("timestamp")).first()[0])
        out, totals = self.path(f"{run}/out"), pipeline.Totals()
        stateful.use_rocksdb(self.spark)
        self.spark.streams.addListener(totals)
        try:
            queries = pipeline.start_pipeline(
                self.spark,
                streams.file_events(self.spark, folders["orders"]),
                streams.file_events(self.spark, folders["inventory"]),
                self.dim_store,
                self.dim_sku,
                out,
                retail.SPEC,
                now=now,
                clock=lambda: F.col("window_end"),
                trigger={"availableNow": True},
            )
            for q in queries:
                totals.finished(q)
        finally:
            self.spark.streams.removeListener(totals)
        return pipeline.StreamTables(self.spark, out), totals.events("orders", str(queries[0].runId)), f"{out}/checkpoints/features"

    def all_alerts(self) -> DataFrame:
        return scoring.score_rules(
            self.features, self.dim_sku, triggered_at=F.col("window_end"), alert_id=scoring.stable_alert_id()
        )

    def alert_state(self) -> DataFrame:
        return scoring.current_alerts(self.all_alerts())

    @cached_property
    def line_features(self) -> DataFrame:
        """Weekly feature rows over all order lines: the input size of this one is the largest table."""
        rows = windows.assemble_events(retail.line_events(self.spark, self.sf_dir), retail.LINE_SPEC)
        built = windows.feature_rows(rows, F.col("window_end")).select(*WINDOWED_FEATURES.names)
        return self.stored("line_windowed_features", built)

    @cached_property
    def alerts(self) -> DataFrame:
        resolved = scoring.auto_resolve(self.alert_state(), serving.latest_features(self.features), self.dim_sku)
        return self.stored("alerts", resolved)

    @cached_property
    def velocity(self) -> DataFrame:
        return serving.sku_velocity(self.features, self.serving_clock, 600 * retail.SCALE, limit=None)

    def forecast(self) -> DataFrame:
        return features.forecast_features(self.features, retail.SPEC.chunk_s)

    @cached_property
    def zscores(self) -> DataFrame:
        return self.stored("anomaly_features", features.anomaly_features(self.features, retail.SPEC.chunk_s))

    def flagged(self) -> DataFrame:
        """Rows far from their key's mean, flagged like a model would."""
        far = (F.abs("order_rate_zscore") >= 1.5) | (F.abs("depletion_vel_zscore") >= 2)
        return self.zscores.withColumn("prediction", F.when(far, -1).otherwise(1))

    def labels(self) -> DataFrame:
        return retail.anomaly_labels(self.spark, self.sf_dir).withColumn(
            "injected_at", F.to_timestamp("injected_at")
        )

    def split(self) -> DataFrame:
        return drift.time_split(self.features, retail.DRIFT)

    @cached_property
    def drift_run(self) -> tuple[DataFrame, DataFrame]:
        return drift.drift_run(self.features, retail.DRIFT)

    def drift_metrics(self) -> DataFrame:
        return self.drift_run[0]

    def drift_summary(self) -> DataFrame:
        return self.drift_run[1]

    def metric_log(self) -> DataFrame:
        return self.stored("metric_log", retail.metric_log(self.spark, self.sf_dir))

    def runs(self) -> DataFrame:
        return self.stored("model_runs", retail.model_runs(self.spark, self.sf_dir))

    def registry_events(self) -> DataFrame:
        return self.stored("registry_events", retail.registry_events(self.spark, self.sf_dir))

    def orders_clock(self) -> Column:
        """Ninety minutes after the newest order."""
        return self.table("orders").agg(
            (F.max("o_orderdate").cast("timestamp") + F.expr("interval 90 minutes"))
        ).scalar()

    def cooldown_limits(self) -> DataFrame:
        rows = [("detector_retrain", 60), ("forecaster_retrain", 120), ("never_triggered", 30)]
        return self.spark.createDataFrame(rows, "job_name STRING, cooldown_min INT")

    def detector_metrics(self) -> DataFrame:
        return evaluate.detector_metrics(
            scoring.offline_alerts(self.flagged()), self.labels(), evaluate.MATCH_WINDOW_S * retail.SCALE
        )
