"""What the retrain loop remembers between passes: triggers, registry events and run parameters.

Each is an append log of small Parquet folders, one per pass or run, which only overwrites itself; a pass that is done
again leaves the same rows. Files under a log follow the number of retrains, not the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stocktide.config import DriftSpec
from stocktide.operators import registry, retrain
from stocktide.storage import listed

TRIGGERS = "job_name STRING, run_key STRING, triggered_at TIMESTAMP, cleared BOOLEAN"
EVENTS = "model_name STRING, version LONG, run_id STRING, stage STRING, event_ts TIMESTAMP"
PARAMETERS = "experiment STRING, parameter STRING, value STRING, run_id STRING"


class LoopState:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _append(self, rows: DataFrame, log: str, name: str, schema: str) -> None:
        fields = [c.split()[0] for c in schema.split(", ")]
        rows.select(*fields).write.mode("overwrite").parquet(f"{self.path}/{log}/pass={name}")

    def _log(self, log: str, schema: str, without: str | None = None) -> DataFrame:
        """All rows of a log, but for those of the pass ``without``, which a retry of that pass must not see."""
        path = f"{self.path}/{log}"
        folders = [f"{path}/{f}" for f in listed(self.spark, path) if f != f"pass={without}"]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def triggers(self, without: str | None = None) -> DataFrame:
        """Triggers that still count: those after the last time their job's cooldown was cleared."""
        log = self._log("triggers", TRIGGERS, without)
        cleared = log.filter("cleared").groupBy("job_name").agg(F.max("triggered_at").alias("_cleared_at"))
        kept = log.filter("NOT cleared").join(cleared, "job_name", "left")
        return kept.filter("_cleared_at IS NULL OR triggered_at > _cleared_at").select("job_name", "run_key", "triggered_at")

    def record_triggers(self, requests: DataFrame, name: str, at: Column) -> None:
        """Remember the started jobs of a pass, so their cooldown begins."""
        rows = requests.select("job_name", "run_key", at.alias("triggered_at"), F.lit(False).alias("cleared"))
        self._append(rows, "triggers", name, TRIGGERS)

    def clear_cooldown(self, job_name: str, name: str, at: Column) -> None:
        row = self.spark.range(1).select(
            F.lit(job_name).alias("job_name"), F.lit(None).cast("string").alias("run_key"), at.alias("triggered_at"), F.lit(True).alias("cleared")
        )
        self._append(row, "triggers", name, TRIGGERS)

    def events(self, without: str | None = None) -> DataFrame:
        return self._log("registry", EVENTS, without)

    def promote(self, decisions: DataFrame, name: str, at: Column) -> None:
        """Append the registry events that the decisions (model_name, run_id, promote) call for."""
        state = registry.registry_state(self.events(without=name))
        self._append(registry.transitions(state, decisions, at), "registry", name, EVENTS)

    def production(self, model_name: str, folder_of=lambda version, run_id: run_id) -> tuple[int, str] | None:
        """(version, path) of the Production model, the look-up that ``ModelSlot`` takes; None before the first."""
        state = registry.production_versions(registry.registry_state(self.events()))
        row = state.filter(F.col("model_name") == model_name).first()
        return (row["version"], folder_of(row["version"], row["run_id"])) if row else None

    def record_parameters(self, experiment: str, run_id: str, parameters: dict[str, object]) -> None:
        """The settings a run was made with, beside its metrics."""
        rows = [(experiment, k, str(v), run_id) for k, v in sorted(parameters.items())]
        self._append(self.spark.createDataFrame(rows, PARAMETERS), "parameters", run_id, PARAMETERS)

    def parameters(self) -> DataFrame:
        return self._log("parameters", PARAMETERS)


def retrain_pass(
    state: LoopState, summary: DataFrame, limits: DataFrame, name: str, at: Column, spec: DriftSpec = DriftSpec()
) -> DataFrame:
    """Decide on drift runs with the remembered cooldowns, remember what is started, and return the requests.

    A pass that is done again decides on what was remembered before it, so a retry starts nothing twice.
    """
    cooldowns = registry.cooldown_state(state.triggers(without=name), limits, at)
    decided = retrain.retrain_decision(summary, cooldowns, spec)
    requests = retrain.run_requests(decided).withColumn("run_key", F.concat(F.lit(f"{name}:"), "run_key"))
    state.record_triggers(requests, name, at)
    return state.triggers().filter(F.col("run_key").startswith(f"{name}:"))


REQUESTS = "run_key STRING, job_name STRING, run_id STRING, drifted_features STRING, max_psi STRING, batch LONG"


def start_decisions(
    summaries: DataFrame, cooldowns: Callable[[], DataFrame], path: str, checkpoint: str, within: str = "7 days",
    spec: DriftSpec = DriftSpec(), trigger: dict | None = None,
) -> StreamingQuery:
    """Decide on a stream of drift summaries (run_id, run_ts, ...) and store the requests below ``path``, one folder a batch.

    A summary that is sent again ``within`` that time of its first copy starts nothing: the ids seen are state under a watermark.
    A batch that is run again writes its own folder again. ``cooldowns`` is asked once per batch.
    """
    once = summaries.withWatermark("run_ts", within).dropDuplicatesWithinWatermark(["run_id"])

    def decide(batch: DataFrame, batch_id: int) -> None:
        decided = retrain.retrain_decision(batch, cooldowns(), spec)
        # a request's key is its job and its run
        requests = retrain.run_requests(decided).withColumn("run_id", F.expr("substr(run_key, length(job_name) + 2)"))
        fields = [c.split()[0] for c in REQUESTS.split(", ")][:-1]
        requests.select(*fields).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        once.writeStream.outputMode("append").foreachBatch(decide).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"})).start()
    )


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REQUESTS).parquet(path)
