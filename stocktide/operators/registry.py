"""Model registry as an append-only event table, run metrics as a long log, and the promotion gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.config import PROMOTE_COOLDOWN_MIN
from stocktide.functions.expr import seconds_between
from stocktide.operators.chunks import latest_wins
from stocktide.operators.evaluate import beats

REGISTRY_EVENT = "model_name STRING, version LONG, run_id STRING, stage STRING, event_ts TIMESTAMP"


def registry_state(events: DataFrame) -> DataFrame:
    """Current stage of every version: its last event."""
    return latest_wins(events, ["model_name", "version"], ["event_ts", "stage"])


def production_versions(state: DataFrame) -> DataFrame:
    """The newest Production version per model."""
    rest = [c for c in state.columns if c != "model_name"]
    return (
        state.filter(F.col("stage") == "Production")
        .groupBy("model_name")
        .agg(F.max_by(F.struct(*rest), "version").alias("_row"))
        .select("model_name", "_row.*")
    )


def incumbent_metrics(state: DataFrame, metric_log: DataFrame, primary: DataFrame) -> DataFrame:
    """Primary metric of the Production version per model.

    ``primary`` names each model's metric and direction. Models without a Production version, or whose
    version never logged the metric, have no row. ``metric_log`` has one row per run and metric.
    """
    wanted = production_versions(state).join(primary, "model_name").withColumnRenamed("primary_metric", "metric")
    return wanted.join(metric_log.select("run_id", "metric", "value"), ["run_id", "metric"]).select(
        "model_name", "version", "run_id", "metric", F.col("value").alias("incumbent_value")
    )


def cooldown_state(triggers: DataFrame, limits: DataFrame, as_of: Column) -> DataFrame:
    """Per job of ``limits`` (job_name, cooldown_min): minutes since its last trigger and whether it must wait.

    A job that was never triggered, or whose limit is 0, does not wait.
    """
    last = triggers.groupBy("job_name").agg(F.max("triggered_at").alias("last_triggered"))
    elapsed = seconds_between(as_of, F.col("last_triggered")) / 60
    return (
        limits.join(last, "job_name", "left")
        .withColumn("elapsed_min", elapsed)
        .withColumn("in_cooldown", F.coalesce(F.col("elapsed_min") < F.col("cooldown_min"), F.lit(False)))
    )


def promotion_gate(
    candidates: DataFrame,
    incumbents: DataFrame,
    last_promotions: DataFrame,
    as_of: Column,
    cooldown_min: float = PROMOTE_COOLDOWN_MIN,
) -> DataFrame:
    """Decide per candidate (model_name, run_id, value, higher_is_better).

    In order: cooldown refuses; no incumbent promotes; a missing value refuses; else strictly better promotes.
    """
    elapsed = seconds_between(as_of, F.col("promoted_at")) / 60
    waiting = F.coalesce(elapsed < cooldown_min, F.lit(False))
    no_incumbent = F.col("_known").isNull()
    missing = F.col("value").isNull() | F.col("incumbent_value").isNull()
    better = F.coalesce(beats(F.col("value"), F.col("incumbent_value"), F.col("higher_is_better")), F.lit(False))
    known = incumbents.select("model_name", "incumbent_value", F.lit(True).alias("_known"))
    last = last_promotions.select("model_name", "promoted_at")
    return (
        candidates.join(known, "model_name", "left")
        .join(last, "model_name", "left")
        .withColumns({
            "reason": F.when(waiting, "cooldown")
            .when(no_incumbent, "no_incumbent")
            .when(missing, "metric_missing")
            .when(better, "better")
            .otherwise("not_better"),
            "beats_incumbent": better,
        })
        .withColumn("promote", F.col("reason").isin("no_incumbent", "better"))
        .select("model_name", "run_id", "value", "incumbent_value", "beats_incumbent", "promote", "reason")
    )


def transitions(state: DataFrame, decisions: DataFrame, as_of: Column) -> DataFrame:
    """Registry events to append: the promoted run becomes the next version, old Production is archived."""
    promoted = decisions.filter("promote").select("model_name", "run_id")
    next_version = state.groupBy("model_name").agg(F.max("version").alias("_last"))
    new = promoted.join(next_version, "model_name", "left").select(
        "model_name",
        (F.coalesce("_last", F.lit(0)) + 1).cast("long").alias("version"),
        "run_id",
        F.lit("Production").alias("stage"),
        as_of.alias("event_ts"),
    )
    old = (
        state.filter(F.col("stage") == "Production")
        .join(promoted.select("model_name"), "model_name", "left_semi")
        .select("model_name", "version", "run_id", F.lit("Archived").alias("stage"), as_of.alias("event_ts"))
    )
    return new.unionByName(old)


def latest_run_metrics(metric_log: DataFrame) -> DataFrame:
    """Value of every metric of the newest run per experiment."""
    runs = metric_log.groupBy("experiment").agg(
        F.max_by("run_id", F.struct("start_time", "run_id")).alias("run_id")
    )
    return metric_log.join(runs, ["experiment", "run_id"], "left_semi").select(
        "experiment", "run_id", "metric", "value", "start_time"
    )


def run_metric_rows(metrics: DataFrame, experiment: str, run_id: str, start_time: Column) -> DataFrame:
    """A one-row metric frame as rows of the long metric log."""
    numeric = [c for c, t in metrics.dtypes if t in ("double", "float", "int", "bigint")]
    wide = metrics.select(*[F.col(c).cast("double").alias(c) for c in numeric])
    return wide.unpivot([], numeric, "metric", "value").select(
        F.lit(experiment).alias("experiment"), F.lit(run_id).alias("run_id"),
        start_time.alias("start_time"), "metric", "value",
    )
