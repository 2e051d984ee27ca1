"""Whether a drift run starts a retrain, and which runs still wait for a decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.config import DriftSpec

JOBS = ("detector_retrain", "forecaster_retrain")


def _quoted(names: Column) -> Column:
    """Names as a bracketed list, each in quotes."""
    quoted = F.transform(names, lambda n: F.concat(F.lit("'"), n, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def retrain_decision(summary: DataFrame, cooldowns: DataFrame, spec: DriftSpec = DriftSpec()) -> DataFrame:
    """One decision per drift run: trigger or not, for which jobs, and why.

    ``summary`` has one row per run (drift_summary). ``cooldowns`` holds the state of the two jobs, reduced to
    two flags before it is used.
    """
    blocked = {
        job: cooldowns.agg(
            F.coalesce(F.max(F.when(F.col("job_name") == job, F.col("in_cooldown"))), F.lit(False))
        ).scalar()
        for job in JOBS
    }
    considered = ~F.col("skipped") & F.col("any_drift")
    psi_text = F.format_string("%.4f", F.col("max_psi"))
    names = _quoted(F.col("drifted_features"))
    jobs = _quoted(
        F.array_compact(
            F.array(
                F.when(F.col("trigger_detector"), F.lit("detector")),
                F.when(F.col("trigger_forecaster"), F.lit("forecaster")),
            )
        )
    )
    reason = (
        F.when(F.col("skipped"), F.concat(F.lit("drift_job skipped: "), F.coalesce("reason", F.lit("unknown"))))
        .when(~F.col("any_drift"), "No drift detected (all PSI below threshold).")
        .when(
            ~F.col("should_trigger"),
            F.concat(
                F.lit("Drift detected on "), names, F.lit(" (max PSI="), psi_text,
                F.lit(") but both jobs are in cooldown."),
            ),
        )
        .otherwise(
            F.concat(
                F.lit("Drift detected on features "), names, F.lit(" (max PSI="), psi_text,
                F.lit(f" > threshold={spec.psi_threshold}). Triggering: "), jobs, F.lit("."),
            )
        )
    )
    return (
        summary.withColumns({
            "trigger_detector": considered & ~blocked["detector_retrain"],
            "trigger_forecaster": considered & ~blocked["forecaster_retrain"],
        })
        .withColumn("should_trigger", F.col("trigger_detector") | F.col("trigger_forecaster"))
        .withColumn("decision_reason", reason)
        .withColumn(
            "drifted_features",
            F.when(considered, F.col("drifted_features")).otherwise(F.array().cast("array<string>")),
        )
        .withColumn("max_psi", F.when(F.col("skipped"), 0.0).otherwise(F.col("max_psi")))
        .select(
            *[c for c in ("run_id", "run_ts") if c in summary.columns],
            "should_trigger",
            F.col("decision_reason").alias("reason"),
            "drifted_features",
            "max_psi",
            "trigger_detector",
            "trigger_forecaster",
        )
    )


def run_requests(decisions: DataFrame) -> DataFrame:
    """One row per job to start, with a key that makes a repeated request recognisable."""
    jobs = F.array(
        F.struct(F.col("trigger_detector").alias("go"), F.lit("detector_retrain").alias("job_name")),
        F.struct(F.col("trigger_forecaster").alias("go"), F.lit("forecaster_retrain").alias("job_name")),
    )
    return (
        decisions.select("run_id", "drifted_features", "max_psi", F.explode(jobs).alias("j"))
        .filter("j.go")
        .select(
            F.concat_ws("_", "j.job_name", "run_id").alias("run_key"),
            F.col("j.job_name").alias("job_name"),
            F.array_join("drifted_features", ",").alias("drifted_features"),
            F.format_string("%.4f", "max_psi").alias("max_psi"),
        )
    )


def pending_runs(runs: DataFrame, handled: DataFrame) -> DataFrame:
    """Drift runs that no decision has handled yet."""
    return runs.join(handled.select("run_id").distinct(), "run_id", "left_anti")
