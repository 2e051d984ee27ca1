"""Forecast and detector quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.operators.joins import salted_join
from stocktide.schemas import KEYS
from stocktide.storage import staged

MATCH_WINDOW_S = 120


def forecast_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: mae, rmse and mape in percent. Zero actuals are left out of mape, NaN when all are zero."""
    error = F.col(actual) - F.col(predicted)
    relative = F.when(F.col(actual) != 0, F.abs(error / F.col(actual)))
    return df.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.coalesce(F.avg(relative) * 100, F.lit(float("nan"))).alias("mape"),
    )


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def near_in_time(
    left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str, window_s: float, out: str
) -> DataFrame:
    """Add the flag ``out``: some ``right`` row with equal keys lies within ``window_s`` of the left row.

    Time is cut into buckets one window wide. A right row in the same bucket is always near; from
    the bucket before only its latest time matters, from the bucket after only its earliest. So ``right``
    collapses to one row per key and bucket before the join, no pairs are formed, and the join is a plain
    equi-join with at most one partner per row.
    """
    width = int(window_s * 1_000_000)

    def bucket(c: str) -> Column:
        return F.expr(f"floor(unix_micros(cast({c} as timestamp)) / {width})").cast("long")

    held = right.groupBy(*keys, bucket(right_ts).alias("_b")).agg(
        F.min(_micros(right_ts)).alias("_first"), F.max(_micros(right_ts)).alias("_last")
    )
    probes = F.array(*[
        F.struct(
            (F.col("_b") + d).alias("b"),
            F.lit(d == 0).alias("same"),
            F.when(F.lit(d == 1), F.col("_last")).alias("before"),
            F.when(F.lit(d == -1), F.col("_first")).alias("after"),
        )
        for d in (-1, 0, 1)
    ])
    near = (
        held.select(*keys, F.explode(probes).alias("p"))
        .groupBy(*keys, F.col("p.b").alias("_b"))
        .agg(
            F.max("p.same").alias("_same"),
            F.max("p.before").alias("_before"),
            F.min("p.after").alias("_after"),
        )
    )
    t = _micros(left_ts)
    hit = F.col("_same") | (t - F.col("_before") <= width) | (F.col("_after") - t <= width)
    return (
        salted_join(left.withColumn("_b", bucket(left_ts)), near, [*keys, "_b"], [left_ts])
        .withColumn(out, F.coalesce(hit, F.lit(False)))
        .select(*left.columns, out)
    )


def detector_metrics(
    predictions: DataFrame, labels: DataFrame, match_window_s: float = MATCH_WINDOW_S
) -> DataFrame:
    """One row: precision, recall, f1, and the sizes.

    A prediction counts when a label of the same type, store and product lies within the window. ``recall``
    is matched predictions over labels and may exceed 1; ``label_recall`` is the share of labels matched.
    """
    keys = ["anomaly_type", *KEYS]
    # Equal rows are counted first; matching then sees each (type, store, product, time) once.
    typed = predictions.withColumnRenamed("alert_type", "anomaly_type")
    typed = staged(typed.groupBy(*keys, "triggered_at").agg(F.count("*").alias("_n")))
    truth = staged(labels.groupBy(*keys, "injected_at").agg(F.count("*").alias("_n")))
    hit_rows = F.coalesce(F.sum(F.when(F.col("hit"), F.col("_n"))), F.lit(0))
    all_rows = F.coalesce(F.sum("_n"), F.lit(0))
    hits = near_in_time(typed, truth, keys, "triggered_at", "injected_at", match_window_s, "hit").agg(
        hit_rows.alias("_tp"), all_rows.alias("n_predictions")
    )
    found = near_in_time(truth, typed, keys, "injected_at", "triggered_at", match_window_s, "hit").agg(
        hit_rows.alias("_found"), all_rows.alias("n_labels")
    )
    precision = F.coalesce(F.try_divide("_tp", "n_predictions"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("_tp", "n_labels"), F.lit(0.0))
    both = F.col("_p") + F.col("_r")
    return (
        hits.withColumns({
            "n_labels": found.select("n_labels").scalar(),
            "_found": found.select("_found").scalar(),
        })
        .withColumns({"_p": precision, "_r": recall})
        .select(
            F.bround("_p", 4).alias("precision"),
            F.bround("_r", 4).alias("recall"),
            F.bround(
                F.when(both > 0, 2 * F.col("_p") * F.col("_r") / both).otherwise(0.0), 4
            ).alias("f1"),
            F.bround(F.coalesce(F.try_divide("_found", "n_labels"), F.lit(0.0)), 4).alias("label_recall"),
            "n_predictions",
            "n_labels",
        )
    )


def beats(candidate: Column, incumbent: Column, higher_is_better: bool | Column) -> Column:
    """Strictly better; NULL when either value is missing."""
    if isinstance(higher_is_better, bool):
        return candidate > incumbent if higher_is_better else candidate < incumbent
    return F.when(higher_is_better, candidate > incumbent).otherwise(candidate < incumbent)
