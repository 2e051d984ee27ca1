"""Distribution drift between a current and a reference slice of the feature table.

All monitored features go through one long frame, collapsed to counts per distinct value with partial
aggregation. Histograms and the Kolmogorov–Smirnov statistic are computed from those counts; the latter
orders values in parts of even size.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktide.config import DriftSpec
from stocktide.operators.chunks import running_totals
from stocktide.operators.features import holdout_split
from stocktide.schemas import KEYS
from stocktide.storage import staged

# Share given to an empty histogram bin, so that its logarithm exists. Nothing is renormalised.
EMPTY_BIN_SHARE = 1e-4


def latest_window_end(df: DataFrame) -> Column:
    """As-of time of a drift run: the newest window end in the data.

    One value, fetched before the run is planned, so that the time filters reach the scan as literals and
    skip files and row groups.
    """
    return F.lit(df.agg(F.max("window_end")).first()[0]).cast("timestamp")


def time_split(df: DataFrame, spec: DriftSpec = DriftSpec(), as_of: Column | None = None) -> DataFrame:
    """Add ``side``: current within ``current_s`` of the as-of time, reference in the ``reference_s`` before."""
    as_of = latest_window_end(df) if as_of is None else as_of
    current_from = as_of - F.expr(f"interval {spec.current_s} seconds")
    reference_from = as_of - F.expr(f"interval {spec.current_s + spec.reference_s} seconds")
    ended = F.col("window_end")
    return df.filter(ended >= reference_from).withColumn(
        "side", F.when(ended >= current_from, "current").otherwise("reference")
    )


def fraction_split(df: DataFrame, spec: DriftSpec = DriftSpec()) -> DataFrame:
    """Add ``side`` by row share: the newest ``fallback_current_frac`` of the rows is current."""
    return (
        holdout_split(df, spec.fallback_current_frac, ts="window_end")
        .withColumn("side", F.when(F.col("is_train"), "reference").otherwise("current"))
        .drop("is_train")
    )


def side_counts(split: DataFrame) -> DataFrame:
    """One row: rows on each side."""
    return split.agg(
        F.count_if(F.col("side") == "current").alias("n_current"),
        F.count_if(F.col("side") == "reference").alias("n_reference"),
    )


def drift_sides(df: DataFrame, spec: DriftSpec = DriftSpec(), as_of: Column | None = None) -> DataFrame:
    """Time split, or the row-share split where the time split leaves too few rows on a side."""
    timed = time_split(df, spec, as_of)
    found = side_counts(timed).first()
    enough = found["n_current"] >= spec.min_current and found["n_reference"] >= spec.min_reference
    return timed if enough else fraction_split(df, spec)


def value_counts(split: DataFrame, spec: DriftSpec = DriftSpec()) -> DataFrame:
    """Rows per (feature, distinct value) on each side, without NULLs; columns the frame lacks are skipped.

    Every statistic below is computed from this table, so the feature rows are read once per drift run.
    """
    present = [f for f in spec.features if f in split.columns]
    return (
        split.select("side", *[F.col(c).cast("double").alias(c) for c in present])
        .unpivot("side", present, "feature", "value")
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("feature", "value")
        .agg(
            F.count_if(F.col("side") == "reference").alias("reference"),
            F.count_if(F.col("side") == "current").alias("current"),
        )
    )


def value_ranges(counts: DataFrame) -> DataFrame:
    """Joint minimum and maximum and both sample sizes per feature: as many rows as there are features."""
    return counts.groupBy("feature").agg(
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
        F.sum("current").alias("n_current"),
        F.sum("reference").alias("n_reference"),
    )


def _with_ranges(counts: DataFrame, ranges: DataFrame, spec: DriftSpec) -> DataFrame:
    # One row per monitored feature, a list fixed in the settings: broadcasting it cannot grow with the data.
    assert len(spec.features) <= 1000
    return counts.join(F.broadcast(ranges), "feature")


def _edge(i: Column | int, bins: int) -> Column:
    i = F.lit(i) if isinstance(i, int) else i
    return F.col("lo") + i * ((F.col("hi") - F.col("lo")) / bins)


def equal_width_bin(bins: int) -> Column:
    """Bin 1..``bins`` of ``value`` between ``lo`` and ``hi``; the last bin includes its right edge.

    Counting the inner edges at or below the value gives the same answer as comparing with the edge list.
    """
    at_or_above = [(F.col("value") >= _edge(i, bins)).cast("int") for i in range(1, bins)]
    return reduce(lambda a, b: a + b, at_or_above, F.lit(1))


def histogram(counts: DataFrame, spec: DriftSpec = DriftSpec(), ranges: DataFrame | None = None) -> DataFrame:
    """Counts per (feature, bin) and side, empty bins included. Constant features have no bins."""
    ranges = value_ranges(counts) if ranges is None else ranges
    ranges = ranges.filter(F.col("lo") < F.col("hi"))
    counted = (
        _with_ranges(counts, ranges, spec)
        .groupBy("feature", equal_width_bin(spec.bins).alias("bin"))
        .agg(F.sum("reference").alias("reference"), F.sum("current").alias("current"))
    )
    grid = ranges.select(
        "feature",
        "n_reference",
        "n_current",
        F.explode(F.sequence(F.lit(1), F.lit(spec.bins))).alias("bin"),
    )
    zero = F.lit(0)
    return grid.join(counted, ["feature", "bin"], "left").withColumns({
        "reference": F.coalesce("reference", zero),
        "current": F.coalesce("current", zero),
    })


def psi(bins: DataFrame) -> DataFrame:
    """Population stability index per feature."""
    floor = F.lit(EMPTY_BIN_SHARE)
    r = F.when(F.col("reference") == 0, floor).otherwise(F.col("reference") / F.col("n_reference"))
    c = F.when(F.col("current") == 0, floor).otherwise(F.col("current") / F.col("n_current"))
    return bins.groupBy("feature").agg(F.round(F.abs(F.sum((c - r) * F.ln(c / r))), 6).alias("psi"))


def js_divergence(bins: DataFrame) -> DataFrame:
    """Jensen–Shannon divergence in bits per feature, clamped to 1."""
    p, q = F.col("reference") / F.col("n_reference"), F.col("current") / F.col("n_current")
    m = (p + q) * 0.5

    def divergence(a: Column) -> Column:
        return F.sum(F.when(a > 0, a * F.log2(a / m)).otherwise(0.0))

    total = divergence(p) * 0.5 + divergence(q) * 0.5
    return bins.groupBy("feature").agg(F.round(F.least(F.abs(total), F.lit(1.0)), 6).alias("js_div"))


def ks_statistic(counts: DataFrame, spec: DriftSpec = DriftSpec(), ranges: DataFrame | None = None) -> DataFrame:
    """Largest gap between the two empirical distribution functions per feature, with the sample sizes."""
    ranges = value_ranges(counts) if ranges is None else ranges
    wanted = _with_ranges(counts, ranges, spec).select("feature", "value", "reference", "current")
    totals = running_totals(wanted, ["feature"], "value", ["reference", "current"])
    gap = F.abs(
        F.col("cum_reference") / F.col("all_reference") - F.col("cum_current") / F.col("all_current")
    )
    return totals.groupBy("feature").agg(
        F.max(gap).alias("ks"),
        F.max("all_reference").alias("n_reference"),
        F.max("all_current").alias("n_current"),
    )


def kolmogorov_pvalue(ks: Column, n1: Column, n2: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided p-value; 1 when the statistic is 0."""
    effective = n1 * n2 / (n1 + n2)
    lam2 = effective * ks * ks
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam2),
    )
    return F.when(ks <= 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * series)))


def exact_ks_pvalue(ks: float, n1: int, n2: int) -> float:
    """Exact two-sided p-value: the chance that a random interleaving of the samples leaves the band.

    Draw by draw, ``chance`` has the probability of having taken j values of the smaller sample without the two
    distribution functions ever having been ``ks`` or more apart, for the j inside that band only. A statistic whose
    p-value is below the resolution of 1 - chance (Massart's bound for each sample) needs no draws.
    """
    a, b = max(n1, n2), min(n1, n2)
    lcm = a * b // math.gcd(a, b)
    limit = round(ks * lcm)
    if limit == 0:
        return 1.0
    if 4 * math.exp(-2 * a * b * (limit / lcm) ** 2 / (math.sqrt(a) + math.sqrt(b)) ** 2) < 1e-17:
        return 0.0
    step_a, step_b = lcm // a, lcm // b
    both = step_a + step_b
    low, chance = 0, np.ones(1)
    for drawn in range(a + b):
        left = a + b - drawn
        j = np.arange(low, low + len(chance))
        grown = np.append(chance * (a - drawn + j) / left, 0.0)
        grown[1:] += chance * (b - j) / left
        d = drawn + 1
        first = max(0, d - a, (d * step_a - limit) // both + 1)
        last = min(b, d, -((-d * step_a - limit) // both) - 1)
        if first > last:
            return 1.0
        low, chance = first, grown[first - low:last - low + 1]
    return float(min(1.0, max(0.0, 1.0 - chance[0])))


@F.pandas_udf(T.DoubleType())
def _exact_ks_pvalues(ks: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    return pd.Series([exact_ks_pvalue(d, int(a), int(b)) for d, a, b in zip(ks, n1, n2)], dtype="float64")


def ks_test(
    counts: DataFrame, spec: DriftSpec = DriftSpec(), method: str = "asymptotic", ranges: DataFrame | None = None
) -> DataFrame:
    """Statistic and p-value per feature: the series by default, at any sample size. ``method="exact"`` asks for the exact
    two-sample distribution instead, whose cost is the product of the sample sizes."""
    stat = ks_statistic(counts, spec, ranges)
    if method == "exact":
        pvalue = _exact_ks_pvalues("ks", "n_reference", "n_current")
    else:
        pvalue = kolmogorov_pvalue(F.col("ks"), F.col("n_reference"), F.col("n_current"))
    return stat.select(
        "feature", F.round("ks", 6).alias("ks_stat"), F.round(pvalue, 6).alias("ks_pval")
    )


def exact_ks_by_key(split: DataFrame, spec: DriftSpec = DriftSpec(), keys: list[str] = KEYS) -> DataFrame:
    """Statistic and exact p-value per key and feature, for the small samples that the series is too rough for.

    A key has one row per window, so a sample is as long as the split's horizon has windows, however many rows the table has. Distribution
    functions are windows inside a key; the exact distributions, whose cost is the product of both sample sizes, are spread over
    tasks by key and feature. Keys without rows on one side have no row.
    """
    present = [f for f in spec.features if f in split.columns]
    values = (
        split.select(*keys, "side", *[F.col(c).cast("double").alias(c) for c in present])
        .unpivot([*keys, "side"], present, "feature", "value").filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy(*keys, "feature", "value")
        .agg(F.count_if(F.col("side") == "reference").alias("reference"), F.count_if(F.col("side") == "current").alias("current"))
    )
    sample = Window.partitionBy(*keys, "feature")
    upto = sample.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {f"{name}_{side}": F.sum(side).over(w) for side in ("reference", "current") for name, w in (("cum", upto), ("all", sample))}
    gap = F.abs(F.col("cum_reference") / F.col("all_reference") - F.col("cum_current") / F.col("all_current"))
    found = (
        values.withColumns(sums).filter("all_reference > 0 AND all_current > 0").groupBy(*keys, "feature")
        .agg(F.max(gap).alias("ks"), F.max("all_reference").alias("n_reference"), F.max("all_current").alias("n_current"))
        .repartition(*keys, "feature")
    )
    return found.select(
        *keys, "feature", F.round("ks", 6).alias("ks_stat"),
        F.round(_exact_ks_pvalues("ks", "n_reference", "n_current"), 6).alias("ks_pval"),
    )


def drift_metrics(split: DataFrame, spec: DriftSpec = DriftSpec(), ks_method: str = "asymptotic") -> DataFrame:
    """The drift table: psi, ks_stat, ks_pval, js_div and the drifted flag per feature.

    Features with too few values on a side have no row; a constant feature has psi and js 0.
    """
    counts = staged(value_counts(split, spec))
    ranges = value_ranges(counts).filter(
        (F.col("n_current") >= spec.min_values) & (F.col("n_reference") >= spec.min_values)
    )
    bins = histogram(counts, spec, ranges)
    zero = F.lit(0.0)
    return (
        ranges.select("feature")
        .join(psi(bins), "feature", "left")
        .join(js_divergence(bins), "feature", "left")
        .join(ks_test(counts, spec, ks_method, ranges), "feature", "left")
        .select(
            "feature",
            F.coalesce("psi", zero).alias("psi"),
            "ks_stat",
            "ks_pval",
            F.coalesce("js_div", zero).alias("js_div"),
            (F.coalesce("psi", zero) > spec.psi_threshold).cast("double").alias("drifted"),
        )
    )


def drift_summary(
    split: DataFrame,
    metrics: DataFrame,
    spec: DriftSpec = DriftSpec(),
    as_of: Column | None = None,
) -> DataFrame:
    """One row per run: whether it was skipped and why, side sizes, and what drifted."""
    as_of = latest_window_end(split) if as_of is None else as_of
    reason = (
        F.when(F.col("n_reference") < spec.min_reference, "insufficient_reference_data")
        .when(F.col("n_current") < spec.min_current, "insufficient_current_data")
    )
    totals = metrics.agg(
        F.struct(
            F.coalesce(F.max("drifted") > 0, F.lit(False)).alias("any"),
            F.coalesce(F.sum("drifted").cast("long"), F.lit(0)).alias("n"),
            F.coalesce(F.max("psi"), F.lit(0.0)).alias("psi"),
            F.array_sort(F.collect_list(F.when(F.col("drifted") > 0, F.col("feature")))).alias("names"),
        )
    ).scalar()
    run = ~F.col("skipped")
    return (
        side_counts(split)
        .withColumns({"reason": reason, "skipped": reason.isNotNull()})
        .withColumns({
            "any_drift": run & totals["any"],
            "n_features_drifted": F.when(run, totals["n"]).otherwise(0).cast("long"),
            "max_psi": F.when(run, totals["psi"]).otherwise(0.0),
            "drifted_features": F.when(run, totals["names"]).otherwise(F.array().cast("array<string>")),
            "run_ts": as_of,
        })
    )


def drift_run(df: DataFrame, spec: DriftSpec = DriftSpec(), as_of: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """One drift run: (metrics, summary).

    The time split, or the row-share split where a side is thin; when a side is still too thin the run is skipped,
    with its reason in the summary and no metrics.
    """
    as_of = latest_window_end(df) if as_of is None else as_of
    split = drift_sides(df, spec, as_of)
    found = side_counts(split).first()
    enough = found["n_current"] >= spec.min_current and found["n_reference"] >= spec.min_reference
    metrics = staged(drift_metrics(split if enough else split.limit(0), spec))
    return metrics, drift_summary(split, metrics, spec, as_of)


def metrics_long(metrics: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    """``{feature}_{metric}`` and value, the flat form that a metric log stores."""
    names = ["psi", "ks_stat", "ks_pval", "js_div", "drifted"]
    flat = metrics.unpivot("feature", names, "m", "value").select(
        F.concat_ws("_", "feature", "m").alias("metric"), "value"
    )
    if summary is None:
        return flat
    counts = summary.select(
        F.col("n_current").cast("double").alias("n_current_rows"),
        F.col("n_reference").cast("double").alias("n_reference_rows"),
        F.col("n_features_drifted").cast("double").alias("n_features_drifted"),
    )
    return flat.unionByName(counts.unpivot([], list(counts.columns), "metric", "value"))
