"""Demand profiles measured from order events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocktide.functions.expr import seconds_between
from stocktide.operators.chunks import neighbours, running_totals
from stocktide.storage import staged


def demand_profile(orders: DataFrame) -> DataFrame:
    """Orders per hour of day, weekdays against weekends, per day seen, and the weekend uplift of the hour.

    Orders collapse to one row per hour of history first; days and hours are counted from those.
    """
    hours = staged(orders.groupBy(F.date_trunc("hour", "event_time").alias("_h")).agg(F.count("*").alias("_n")))
    weekend = F.weekday("_h") >= 5
    tagged = hours.select(
        F.hour("_h").alias("hour_of_day"), weekend.alias("is_weekend"), F.to_date("_h").alias("_d"), "_n"
    )
    days = tagged.agg(
        F.countDistinct(F.when(F.col("is_weekend"), F.col("_d"))).alias("weekend"),
        F.countDistinct(F.when(~F.col("is_weekend"), F.col("_d"))).alias("weekday"),
    )
    n_days = F.when(F.col("is_weekend"), days.select("weekend").scalar()).otherwise(days.select("weekday").scalar())
    rates = (
        tagged.groupBy("hour_of_day", "is_weekend")
        .agg(F.sum("_n").alias("orders"))
        .withColumn("orders_per_day", F.col("orders") / n_days)
    )
    hour = Window.partitionBy("hour_of_day")  # two rows per hour
    uplift = F.max(F.when(F.col("is_weekend"), F.col("orders_per_day"))).over(hour) / F.max(
        F.when(~F.col("is_weekend"), F.col("orders_per_day"))
    ).over(hour)
    return rates.withColumn("weekend_uplift", uplift)


def _ranked(orders: DataFrame, by: str = "sku_id") -> DataFrame:
    """Distinct ids with orders, dense position by count descending, then id; positions come part by part."""
    counts = orders.groupBy(by).agg(F.count("*").alias("orders"))
    place = counts.select(
        F.lit(1).alias("_all"), F.struct((-F.col("orders")).alias("n"), F.col(by).alias("id")).alias("_k"), F.lit(1).alias("_one"), "orders"
    )
    return running_totals(place, ["_all"], "_k", ["_one", "orders"]).select(
        F.col("_k.id").alias(by),
        "orders",
        F.col("cum__one").cast("long").alias("rank"),
        (F.col("orders") / F.col("all_orders")).alias("share"),
        (F.col("cum_orders") / F.col("all_orders")).alias("cum_share"),
    )


def sku_popularity(orders: DataFrame) -> DataFrame:
    """Popularity rank, share and cumulative share per product."""
    return _ranked(orders)


def popularity_slope(popularity: DataFrame) -> DataFrame:
    """Slope of log share on log rank: minus the exponent of a Zipf law that fits the shares."""
    return popularity.agg(
        F.regr_slope(F.ln("share"), F.ln("rank")).alias("slope"), F.count("*").alias("n_skus")
    )


def basket_distribution(orders: DataFrame) -> DataFrame:
    """Share of orders per quantity."""
    counts = orders.groupBy("quantity").agg(F.count("*").alias("orders"))
    total = F.sum("orders").over(Window.partitionBy())  # one row per distinct quantity
    return counts.withColumn("share", F.col("orders") / total)


def interarrival_stats(orders: DataFrame) -> DataFrame:
    """Gaps between consecutive orders of a store: count, mean, deviation and 95th percentile in seconds.

    Orders are cut into parts of even size in order of store and time, so a busy store is spread over many. All figures
    come from counts per distinct gap; the percentile is the smallest gap that at least 95 % of the gaps do not exceed.
    """
    paired = neighbours(
        orders.select("store_id", "event_time", "event_id"), ["store_id"], ["event_time", "event_id"], "event_time", 1, None, "_prev"
    )
    gap = seconds_between(F.col("event_time"), F.col("_prev1"))
    gaps = staged(paired.filter(F.col("_prev1").isNotNull()).groupBy("store_id", gap.alias("gap_s")).agg(F.count("*").alias("n")))
    means = gaps.groupBy("store_id").agg(
        F.sum("n").alias("n_gaps"), (F.sum(F.col("n") * F.col("gap_s")) / F.sum("n")).alias("mean_gap_s")
    )
    off = F.col("gap_s") - F.col("mean_gap_s")
    spread = gaps.join(means, "store_id").groupBy("store_id", "n_gaps", "mean_gap_s").agg(F.sum(F.col("n") * off * off).alias("_square"))
    moments = spread.select(
        "store_id", "n_gaps", "mean_gap_s", F.sqrt(F.try_divide(F.col("_square"), F.col("n_gaps") - 1)).alias("std_gap_s")
    )
    totals = running_totals(gaps, ["store_id"], "gap_s", ["n"])
    p95 = totals.filter(F.col("cum_n") >= F.ceil(F.col("all_n") * 0.95)).groupBy("store_id").agg(F.min("gap_s").alias("p95_gap_s"))
    return moments.join(p95, "store_id", "left")
