"""The exact k-th value of a column, without a sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ranges counted per round, and values that are few enough to be ordered on the driver.
RANGES, FEW = 1024, 4096


def kth_smallest(df: DataFrame, column: str, k: int, ranges: int = RANGES, few: int = FEW) -> float | None:
    """The ``k``-th smallest (from 1) of the numbers in ``column``, NULL and NaN aside; None where there are fewer.

    Each round counts the values per range of equal width between the smallest and the largest value left, and goes on with the range
    that holds the rank, between its own extremes. So every round is one partial aggregation over a stored column, and at most ``ranges`` rows,
    in the end ``few`` values, reach the driver. ``df`` should be stored, it is read once a round.
    """
    left = df.select(F.col(column).cast("double").alias("v")).filter("v IS NOT NULL AND NOT isnan(v)")
    found = left.agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).first()
    n, low, high = found
    if not 1 <= k <= n:
        return None
    while low < high:
        inside = left.filter(F.col("v").between(low, high))
        if n <= few:
            return sorted(r["v"] for r in inside.collect())[k - 1]
        # shares of the span stay finite where the span itself would not
        share = (F.col("v") / 2 - low / 2) / (high / 2 - low / 2)
        at = F.least(F.floor(share * ranges), F.lit(ranges - 1))
        counts = inside.groupBy(at.alias("at")).agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        for r in sorted(counts.collect()):
            if k <= r["n"]:
                n, low, high = r["n"], r["low"], r["high"]
                break
            k -= r["n"]
    return low
