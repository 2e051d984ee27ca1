"""Column expressions: bands, texts and small formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def banded(value: Column | str, bands: list[tuple[float, str]], above: str) -> Column:
    """First label whose upper bound is above ``value``; NULL stays NULL."""
    value = col(value)
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for upper, label in bands:
        out = out.when(value < upper, label)
    return out.otherwise(above)


def stock_band(on_hand: Column | str, low: int = 20, mid: int = 50) -> Column:
    """Stock colour: at most ``low`` is low, at most ``mid`` is mid, else ok."""
    on_hand = col(on_hand)
    return F.when(on_hand <= low, "low").when(on_hand <= mid, "mid").otherwise("ok")


def psi_band(psi: Column | str) -> Column:
    """Below 0.10 stable, to 0.25 inclusive moderate, above significant."""
    psi = col(psi)
    return F.when(psi < 0.10, "stable").when(psi <= 0.25, "moderate").otherwise("significant")


def lag_status(lag_s: Column | str, healthy_s: float = 120, stale_s: float = 300) -> Column:
    lag_s = col(lag_s)
    return (
        F.when(lag_s.isNull(), "no_data")
        .when(lag_s < healthy_s, "healthy")
        .when(lag_s < stale_s, "stale")
        .otherwise("down")
    )


def lag_text(lag_s: Column | str) -> Column:
    """``12s ago`` below a minute, ``1.5m ago`` from there, a dash when there is no data."""
    lag_s = col(lag_s)
    return (
        F.when(lag_s.isNull(), "—")
        .when(lag_s < 60, F.format_string("%.0fs ago", lag_s))
        .otherwise(F.format_string("%.1fm ago", lag_s / 60))
    )


def key_label(sku: Column | str = "sku_id", store: Column | str = "store_id") -> Column:
    return F.concat_ws(" / ", col(sku), col(store))


def seconds_between(later: Column, earlier: Column) -> Column:
    """Difference in seconds with microseconds kept."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1_000_000.0)


def momentum(short_rate: Column, long_rate: Column) -> Column:
    """Short over long rate; the denominator is floored so an empty long window is safe."""
    return short_rate / F.greatest(long_rate, F.lit(0.01))


def depletion_momentum(depletion: Column | str, mom: Column | str) -> Column:
    return col(depletion) * col(mom)


def time_to_empty(on_hand: Column | str, depletion: Column | str) -> Column:
    """Rate units left until the shelf is empty; NULL when nothing depletes."""
    return F.try_divide(col(on_hand).cast("double"), col(depletion))


def window_start_of(c: Column | str, numeric: bool) -> Column:
    """Epoch milliseconds or ISO text to timestamp."""
    return F.timestamp_millis(col(c).cast("long")) if numeric else F.try_to_timestamp(col(c).cast("string"))


def calendar(ts: Column | str) -> dict[str, Column]:
    """Hour, weekday with Monday 0, and the weekend flag."""
    ts = col(ts)
    return {
        "hour_of_day": F.hour(ts),
        "day_of_week": F.weekday(ts),
        "is_weekend": (F.weekday(ts) >= 5).cast("int"),
    }
