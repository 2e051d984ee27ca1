"""Event-time windows per (store, product) and their assembly into feature rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.config import WindowSpec
from stocktide.functions import expr
from stocktide.operators.chunks import CHUNK, last_level_before
from stocktide.operators.joins import lookup_join, salted_join
from stocktide.schemas import KEYS
from stocktide.storage import staged

_MIN_MINUTES = 1e-6


def _rate(n: Column, span_s: int, spec: WindowSpec) -> Column:
    return n / F.lit(max(span_s / spec.rate_unit_s, _MIN_MINUTES))


def _bounds(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c not in (*KEYS, "window")]
    return df.select(
        *KEYS, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )


def tumbling_orders(orders: DataFrame, spec: WindowSpec = WindowSpec()) -> DataFrame:
    """Per key and short window: orders, units, mean basket and the short order rate."""
    grouped = orders.groupBy(*KEYS, F.window("event_time", spec.short)).agg(
        F.count("*").alias("order_count"),
        F.sum("quantity").alias("total_units"),
        F.avg("quantity").alias("avg_basket_size"),
    )
    return _bounds(grouped).withColumn("short_rate", _rate(F.col("order_count"), spec.short_s, spec))


def tumbling_inventory(inventory: DataFrame, spec: WindowSpec = WindowSpec()) -> DataFrame:
    """Per key and short window: units depleted, units restocked, and the level after the last movement.

    The last movement is by event time, then event id, so the result does not depend on arrival order.
    """
    delta = F.col("delta_units")
    grouped = inventory.groupBy(*KEYS, F.window("event_time", spec.short)).agg(
        F.coalesce(F.sum(F.when(delta < 0, -delta)), F.lit(0)).alias("depletion_units"),
        F.coalesce(F.sum(F.when(F.col("movement_type") == "restock", delta)), F.lit(0)).alias("restock_units"),
        F.max_by("on_hand_after", F.struct("event_time", "event_id")).alias("on_hand_latest"),
    )
    return _bounds(grouped)


def sliding_orders(orders: DataFrame, spec: WindowSpec = WindowSpec()) -> DataFrame:
    """Per key and long window sliding by the short one: the long order rate.

    Orders are counted per short pane first, so each pane, not each order, is spread over the
    windows that contain it.
    """
    panes = orders.groupBy(*KEYS, F.window("event_time", spec.short).alias("pane")).agg(F.count("*").alias("_n"))
    grouped = panes.groupBy(*KEYS, F.window(F.col("pane.start"), spec.long, spec.short)).agg(
        F.sum("_n").alias("order_count")
    )
    return _bounds(grouped).withColumn("long_rate", _rate(F.col("order_count"), spec.long_s, spec))


def merged_events(orders: DataFrame, inventory: DataFrame) -> DataFrame:
    """Orders and stock movements as one frame, so both can be aggregated in one shuffle.

    A row may be both at once (``is_order``, ``is_move``), where one source has both measures.
    """
    left = orders.select(
        *KEYS, "event_time", "event_id", F.lit(True).alias("is_order"), F.lit(False).alias("is_move"), "quantity",
        F.lit(None).cast("int").alias("delta_units"),
        F.lit(None).cast("int").alias("on_hand_after"),
        F.lit(None).cast("string").alias("movement_type"),
    )
    right = inventory.select(
        *KEYS, "event_time", "event_id", F.lit(False).alias("is_order"), F.lit(True).alias("is_move"),
        F.lit(None).cast("int").alias("quantity"), "delta_units", "on_hand_after", "movement_type",
    )
    return left.unionByName(right)


def pane_sums(within: Column | None = None) -> list[Column]:
    """Counts and sums of one short pane; ``within`` restricts them to a part of a longer window."""
    here = F.lit(True) if within is None else within
    order, move = here & F.col("is_order"), here & F.col("is_move")
    delta = F.col("delta_units")
    return [
        F.count_if(order).alias("order_count"),
        F.coalesce(F.sum(F.when(order, F.col("quantity"))), F.lit(0)).alias("total_units"),
        F.coalesce(F.sum(F.when(move & (delta < 0), -delta)), F.lit(0)).alias("depletion_units"),
        F.coalesce(F.sum(F.when(move & (F.col("movement_type") == "restock"), delta)), F.lit(0)).alias(
            "restock_units"
        ),
    ]


def pane_measures(within: Column | None = None) -> list[Column]:
    """Aggregates of one short pane, the level after its last movement included."""
    move = F.col("is_move") if within is None else within & F.col("is_move")
    return [
        *pane_sums(within),
        F.max_by("on_hand_after", F.when(move, F.struct("event_time", "event_id"))).alias("on_hand_latest"),
    ]


def feature_assembly(
    orders: DataFrame, inventory: DataFrame, spec: WindowSpec = WindowSpec(), mode: str = "joined"
) -> DataFrame:
    """One row per key and short window with orders: order, stock and long-rate measures side by side.

    ``joined`` collapses both inputs into panes, stages them and assembles those; the events are aggregated once and the
    movements read once more (see ``panes``). A window without stock movement takes the
    last known level of its key (``on_hand_source`` carried), or none. ``stub`` leaves stock at 0 and the
    long rate at 1, the constants of a pipeline whose join is not wired.
    """
    if mode == "stub":
        return tumbling_orders(orders, spec).select(
            *KEYS, "window_start", "window_end", "order_count", "total_units",
            F.lit(0).cast("long").alias("depletion_units"),
            F.lit(0).cast("long").alias("restock_units"),
            F.lit(0).alias("on_hand"),
            F.lit("window").alias("on_hand_source"),
            "short_rate",
            F.lit(1.0).alias("long_rate"),
        )
    return assemble_events(merged_events(orders, inventory), spec)


def assemble_events(events: DataFrame, spec: WindowSpec = WindowSpec()) -> DataFrame:
    """The joined assembly of events in the form of ``merged_events``."""
    return assemble_panes(staged(panes(events, spec)), spec)


def panes(events: DataFrame, spec: WindowSpec = WindowSpec()) -> DataFrame:
    """Events collapsed to one row per key and short window.

    Counts, sums and the time of the last movement have buffers of a fixed width, so the events are hashed, not sorted, and
    a task holds its panes, not its rows. The level after the last movement is then looked for among the movements of that
    time only, in a second reading of the events. Both are staged, as they are small and read again.
    """
    start = F.window("event_time", spec.short)["start"].alias("window_start")
    last = F.max(F.when(F.col("is_move"), F.col("event_time"))).alias("_last")
    sums = staged(events.groupBy(*KEYS, start).agg(*pane_sums(), last))
    key = F.struct(*KEYS, "window_start").alias("_key")  # a struct is never NULL, so keys compare as in the groups they come from
    moves = events.filter("is_move").select(*KEYS, start, F.col("event_time").alias("_last"), "event_id", "on_hand_after")
    at_last = lookup_join(
        moves.select(key, "_last", "event_id", "on_hand_after"),
        sums.filter("_last IS NOT NULL").select(key, "_last"), ["_key", "_last"], ["event_id"], "inner",
    )
    # of movements that share time and id the higher level is taken, so a result does not depend on their order
    level = F.max_by("on_hand_after", F.struct("event_id", "on_hand_after")).alias("on_hand_latest")
    levels = staged(at_last.groupBy("_key").agg(level))
    return sums.withColumn("_key", key).join(levels, "_key", "left").select(*KEYS, "window_start", *_MEASURES, "on_hand_latest")


_MEASURES = ["order_count", "total_units", "depletion_units", "restock_units"]


def assemble_panes(pane_rows: DataFrame, spec: WindowSpec = WindowSpec()) -> DataFrame:
    """Panes to assembled windows (see ``feature_assembly``).

    A key's panes are cut into time chunks; the few panes at the end of a chunk that later windows reach
    back to are copied into the next one. Long counts and carried levels are then windows inside a chunk.
    """
    assert spec.chunk_s >= spec.long_s
    reach = spec.long_s - spec.short_s
    own = f"unix_seconds(window_start) div {spec.chunk_s}"
    reached = f"(unix_seconds(window_start) + {reach}) div {spec.chunk_s}"
    chunked = pane_rows.withColumns({
        "_own": F.expr(own),
        CHUNK: F.explode(F.expr(f"array_distinct(array({own}, {reached}))")),
        "_pane": F.expr(f"unix_seconds(window_start) div {spec.short_s}"),
    })
    in_chunk = Window.partitionBy(*KEYS, CHUNK).orderBy("_pane")
    entry = last_level_before(pane_rows, KEYS, ["window_start"], "on_hand_latest", spec.chunk_s, "_entry")
    levelled = (
        chunked.withColumns({
            "long_count": F.sum("order_count").over(in_chunk.rangeBetween(-(spec.panes - 1), 0)),
            "_seen": F.last("on_hand_latest", ignorenulls=True).over(
                in_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        })
        .filter((F.col("_own") == F.col(CHUNK)) & (F.col("order_count") > 0))
        .join(entry.hint("merge"), [*KEYS, CHUNK], "left")
        .withColumn("on_hand", F.coalesce("_seen", "_entry"))
    )
    return (
        levelled.withColumns({
            "window_end": F.col("window_start") + F.expr(f"interval {spec.short}"),
            "on_hand_source": F.when(F.col("on_hand_latest").isNotNull(), "window")
            .when(F.col("on_hand").isNotNull(), "carried")
            .otherwise("none"),
            "short_rate": _rate(F.col("order_count"), spec.short_s, spec),
            "long_rate": _rate(F.col("long_count"), spec.long_s, spec),
        })
        .select(
            *KEYS, "window_start", "window_end", *_MEASURES, "on_hand", "on_hand_source", "short_rate", "long_rate"
        )
    )


def feature_rows(assembled: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """Stored feature rows. Rounding is half-even at four decimals; an unknown level is stored as 0."""
    updated_at = F.current_timestamp() if updated_at is None else updated_at
    extra = ["on_hand_source"] if "on_hand_source" in assembled.columns else []
    return assembled.select(
        *KEYS,
        "window_start",
        "window_end",
        F.bround("short_rate", 4).alias("order_rate"),
        F.bround(F.col("depletion_units") / 1.0, 4).alias("depletion_vel"),
        F.bround(expr.momentum(F.col("short_rate"), F.col("long_rate")), 4).alias("demand_momentum"),
        F.coalesce(F.col("on_hand"), F.lit(0)).cast("int").alias("on_hand_est"),
        updated_at.alias("updated_at"),
        *extra,
    )


def window_imbalance(assembled: DataFrame) -> DataFrame:
    """(orders − restocked units) over units sold, per window; NULL when nothing was sold."""
    return assembled.select(
        *KEYS,
        "window_start",
        F.try_divide(
            (F.col("order_count") - F.col("restock_units")).cast("double"), F.col("total_units").cast("double")
        ).alias("volume_imbalance"),
    )


def late_data_split(orders: DataFrame, spec: WindowSpec, arrival: str) -> DataFrame:
    """Mark orders that a stream with this watermark would drop, given when each order arrived.

    The watermark at a row is the greatest event time that arrived in an earlier short arrival window, less
    the delay. A row is late when its own window ended at or before that watermark.
    """
    batches = staged(
        orders.groupBy(F.window(arrival, spec.short).alias("_batch")).agg(F.max("event_time").alias("_max"))
    )
    # One row per arrival window: seen-so-far is exact through day-level maxima.
    by_day = batches.withColumn("_day", F.to_date("_batch.start"))
    day_max = by_day.groupBy("_day").agg(F.max("_max").alias("_max"))
    before_day = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    in_day = Window.partitionBy("_day").orderBy("_batch").rowsBetween(Window.unboundedPreceding, -1)
    seen = (
        by_day.withColumn("_in_day", F.max("_max").over(in_day))
        .join(day_max.select("_day", F.max("_max").over(before_day).alias("_before")), "_day")
        .select("_batch", F.greatest("_in_day", "_before").alias("_seen"))
    )
    window_end = F.window("event_time", spec.short)["end"]
    watermark = F.col("_seen") - F.expr(f"interval {spec.watermark_s} seconds")
    return (
        orders.withColumn("_batch", F.window(arrival, spec.short))
        .transform(lambda df: salted_join(df, seen, ["_batch"], ["event_time", *KEYS]))
        .withColumn("is_late", F.coalesce(window_end <= watermark, F.lit(False)))
        .drop("_batch", "_seen")
    )
