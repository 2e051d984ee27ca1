"""Ordered work per key without one task per key.

A key (a store and product, or a metric series) may hold a third of all rows, so nothing here
orders a whole key in one task. The key's timeline is cut into chunks of ``chunk_s`` seconds; rows are
ordered inside a chunk, chunks are summarised into one small row each, and only those summaries
are ordered per key. Every result is exact and equals the plain per-key window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.functions.expr import col
from stocktide.storage import staged

CHUNK = "_chunk"


def with_chunk(df: DataFrame, ts: str, chunk_s: int) -> DataFrame:
    return df.withColumn(CHUNK, F.expr(f"unix_seconds(cast({ts} as timestamp)) div {int(chunk_s)}"))


def _ordering(order: list[str], forward: bool) -> list[Column]:
    return [F.col(c).asc() if forward else F.col(c).desc() for c in order]


def neighbours(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column | str,
    depth: int,
    chunk_s: int | None,
    prefix: str,
    forward: bool = True,
) -> DataFrame:
    """Add ``prefix1 .. prefixN``: ``value`` of the 1st..Nth row before (after, when not ``forward``) in key order.

    Same as ``lag(value, i)`` over the whole key. ``order[0]`` must be the time column and
    ``order`` must be unique within the key. Neighbours across a chunk border come from the last
    ``depth`` rows of the preceding chunks. Without ``chunk_s`` the chunks are of even size in rows, not in time,
    for raw rows of which one key may have many at once.
    """
    chunked = ranged(df, [*keys, *order], CHUNK) if chunk_s is None else with_chunk(df, order[0], chunk_s)
    base = chunked.withColumn("_v", col(value))
    in_chunk = Window.partitionBy(*keys, CHUNK).orderBy(*_ordering(order, forward))
    from_end = Window.partitionBy(*keys, CHUNK).orderBy(*_ordering(order, not forward))
    by_chunk = Window.partitionBy(*keys).orderBy(F.col(CHUNK).asc() if forward else F.col(CHUNK).desc())

    tails = (
        base.select(*keys, CHUNK, *order, "_v")
        .withColumn("_r", F.row_number().over(from_end))
        .filter(F.col("_r") <= depth)
        .groupBy(*keys, CHUNK)
        .agg(F.array_sort(F.collect_list(F.struct("_r", "_v"))).alias("_tail"))
    )
    earlier = F.collect_list("_tail").over(by_chunk.rowsBetween(-depth, -1))
    halo = tails.select(*keys, CHUNK, F.slice(F.flatten(F.reverse(earlier)), 1, depth).alias("_halo"))

    inner = base.withColumns(
        {"_rn": F.row_number().over(in_chunk)}
        | {f"_l{i}": F.lag("_v", i).over(in_chunk) for i in range(1, depth + 1)}
    )
    joined = inner.join(halo, [*keys, CHUNK], "left")
    lagged = {
        f"{prefix}{i}": F.when(F.col("_rn") > i, F.col(f"_l{i}")).otherwise(
            F.get(F.col("_halo"), i - F.col("_rn"))["_v"]
        )
        for i in range(1, depth + 1)
    }
    return joined.select(*[F.col(c) for c in df.columns], *[v.alias(k) for k, v in lagged.items()])


def carry_forward(
    df: DataFrame, keys: list[str], order: list[str], value: str, chunk_s: int, out: str
) -> DataFrame:
    """Add ``out``: the latest non-null ``value`` at or before the row in key order."""
    base = with_chunk(df, order[0], chunk_s)
    in_chunk = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    levels = last_level_before(df, keys, order, value, chunk_s, "_entry")
    running = F.last(value, ignorenulls=True).over(
        in_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        base.withColumn("_seen", running)
        .join(levels.hint("merge"), [*keys, CHUNK], "left")  # both sides lie by key and chunk
        .select(*[F.col(c) for c in df.columns], F.coalesce("_seen", "_entry").alias(out))
    )


def last_level_before(
    df: DataFrame, keys: list[str], order: list[str], value: str, chunk_s: int, out: str
) -> DataFrame:
    """One row per key and chunk: the latest non-null ``value`` of the key's earlier chunks."""
    known = F.when(F.col(value).isNotNull(), F.struct(*order))
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return (
        with_chunk(df, order[0], chunk_s)
        .groupBy(*keys, CHUNK)
        .agg(F.max_by(value, known).alias("_level"))
        .select(*keys, CHUNK, F.last("_level", ignorenulls=True).over(earlier).alias(out))
    )


def standardise(
    df: DataFrame, keys: list[str], ts: str, columns: dict[str, str], chunk_s: int
) -> DataFrame:
    """Add z-scores against the key's own mean and sample deviation; 0 where the deviation is 0 or undefined.

    Moments are taken per (key, chunk) with partial aggregation, merged per key over the chunk rows, and
    joined back on (key, chunk), so a hot key is spread over its chunks on both sides of the join.
    """
    base = with_chunk(df, ts, chunk_s)
    moments = [
        e
        for c in columns
        for e in (
            F.count(c).alias(f"_n_{c}"),
            F.avg(c).alias(f"_m_{c}"),
            F.var_pop(c).alias(f"_v_{c}"),
            F.min(c).alias(f"_lo_{c}"),
            F.max(c).alias(f"_hi_{c}"),
        )
    ]
    parts = base.groupBy(*keys, CHUNK).agg(*moments)
    whole = Window.partitionBy(*keys)
    total = parts
    for c in columns:
        n, m, v = F.col(f"_n_{c}"), F.col(f"_m_{c}"), F.col(f"_v_{c}")
        total = total.withColumns({
            f"_rows_{c}": F.sum(n).over(whole),
            f"_mean_{c}": F.sum(n * m).over(whole) / F.sum(n).over(whole),
        })
        offset = m - F.col(f"_mean_{c}")
        spread = F.sum(n * (v + offset * offset)).over(whole)
        # Rounding differs from chunk to chunk, so a constant key is told by its ends, not by a deviation of 0.
        constant = F.min(f"_lo_{c}").over(whole) == F.max(f"_hi_{c}").over(whole)
        deviation = F.sqrt(F.try_divide(spread, F.col(f"_rows_{c}") - 1))
        total = total.withColumn(f"_std_{c}", F.when(~constant, deviation).otherwise(0.0))
    total = total.select(*keys, CHUNK, *[f"_{p}_{c}" for c in columns for p in ("mean", "std")])
    joined = base.join(total, [*keys, CHUNK], "left")
    scores = [
        F.when(F.coalesce(F.col(f"_std_{c}"), F.lit(0.0)) == 0.0, F.when(F.col(c).isNotNull(), F.lit(0.0)))
        .otherwise((F.col(c) - F.col(f"_mean_{c}")) / F.col(f"_std_{c}"))
        .alias(out)
        for c, out in columns.items()
    ]
    return joined.select(*[F.col(c) for c in df.columns], *scores)


def ranged(df: DataFrame, order: list[str], part: str) -> DataFrame:
    """The rows with ``part``, a number that does not fall in the given order; parts hold about as many rows each.

    The borders come from the data, so neither long common heads, outliers nor one busy hour fill a part. Stored, because
    the borders are drawn anew whenever the plan runs.
    """
    return staged(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()))


def running_totals(df: DataFrame, groups: list[str], value: str, sums: list[str]) -> DataFrame:
    """Collapse to distinct ``value`` per group and add inclusive running sums ``cum_*`` and totals ``all_*``.

    Distinct values are cut into parts of even size. Parts are summed first, the prefix over part totals is
    taken per group, and rows are ordered only inside a part.
    """
    distinct = ranged(df.groupBy(*groups, value).agg(*[F.sum(s).alias(s) for s in sums]), [*groups, value], "_part")
    per_part = distinct.groupBy(*groups, "_part").agg(*[F.sum(s).alias(f"_b_{s}") for s in sums])
    ordered = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    offsets = per_part.select(
        *groups,
        "_part",
        *[F.coalesce(F.sum(f"_b_{s}").over(ordered), F.lit(0)).alias(f"_o_{s}") for s in sums],
        *[F.sum(f"_b_{s}").over(whole).alias(f"all_{s}") for s in sums],
    )
    in_part = (
        Window.partitionBy(*groups, "_part")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        distinct.withColumns({f"_c_{s}": F.sum(s).over(in_part) for s in sums})
        .join(offsets, [*groups, "_part"])
        .select(
            *groups,
            value,
            *sums,
            *[(F.col(f"_c_{s}") + F.col(f"_o_{s}")).alias(f"cum_{s}") for s in sums],
            *[f"all_{s}" for s in sums],
        )
    )


def latest_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one that is last by ``order``. Partial aggregation keeps one row per key and task."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
        .select(*df.columns)
    )
