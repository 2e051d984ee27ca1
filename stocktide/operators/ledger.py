"""Stock ledger replay: sales against a level that is refilled when a sale does not fit.

The level after an order depends on the level before it, so a key's orders cannot be summed. A key with few
orders is replayed in one run. A hot key is cut into time chunks: levels lie between 0 and a small maximum, so
a run of orders maps every entry level to one exit level; the chunks are mapped in parallel, the maps are
chained, and each chunk is replayed from its own entry level. No task holds more than one Arrow batch of orders.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.operators.chunks import CHUNK, with_chunk
from stocktide.operators.joins import lookup_join
from stocktide.schemas import KEYS
from stocktide.storage import staged


def exit_levels(quantities: np.ndarray, levels: np.ndarray, restock_to: int) -> np.ndarray:
    """Level after the orders for each entry level; jumps from refill to refill over the running sum."""
    taken = np.concatenate([[0], np.cumsum(quantities)])
    n = len(quantities)
    level, start = levels.astype(np.int64).copy(), np.zeros(len(levels), dtype=np.int64)
    open_ = np.full(len(levels), n > 0)
    while open_.any():
        refused = np.searchsorted(taken, taken[start[open_]] + level[open_], side="right") - 1
        ends = refused >= n
        index = np.flatnonzero(open_)
        done = index[ends]
        level[done] -= taken[n] - taken[start[done]]
        again = index[~ends]
        level[again], start[again] = restock_to, refused[~ends] + 1
        open_[done] = False
        open_[again] = start[again] < n
    return level


def replay(quantities: np.ndarray, entry: int, restock_to: int) -> tuple[np.ndarray, np.ndarray]:
    """Level after each order and whether it was sold; a refused order refills the shelf and is skipped."""
    taken = np.concatenate([[0], np.cumsum(quantities)])
    n = len(quantities)
    after, sold = np.empty(n, dtype=np.int64), np.ones(n, dtype=bool)
    start, level = 0, entry
    while start < n:
        refused = int(np.searchsorted(taken, taken[start] + level, side="right")) - 1
        stop = min(refused, n)
        after[start:stop] = level - (taken[start + 1 : stop + 1] - taken[start])
        if stop < n:
            after[stop], sold[stop] = restock_to, False
        start, level = stop + 1, restock_to
    return after, sold


def _runs(batch: pd.DataFrame) -> Iterator[tuple[tuple, int, int]]:
    """Key and row range of consecutive rows of one (store, product, chunk)."""
    columns = [batch[c].to_numpy() for c in ("store_id", "sku_id", CHUNK)]
    n = len(batch)
    changes = np.zeros(max(n - 1, 0), dtype=bool)
    for values in columns:
        changes |= values[1:] != values[:-1]
    starts = np.concatenate([[0], np.flatnonzero(changes) + 1]) if n else []
    for a, b in zip(starts, [*starts[1:], n]):
        yield tuple(values[a] for values in columns), int(a), int(b)


def ledger_replay(
    orders: DataFrame, initial: int = 100, restock_to: int = 90, chunk_s: int = 86400, hot_rows: int = 1_000_000
) -> DataFrame:
    """Per order: ``level_after``, and ``sold`` false where the shelf was refilled instead.

    ``orders`` needs store, product, event_time, event_id and quantity. Keys with more than ``hot_rows`` orders
    are chunked by ``chunk_s``.
    """
    top = max(initial, restock_to)
    rows = orders.select(*KEYS, "event_time", "event_id", F.col("quantity").cast("int").alias("quantity"))
    counts = rows.groupBy(*KEYS).agg(F.count("*").alias("_n"))
    hot = staged(counts.filter(F.col("_n") > hot_rows).select(*KEYS, F.lit(True).alias("_hot")))
    marked = with_chunk(lookup_join(rows, hot, KEYS, ["event_id"]), "event_time", chunk_s)
    chunked = marked.withColumn(CHUNK, F.when(F.col("_hot"), F.col(CHUNK)).otherwise(0)).select(
        *rows.columns, CHUNK, "_hot"
    )
    hot_runs = (
        chunked.filter("_hot")
        .drop("_hot")
        .repartition(*KEYS, CHUNK)
        .sortWithinPartitions(*KEYS, CHUNK, "event_time", "event_id")
    )

    def map_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every = np.arange(top + 1)
        open_key, levels = None, every
        for batch in batches:
            closed = []
            quantities = batch["quantity"].to_numpy()
            for key, a, b in _runs(batch):
                if key != open_key:
                    if open_key is not None:
                        closed.append((*open_key, levels.tolist()))
                    open_key, levels = key, every
                levels = exit_levels(quantities[a:b], levels, restock_to)
            yield pd.DataFrame(closed, columns=["store_id", "sku_id", CHUNK, "exits"])
        if open_key is not None:
            yield pd.DataFrame([(*open_key, levels.tolist())], columns=["store_id", "sku_id", CHUNK, "exits"])

    maps = hot_runs.mapInPandas(map_runs, f"store_id STRING, sku_id STRING, {CHUNK} LONG, exits ARRAY<INT>")
    # Chain the maps: one small row per chunk of a hot key, streamed in order.
    ordered = maps.repartition(*KEYS).sortWithinPartitions(*KEYS, CHUNK)

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_key, level = None, initial
        for batch in batches:
            entry = []
            for store, sku, exits in zip(batch["store_id"], batch["sku_id"], batch["exits"]):
                if (store, sku) != open_key:
                    open_key, level = (store, sku), initial
                entry.append(level)
                level = int(exits[level])
            yield batch[["store_id", "sku_id", CHUNK]].assign(quantity=entry)

    # An entry level travels as the first row of its run: it has no event time, and NULL sorts first.
    entries = ordered.mapInPandas(chain, f"store_id STRING, sku_id STRING, {CHUNK} LONG, quantity INT")
    placed = (
        chunked.drop("_hot")
        .unionByName(entries, allowMissingColumns=True)
        .repartition(*KEYS, CHUNK)
        .sortWithinPartitions(*KEYS, CHUNK, "event_time", "event_id")
    )

    def replay_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_key, level = None, initial
        for batch in batches:
            quantities, is_entry = batch["quantity"].to_numpy(), batch["event_time"].isna().to_numpy()
            after, sold = np.zeros(len(batch), dtype=np.int64), np.zeros(len(batch), dtype=bool)
            for key, a, b in _runs(batch):
                if key != open_key:
                    open_key, level = key, initial
                if is_entry[a]:
                    level, a = int(quantities[a]), a + 1
                if a < b:
                    after[a:b], sold[a:b] = replay(quantities[a:b], level, restock_to)
                    level = int(after[b - 1])
            out = batch.drop(columns=CHUNK).assign(level_after=after, sold=sold)
            yield out[~is_entry]

    return placed.mapInPandas(
        replay_runs,
        "store_id STRING, sku_id STRING, event_time TIMESTAMP, event_id STRING, quantity INT, "
        "level_after INT, sold BOOLEAN",
    )
