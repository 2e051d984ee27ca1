"""The stock ledger over a stream: one stored level per store and product, by arrival or by event time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from stocktide.operators.ledger import replay
from stocktide.schemas import KEYS
from stocktide.streaming.stateful import InEventTimeOrder, from_micros

_OUTPUT = (
    "store_id STRING, sku_id STRING, event_time TIMESTAMP, event_id STRING, quantity INT, level_after INT, sold BOOLEAN"
)


def ledger_stream(orders: DataFrame, initial: int = 100, restock_to: int = 90) -> DataFrame:
    """Level after each order, in event-time order within a micro-batch and arrival order across them.

    State is one integer per key. A micro-batch of a hot key is sorted in one task; bound it with the
    source's rows per trigger.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values(["event_time", "event_id"])
        level = state.get[0] if state.exists else initial
        after, sold = replay(rows["quantity"].to_numpy(), level, restock_to)
        state.update((int(after[-1]),))
        yield rows.assign(store_id=key[0], sku_id=key[1], level_after=after, sold=sold)[
            ["store_id", "sku_id", "event_time", "event_id", "quantity", "level_after", "sold"]
        ]

    wanted = orders.select(*KEYS, "event_time", "event_id", "quantity")
    return wanted.groupBy(*KEYS).applyInPandasWithState(
        step, _OUTPUT, "level INT", "append", GroupStateTimeout.NoTimeout
    )


class _Ledger(InEventTimeOrder):
    def __init__(self, initial: int, restock_to: int):
        super().__init__(T.StructType.fromDDL("event_time TIMESTAMP, event_id STRING, quantity INT"))
        self.initial, self.restock_to = initial, restock_to

    def init(self, handle) -> None:
        super().init(handle)
        self.level = handle.getValueState("level", "level INT")

    def step(self, key, due, mark):
        if not due.num_rows:
            return None
        quantities = due.column("quantity").to_numpy()
        level = self.level.get()[0] if self.level.exists() else self.initial
        after, sold = replay(quantities, level, self.restock_to)
        self.level.update((int(after[-1]),))
        return pd.DataFrame({
            "store_id": key[0], "sku_id": key[1], "event_time": from_micros(due.column("at").to_numpy()), "event_id": due.column("event_id").to_pandas(), "quantity": quantities,
            "level_after": after, "sold": sold,
        })


def ordered_ledger_stream(orders: DataFrame, initial: int = 100, restock_to: int = 90) -> DataFrame:
    """Level after each order in event-time order, in whatever order the orders arrive within the watermark's delay.

    ``orders`` carries a watermark on ``event_time``. Orders wait in their key's state until the watermark has passed them, so the result
    is that of the batch replay of all orders up to the watermark; orders behind the watermark are dropped. State per key is
    one level and the orders of one delay. Needs ``use_rocksdb``.
    """
    wanted = orders.select(*KEYS, "event_time", "event_id", "quantity")
    return wanted.groupBy(*KEYS).transformWithStateInPandas(
        _Ledger(initial, restock_to), _OUTPUT, "append", "eventTime"
    )
