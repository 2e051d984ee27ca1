"""Custom state over streams: rows of a key in event-time order, whatever order they arrive in, and timers.

Rows wait in the key's state until the watermark has passed them, so micro-batches and late arrivals do not change a result.
Needs the RocksDB state store, see ``use_rocksdb``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

#: Rows that wait in one value of a key's state. Spark passes every value to and from Python on its own, so rows travel in blocks.
BLOCK = 10_000


def use_rocksdb(spark: SparkSession) -> None:
    """Keep the state of queries that start from now on in RocksDB, with changes only in each checkpoint."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def to_micros(times: pd.Series) -> list[int]:
    return times.to_numpy("datetime64[us]").astype("int64").tolist()


def from_micros(times: list) -> pd.Series:
    return pd.Series(pd.to_datetime(pd.array(times, "Int64"), unit="us"))


class InEventTimeOrder(StatefulProcessor):
    """Hands a key's rows to ``step`` in the order of (event time, further columns), once the watermark has passed them.

    ``fields`` are the columns that wait, the event time first, as ``at`` in microseconds. Rows wait in Arrow blocks of at most ``BLOCK`` rows.
    """

    def __init__(self, fields: T.StructType):
        self.fields = fields

    def init(self, handle) -> None:
        self.handle = handle
        self.kept = to_arrow_schema(T.StructType([T.StructField("at", T.LongType()), *self.fields.fields[1:]]))
        self.waiting = handle.getListState("waiting", "block BINARY")

    def _keep(self, rows: pa.Table) -> None:
        for block in rows.combine_chunks().to_batches(BLOCK):
            self.waiting.appendValue((block.serialize().to_pybytes(),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        got = pd.concat(list(rows))
        self.mark = timerValues.getCurrentWatermarkInMs()
        at = np.array(to_micros(got[self.fields.names[0]]))
        columns = [pa.array(at), *(pa.Array.from_pandas(got[f.name], type=f.type) for f in list(self.kept)[1:])]
        self._keep(pa.Table.from_arrays(columns, schema=self.kept))
        self.wake(int(at.min()))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.mark = timerValues.getCurrentWatermarkInMs()
        mark = self.mark * 1000
        blocks = [pa.ipc.read_record_batch(pa.py_buffer(bytes(block)), self.kept) for block, in self.waiting.get()]
        rows = pa.Table.from_batches(blocks, self.kept)
        rows = rows.sort_by([(name, "ascending") for name in self.kept.names])
        n = int(np.searchsorted(rows.column("at").to_numpy(), mark, "right"))
        due, rest = rows.slice(0, n), rows.slice(n)
        if n:
            self.waiting.clear()
            self._keep(rest)
        if rest.num_rows:
            self.wake(rest.column("at")[0].as_py())
        found = self.step(key, due, mark)
        return iter([] if found is None else [found])

    def wake(self, at: int) -> None:
        """Come back when the watermark passes a time, unless an earlier timer will that is still to come."""
        ms = -(-at // 1000)
        if not any(self.mark < t <= ms for t in self.handle.listTimers()):
            self.handle.registerTimer(ms)

    def step(self, key, due: pa.Table, mark: int) -> pd.DataFrame | None:
        raise NotImplementedError

    def close(self) -> None:
        pass
