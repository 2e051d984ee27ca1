"""Helpers for code that runs in Python workers over Arrow batches."""

from __future__ import annotations

import ctypes
import pickle
import sys
import types
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

import stocktide

# Executors need not have the package installed: its functions travel with the tasks that use them.
cloudpickle.register_pickle_by_value(stocktide)

#: Rows turned into Python objects at a time; a batch itself is bounded by Spark's bytes per batch.
SLICE = 256


def per_worker(key: object, make: Callable[[], object]) -> object:
    """An object that a Python worker process keeps between its tasks, such as a tokenizer or a cache of words.

    It only ever holds values that can be made again, so a lost worker costs time, not results. ``release`` lets go of
    those that the running task has not asked for, as they are of another step.
    """
    held, task = _held(), _task()
    if key not in held:
        release()
        held[key] = make(), task
    value, _ = held[key] = held[key][0], task
    return value


def _held() -> dict[object, tuple]:
    """Kept objects by key, with the task that asked for each last."""
    module = sys.modules.setdefault("_stocktide_llm_held", types.ModuleType("_stocktide_llm_held"))
    return module.__dict__.setdefault("held", {})


def _task() -> int | None:
    context = TaskContext.get()
    return context.taskAttemptId() if context else None


def release() -> None:
    """Give memory that is no longer needed back to the system: what finished tasks have freed, and objects kept by other
    steps' tasks. The worker process lives on for other tasks."""
    held, task = _held(), _task()
    for key in [k for k, (_, last) in held.items() if last != task]:
        del held[key]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


class Bounded(dict):
    """A dictionary of derived values that is emptied when it reaches ``limit`` entries."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def room_for(self, n: int) -> None:
        if len(self) + n > self.limit:
            self.clear()


class Recent:
    """Derived values by key, at most about ``limit`` of them; when room is needed, those not used for longest go.

    Values are in two halves. A full half takes the place of the older one, and what is used of that moves on.
    """

    def __init__(self, limit: int):
        self.half, self.newer, self.older = limit // 2, {}, {}

    def __len__(self) -> int:
        return len(self.newer) + len(self.older)

    def __sizeof__(self) -> int:
        return sys.getsizeof(self.newer) + sys.getsizeof(self.older)

    def items(self) -> Iterator[tuple]:
        return chain(self.newer.items(), self.older.items())

    def get(self, key: object) -> object:
        """The value of one key, or None; this does not count as a use."""
        return self.newer.get(key) or self.older.get(key)

    def lacking(self, keys: set) -> tuple[dict, list]:
        """The dictionary that holds the known ones of ``keys``, and the others, to be added to it."""
        if len(self.newer) + len(keys) > self.half:
            self.newer, self.older = {}, self.newer
        newer, older = self.newer, self.older
        absent = keys.difference(newer)
        new = absent.difference(older)
        again = absent.difference(new)
        newer.update(zip(again, map(older.__getitem__, again)))
        return newer, list(new)


def map_rows(
    df: DataFrame, columns: list, schema: str | T.StructType, start: Callable[[], Callable], by: str | None = None
) -> DataFrame:
    """Apply a Python function to slices of rows, without a shuffle.

    ``start()`` runs once per task and returns a function that gets one list per column and returns one list per
    field of ``schema``. The number of rows may change. ``by`` names a text column whose bytes bound a slice as well.
    """
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply, arrow = start(), to_arrow_schema(kind)
        release()  # what earlier tasks of this worker have left
        parts = slices_by_bytes(batches, by) if by else (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE))
        for part in parts:
            found = apply(*(c.to_pylist() for c in part.columns))
            yield pa.RecordBatch.from_arrays([pa.array(values, type=f.type) for values, f in zip(found, arrow)], schema=arrow)
        release()

    return df.select(*columns).mapInArrow(run, kind)


def on_one_worker(sample: DataFrame, make: Callable[[list[tuple]], object]) -> object:
    """What ``make`` makes of the rows of a sample of bounded size, in one task of an executor; it gets them in no order.

    The driver only sees the result, which must be plain values.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        rows = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(make(rows))], pa.binary())], ["made"])
        release()

    made = sample.repartition(1).mapInArrow(run, "made binary").first()
    return pickle.loads(made["made"]) if made else make([])


def slices_by_bytes(batches: Iterator[pa.RecordBatch], column: str, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut into slices of about ``size`` bytes of a text column, one row at least and ``SLICE`` at most."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        at = 0
        while at < batch.num_rows:
            reach = lengths[at:at + SLICE].cumsum()
            n = max(1, int((reach <= size).sum()))
            yield batch.slice(at, n)
            at += n


def renamed(df: DataFrame, **columns: str):
    """Only the named columns, under fixed names, so other columns of the table cannot clash."""
    return df.select(*[F.col(f"`{c}`").alias(name) for name, c in columns.items()])
