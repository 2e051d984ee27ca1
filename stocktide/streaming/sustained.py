"""Sustained-threshold alerts over a running metric stream: timers fire when a condition has held for its duration."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktide.operators import serving
from stocktide.streaming.stateful import InEventTimeOrder, from_micros


class _Sustained(InEventTimeOrder):
    """State per rule: since when its condition holds, and whether it has fired for that span."""

    def __init__(self, durations: dict[str, int]):
        super().__init__(T.StructType.fromDDL("ts TIMESTAMP, holds BOOLEAN"))
        self.durations = durations  # microseconds

    def init(self, handle) -> None:
        super().init(handle)
        self.span = handle.getValueState("span", "since LONG, fired BOOLEAN")

    def step(self, key, due, mark):
        needed, events = self.durations[key[0]], []
        since, fired = self.span.get() if self.span.exists() else (None, False)

        def look(at: int) -> bool:
            """Fire when the span that is open has lasted long enough by a time up to which it held."""
            if since is not None and not fired and at - since >= needed:
                events.append((since, since + needed, None))
                return True
            return fired

        for at, holds in zip(*(c.to_pylist() for c in due.columns)):
            fired = look(at)
            if holds and since is None:
                since, fired = at, False
            elif not holds and since is not None:
                if fired:
                    events.append((since, since + needed, at))
                since, fired = None, False
        fired = look(mark)
        if since is None:
            self.span.clear()
        else:
            self.span.update((since, fired))
            if not fired:
                self.wake(since + needed)
        if not events:
            return None
        began, fired_at, until = (from_micros(list(c)) for c in zip(*events))
        return pd.DataFrame({"rule": key[0], "since": began, "fired_at": fired_at, "until": until})


def threshold_stream(metrics: DataFrame, rules: list[tuple] | None = None, time_scale: float = 1.0) -> DataFrame:
    """Alerts of the sustained-threshold rules as they happen: (rule, since, fired_at, until).

    ``metrics`` is (ts, metric, label, value) with a watermark on ``ts``. A rule's row without ``until`` comes when the
    watermark reaches ``since`` plus the rule's duration while the condition still holds, sample or no sample; a second row with ``until``
    comes when the condition ends. Samples may arrive in any order within the watermark's delay. Needs ``use_rocksdb``.
    """
    rules = rules or serving.THRESHOLD_RULES
    samples = serving.rule_samples(metrics, rules, time_scale).select("rule", "ts", "holds")
    durations = {r[0]: int(r[5] * time_scale * 1_000_000) for r in rules}
    return samples.groupBy("rule").transformWithStateInPandas(
        _Sustained(durations), "rule STRING, since TIMESTAMP, fired_at TIMESTAMP, until TIMESTAMP", "append", "eventTime"
    )
