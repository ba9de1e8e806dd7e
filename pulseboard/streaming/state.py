"""Keyed state with event-time timers, in its general form.

The dashboards use chained totals; these processors are for logic that no
built-in aggregate expresses. State is bounded: ``n`` rows per window, one row per key.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

TOP_SCHEMA = "window_end timestamp, room_id bigint, cnt bigint, rownum bigint"


class TopPerWindow(StatefulProcessor):
    """The first ``n`` rows of each window, given out when the watermark passes its end."""

    def __init__(self, n: int):
        self._n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._rows = handle.getListState("best", "room_id bigint, cnt bigint")

    def handleInputRows(self, key, rows, timerValues):
        best = [tuple(r) for r in self._rows.get()] if self._rows.exists() else []
        for frame in rows:
            best += list(zip(frame["room_id"].tolist(), frame["cnt"].tolist()))
            best = sorted(best, key=lambda r: (-r[1], r[0]))[: self._n]
        self._rows.put(best)
        self._handle.registerTimer(int(pd.Timestamp(key[0]).timestamp() * 1000) + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        best = [tuple(r) for r in self._rows.get()]
        self._rows.clear()
        yield pd.DataFrame({
            "window_end": [pd.Timestamp(key[0])] * len(best),
            "room_id": [r[0] for r in best],
            "cnt": [r[1] for r in best],
            "rownum": list(range(1, len(best) + 1)),
        })

    def close(self) -> None:
        pass


class IdleTotals(StatefulProcessor):
    """Total per key that is forgotten when the key stays idle for ``idle_ms``."""

    def __init__(self, idle_ms: int):
        self._idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._total = handle.getValueState("total", "cnt bigint", self._idle_ms)

    def handleInputRows(self, key, rows, timerValues):
        total = self._total.get()[0] if self._total.exists() else 0
        for frame in rows:
            total += int(frame["value"].sum())
        self._total.update((total,))
        yield pd.DataFrame({"key": [key[0]], "cnt": [total]})

    def close(self) -> None:
        pass


def top_rooms_with_timers(room_counts: DataFrame, n: int = 3) -> DataFrame:
    """Top rooms per window from (window_end, room_id, cnt) rows with a watermark on ``window_end``."""
    return room_counts.groupBy("window_end").transformWithStateInPandas(
        TopPerWindow(n), outputStructType=TOP_SCHEMA, outputMode="Append", timeMode="eventTime"
    )


def idle_totals(events: DataFrame, key: str, value: str, idle_minutes: int = 6) -> DataFrame:
    rows = events.selectExpr(f"cast({key} as string) as key", f"cast({value} as bigint) as value")
    return rows.groupBy("key").transformWithStateInPandas(
        IdleTotals(idle_minutes * 60_000), outputStructType="key string, cnt bigint",
        outputMode="Update", timeMode="processingTime",
    )
