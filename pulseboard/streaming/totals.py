"""Running results in keyed state: one row out per row in, and a ranking over everything seen.

State holds one total per key, or the best ``n`` rows per bucket, whatever the number of batches; no stored table is
read. The rows of one key in one micro-batch meet in one task, where they are put in order: bound a batch by the files it may take
(``files_per_batch``).
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pulseboard.functions.text import hash_bucket


class RollingTotal(StatefulProcessor):
    """Adds to each row the sum of its key up to and including it."""

    def __init__(self, value: str, order: Sequence[str], name: str):
        self._value = value
        self._order = list(order)
        self._name = name

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._total = handle.getValueState("total", "total bigint")

    def handleInputRows(self, key, rows, timerValues):
        total = self._total.get()[0] if self._total.exists() else 0
        frame = pd.concat(list(rows)).sort_values(self._order, kind="stable")
        # A missing value adds nothing, as in a sum.
        frame[self._name] = total + frame[self._value].fillna(0).astype("int64").cumsum()
        self._total.update((int(frame[self._name].iloc[-1]),))
        yield frame

    def close(self) -> None:
        pass


def rolling_totals(rows: DataFrame, key: str, value: str, order: Sequence[str], name: str = "rolling") -> DataFrame:
    """One row per input row with the sum of its key so far, in the order of ``order`` inside each micro-batch."""
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.LongType())])
    return rows.groupBy(key).transformWithStateInPandas(
        RollingTotal(value, order, name), outputStructType=schema, outputMode="Append", timeMode="None")


class BestRows(StatefulProcessor):
    """Keeps the first ``n`` rows of a bucket; gives out those of a batch that came among them, or all of them with their ranks."""

    def __init__(self, columns: Sequence[str], types: str, order: Sequence[tuple[str, bool]], n: int, ranked: bool):
        self._columns = list(columns)
        self._types = types
        self._order = list(order)
        self._n = n
        self._ranked = ranked

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._best = handle.getListState("best", self._types)

    def handleInputRows(self, key, rows, timerValues):
        before = [tuple(r) for r in self._best.get()] if self._best.exists() else []
        held = pd.DataFrame(before, columns=self._columns)
        names, ways = [c for c, _ in self._order], [up for _, up in self._order]
        for frame in rows:
            new = frame[self._columns]
            held = (pd.concat([held, new]) if len(held) else new).sort_values(names, ascending=ways, kind="stable").head(self._n)
        best = [tuple(r) for r in held.itertuples(index=False)]
        if best == before:
            return
        self._best.put(best)
        if self._ranked:
            yield held.assign(rownum=range(1, len(held) + 1))
        else:
            known = set(before)
            yield held[[r not in known for r in best]].assign(bucket=0)

    def close(self) -> None:
        pass


def best_overall(rows: DataFrame, order: Sequence[tuple[str, bool]], n: int, spread_by: str, buckets: int = 64) -> DataFrame:
    """The first ``n`` rows of everything seen with their ranks, whenever they change.

    Two steps: each bucket keeps its best and passes on what is new among them, at most ``n`` rows a batch; one more state ranks these.
    ``order`` is (column, ascending); it must be a total order.
    """
    times = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.TimestampType)]
    numbers = rows.withColumns({t: F.unix_micros(t) for t in times})
    columns = numbers.columns
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbers.schema.fields)
    first = T.StructType([*numbers.schema.fields, T.StructField("bucket", T.IntegerType())])
    last = T.StructType([*numbers.schema.fields, T.StructField("rownum", T.LongType())])
    local = numbers.withColumn("_bucket", hash_bucket(spread_by, buckets)).groupBy("_bucket").transformWithStateInPandas(
        BestRows(columns, types, order, n, False), outputStructType=first, outputMode="Append", timeMode="None")
    ranked = local.groupBy("bucket").transformWithStateInPandas(
        BestRows(columns, types, order, n, True), outputStructType=last, outputMode="Append", timeMode="None")
    return ranked.withColumns({t: F.timestamp_micros(t) for t in times})
