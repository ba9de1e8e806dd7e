"""Aggregates that a user writes as create, add, merge and result.

Each task adds its rows to one state per key; states of a key are merged in a tree of at most ``fan`` tasks' states a node. No group's rows
are gathered in one place, so a key with a third of all rows sends one state per task and not its rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from typing import Any, Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pulseboard.session import stage

SLOT, STATE, STATES, ROW = "_slot", "_state", "_states", "_row"


class Aggregate(Protocol):
    """A mergeable aggregate. ``merge`` has to be associative and commutative; a state is any picklable value.

    An aggregate for tables of many small groups may also have ``of_groups(rows, starts)``: the states of all groups of an Arrow table at
    once, whose rows are in the order of the groups; group ``i`` begins at row ``starts[i]``. Without it each group is added by itself.
    """

    def create(self) -> Any:
        """The state of no rows."""

    def add(self, state: Any, rows: pd.DataFrame) -> Any:
        """The state with some rows of the group added."""

    def merge(self, state: Any, other: Any) -> Any:
        """The state of both states' rows."""

    def result(self, state: Any) -> tuple:
        """The values of the result columns."""


def merged(df: DataFrame, keys: Sequence[str], aggregate: Aggregate, result: str, fan: int = 32, held: int = 20_000) -> DataFrame:
    """One row per group: the keys and the columns of ``result`` (a schema in text).

    A null key is a group of its own. Without ``keys`` all rows are one group; an empty table then gives no row. A task holds at most about
    ``held`` states at a time and passes on what it has when there are more.
    """
    keys = list(keys)
    key_fields = [T.StructField(k, df.schema[k].dataType, True) for k in keys]
    part = T.StructType([*key_fields, T.StructField(SLOT, T.LongType()), T.StructField(STATE, T.BinaryType())])
    out = T.StructType([*key_fields, *T.StructType.fromDDL(result).fields])
    part_arrow, out_arrow = to_arrow_schema(part), to_arrow_schema(out)

    def batch_of(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, states = TaskContext.get().partitionId(), {}

        def passed_on() -> pa.RecordBatch:
            return batch_of(part_arrow, [(*k, slot, pickle.dumps(s)) for k, s in states.items()])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not table.num_rows:
                continue
            if keys:
                at = pa.array(range(table.num_rows), pa.int64())
                groups = table.select(keys).append_column(ROW, at).group_by(keys).aggregate([(ROW, "list")])
                members = groups.column(f"{ROW}_list").combine_chunks()
                found = zip(*(groups.column(k).to_pylist() for k in keys), strict=True)
                table, sizes = table.take(members.flatten()), members.value_lengths().to_numpy()
            else:
                found, sizes = [()], np.array([table.num_rows])
            starts = np.cumsum(sizes) - sizes
            if hasattr(aggregate, "of_groups"):
                for key, own in zip(found, aggregate.of_groups(table, starts), strict=True):
                    states[key] = aggregate.merge(states[key], own) if key in states else own
            else:
                for key, begin, size in zip(found, starts.tolist(), sizes.tolist(), strict=True):
                    rows = table.slice(begin, size).to_pandas()
                    states[key] = aggregate.add(states[key] if key in states else aggregate.create(), rows)
            if len(states) > held:
                yield passed_on()
                states.clear()
        if states:
            yield passed_on()

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for *key, raw in zip(*(batch.column(c).to_pylist() for c in [*keys, SLOT, STATES]), strict=True):
                total = pickle.loads(raw[0])
                for other in raw[1:]:
                    total = aggregate.merge(total, pickle.loads(other))
                rows.append((*key, pickle.dumps(total)))
            yield batch_of(part_arrow, rows)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            yield batch_of(out_arrow, [(*(r[k] for k in keys), *aggregate.result(pickle.loads(r[STATE]))) for r in rows])

    states = stage(df.mapInArrow(add_up, part), "states")
    last = states.agg(F.max(SLOT)).first()[0] or 0
    while True:
        # A node's states are few, so Spark gathers them and one call merges the nodes of a whole batch.
        nodes = states.groupBy(*keys, F.expr(f"{SLOT} div {fan}").alias(SLOT)).agg(F.collect_list(STATE).alias(STATES))
        states = nodes.mapInArrow(put_together, part)
        if last < fan:
            break
        last //= fan
    return states.mapInArrow(finish, out)


class LatestWithTotal:
    """The value of the last row, by ``order`` (nulls last), and the sum of a measure."""

    def __init__(self, order: Sequence[str], value: str, measure: str):
        self.order, self.value, self.measure = list(order), value, measure

    def create(self):
        return None, None, 0

    def add(self, state, rows):
        return self.merge(state, self.of_groups(pa.Table.from_pandas(rows, preserve_index=False), np.array([0]))[0])

    def of_groups(self, rows, starts):
        sizes = np.diff(np.append(starts, rows.num_rows))
        group = pa.array(np.repeat(np.arange(len(starts)), sizes))
        ordered = pc.sort_indices(pa.table([group, *(rows.column(c) for c in self.order)], names=[ROW, *self.order]),
                                  sort_keys=[(ROW, "ascending"), *((c, "ascending") for c in self.order)], null_placement="at_end")
        last = rows.take(ordered.take(pa.array(starts + sizes - 1)))
        measure = pd.Series(rows.column(self.measure).fill_null(0).to_numpy()).fillna(0)
        if measure.dtype.kind in "iu":
            measure = measure.astype("int64")
        totals = np.add.reduceat(measure.to_numpy(), starts).tolist()
        at = zip(*([(v is None, v) for v in last.column(c).to_pylist()] for c in self.order), strict=True)
        return [(a, v, int(t)) for a, v, t in zip(at, last.column(self.value).to_pylist(), totals, strict=True)]

    def merge(self, state, other):
        later = state if other[0] is None or (state[0] is not None and state[0] >= other[0]) else other
        return later[0], later[1], state[2] + other[2]

    def result(self, state):
        return state[1], state[2]


class Reduce:
    """Values folded by a function of two of them, such as a sum."""

    def __init__(self, column: str, function):
        self.column, self.function = column, function

    def create(self):
        return None

    def add(self, state, rows):
        for value in rows[self.column].dropna().tolist():
            state = value if state is None else self.function(state, value)
        return state

    def merge(self, state, other):
        return other if state is None else state if other is None else self.function(state, other)

    def result(self, state):
        return (state,)
