"""Streaming jobs of the dashboards, each as (operators, batch writer)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseboard.functions.times import hour_label, ten_minute_label
from pulseboard.operators.aggregates import window_sum
from pulseboard.operators.changes import DELETE, latest_changes
from pulseboard.operators.lookup import lookup_join
from pulseboard.operators.ordered import running
from pulseboard.operators.pattern import followed_by
from pulseboard.operators.topk import top_overall, top_per_group
from pulseboard.sinks.files import append_batch
from pulseboard.sinks.keyed import KeyedTable
from pulseboard.streaming.runtime import event_time


def hourly_views(events: DataFrame, ts: str = "time", uid: str = "uid", delay: str = "3 seconds") -> DataFrame:
    """PV and exact UV of each hour the watermark has passed.

    Two chained totals: state holds one row per (hour, user), and a crowded hour is
    spread over its users before it is gathered.
    """
    per_user = (
        event_time(events, ts, delay)
        .groupBy(F.window(ts, "1 hour").alias("window"), uid)
        .agg(F.count(F.lit(1)).alias("_views"))
    )
    hours = per_user.groupBy("window").agg(F.sum("_views").alias("pv"), F.count(F.lit(1)).alias("uv"))
    return hours.select(hour_label("window.start").alias("hour"), "pv", "uv")


def window_totals(
    events: DataFrame,
    ts: str,
    value: str,
    keys: Sequence[str] = (),
    duration: str = "1 minute",
    slide: str | None = None,
    offset: str | None = None,
    delay: str = "3 seconds",
) -> DataFrame:
    """Sum per window and key; append mode gives finished windows, update mode early results."""
    return window_sum(event_time(events, ts, delay), ts, value, keys, duration, slide, offset)


def top_rooms_writer(path: str, n: int = 3) -> Callable[[DataFrame, int], None]:
    """Writer of the top ``n`` rooms of each finished window.

    In append mode all rooms of a window arrive in the one batch in which the
    watermark passes it, so ranking within the batch is ranking within the window.
    """
    append = append_batch(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        append(top_per_group(batch, ["window_end"], [("cnt", "desc"), "room_id"], n), batch_id)

    return write


def overall_top_writer(table: KeyedTable, spread_by: str, n: int = 3) -> Callable[[DataFrame, int], None]:
    """Writer that keeps the top ``n`` rows over all finished windows in ``table`` (keyed by rank)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        before = table.read(before=batch_id)
        rows = batch.unionByName(before.drop("rownum"))
        order = [("cnt", "desc"), "window_start", spread_by]
        table.write(top_overall(rows, order, n, spread_by), batch_id)

    return write


def first_seen(events: DataFrame, ts: str = "time", uid: str = "uid") -> DataFrame:
    """Earliest ten-minute label of each user so far (update mode)."""
    return events.groupBy(uid).agg(F.min(ts).alias("_first")).select(uid, ten_minute_label("_first").alias("label"))


def running_users(first: DataFrame, label: str = "label") -> DataFrame:
    """Different users up to each label that brought new ones.

    The window runs over labels, six per hour, and not over users.
    """
    per_label = first.groupBy(label).agg(F.count(F.lit(1)).alias("_new"))
    so_far = Window.orderBy(label).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_label.select(label, F.sum("_new").over(so_far).alias("cnt"))


def change_writer(table: KeyedTable, keys: Sequence[str], seq: str = "seq", op: str = "op"):
    """Writer that keeps ``table`` equal to the source of a changelog."""

    def write(batch: DataFrame, batch_id: int) -> None:
        last = latest_changes(batch, keys, seq, op).withColumn("_gone", F.col(op) == DELETE)
        table.write(last, batch_id, seq=seq, deleted="_gone")

    return write


def rolling_sum_writer(state: KeyedTable, path: str, key: str, value: str, order: Sequence[str]):
    """Writer of one row per input row with the sum of its key so far.

    The sum within the batch runs over blocks of the order, so a hot key is split;
    the sum before the batch comes from ``state`` (additive, keyed by ``key``).
    """
    append = append_batch(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        before = state.read(before=batch_id).select(F.col(key).alias("_k"), F.col(value).alias("_before"))
        kept = batch.persist()
        try:
            rows = running(kept, order, {"_within": ("sum", value)}, [key])
            summed = (
                rows.join(before, F.col(key).eqNullSafe(F.col("_k")), "left")
                .withColumn("rolling", F.coalesce("_before", F.lit(0)) + F.col("_within"))
                .drop("_k", "_before", "_within")
            )
            append(summed, batch_id)
            state.write(kept, batch_id)
        finally:
            kept.unpersist()

    return write


class SequenceWriter:
    """Writer that finds two-step sequences across micro-batches.

    Events wait until the watermark (largest time seen minus ``delay``) has passed
    them, so disorder up to the delay does not change the matches. Starts and ends that come later still are
    kept in the table ``late`` with their batch; none is dropped unseen. Between batches
    a stored table keeps the waiting events and the starts that can still be closed.
    """

    def __init__(self, path: str, start: str, end: str, span: timedelta, ts: str = "ts", tie: str = "event_id",
                 payload: Sequence[str] = ("uid",), keys: Sequence[str] = (), delay: timedelta = timedelta(0)):
        self.path = path
        self.start = start
        self.end = end
        self.span = span
        self.ts = ts
        self.tie = tie
        self.payload = list(payload)
        self.keys = list(keys)
        self.delay = delay
        self._append = append_batch(f"{path}/matches")
        self._late = append_batch(f"{path}/late")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        columns = list(dict.fromkeys([*self.keys, self.ts, self.tie, *self.payload]))
        marked = batch.select(
            *columns,
            F.coalesce(F.expr(self.start), F.lit(False)).alias("is_start"),
            F.coalesce(F.expr(self.end), F.lit(False)).alias("is_end"),
            F.lit(False).alias("passed"),
        )
        # Only starts and ends are held; the other rows count for the clock alone.
        rows = marked.where("is_start or is_end").persist()
        try:
            self._advance(rows, _largest(batch, F.unix_micros(self.ts)), batch_id)
        finally:
            rows.unpersist()

    def _advance(self, rows: DataFrame, newest: int | None, batch_id: int) -> None:
        spark = rows.sparkSession
        last = None
        if batch_id > 0:
            kept = spark.read.schema(_with_newest(rows.schema)).parquet(f"{self.path}/state/n={batch_id - 1}")
            last = _largest(kept, F.col("newest"))
            if last is not None:
                self._late(rows.where(F.col(self.ts) < self._border(last)).drop("passed"), batch_id)
                rows = rows.where(F.col(self.ts) >= self._border(last))
            rows = rows.unionByName(kept.where(F.col(self.tie).isNotNull()).drop("newest"))
        micros = max((m for m in (last, newest) if m is not None), default=0)
        border = self._border(micros)
        ready = rows.where(F.col(self.ts) <= border)
        span = f"{_delta_micros(self.span)} microseconds"
        # A kept start has played its part as an end already.
        matches = followed_by(
            ready, F.col("is_start"), F.col("is_end") & ~F.col("passed"), span,
            self.ts, self.tie, self.payload, self.keys,
        )
        self._append(matches, batch_id)
        written = spark.read.schema(matches.schema).parquet(f"{self.path}/matches/batch={batch_id}")
        closed = written.select(F.col(f"start.{self.tie}").alias("_closed"))
        open_starts = (
            ready.where(F.col("is_start") & (F.col(self.ts) + F.expr(f"interval {span}") > border))
            .join(closed, F.col(self.tie) == F.col("_closed"), "left_anti")
            .withColumn("passed", F.lit(True))
        )
        waiting = rows.where(F.col(self.ts) > border)
        # One extra row carries the largest time seen.
        clock = spark.range(1).select(F.lit(micros).cast("bigint").alias("newest"))
        state = open_starts.unionByName(waiting).withColumn("newest", F.lit(None).cast("bigint"))
        state.unionByName(clock, allowMissingColumns=True).write.mode("overwrite").parquet(
            f"{self.path}/state/n={batch_id}"
        )

    def _border(self, micros: int):
        return F.timestamp_micros(F.lit(micros - _delta_micros(self.delay)))


def _with_newest(schema: T.StructType) -> T.StructType:
    return T.StructType([
        *[T.StructField(f.name, f.dataType, True) for f in schema.fields],
        T.StructField("newest", T.LongType()),
    ])


def _delta_micros(delta: timedelta) -> int:
    return delta // timedelta(microseconds=1)


def _largest(df: DataFrame, value) -> int | None:
    return df.agg(F.max(value).alias("m")).first()["m"]


def lookup_writer(dimension: Callable[[], DataFrame], fact_key: str, dimension_key: str,
                  write_joined: Callable[[DataFrame, int], None]):
    """Writer that joins each micro-batch with the dimension as it is at that moment."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_joined(lookup_join(batch, dimension(), fact_key, dimension_key), batch_id)

    return write
