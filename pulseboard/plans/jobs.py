"""Whole streaming jobs: topic in, table out, with the spans the dashboards use.

Each starts a query and returns it. ``settings.every`` is the refresh interval;
without it a job drains its topic and ends.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pulseboard.functions import geo, records, text, times
from pulseboard.operators.aggregates import day_sum
from pulseboard.operators.pattern import alert_rows
from pulseboard.operators.shape import wide_row
from pulseboard.sinks import files
from pulseboard.sinks.keyed import KeyedTable
from pulseboard.sources.topic import Topic, json_topic, raw_topic
from pulseboard.streaming import dashboards as db
from pulseboard.streaming.runtime import BatchWriter, event_time, start, text_rows

USER = T.StructType([
    T.StructField("uid", T.LongType()), T.StructField("sex", T.StringType()), T.StructField("age", T.IntegerType()),
    T.StructField("created_time", T.LongType()),
])
BEHAVIOUR = T.StructType([
    T.StructField("uid", T.StringType()), T.StructField("time", T.StringType()),
    T.StructField("phoneType", T.StringType()), T.StructField("clickCount", T.IntegerType()),
])
ROOM_EVENT = T.StructType([
    T.StructField("uid", T.LongType()), T.StructField("roomId", T.LongType()), T.StructField("action", T.IntegerType()),
    T.StructField("ts", T.LongType()),
])
LOCATION = T.StructType([
    T.StructField("uid", T.LongType()), T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()), T.StructField("tag1", T.StringType()), T.StructField("ts", T.LongType()),
])
CHANGE = T.StructType([
    T.StructField("op", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("id", T.LongType()),
    T.StructField("uid", T.LongType()), T.StructField("sex", T.StringType()), T.StructField("age", T.IntegerType()),
    T.StructField("created_time", T.LongType()),
])


@dataclass(frozen=True)
class Settings:
    """Where a job reads, keeps its checkpoint and writes, and how often."""

    topic: Topic
    path: str
    every: str | None = None
    policy: str = "skip"

    @property
    def checkpoint(self) -> str:
        return f"{self.path}/checkpoint"

    @property
    def table(self) -> str:
        return f"{self.path}/table"

    @property
    def dead(self) -> str:
        """Refused lines with their reasons, by batch."""
        return f"{self.path}/dead"


def _records(spark: SparkSession, s: Settings, schema: T.StructType) -> DataFrame:
    return json_topic(spark, s.topic, schema, policy=s.policy)


def _tagged(spark: SparkSession, s: Settings, schema: T.StructType, times: dict[str, str] | None = None) -> DataFrame:
    """All lines of the topic with the reason why a line is refused."""
    return records.tagged_json(raw_topic(spark, s.topic), schema, times=times)


def dead_letters(spark: SparkSession, s: Settings, schema: T.StructType, times: dict[str, str] | None = None) -> StreamingQuery:
    """The refused lines of a topic as a job of its own, beside a job that holds windows and can have one target only."""
    refused = _tagged(spark, s, schema, times).where(F.col(records.REASON).isNotNull())
    lines = refused.select(F.col(records.RAW).alias("value"), F.col(records.REASON).alias("reason"))
    return start(lines, files.append_batch(s.dead), f"{s.path}/dead-checkpoint", "append", s.every)


def _behaviour(spark: SparkSession, s: Settings) -> DataFrame:
    return _records(spark, s, BEHAVIOUR).select(
        "uid", times.parse_timestamp("time").alias("time"), F.col("phoneType").alias("phone_type"),
        F.col("clickCount").alias("click_count"),
    )


def _upsert(df: DataFrame, s: Settings, keys: list[str], mode: str, seq: str | None = None,
            writer: BatchWriter | None = None) -> StreamingQuery:
    """Write by key: into ``writer`` (such as a database) or into the job's own table."""
    if writer is None:
        columns = df.drop(seq) if seq else df
        table = keyed_result(df.sparkSession, s, columns.schema, keys)

        def writer(batch, batch_id):
            table.write(batch, batch_id, seq=seq)

    return start(df, writer, s.checkpoint, mode, s.every)


def keyed_result(spark: SparkSession, s: Settings, schema: T.StructType, keys: list[str]) -> KeyedTable:
    """The table that a keyed job writes."""
    return KeyedTable(spark, s.table, schema, keys, compact_every=100)


def hourly_views(spark: SparkSession, s: Settings, writer: BatchWriter | None = None) -> StreamingQuery:
    """Views and users of each finished hour."""
    return _upsert(db.hourly_views(_behaviour(spark, s)), s, ["hour"], "append", writer=writer)


def running_users(spark: SparkSession, s: Settings) -> StreamingQuery:
    """First label of each user; ``dashboards.running_users`` of the table is the curve."""
    users = _records(spark, s, USER).select("uid", times.millis_to_timestamp("created_time").alias("time"))
    return _upsert(db.first_seen(users), s, ["uid"], "update")


def room_top(spark: SparkSession, s: Settings, n: int = 3) -> StreamingQuery:
    """Rooms with the largest net change per minute, every ten seconds."""
    rooms = _records(spark, s, ROOM_EVENT).select(
        "uid", F.col("roomId").alias("room_id"), "action", F.timestamp_millis("ts").alias("ts")
    )
    totals = db.window_totals(rooms, "ts", "action", ["room_id"], "1 minute", "10 seconds")
    return start(totals, db.top_rooms_writer(s.table, n), s.checkpoint, "append", s.every)


def profile_rows(spark: SparkSession, s: Settings, writer: BatchWriter | None = None) -> StreamingQuery:
    """User profiles under a salted key in one column family."""
    users = _records(spark, s, USER)
    wide = wide_row(
        users, text.profile_row_key("uid", "created_time", "sex"),
        {"uid": "uid", "sex": "sex", "age": "age", "created_time": "created_time"},
    )
    return _upsert(wide.withColumn("seq", F.col("cf.created_time")), s, ["rowkey"], "append", "seq", writer)


def location_rows(spark: SparkSession, s: Settings, writer: BatchWriter | None = None) -> StreamingQuery:
    """Anchor locations under a geographic key."""
    places = _records(spark, s, LOCATION)
    wide = wide_row(
        places, geo.location_row_key("uid", "latitude", "longitude"),
        {"uid": "uid", "longitude": "longitude", "latitude": "latitude", "tag1": "tag1", "ts": "ts"},
    )
    return _upsert(wide.withColumn("seq", F.col("cf.ts")), s, ["rowkey"], "append", "seq", writer)


def profile_lookup(spark: SparkSession, s: Settings, dimension: Callable[[], DataFrame],
                   fact_key: str, dimension_key: str, writer: BatchWriter) -> StreamingQuery:
    """User profiles joined with a dimension as it is at each micro-batch."""
    joined = db.lookup_writer(dimension, fact_key, dimension_key, writer)
    return start(_tagged(spark, s, USER), files.kept_and_dead(joined, s.dead), s.checkpoint, "append", s.every)


def day_clicks(spark: SparkSession, s: Settings, writer: BatchWriter | None = None) -> StreamingQuery:
    """Clicks per user and phone type of the local day, refreshed while the day lasts."""
    totals = day_sum(event_time(_behaviour(spark, s), "time"), "time", "click_count", ["uid", "phone_type"])
    return _upsert(totals, s, ["window_start", "uid", "phone_type"], "update", writer=writer)


def table_sync(spark: SparkSession, s: Settings) -> StreamingQuery:
    """A table kept equal to the source of its changelog; refused lines are put aside."""
    feed = _tagged(spark, s, CHANGE)
    schema = feed.drop("op", "seq", records.RAW, records.REASON).schema
    writer = db.change_writer(keyed_result(spark, s, schema, ["id"]), ["id"])
    return start(feed, files.kept_and_dead(writer, s.dead), s.checkpoint, "append", s.every)


def click_alerts(spark: SparkSession, s: Settings, clicks: int = 7, phone: str = "iOS",
                 span: timedelta = timedelta(seconds=10), delay: timedelta = timedelta(0)) -> StreamingQuery:
    """A busy event followed by one of a phone type within the span; ``read_alerts`` shows the messages.

    Events may come out of order by ``delay``; starts and ends beyond it are in the table ``late`` beside the matches.
    """
    rows = _behaviour(spark, s).withColumn("event_id", F.xxhash64("uid", "time", "phone_type", "click_count"))
    writer = db.SequenceWriter(
        s.table, f"click_count > {clicks}", f"phone_type = '{phone}'", span, "time", "event_id", ["uid"], delay=delay
    )
    return start(rows, writer, s.checkpoint, "append", s.every)


def read_alerts(spark: SparkSession, s: Settings) -> DataFrame:
    return alert_rows(spark.read.parquet(f"{s.table}/matches"), "time")


def credit_totals(spark: SparkSession, s: Settings, writer: BatchWriter | None = None) -> StreamingQuery:
    """Credits added up per user and date from comma-separated messages inside log records; refused lines are put aside."""
    parts = records.computed_once(
        raw_topic(spark, s.topic), {"m": F.split(records.json_path("value", "$.message"), ",")}, ["value"]
    )
    kinds = {"uid": "bigint", "date_of": "bigint", "num": "bigint", "result_credit": "decimal(38,18)"}
    fields = {name: F.try_element_at("m", F.lit(n)).try_cast(kind) for n, (name, kind) in enumerate(kinds.items(), 1)}
    read = records.computed_once(parts, fields, ["value", "m"])
    reason = F.when(F.col("m").isNull(), "no record")
    for name in kinds:
        reason = reason.when(F.col(name).isNull(), f"field {name}")
    rows = read.select(*kinds, F.col("value").alias(records.RAW), reason.alias(records.REASON))
    if writer is None:
        schema = rows.select(*kinds).schema
        writer = KeyedTable(spark, s.table, schema, ["uid", "date_of"], "add", ["num", "result_credit"], 100).write
    return start(rows, files.kept_and_dead(writer, s.dead), s.checkpoint, "append", s.every)


def dated_files(spark: SparkSession, s: Settings, rows_per_file: int | None = None) -> StreamingQuery:
    """Lines of a topic in folders by their event date."""
    lines = raw_topic(spark, s.topic).withColumn("dt", files.event_date("value"))
    return text_rows(lines, s.table, s.checkpoint, ("dt",), s.every, rows_per_file)


def warehouse(spark: SparkSession, s: Settings) -> StreamingQuery:
    """Profiles in date, hour and minute partitions; a minute is committed once the watermark has passed it."""
    ts = times.millis_to_timestamp("created_time")
    rows = _records(spark, s, USER).withColumns({
        "ts": ts, "ts_date": F.date_format(ts, "yyyy-MM-dd"), "ts_hour": F.date_format(ts, "HH"),
        "ts_minute": F.date_format(ts, "mm"),
    })
    sink = files.CommittingPartitions(
        spark, s.table, ["ts_date", "ts_hour", "ts_minute"], "ts", timedelta(minutes=1), timedelta(seconds=3)
    )
    return start(rows, sink, s.checkpoint, "append", s.every)
