"""The dashboard inputs, read from the given tables, each with its SQL form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseboard.session import files_state, new_path
from pulseboard.sources.tables import monitored_table, named_table

# Fixed value: the hash in which the dashboard looks for its counts.
CLICK_HASH = "DASHBOARD:USER:PHONE:CNT"

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with their time as an instant."""
    return named_table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


#: Files in which the events arrive, one per micro-batch.
ARRIVALS = 5
_arrived: dict[tuple, str] = {}


def arrival_second(disorder: int = 0) -> Column:
    """When an event arrives: up to ``disorder`` seconds after it happened."""
    return F.unix_seconds(F.col("ts").cast("timestamp")) + F.col("event_id") % (disorder + 1)


def event_arrivals(spark: SparkSession, folder: str, disorder: int = 0) -> str:
    """The events as files that were written one after the other, by the time of their arrival."""
    source = f"{folder}/events.parquet"
    key = (spark.sparkContext.applicationId, source, disorder, files_state(spark, source))
    if key not in _arrived:
        path = new_path(spark, "arrivals")
        rows = named_table(spark, folder, "events").withColumn("_at", arrival_second(disorder))
        ends = rows.agg(F.min("_at").alias("low"), F.max("_at").alias("high")).first()
        low, step = ends["low"] or 0, ((ends["high"] or 0) - (ends["low"] or 0)) // ARRIVALS + 1
        for n in range(ARRIVALS):
            due = F.floor((F.coalesce("_at", F.lit(low)) - low) / step) == n
            rows.where(due).drop("_at").coalesce(1).write.mode("append").parquet(path)
        _arrived[key] = path
    return _arrived[key]


#: Number of the file an event arrives in.
_SECOND = "CAST(floor(epoch(ts)) AS BIGINT)"
ARRIVAL_SQL = f"""({_SECOND} - (SELECT min({_SECOND}) FROM events))
    // ((SELECT max({_SECOND}) - min({_SECOND}) FROM events) // {ARRIVALS} + 1)"""


def event_stream(spark: SparkSession, folder: str, disorder: int = 0) -> DataFrame:
    """The events as they arrive, one file per micro-batch."""
    rows = monitored_table(spark, event_arrivals(spark, folder, disorder), EVENT_SCHEMA, files_per_batch=1)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def as_behaviour(rows: DataFrame) -> DataFrame:
    """Click behaviour: who, when, on what, how many clicks."""
    return rows.select(
        "event_id",
        F.col("user_id").cast("string").alias("uid"),
        F.col("ts").alias("time"),
        F.col("event_type").alias("phone_type"),
        F.floor("value").cast("int").alias("click_count"),
    )


def behaviour(spark: SparkSession, folder: str) -> DataFrame:
    return as_behaviour(events(spark, folder))


BEHAVIOUR = """(SELECT event_id, CAST(user_id AS VARCHAR) AS uid, ts AS time, event_type AS phone_type,
    CAST(floor(value) AS INTEGER) AS click_count FROM events)"""


def as_rooms(rows: DataFrame) -> DataFrame:
    """Room events: a user enters (1) or leaves (-1)."""
    return rows.select(
        "event_id",
        F.col("user_id").alias("uid"),
        (F.get_json_object("props", "$.k").cast("bigint") % 5 + 1).alias("room_id"),
        F.when(F.col("event_type") == "error", -1).otherwise(1).alias("action"),
        "ts",
    )


def rooms(spark: SparkSession, folder: str) -> DataFrame:
    return as_rooms(events(spark, folder))


ROOMS = """(SELECT event_id, user_id AS uid, CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 + 1 AS room_id,
    CASE WHEN event_type = 'error' THEN -1 ELSE 1 END AS action, ts FROM events)"""


def profiles(spark: SparkSession, folder: str) -> DataFrame:
    """User profiles: one per order, created at the order date."""
    return named_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("uid"),
        F.col("o_orderstatus").alias("sex"),
        (F.col("o_orderkey") % 80).cast("int").alias("age"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("created_time"),
    )


PROFILES = """(SELECT o_orderkey AS id, o_custkey AS uid, o_orderstatus AS sex,
    CAST(o_orderkey % 80 AS INTEGER) AS age, epoch_ms(o_orderdate) AS created_time FROM orders)"""


def as_amounts(rows: DataFrame) -> DataFrame:
    """Amounts in whole hundredths, so that sums do not depend on their order."""
    return rows.select(
        "event_id", "ts", F.col("event_type").alias("category"), "user_id",
        F.round(F.col("value") * 100).cast("bigint").alias("value"),
    )


def amounts(spark: SparkSession, folder: str) -> DataFrame:
    return as_amounts(events(spark, folder))


AMOUNTS = """(SELECT event_id, ts, event_type AS category, user_id,
    CAST(round(value * 100) AS BIGINT) AS value FROM events)"""


def locations(spark: SparkSession, folder: str) -> DataFrame:
    """Where a customer is."""
    return named_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("uid"),
        (F.col("c_nationkey") * 14.0 - 170.0).alias("longitude"),
        (F.col("c_custkey") % 180 - 90 + 0.5).alias("latitude"),
        F.col("c_mktsegment").alias("tag1"),
    )


LOCATIONS = """(SELECT c_custkey AS uid, CAST(c_nationkey AS DOUBLE) * 14.0 - 170.0 AS longitude,
    CAST(c_custkey % 180 - 90 AS DOUBLE) + 0.5 AS latitude, c_mktsegment AS tag1 FROM customer)"""


def changes(spark: SparkSession, folder: str) -> DataFrame:
    """Change feed of orders: each key is inserted, some are updated, some deleted.

    An update gives the row before and the row after it.
    """
    orders = named_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("uid"),
        F.col("o_orderstatus").alias("sex"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("amount"),
    )

    def change(op: str, step: int, where: str, amount: str = "amount") -> DataFrame:
        return orders.where(where).select(
            F.lit(op).alias("op"),
            (F.col("id") * 10 + step).alias("seq"),
            "id", "uid", "sex",
            F.expr(amount).alias("amount"),
        )

    return (
        change("+I", 0, "true")
        .unionByName(change("-U", 1, "id % 3 = 0"))
        .unionByName(change("+U", 2, "id % 3 = 0", "amount + 100"))
        .unionByName(change("-D", 3, "id % 7 = 0", "if(id % 3 = 0, amount + 100, amount)"))
    )


_ORDERS = """(SELECT o_orderkey AS id, o_custkey AS uid, o_orderstatus AS sex,
    CAST(round(o_totalprice * 100) AS BIGINT) AS amount FROM orders)"""
CHANGES = f"""(
    SELECT '+I' AS op, id * 10 AS seq, id, uid, sex, amount FROM {_ORDERS}
    UNION ALL SELECT '-U', id * 10 + 1, id, uid, sex, amount FROM {_ORDERS} WHERE id % 3 = 0
    UNION ALL SELECT '+U', id * 10 + 2, id, uid, sex, amount + 100 FROM {_ORDERS} WHERE id % 3 = 0
    UNION ALL SELECT '-D', id * 10 + 3, id, uid, sex,
        CASE WHEN id % 3 = 0 THEN amount + 100 ELSE amount END FROM {_ORDERS} WHERE id % 7 = 0)"""
