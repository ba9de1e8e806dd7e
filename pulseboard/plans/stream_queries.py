"""Streaming jobs, each run over everything its source holds; the result is the table it wrote."""

from __future__ import annotations

import time
from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseboard.functions import text, times
from pulseboard.functions.records import tagged_json
from pulseboard.operators.aggregates import day_sum
from pulseboard.operators.cache import LookupCache
from pulseboard.operators.lookup import RefreshingDimension
from pulseboard.operators.pattern import alert_rows
from pulseboard.operators.shape import wide_row
from pulseboard.operators.topk import top_per_group
from pulseboard.plans import dashboard_queries as dq
from pulseboard.plans import table_queries as tq
from pulseboard.plans.functions_queries import CREDITS, DECODED, RECORD_SCHEMA, credit_lines, credit_records
from pulseboard.plans.inputs import (
    AMOUNTS, ARRIVAL_SQL, BEHAVIOUR, CLICK_HASH, as_amounts, as_behaviour, as_rooms, changes, event_stream,
)
from pulseboard.plans.registry import query
from pulseboard.session import new_path, stream_session
from pulseboard.sinks import files
from pulseboard.sinks.buckets import BucketedTable
from pulseboard.sinks.keyed import KeyedTable
from pulseboard.sinks.rolling import RollingFiles
from pulseboard.sources.function import NUMBERS, function_stream
from pulseboard.sources.generated import with_fields
from pulseboard.sources.tables import monitored_table, named_table
from pulseboard.sources.topic import Topic, json_topic, raw_topic
from pulseboard.streaming import dashboards as db
from pulseboard.streaming.runtime import drain, event_time, run_to, text_rows
from pulseboard.streaming.sequence import followed_by_join
from pulseboard.streaming.state import top_rooms_with_timers
from pulseboard.streaming.totals import best_overall, rolling_totals

# Finished windows: the watermark is the largest event time, cut to milliseconds, minus three seconds.
PASSED = "window_end <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL 3 SECOND"


class Job:
    """Folders of one run of a streaming job, and the number of micro-batches that brought rows."""

    batches: dict[str, int] = {}

    def __init__(self, spark, name):
        self.name = name
        self.spark = spark
        self.session = stream_session(spark)
        self.base = new_path(spark, name)
        self.out = f"{self.base}/out"
        self.checkpoint = f"{self.base}/checkpoint"

    def run(self, df, write, mode="append"):
        """Drain ``df`` into ``write``."""
        done = drain(df, write, self.checkpoint, mode)
        self.batches[self.name] = sum(p["numInputRows"] > 0 for p in done.recentProgress)

    def append(self, df, mode="append"):
        """Append finished rows and read them back."""
        self.run(df, files.append_batch(self.out), mode)
        return self.rows(df.schema)

    def rows(self, schema, path=""):
        folder = path or self.out
        return self.spark.read.schema(_nullable(schema)).parquet(f"{folder}/batch=*")

    def keyed(self, schema, keys, mode="replace", measures=()):
        return KeyedTable(self.session, f"{self.base}/keyed", _nullable(schema), keys, mode, measures)

    def seen(self, table):
        """The bucketed table, seen from the caller's session."""
        return BucketedTable(self.spark, table.path, table.schema, table.keys, buckets=table.buckets).read()

    def read(self, table):
        """The keyed table, seen from the caller's session."""
        return KeyedTable(self.spark, table.path, table.schema, table.keys, table.mode, table.measures).read()


def _nullable(schema):
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


@query("src1_json_topic_stream", f"SELECT event_id, user_id, event_type, clicks FROM {DECODED}")
def src1_stream(spark, folder):
    job = Job(spark, "src1")
    return job.append(json_topic(job.session, Topic(path=tq.stored_topic(spark, folder)), RECORD_SCHEMA))


@query("src2_raw_topic_stream", """
    SELECT CAST(event_id AS VARCHAR) AS id_text, event_id % 50 = 0 AS broken FROM events""")
def src2_stream(spark, folder):
    """All lines of the topic as they are, the broken ones among them."""
    job = Job(spark, "src2")
    lines = raw_topic(job.session, Topic(path=tq.stored_topic(spark, folder)))
    broken = F.col("value").startswith("{broken ")
    number = F.when(broken, text.tail("value", 9)).otherwise(F.get_json_object("value", "$.event_id"))
    return job.append(lines.select(number.alias("id_text"), broken.alias("broken")))


@query("src10_monitored_table_stream", """
    SELECT event_id, user_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-15 23:30:00'""")
def src10_stream(spark, folder):
    job = Job(spark, "src10")
    schema = T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()), T.StructField("ts_date", T.DateType()),
        T.StructField("ts_hour", T.StringType()),
    ])
    start = (F.col("ts_date") >= F.lit("2024-01-15").cast("date")) & (
        F.col("ts") >= F.lit("2024-01-15 23:30:00").cast("timestamp_ntz")
    )
    rows = monitored_table(job.session, tq.daily_table(spark, folder), schema, start)
    return job.append(rows.select("event_id", "user_id", "ts"))


@query("agg1_hourly_pv_uv_stream", f"""
    SELECT hour, pv, uv FROM (
        SELECT strftime(time, '%Y-%m-%d %H:00') AS hour, max(date_trunc('hour', time)) + INTERVAL 1 HOUR AS window_end,
            count(*) AS pv, count(DISTINCT uid) AS uv FROM {BEHAVIOUR} GROUP BY hour) WHERE {PASSED}""")
def agg1_stream(spark, folder):
    job = Job(spark, "agg1")
    return job.append(db.hourly_views(as_behaviour(event_stream(job.session, folder))))


@query("agg3_room_window_sum_stream", f"SELECT * FROM {dq.ROOM_HOURS} WHERE {PASSED}")
def agg3_stream(spark, folder):
    job = Job(spark, "agg3")
    totals = db.window_totals(as_rooms(event_stream(job.session, folder)), "ts", "action", ["room_id"], dq.TUMBLE)
    return dq.borders_at_rest(job.append(totals))


@query("st5_sliding_window_stream", f"SELECT * FROM {dq.SLIDING} WHERE {PASSED}")
def st5_stream(spark, folder):
    job = Job(spark, "st5")
    rooms = as_rooms(event_stream(job.session, folder))
    totals = db.window_totals(rooms, "ts", "action", ["room_id"], dq.SLIDE_SIZE, dq.SLIDE_STEP)
    return dq.borders_at_rest(job.append(totals))


@query("top2_room_topn_stream", f"SELECT * FROM ({dq.TOP_ROOMS}) WHERE {PASSED}")
def top2_stream(spark, folder):
    job = Job(spark, "top2")
    rooms = as_rooms(event_stream(job.session, folder))
    totals = db.window_totals(rooms, "ts", "action", ["room_id"], dq.SLIDE_SIZE, dq.SLIDE_STEP)
    job.run(totals, db.top_rooms_writer(job.out))
    schema = T.StructType([*totals.schema.fields, T.StructField("rownum", T.LongType())])
    return dq.borders_at_rest(job.rows(schema)).select("window_end", "room_id", "cnt", "rownum")


@query("st8_top_rooms_timers_stream", f"SELECT * FROM ({dq.TOP_ROOMS}) WHERE {PASSED}")
def st8_stream(spark, folder):
    """The same ranking by keyed state: a window's best rooms are given out by a timer at its end, and forgotten."""
    job = Job(spark, "st8")
    rooms = as_rooms(event_stream(job.session, folder))
    totals = db.window_totals(rooms, "ts", "action", ["room_id"], dq.SLIDE_SIZE, dq.SLIDE_STEP)
    best = top_rooms_with_timers(totals.select("window_end", "room_id", "cnt"))
    return dq.borders_at_rest(job.append(best)).select("window_end", "room_id", "cnt", "rownum")


@query("top1_two_phase_stream", f"""
    SELECT window_start, room_id, cnt, rownum FROM (
        SELECT *, row_number() OVER (ORDER BY cnt DESC, window_start, room_id) AS rownum
        FROM {dq.ROOM_HOURS} WHERE {PASSED}) WHERE rownum <= 3""")
def top1_stream(spark, folder):
    job = Job(spark, "top1")
    rooms = as_rooms(event_stream(job.session, folder))
    totals = db.window_totals(rooms, "ts", "action", ["room_id"], dq.TUMBLE)
    best = best_overall(totals, [("cnt", False), ("window_start", True), ("room_id", True)], 3, "room_id")
    table = job.keyed(best.schema, ["rownum"])
    job.run(best, table.write)
    return dq.borders_at_rest(job.read(table)).select("window_start", "room_id", "cnt", "rownum")


@query("agg5_clicks_early_results_stream", dq.USER_CLICKS)
def agg5_stream(spark, folder):
    job = Job(spark, "agg5")
    clicks = as_behaviour(event_stream(job.session, folder)).groupBy("uid", "phone_type").agg(
        F.sum("click_count").alias("cnt")
    )
    table = job.keyed(clicks.schema, ["uid", "phone_type"])
    job.run(clicks, table.write, "update")
    return job.read(table)


@query("agg7_day_total_stream", dq.DAY_TOTALS)
def agg7_stream(spark, folder):
    job = Job(spark, "agg7")
    totals = day_sum(event_time(as_amounts(event_stream(job.session, folder)), "ts"), "ts", "value", ["category"])
    table = job.keyed(totals.schema, ["window_start", "category"])
    job.run(totals, table.write, "update")
    return dq.borders_at_rest(job.read(table))


@query("agg8_rolling_sum_stream", dq.ROLLING)
def agg8_stream(spark, folder):
    job = Job(spark, "agg8")
    amounts = as_amounts(event_stream(job.session, folder)).select("event_id", "ts", "category", "value")
    return job.append(rolling_totals(amounts, "category", "value", ["ts", "event_id"])).select("event_id", "category", "rolling")


@query("win1_running_users_stream", dq.RUNNING_BY_LABEL)
def win1_stream(spark, folder):
    job = Job(spark, "win1")
    first = db.first_seen(as_behaviour(event_stream(job.session, folder)))
    table = job.keyed(first.schema, ["uid"])
    job.run(first, table.write, "update")
    return db.running_users(job.read(table))


def _sequence_job(spark, folder, name):
    job = Job(spark, name)
    rows = as_behaviour(event_stream(job.session, folder))
    writer = db.SequenceWriter(
        job.base, dq.SEQUENCE_START, dq.SEQUENCE_END, timedelta(hours=1), "time", "event_id", ["uid"]
    )
    job.run(rows, writer)
    return spark.read.parquet(f"{job.base}/matches")


@query("cep1_sequence_stream", dq.SEQUENCES)
def cep1_stream(spark, folder):
    return dq.sequence_ids(_sequence_job(spark, folder, "cep1"))


@query("cep1_interval_join_stream", f"""
    SELECT start_id, end_id, start_uid, end_uid FROM {dq.sequence_sql()}
    WHERE start_time <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL 10 MINUTE - INTERVAL 1 HOUR""")
def cep1_join_stream(spark, folder):
    """Events arrive up to ten minutes late; a match is given out once the watermark has passed its start by the span."""
    job = Job(spark, "cep1_join")
    starts, ends = (as_behaviour(event_stream(job.session, folder, 600)) for _ in range(2))
    matches = followed_by_join(
        starts, ends, F.expr(dq.SEQUENCE_START), F.expr(dq.SEQUENCE_END), 3600, "time", "event_id", ["uid"], delay="10 minutes")
    return dq.sequence_ids(job.append(matches))


@query("snk16_alert_table_stream", dq.ALERTS)
def snk16_stream(spark, folder):
    return alert_rows(_sequence_job(spark, folder, "snk16"), "time")


@query("mut1_apply_changes_stream", tq.FINAL_TABLE)
def mut1_stream(spark, folder):
    job = Job(spark, "mut1")
    feed = changes(spark, folder)
    source = f"{job.base}/feed"
    feed.write.parquet(source)
    stream = monitored_table(job.session, source, feed.schema, files_per_batch=4)
    table = job.keyed(feed.select("id", "uid", "sex", "amount").schema, ["id"])
    job.run(stream, db.change_writer(table, ["id"]))
    return job.read(table)


@query("snk4_additive_upsert_stream", f"""
    SELECT uid, date_of, CAST(sum(num) AS BIGINT) AS num, CAST(sum(credit) AS VARCHAR) AS credit
    FROM {CREDITS} WHERE uid IS NOT NULL GROUP BY uid, date_of""")
def snk4_stream(spark, folder):
    job = Job(spark, "snk4")
    source = f"{job.base}/topic"
    credit_lines(spark, folder).write.text(source)
    parsed = credit_records(raw_topic(job.session, Topic(path=source))).where("uid is not null")
    table = job.keyed(tq.CREDIT_TYPES, ["uid", "date_of"], "add", ["num", "credit"])
    job.run(parsed, table.write)
    return job.read(table).withColumn("credit", F.col("credit").cast("string"))


@query("snk8_hash_fields_stream", f"""
    SELECT '{CLICK_HASH}' AS hash, uid || '_' || phone_type AS field,
        CAST(CAST(sum(click_count) AS BIGINT) AS VARCHAR) AS value FROM {BEHAVIOUR} GROUP BY uid, phone_type""")
def snk8_stream(spark, folder):
    job = Job(spark, "snk8")
    clicks = as_behaviour(event_stream(job.session, folder)).groupBy("uid", "phone_type").agg(
        F.sum("click_count").alias("cnt")
    )
    fields = clicks.select(
        F.lit(CLICK_HASH).alias("hash"), text.hash_field("uid", "phone_type").alias("field"),
        F.col("cnt").cast("string").alias("value"),
    )
    table = BucketedTable(job.session, f"{job.base}/hash", fields.schema, ["hash", "field"])
    job.run(fields, table.write, "update")
    return job.seen(table)


@query("snk3_keyed_upsert_stream", f"""
    SELECT phone_type, uid, arg_max(event_id, (time, event_id)) AS event_id, max(time) AS time FROM {BEHAVIOUR} GROUP BY phone_type, uid""")
def snk3_stream(spark, folder):
    """The last event of each user and type; a batch rewrites the buckets it touches."""
    job = Job(spark, "snk3")
    rows = as_behaviour(event_stream(job.session, folder)).withColumn("seq", F.unix_micros("time"))
    schema = rows.select("phone_type", "uid", "event_id", "time").schema
    table = BucketedTable(job.session, f"{job.base}/last", schema, ["phone_type", "uid"])

    def last_of_batch(batch, batch_id):
        # Equal times are ordered by the event.
        latest = top_per_group(batch, ["phone_type", "uid"], [("time", "desc"), ("event_id", "desc")], 1).drop("rownum")
        table.write(latest, batch_id, seq="seq")

    job.run(rows, last_of_batch)
    return job.seen(table).withColumn("time", times.at_rest("time"))


@query("snk7_wide_column_stream", f"""
    SELECT uid AS rowkey, arg_max(phone_type, (time, event_id)) AS phone_type, arg_max(click_count, (time, event_id)) AS click_count
    FROM {BEHAVIOUR} GROUP BY uid""")
def snk7_stream(spark, folder):
    """One wide row per user in one column family, rewritten bucket by bucket."""
    job = Job(spark, "snk7")
    rows = as_behaviour(event_stream(job.session, folder))
    wide = wide_row(rows, F.col("uid"), {"phone_type": "phone_type", "click_count": "click_count", "event_id": "event_id", "time": "time"})
    table = BucketedTable(job.session, f"{job.base}/wide", wide.schema, ["rowkey"])

    def write(batch, batch_id):
        at = batch.withColumns({"time": F.col("cf.time"), "event": F.col("cf.event_id")})
        latest = top_per_group(at, ["rowkey"], [("time", "desc"), ("event", "desc")], 1)
        table.write(latest.withColumn("seq", F.unix_micros("time")), batch_id, seq="seq")

    job.run(wide, write)
    return job.seen(table).select("rowkey", "cf.phone_type", "cf.click_count")


@query("snk10_dead_letters_stream", """
    SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'no record' WHEN event_id % 50 = 1 THEN 'field clicks'
        WHEN event_id % 50 = 2 THEN 'time at' ELSE 'kept' END AS fate FROM events""")
def snk10_stream(spark, folder):
    """Every line is either kept or put aside with its reason; together they are all lines."""
    job = Job(spark, "snk10")
    number = F.col("event_id")
    fields = F.struct("event_id", F.when(number % 50 == 1, "many").otherwise(F.floor("value").cast("string")).alias("clicks"),
                      F.when(number % 50 == 2, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("at"))
    # Numbers are written as numbers.
    line = F.regexp_replace(F.to_json(fields), r'"clicks":"(\d+)"', '"clicks":$1')
    lines = event_stream(job.session, folder).select(
        F.when(number % 50 == 0, F.concat(F.lit("{broken "), number.cast("string"))).otherwise(line).alias("value"))
    schema = T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("clicks", T.LongType()), T.StructField("at", T.StringType())])
    counts = {}
    job.run(tagged_json(lines, schema, times={"at": "yyyy-MM-dd HH:mm:ss"}),
            files.kept_and_dead(files.append_batch(job.out), f"{job.base}/dead", counts))
    kept = spark.read.parquet(job.out)
    dead = spark.read.parquet(f"{job.base}/dead")
    if (kept.count() + dead.count(), dead.count()) != tuple(map(sum, zip(*counts.values()))):
        raise RuntimeError("kept and refused lines do not add up to those that passed")
    whose = F.coalesce(F.get_json_object("value", "$.event_id"), F.regexp_extract("value", r"(\d+)$", 1)).cast("bigint")
    return kept.select("event_id", F.lit("kept").alias("fate")).unionByName(dead.select(whose.alias("event_id"), F.col("reason").alias("fate")))


@query("jn5_refreshed_lookup_stream", f"""
    SELECT event_id, c_name || ' v' || first AS c_name FROM (
        SELECT event_id, user_id, min(n) OVER (PARTITION BY user_id) AS first
        FROM (SELECT event_id, user_id, CAST({ARRIVAL_SQL} AS BIGINT) AS n FROM events)) JOIN customer ON user_id = c_custkey""")
def jn5_stream(spark, folder):
    """The dimension changes with each batch; a key that was looked up once is answered from the cache."""
    job = Job(spark, "jn5")
    customers = named_table(job.session, folder, "customer").select("c_custkey", "c_name")
    batch_now = [0]

    def load(keys):
        named = customers.withColumn("c_name", F.concat("c_name", F.lit(f" v{batch_now[0]}")))
        return named.join(keys, "c_custkey", "left_semi")

    cache = LookupCache(job.session, load, customers.schema, ["c_custkey"], ttl=float("inf"), max_keys=1_000_000)
    append = files.append_batch(job.out)

    def write(batch, batch_id):
        batch_now[0] = batch_id
        append(cache.join(batch, ["user_id"]).select("event_id", "c_name"), batch_id)

    job.run(event_stream(job.session, folder).select("event_id", "user_id"), write)
    return spark.read.parquet(job.out).drop("batch")


@query("jn3_refreshed_lookup_stream", """
    SELECT event_id, c_name FROM events JOIN customer ON user_id = c_custkey""")
def jn3_stream(spark, folder):
    job = Job(spark, "jn3")
    # Built anew in each micro-batch: a file table is listed when its DataFrame is made.
    dimension = RefreshingDimension(
        lambda: named_table(job.session, folder, "customer").select("c_custkey", "c_name"), ttl=0.0
    )
    facts = event_stream(job.session, folder).select("event_id", "user_id")
    append = files.append_batch(job.out)
    job.run(facts, db.lookup_writer(dimension, "user_id", "c_custkey", lambda b, i: append(b.select("event_id", "c_name"), i)))
    return spark.read.parquet(job.out).drop("batch")


@query("src4_generated_stream", tq.GENERATED)
def src4_stream(spark, folder):
    """One generated row per event at a rate, until the sequence ends; the events are joined to it by their number."""
    job = Job(spark, "src4")
    events = named_table(spark, folder, "events").select("event_id", "user_id")
    end = (events.agg(F.max("event_id")).first()[0] or 0) + 1
    source = function_stream(job.session, NUMBERS, end, rows_per_second=end / 4)
    made = with_fields(source, "value", tq.GENERATED_FIELDS, seed=7).drop("value")
    run_to(made, files.append_batch(job.out), job.checkpoint, {"n": end})
    return tq.generated_facts(events.join(job.rows(made.schema), F.col("event_id") + 1 == F.col("f_sequence")))


@query("snk12_event_time_folders_stream", tq.DATED)
def snk12_stream(spark, folder):
    job = Job(spark, "snk12")
    lines = tq.dated_lines(event_stream(job.session, folder)).withColumn("dt", files.event_date("value"))
    text_rows(lines, job.out, job.checkpoint, ("dt",)).awaitTermination()
    stored = spark.read.schema("value string, dt string").text(job.out)
    return stored.select("dt", F.col("value").alias("line"))


@query("snk11_rolling_files_stream", """
    SELECT event_type, count(*) AS rows FROM events GROUP BY event_type""")
def snk11_stream(spark, folder):
    job = Job(spark, "snk11")
    lines = tq.dated_lines(event_stream(job.session, folder))
    text_rows(lines, job.out, job.checkpoint, rows_per_file=1_000).awaitTermination()
    stored = spark.read.text(job.out)
    kind = F.element_at(F.split("value", ","), 3)
    return stored.groupBy(kind.alias("event_type")).agg(F.count(F.lit(1)).alias("rows"))


@query("snk11_rolled_by_size_and_idleness_stream", f"""
    SELECT dt, count(*) AS rows, CAST(sum(strlen(line) + 1) AS BIGINT) AS bytes FROM ({tq.DATED}) GROUP BY dt""")
def snk11_rolled_stream(spark, folder):
    """Folders roll by size while rows come; the clock then runs on and the rest is closed as idle."""
    job = Job(spark, "snk11_rolled")
    lines = tq.dated_lines(event_stream(job.session, folder)).withColumn("dt", files.event_date("value"))
    late = [0.0]
    sink = RollingFiles(job.session, job.out, ["dt"], 20_000, timedelta(hours=1), timedelta(minutes=1), clock=lambda: time.time() + late[0])
    job.run(lines, sink)
    late[0] = 61.0
    sink.tick()
    done = RollingFiles(spark, job.out, ["dt"], 20_000, timedelta(hours=1), timedelta(minutes=1)).finished()
    return done.groupBy("dt").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("value") + 1).alias("bytes"))


@query("snk13_partition_commit_stream", tq.COMMITTED)
def snk13_stream(spark, folder):
    job = Job(spark, "snk13")
    rows = event_stream(job.session, folder).select(
        "event_id", "user_id", "ts", F.date_format("ts", "yyyy-MM-dd").alias("ts_date")
    )
    sink = files.CommittingPartitions(
        job.session, job.out, ["ts_date"], "ts", grain=timedelta(days=1), delay=timedelta(seconds=3)
    )
    job.run(rows, sink)
    stored = spark.read.schema("event_id bigint, ts_date string").parquet(f"{job.out}/data")
    return stored.join(spark.read.parquet(f"{job.out}/committed").select("ts_date").distinct(), "ts_date").groupBy(
        "ts_date"
    ).agg(F.count(F.lit(1)).alias("rows"))


@query("snk14_topic_chain_stream", dq.HOURLY_VIEWS)
def snk14_stream(spark, folder):
    """The first job writes each change of an hour to a topic, the second keeps the largest value."""
    job = Job(spark, "snk14")
    views = as_behaviour(event_stream(job.session, folder)).groupBy(
        times.hour_label("time").alias("hour"), "uid"
    ).agg(F.count(F.lit(1)).alias("n"))
    topic = f"{job.base}/topic"

    def publish(batch, batch_id):
        files.to_topic(batch.select("hour", "uid", "n"), topic, batch_id=batch_id)

    job.run(views, publish, "update")
    schema = T.StructType([
        T.StructField("hour", T.StringType()), T.StructField("uid", T.StringType()), T.StructField("n", T.LongType()),
    ])
    second = json_topic(job.session, Topic(path=f"{topic}/batch=*"), schema)
    latest = second.groupBy("hour", "uid").agg(F.max("n").alias("n"))
    table = job.keyed(latest.schema, ["hour", "uid"])
    drain(latest, table.write, f"{job.base}/checkpoint2", "update")
    return job.read(table).groupBy("hour").agg(F.sum("n").alias("pv"), F.count(F.lit(1)).alias("uv"))


@query("snk15_several_sinks_stream", f"""
    SELECT 'rows' AS target, category, count(*) AS n FROM {AMOUNTS} GROUP BY category
    UNION ALL SELECT 'totals', category, CAST(sum(value) AS BIGINT) FROM {AMOUNTS} GROUP BY category""")
def snk15_stream(spark, folder):
    job = Job(spark, "snk15")
    amounts = as_amounts(event_stream(job.session, folder)).select("event_id", "category", "value")
    schema = amounts.select("category", "value").schema
    table = job.keyed(schema, ["category"], "add", ["value"])
    job.run(amounts, files.several(files.append_batch(job.out), table.write))
    rows = job.rows(amounts.schema).groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return rows.select(F.lit("rows").alias("target"), "category", "n").unionByName(
        job.read(table).select(F.lit("totals").alias("target"), "category", F.col("value").alias("n"))
    )
