"""Projection, filter and table definition."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseboard.functions import times
from pulseboard.operators import changes as ch
from pulseboard.operators.shape import by_position, elements, into_columns, wide_row
from pulseboard.operators.topk import top_per_group
from pulseboard.plans.inputs import (
    BEHAVIOUR, CHANGES, PROFILES, ROOMS, behaviour, changes, events, profiles, rooms,
)
from pulseboard.plans.registry import query
from pulseboard.session import new_path
from pulseboard.sources.tables import named_table


@query("prj1_rename_by_position", f"""
    SELECT uid AS uid1, time AS created_time1, phone_type AS kind1 FROM {BEHAVIOUR}""")
def prj1(spark, folder):
    rows = behaviour(spark, folder).select("uid", times.at_rest("time"), "phone_type")
    return by_position(rows, ["uid1", "created_time1", "kind1"])


@query("prj2_whole_table", "SELECT * FROM customer")
def prj2(spark, folder):
    return named_table(spark, folder, "customer").select("*")


@query("prj3_computed_columns", f"""
    SELECT id, created_time, make_timestamp(created_time // 1000 * 1000000) AS event_time FROM {PROFILES}""")
def prj3(spark, folder):
    rows = profiles(spark, folder).select("id", "created_time")
    return rows.withColumn("event_time", times.at_rest(times.millis_to_timestamp("created_time")))


@query("prj4_derived_table", f"""
    SELECT day, CAST(max(clicks) AS BIGINT) AS most_clicks, count(*) AS users
    FROM (SELECT uid, strftime(time, '%Y-%m-%d') AS day, sum(click_count) AS clicks FROM {BEHAVIOUR} GROUP BY uid, day)
    GROUP BY day""")
def prj4(spark, folder):
    per_user = behaviour(spark, folder).groupBy("uid", F.date_format("time", "yyyy-MM-dd").alias("day")).agg(
        F.sum("click_count").alias("clicks")
    )
    return per_user.groupBy("day").agg(F.max("clicks").alias("most_clicks"), F.count(F.lit(1)).alias("users"))


@query("prj5_wide_row", f"""
    SELECT CAST(id AS VARCHAR) AS rowkey, uid AS cf_uid, sex AS cf_sex, age AS cf_age, created_time AS cf_created
    FROM {PROFILES}""")
def prj5(spark, folder):
    wide = wide_row(
        profiles(spark, folder), F.col("id").cast("string"),
        {"uid": "uid", "sex": "sex", "age": "age", "created_time": "created_time"},
    )
    return wide.select(
        "rowkey", F.col("cf.uid").alias("cf_uid"), F.col("cf.sex").alias("cf_sex"), F.col("cf.age").alias("cf_age"),
        F.col("cf.created_time").alias("cf_created"),
    )


@query("prj6_target_columns", """
    SELECT o_orderkey AS id, CAST(NULL AS INTEGER) AS times, o_orderpriority AS gname,
        CAST(CAST(o_custkey AS DECIMAL(38,18)) AS VARCHAR) AS counts FROM orders""")
def prj6(spark, folder):
    target = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("times", T.IntegerType()),
        T.StructField("gname", T.StringType()), T.StructField("counts", T.DecimalType(38, 18)),
    ])
    rows = named_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    filled = into_columns(rows, target, ["id", "counts", "gname"])
    return filled.withColumn("counts", F.col("counts").cast("string"))


@query("prj7_map_records", """
    SELECT c_custkey AS uid, upper(c_name) AS name, c_nationkey * 2 + 1 AS code FROM customer""")
def prj7(spark, folder):
    return named_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("uid"), F.upper("c_name").alias("name"), (F.col("c_nationkey") * 2 + 1).alias("code")
    )


@query("prj8_list_elements", """
    SELECT doc_id, unnest(string_split(text, chr(10))) AS element FROM documents""")
def prj8(spark, folder):
    lines = named_table(spark, folder, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    return elements(lines, "lines", ["doc_id"])


@query("flt1_rank_filter", f"""
    SELECT room_id, uid, cnt, rownum FROM (
        SELECT room_id, uid, cnt, row_number() OVER (PARTITION BY room_id ORDER BY cnt DESC, uid) AS rownum
        FROM (SELECT room_id, uid, CAST(sum(action) AS BIGINT) AS cnt FROM {ROOMS} GROUP BY room_id, uid))
    WHERE rownum <= 3""")
def flt1(spark, folder):
    counts = rooms(spark, folder).groupBy("room_id", "uid").agg(F.sum("action").alias("cnt"))
    return top_per_group(counts, ["room_id"], [("cnt", "desc"), "uid"], 3)


@query("flt2_event_predicates", f"""
    SELECT event_id, click_count > 7 AS is_start, phone_type = 'purchase' AS is_end
    FROM {BEHAVIOUR} WHERE click_count > 7 OR phone_type = 'purchase'""")
def flt2(spark, folder):
    start, end = F.col("click_count") > 7, F.col("phone_type") == "purchase"
    return behaviour(spark, folder).where(start | end).select("event_id", start.alias("is_start"), end.alias("is_end"))


@query("flt3_retract_flag", f"SELECT op, seq, id, amount FROM {CHANGES} WHERE op IN ('+I', '+U')")
def flt3(spark, folder):
    return ch.accumulating(changes(spark, folder)).where("flag").select("op", "seq", "id", "amount")


def _database(spark, name):
    # The name is fresh, so that two runs in one session do not meet.
    database = f"pulseboard_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{new_path(spark, name)}'")
    return database


@query("ddl1_database_and_table", """
    SELECT event_type, strftime(ts, '%Y-%m-%d') AS ts_date, count(*) AS cnt FROM events GROUP BY ALL""")
def ddl1(spark, folder):
    database = _database(spark, "ddl1")
    spark.sql(f"DROP TABLE IF EXISTS {database}.daily")
    spark.sql(
        f"CREATE TABLE {database}.daily (event_type STRING, cnt BIGINT, ts_date STRING) USING parquet "
        "PARTITIONED BY (ts_date)"
    )
    daily = events(spark, folder).groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("ts_date")).agg(
        F.count(F.lit(1)).alias("cnt")
    )
    daily.select("event_type", "cnt", "ts_date").write.insertInto(f"{database}.daily")
    return spark.table(f"{database}.daily").select("event_type", "ts_date", "cnt")


@query("ddl2_table_like", f"SELECT id, uid, sex, age, created_time FROM {PROFILES}")
def ddl2(spark, folder):
    database = _database(spark, "ddl2")
    rows = profiles(spark, folder)
    rows.limit(0).write.saveAsTable(f"{database}.model", format="parquet")
    spark.sql(f"CREATE TABLE {database}.copy LIKE {database}.model USING parquet")
    rows.write.insertInto(f"{database}.copy")
    return spark.table(f"{database}.copy")


@query("ddl3_temporary_view", f"""
    SELECT phone_type, CAST(sum(click_count) AS BIGINT) AS clicks FROM {BEHAVIOUR} GROUP BY phone_type""")
def ddl3(spark, folder):
    behaviour(spark, folder).createOrReplaceTempView("pulseboard_behaviour")
    return spark.sql("SELECT phone_type, sum(click_count) AS clicks FROM pulseboard_behaviour GROUP BY phone_type")
