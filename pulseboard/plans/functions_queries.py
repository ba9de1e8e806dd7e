"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseboard.functions import geo, records, text, times
from pulseboard.plans.inputs import BEHAVIOUR, LOCATIONS, PROFILES, behaviour, events, locations, profiles
from pulseboard.plans.registry import query
from pulseboard.sources.tables import named_table

# A timestamp as text with three digits of the fraction, cut and not rounded.
_MS_TEXT = "strftime(date_trunc('milliseconds', {c}), '%Y-%m-%d %H:%M:%S.%g')"


@query("f1_substring", """
    SELECT o_orderkey, substr(o_orderpriority, 1, 3) AS first_three, substr(o_orderpriority, 1, 4) AS from_zero,
        substr(o_orderpriority, 3) AS rest FROM orders""")
def f1(spark, folder):
    orders = named_table(spark, folder, "orders")
    return orders.select(
        "o_orderkey",
        text.head("o_orderpriority", 3).alias("first_three"),
        F.substring("o_orderpriority", 0, 4).alias("from_zero"),
        text.tail("o_orderpriority", 3).alias("rest"),
    )


@query("f2_concat", """
    SELECT o_orderkey, o_orderstatus || '-' || o_orderpriority AS joined,
        o_orderstatus || nullif(o_orderpriority, '5-LOW') AS null_in FROM orders""")
def f2(spark, folder):
    orders = named_table(spark, folder, "orders")
    return orders.select(
        "o_orderkey",
        F.concat("o_orderstatus", F.lit("-"), "o_orderpriority").alias("joined"),
        F.concat("o_orderstatus", F.nullif("o_orderpriority", F.lit("5-LOW"))).alias("null_in"),
    )


@query("f3_date_format", """
    SELECT event_id, strftime(ts, '%H:%M') AS clock, strftime(ts, '%Y-%m-%d %H:00') AS hour,
        strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H') AS hh, strftime(ts, '%M') AS mm FROM events""")
def f3(spark, folder):
    return events(spark, folder).select(
        "event_id",
        F.date_format("ts", "HH:mm").alias("clock"),
        times.hour_label("ts").alias("hour"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.date_format("ts", "HH").alias("hh"),
        F.date_format("ts", "mm").alias("mm"),
    )


# Every third text is plain, every third in ISO form, every third is no time at all.
def _time_texts(spark, folder):
    return events(spark, folder).select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, F.date_format("ts", times.MILLIS_FORMAT))
        .when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .otherwise(F.concat(F.lit("at "), "event_type"))
        .alias("text"),
    )


@query("f4_to_timestamp", """
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN date_trunc('milliseconds', ts) END AS parsed FROM events""")
def f4(spark, folder):
    return _time_texts(spark, folder).select(
        "event_id", times.at_rest(times.parse_timestamp("text")).alias("parsed")
    )


@query("f5_epoch_to_timestamp", """
    SELECT event_id, date_trunc('second', ts) AS seconds, strftime(ts, '%Y-%m-%d %H:%M:%S') AS seconds_text
    FROM events""")
def f5(spark, folder):
    ms = events(spark, folder).select("event_id", F.unix_millis("ts").alias("ms"))
    return ms.select(
        "event_id",
        times.at_rest(times.millis_to_timestamp("ms")).alias("seconds"),
        F.from_unixtime(F.expr("ms div 1000"), times.SECONDS_FORMAT).alias("seconds_text"),
    )


@query("f6_unix_timestamp", """
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(floor(epoch(ts)) AS BIGINT) END AS seconds FROM events""")
def f6(spark, folder):
    return _time_texts(spark, folder).select("event_id", times.epoch_seconds("text").alias("seconds"))


@query("f7_literals", """
    SELECT event_type, count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-16 13:39:06.454') AS after_instant,
        count(*) FILTER (WHERE CAST(ts AS DATE) = DATE '2024-01-11') AS on_day,
        count(*) FILTER (WHERE CAST(ts AS TIME) >= TIME '12:14:50') AS after_clock,
        max(CAST(TIME '12:14:50' AS VARCHAR)) AS clock
    FROM events GROUP BY event_type""")
def f7(spark, folder):
    events(spark, folder).createOrReplaceTempView("pulseboard_events")
    return spark.sql("""
        SELECT event_type, count_if(ts >= TIMESTAMP '2024-01-16 13:39:06.454') AS after_instant,
            count_if(CAST(ts AS DATE) = DATE '2024-01-11') AS on_day,
            count_if(date_format(ts, 'HH:mm:ss') >= CAST(TIME '12:14:50' AS STRING)) AS after_clock,
            max(CAST(TIME '12:14:50' AS STRING)) AS clock
        FROM pulseboard_events GROUP BY event_type""")


@query("f8_calendar_parts", """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
        CAST(month(o_orderdate) AS INTEGER) AS month, CAST(dayofyear(o_orderdate) AS INTEGER) AS day_of_year,
        CAST(dayofmonth(o_orderdate) AS INTEGER) AS day_of_month FROM orders""")
def f8(spark, folder):
    orders = named_table(spark, folder, "orders")
    parts = times.calendar_parts("o_orderdate")
    return orders.select("o_orderkey", *[c.alias(n) for n, c in parts.items() if n != "week"])


@query("f9_week", "SELECT o_orderkey, CAST(week(o_orderdate) AS INTEGER) AS week FROM orders")
def f9(spark, folder):
    orders = named_table(spark, folder, "orders")
    return orders.select("o_orderkey", times.calendar_parts("o_orderdate")["week"].alias("week"))


@query("f10_clock_parts", """
    SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute,
        CAST(second(ts) AS INTEGER) AS second FROM events""")
def f10(spark, folder):
    return events(spark, folder).select("event_id", *[c.alias(n) for n, c in times.clock_parts("ts").items()])


@query("f11_timestamp_text", f"""
    SELECT event_id, t AS ts_text, substr(t, 1, 10) AS date_text, substr(t, 12) AS time_text
    FROM (SELECT event_id, {_MS_TEXT.format(c='ts')} AS t FROM events)""")
def f11(spark, folder):
    t = times.timestamp_text("ts")
    return events(spark, folder).select(
        "event_id", t.alias("ts_text"), text.head(t, 10).alias("date_text"), text.tail(t, 12).alias("time_text")
    )


@query("f12_casts", """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_orderkey AS VARCHAR) AS key_text,
        CAST(CAST(l_quantity AS DECIMAL(38,18)) AS VARCHAR) AS quantity FROM lineitem""")
def f12(spark, folder):
    return named_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_orderkey").cast("string").alias("key_text"),
        F.col("l_quantity").cast("decimal(38,18)").cast("string").alias("quantity"),
    )


@query("f13_md5", "SELECT c_custkey, md5(c_name) AS lower_hex, upper(md5(c_name)) AS upper_hex FROM customer")
def f13(spark, folder):
    return named_table(spark, folder, "customer").select(
        "c_custkey", F.md5("c_name").alias("lower_hex"), text.md5_key("c_name").alias("upper_hex")
    )


@query("f14_hash_bucket", """
    SELECT count(*) AS keys, count(*) AS in_range, TRUE AS stable FROM customer""")
def f14(spark, folder):
    keyed = named_table(spark, folder, "customer").select(
        text.hash_bucket("c_custkey").alias("b"),
        text.hash_bucket(F.col("c_custkey").cast("string")).alias("again"),
    )
    return keyed.agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("b").between(0, 127)).alias("in_range"),
        F.bool_and(F.col("b") == F.col("again")).alias("stable"),
    )


@query("f15_current_time", "SELECT event_type, count(*) AS rows, TRUE AS one_value FROM events GROUP BY event_type")
def f15(spark, folder):
    stamped = events(spark, folder).select(
        "event_type", F.localtimestamp().alias("local"), F.current_timestamp().alias("now")
    )
    return stamped.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"),
        ((F.min("local") == F.max("local")) & (F.min("now") == F.max("now"))).alias("one_value"),
    )


@query("f16_ten_minute_label", """
    SELECT event_id, substr(strftime(ts, '%H:%M'), 1, 4) || '0' AS clock_label,
        substr(strftime(ts, '%Y-%m-%d %H:%M'), 1, 15) || '0' AS day_label FROM events""")
def f16(spark, folder):
    return events(spark, folder).select(
        "event_id",
        times.ten_minute_label("ts", with_date=False).alias("clock_label"),
        times.ten_minute_label("ts").alias("day_label"),
    )


PROFILE_KEY_SQL = """substr(md5(CAST(uid AS VARCHAR)), 1, 6) || substr({c}, 1, 10) || sex ||
    substr(md5(substr({c}, 12)), 1, 6)"""


@query("f17_salted_row_key", f"""
    SELECT id, {PROFILE_KEY_SQL.format(c="CAST(created_time AS VARCHAR)")} AS epoch_key,
        {PROFILE_KEY_SQL.format(c="strftime(make_timestamp(created_time * 1000), '%Y-%m-%d %H:%M:%S.%g')")} AS text_key,
        substr(md5(CAST(uid AS VARCHAR)), 1, 6) || substr(md5(sex), 1, 6) AS pair_key
    FROM {PROFILES}""")
def f17(spark, folder):
    created = times.timestamp_text(F.timestamp_millis("created_time"))
    return profiles(spark, folder).select(
        "id",
        text.profile_row_key("uid", "created_time", "sex").alias("epoch_key"),
        text.profile_row_key("uid", created, "sex").alias("text_key"),
        text.pair_row_key("uid", "sex").alias("pair_key"),
    )


_LAT_CELL = "least(CAST(floor((latitude + 90.0) / 180.0 * 1073741824.0) AS BIGINT), 1073741823)"
_LON_CELL = "least(CAST(floor((longitude + 180.0) / 360.0 * 1073741824.0) AS BIGINT), 1073741823)"
# Bit j of the code, from the top: even bits are of the longitude, odd ones of the latitude.
_GEO_SQL = f"""array_to_string(list_transform(range(0, 12), lambda i:
    substr('{geo.GEOHASH_ALPHABET}', CAST(1 + list_sum(list_transform(range(0, 5), lambda b:
        ((CASE WHEN (5 * i + b) % 2 = 0 THEN lon_cell ELSE lat_cell END >> CAST(29 - (5 * i + b) // 2 AS BIGINT)) & 1)
        * CAST(pow(2, 4 - b) AS BIGINT))) AS BIGINT), 1)), '')"""


@query("f18_geohash", f"""
    SELECT uid, code AS geohash12, substr(code, 1, 7) AS geohash7,
        code || substr(upper(md5(CAST(uid AS VARCHAR))), 1, 6) AS row_key
    FROM (SELECT uid, {_GEO_SQL} AS code
          FROM (SELECT uid, {_LAT_CELL} AS lat_cell, {_LON_CELL} AS lon_cell FROM {LOCATIONS}))""")
def f18(spark, folder):
    return locations(spark, folder).select(
        "uid",
        geo.geohash("latitude", "longitude").alias("geohash12"),
        geo.geohash("latitude", "longitude", 7).alias("geohash7"),
        geo.location_row_key("uid", "latitude", "longitude").alias("row_key"),
    )


def credit_lines(spark, folder):
    """Log records: JSON with a comma-separated message; some messages are too short or no numbers."""
    return named_table(spark, folder, "lineitem").select(
        F.to_json(F.struct(
            F.when(F.col("l_partkey") % 11 == 0, F.concat(F.lit("short,"), F.col("l_orderkey").cast("string")))
            .otherwise(F.concat_ws(
                ",", F.col("l_orderkey").cast("string"), F.date_format("l_shipdate", "yyyyMMdd"),
                F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("bigint").cast("string"),
            )).alias("message"),
            F.struct(F.col("l_suppkey").alias("offset")).alias("log"),
        )).alias("value")
    )


CREDITS = """(SELECT CASE WHEN l_partkey % 11 <> 0 THEN l_orderkey END AS uid,
    CASE WHEN l_partkey % 11 = 0 THEN l_orderkey ELSE CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) END AS date_of,
    CASE WHEN l_partkey % 11 <> 0 THEN l_linenumber END AS num,
    CASE WHEN l_partkey % 11 <> 0 THEN CAST(CAST(l_quantity AS BIGINT) AS DECIMAL(38,18)) END AS credit,
    l_suppkey AS log_offset FROM lineitem)"""


def credits(spark, folder):
    return credit_records(credit_lines(spark, folder))


def credit_records(lines):
    parts = records.computed_once(lines, {
        "m": F.split(records.json_path("value", "$.message"), ","), "o": records.json_path("value", "$.log.offset"),
    })

    def field(position, data_type):
        return F.try_element_at("m", F.lit(position)).try_cast(data_type)

    return parts.select(
        field(1, "bigint").alias("uid"),
        field(2, "bigint").alias("date_of"),
        field(3, "int").alias("num"),
        field(4, "decimal(38,18)").alias("credit"),
        F.col("o").cast("bigint").alias("log_offset"),
    )


@query("f19_csv_fields", f"SELECT uid, date_of, num, CAST(credit AS VARCHAR) AS credit FROM {CREDITS}")
def f19(spark, folder):
    return credits(spark, folder).select("uid", "date_of", "num", F.col("credit").cast("string").alias("credit"))


@query("f20_json_path", f"""
    SELECT log_offset, count(*) AS records, count(uid) AS readable FROM {CREDITS} GROUP BY log_offset""")
def f20(spark, folder):
    return credits(spark, folder).groupBy("log_offset").agg(
        F.count(F.lit(1)).alias("records"), F.count("uid").alias("readable")
    )


@query("f21_epoch_text", """
    SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS stamp, strftime(ts, '%Y%m%d') AS day,
        strftime(ts + INTERVAL 8 HOUR, '%Y%m%d%H%M%S') AS local_stamp FROM events""")
def f21(spark, folder):
    ms = events(spark, folder).select("event_id", F.unix_millis("ts").alias("ms"))
    return ms.select(
        "event_id",
        times.format_millis("ms").alias("stamp"),
        times.format_millis("ms", "yyyyMMdd").alias("day"),
        times.format_millis("ms", zone="Asia/Shanghai").alias("local_stamp"),
    )


@query("f22_hash_field", f"""
    SELECT event_id, uid || '_' || phone_type AS field, CAST(click_count AS VARCHAR) AS value FROM {BEHAVIOUR}""")
def f22(spark, folder):
    return behaviour(spark, folder).select(
        "event_id",
        text.hash_field("uid", "phone_type").alias("field"),
        F.col("click_count").cast("string").alias("value"),
    )


RECORD_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("clicks", T.LongType()),
])


def as_lines(rows):
    """Events as JSON lines; one in fifty is cut off, one in fifty has a text where a number belongs."""
    good = F.to_json(F.struct("event_id", "user_id", "event_type", F.floor("value").alias("clicks")))
    mistyped = F.to_json(F.struct("event_id", "user_id", "event_type", F.lit("many").alias("clicks")))
    return rows.select(
        F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("{broken "), F.col("event_id").cast("string")))
        .when(F.col("event_id") % 50 == 1, mistyped)
        .otherwise(good)
        .alias("value")
    )


DECODED = """(SELECT event_id, user_id, event_type,
    CASE WHEN event_id % 50 <> 1 THEN CAST(floor(value) AS BIGINT) END AS clicks
    FROM events WHERE event_id % 50 <> 0)"""


@query("f30_json_decode", f"SELECT event_id, user_id, event_type, clicks FROM {DECODED}")
def f30(spark, folder):
    return records.decode_json(as_lines(events(spark, folder)), RECORD_SCHEMA)


@query("f30_json_decode_sentinel", f"""
    SELECT event_id, user_id, event_type, clicks FROM {DECODED}
    UNION ALL SELECT 0, 0, '', 0 FROM events WHERE event_id % 50 = 0""")
def f30_sentinel(spark, folder):
    return records.decode_json(
        as_lines(events(spark, folder)), RECORD_SCHEMA, policy="sentinel",
        sentinel={"event_id": 0, "user_id": 0, "event_type": "", "clicks": 0},
    )


@query("f31_json_timestamps", "SELECT event_id, date_trunc('milliseconds', ts) AS ts FROM events")
def f31(spark, folder):
    lines = events(spark, folder).select(F.to_json(
        F.struct("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("ts"))
    ).alias("value"))
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType())])
    decoded = records.decode_json(lines, schema, timestamp_format="yyyy-MM-dd'T'HH:mm:ss.SSSX")
    return decoded.select("event_id", times.at_rest("ts").alias("ts"))


@query("f32_json_encode", """
    SELECT c_custkey, '{"name":"' || c_name || '","num":' || CAST(c_nationkey AS VARCHAR) || '}' AS doc
    FROM customer""")
def f32(spark, folder):
    return named_table(spark, folder, "customer").select(
        "c_custkey", records.encode_json(F.col("c_name").alias("name"), F.col("c_nationkey").alias("num")).alias("doc")
    )
