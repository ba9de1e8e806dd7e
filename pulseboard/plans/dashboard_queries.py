"""Aggregates, windows, ranking and event sequences."""

from __future__ import annotations

import operator

from pyspark.sql import functions as F

from pulseboard.functions import times
from pulseboard.operators import aggregates as ag
from pulseboard.operators.merging import LatestWithTotal, Reduce, merged
from pulseboard.operators.ordered import global_row_number, running, running_distinct
from pulseboard.operators.pattern import alert_rows, followed_by
from pulseboard.operators.topk import top_overall, top_per_group
from pulseboard.plans.inputs import AMOUNTS, BEHAVIOUR, ROOMS, amounts, behaviour, rooms
from pulseboard.plans.registry import query
from pulseboard.streaming.dashboards import first_seen, running_users

# Input spans are longer than the defaults of the operators, since the events lie minutes apart.
TUMBLE = "1 hour"
SLIDE_SIZE, SLIDE_STEP = "1 hour", "10 minutes"
PATTERN_SPAN = "1 hour"

HOURLY_VIEWS = f"""SELECT strftime(time, '%Y-%m-%d %H:00') AS hour, count(*) AS pv, count(DISTINCT uid) AS uv
    FROM {BEHAVIOUR} GROUP BY hour"""


@query("agg1_hourly_pv_uv", HOURLY_VIEWS)
def agg1(spark, folder):
    return ag.page_and_user_views(behaviour(spark, folder))


RUNNING_USERS_ROWS = f"""(SELECT event_id, count(DISTINCT uid) OVER w AS cnt,
    max(substr(strftime(time, '%Y-%m-%d %H:%M'), 1, 15) || '0') OVER w AS label FROM {BEHAVIOUR}
    WINDOW w AS (ORDER BY time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def running_user_rows(rows):
    # The label grows with the time, so the running maximum is taken of the time.
    counted = running_distinct(
        rows.select("event_id", "uid", "time"), ["time", "event_id"], "uid", "cnt", {"_latest": ("max", "time")}
    )
    return counted.select("event_id", "cnt", times.ten_minute_label("_latest").alias("label"))


@query("agg2_max_by_label", f"SELECT label, max(cnt) AS cnt FROM {RUNNING_USERS_ROWS} GROUP BY label")
def agg2(spark, folder):
    return running_user_rows(behaviour(spark, folder)).groupBy("label").agg(F.max("cnt").alias("cnt"))


ROOM_HOURS = f"""(SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
    room_id, CAST(sum(action) AS BIGINT) AS cnt FROM {ROOMS} GROUP BY ALL)"""


def room_hours(rows):
    return ag.window_sum(rows, "ts", "action", ["room_id"], TUMBLE)


def borders_at_rest(df):
    return df.withColumns({c: times.at_rest(c) for c in ("window_start", "window_end") if c in df.columns})


@query("agg3_room_window_sum", f"SELECT * FROM {ROOM_HOURS}")
def agg3(spark, folder):
    return borders_at_rest(room_hours(rooms(spark, folder)))


@query("agg4_net_room_change", f"""
    SELECT room_id, CAST(sum(action) AS BIGINT) AS cnt FROM {ROOMS} GROUP BY room_id""")
def agg4(spark, folder):
    return rooms(spark, folder).groupBy("room_id").agg(F.sum("action").alias("cnt"))


USER_CLICKS = f"""SELECT uid, phone_type, CAST(sum(click_count) AS BIGINT) AS cnt FROM {BEHAVIOUR}
    GROUP BY uid, phone_type"""


@query("agg5_clicks_by_user_and_type", USER_CLICKS)
def agg5(spark, folder):
    return behaviour(spark, folder).groupBy("uid", "phone_type").agg(F.sum("click_count").alias("cnt"))


@query("agg6_total_with_latest", f"""
    SELECT uid, arg_max(phone_type, (time, event_id)) AS phone_type, CAST(sum(click_count) AS BIGINT) AS cnt
    FROM {BEHAVIOUR} GROUP BY uid""")
def agg6(spark, folder):
    return ag.latest_with_total(behaviour(spark, folder), "uid", ["time", "event_id"], "phone_type", "click_count")


@query("agg6_total_with_latest_merged", f"""
    SELECT uid, arg_max(phone_type, (time, event_id)) AS phone_type, CAST(sum(click_count) AS BIGINT) AS cnt
    FROM {BEHAVIOUR} GROUP BY uid""")
def agg6_merged(spark, folder):
    """As a user's own aggregate: partials per task, merged as a tree."""
    rows = behaviour(spark, folder).select("uid", "time", "event_id", "phone_type", "click_count")
    return merged(rows, ["uid"], LatestWithTotal(["time", "event_id"], "phone_type", "click_count"), "phone_type string, cnt bigint")


# Local day of a zone eight hours ahead: it starts at 16:00 UTC.
DAY_TOTALS = f"""SELECT date_trunc('day', ts + INTERVAL 8 HOUR) - INTERVAL 8 HOUR AS window_start,
    date_trunc('day', ts + INTERVAL 8 HOUR) + INTERVAL 16 HOUR AS window_end, category,
    CAST(sum(value) AS BIGINT) AS cnt FROM {AMOUNTS} GROUP BY ALL"""


@query("agg7_day_total", DAY_TOTALS)
def agg7(spark, folder):
    return borders_at_rest(ag.day_sum(amounts(spark, folder), "ts", "value", ["category"]))


ROLLING = f"""SELECT event_id, category, CAST(sum(value) OVER (PARTITION BY category ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS rolling FROM {AMOUNTS}"""


@query("agg8_rolling_sum", ROLLING)
def agg8(spark, folder):
    rows = amounts(spark, folder).select("event_id", "ts", "category", "value")
    summed = running(rows, ["ts", "event_id"], {"rolling": ("sum", "value")}, ["category"])
    return summed.select("event_id", "category", "rolling")


@query("agg9_global_reduce", f"SELECT CAST(sum(value) AS BIGINT) AS total FROM {AMOUNTS}")
def agg9(spark, folder):
    return amounts(spark, folder).agg(F.sum("value").alias("total"))


@query("agg9_global_reduce_merged", f"SELECT CAST(sum(value) AS BIGINT) AS total FROM {AMOUNTS}")
def agg9_merged(spark, folder):
    return merged(amounts(spark, folder).select("value"), [], Reduce("value", operator.add), "total bigint")


@query("agg10_window_members", f"""
    SELECT strftime(date_trunc('hour', ts), '%Y%m%d%H%M%S') AS window_from,
        strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y%m%d%H%M%S') AS window_to,
        count(*) OVER (PARTITION BY date_trunc('hour', ts)) AS size, event_id, value FROM {AMOUNTS}""")
def agg10(spark, folder):
    return ag.window_members(amounts(spark, folder), "ts", ["event_id", "value"], TUMBLE)


@query("agg11_window_borders", f"""
    SELECT epoch_ms(window_start) AS start_ms, epoch_ms(window_end) AS end_ms, room_id, cnt FROM {ROOM_HOURS}""")
def agg11(spark, folder):
    return room_hours(rooms(spark, folder)).select(
        F.unix_millis("window_start").alias("start_ms"), F.unix_millis("window_end").alias("end_ms"), "room_id", "cnt"
    )


@query("st4_tumbling_window", f"""
    SELECT make_timestamp(epoch_us(ts) // 2000000 * 2000000) AS window_start,
        make_timestamp(epoch_us(ts) // 2000000 * 2000000 + 2000000) AS window_end, room_id,
        CAST(sum(action) AS BIGINT) AS cnt FROM {ROOMS} GROUP BY ALL""")
def st4(spark, folder):
    return borders_at_rest(ag.window_sum(rooms(spark, folder), "ts", "action", ["room_id"], "2 seconds"))


def sliding_sql(size_s: int, step_s: int) -> str:
    """One row per event and window that holds it, then the sum per window and room."""
    first = f"epoch_us(ts) // {step_s * 1_000_000} * {step_s * 1_000_000}"
    return f"""(SELECT make_timestamp(w) AS window_start, make_timestamp(w + {size_s * 1_000_000}) AS window_end,
        room_id, CAST(sum(action) AS BIGINT) AS cnt
        FROM (SELECT room_id, action,
            unnest(list_transform(range(0, {size_s // step_s}), lambda i: {first} - i * {step_s * 1_000_000})) AS w
            FROM {ROOMS})
        GROUP BY ALL)"""


SLIDING = sliding_sql(3600, 600)


def sliding_rooms(rows):
    return ag.window_sum(rows, "ts", "action", ["room_id"], SLIDE_SIZE, SLIDE_STEP)


@query("st5_sliding_window", f"SELECT * FROM {sliding_sql(60, 10)}")
def st5(spark, folder):
    return borders_at_rest(ag.window_sum(rooms(spark, folder), "ts", "action", ["room_id"], "1 minute", "10 seconds"))


@query("st6_local_day_window", f"""
    SELECT date_trunc('day', ts + INTERVAL 8 HOUR) - INTERVAL 8 HOUR AS window_start,
        date_trunc('day', ts + INTERVAL 8 HOUR) + INTERVAL 16 HOUR AS window_end, room_id,
        CAST(sum(action) AS BIGINT) AS cnt FROM {ROOMS} GROUP BY ALL""")
def st6(spark, folder):
    return borders_at_rest(ag.day_sum(rooms(spark, folder), "ts", "action", ["room_id"]))


@query("win1_running_distinct", f"SELECT event_id, cnt FROM {RUNNING_USERS_ROWS}")
def win1(spark, folder):
    rows = behaviour(spark, folder).select("event_id", "uid", "time")
    return running_distinct(rows, ["time", "event_id"], "uid").select("event_id", "cnt")


RUNNING_BY_LABEL = f"""SELECT label, CAST(sum(n) OVER (ORDER BY label) AS BIGINT) AS cnt
    FROM (SELECT label, count(*) AS n
          FROM (SELECT uid, min(substr(strftime(time, '%Y-%m-%d %H:%M'), 1, 15) || '0') AS label
                FROM {BEHAVIOUR} GROUP BY uid) GROUP BY label)"""


@query("win1_running_users_by_label", RUNNING_BY_LABEL)
def win1_by_label(spark, folder):
    return running_users(first_seen(behaviour(spark, folder)))


@query("win2_running_max", f"""
    SELECT event_id, max(value) OVER w AS highest,
        max(substr(strftime(ts, '%H:%M'), 1, 4) || '0') OVER w AS label FROM {AMOUNTS}
    WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def win2(spark, folder):
    rows = amounts(spark, folder).select(
        "event_id", "ts", "value", times.ten_minute_label("ts", with_date=False).alias("_label")
    )
    highest = running(rows, ["ts", "event_id"], {"highest": ("max", "value"), "label": ("max", "_label")})
    return highest.select("event_id", "highest", "label")


@query("win3_rank_in_window", f"""
    SELECT window_start, room_id, cnt, rownum FROM (
        SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, room_id) AS rownum
        FROM {ROOM_HOURS}) WHERE rownum <= 3""")
def win3(spark, folder):
    ranked = top_per_group(room_hours(rooms(spark, folder)), ["window_start"], [("cnt", "desc"), "room_id"], 3)
    return borders_at_rest(ranked).select("window_start", "room_id", "cnt", "rownum")


@query("win4_global_rank", f"""
    SELECT window_start, room_id, cnt, row_number() OVER (ORDER BY cnt DESC, window_start, room_id) AS rownum
    FROM {ROOM_HOURS}""")
def win4(spark, folder):
    ranked = global_row_number(room_hours(rooms(spark, folder)), [("cnt", "desc"), "window_start", "room_id"])
    return borders_at_rest(ranked).select("window_start", "room_id", "cnt", "rownum")


@query("top1_two_phase", f"""
    SELECT CAST(second(window_start) AS INTEGER) AS minute_time, window_start, room_id, cnt, rownum FROM (
        SELECT *, row_number() OVER (ORDER BY cnt DESC, window_start, room_id) AS rownum FROM {ROOM_HOURS})
    WHERE rownum <= 3""")
def top1(spark, folder):
    top = top_overall(room_hours(rooms(spark, folder)), [("cnt", "desc"), "window_start", "room_id"], 3, "room_id")
    return borders_at_rest(top.withColumn("minute_time", F.second("window_start"))).select(
        "minute_time", "window_start", "room_id", "cnt", "rownum"
    )


TOP_ROOMS = f"""SELECT window_end, room_id, cnt, rownum FROM (
    SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, room_id) AS rownum FROM {SLIDING})
    WHERE rownum <= 3"""


@query("top2_room_topn", TOP_ROOMS)
def top2(spark, folder):
    top = top_per_group(sliding_rooms(rooms(spark, folder)), ["window_end"], [("cnt", "desc"), "room_id"], 3)
    return borders_at_rest(top).select("window_end", "room_id", "cnt", "rownum")


def sequence_sql(keys: str = "") -> str:
    """All pairs of a start and its first later end within the span."""
    frame = "ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING"
    part = f"PARTITION BY {keys}" if keys else ""
    return f"""(SELECT event_id AS start_id, nxt.id AS end_id, uid AS start_uid, nxt.u AS end_uid, time AS start_time,
        nxt.t AS end_time FROM (
        SELECT *, first_value(CASE WHEN phone_type = 'purchase' THEN
            {{'t': time, 'id': event_id, 'u': uid}} END IGNORE NULLS) OVER ({part} ORDER BY time, event_id {frame}) AS nxt
        FROM {BEHAVIOUR}) WHERE click_count >= 100 AND nxt.t < time + INTERVAL 1 HOUR)"""


SEQUENCE_START, SEQUENCE_END = "click_count >= 100", "phone_type = 'purchase'"


def sequences(rows, keys=()):
    return followed_by(
        rows, F.expr(SEQUENCE_START), F.expr(SEQUENCE_END), PATTERN_SPAN, "time", "event_id", ["uid"], keys
    )


def sequence_ids(matches):
    return matches.select(
        F.col("start.event_id").alias("start_id"), F.col("end.event_id").alias("end_id"),
        F.col("start.uid").alias("start_uid"), F.col("end.uid").alias("end_uid"),
    )


SEQUENCES = f"SELECT start_id, end_id, start_uid, end_uid FROM {sequence_sql()}"


@query("cep1_sequence", SEQUENCES)
def cep1(spark, folder):
    return sequence_ids(sequences(behaviour(spark, folder)))


@query("cep1_sequence_per_user", f"SELECT start_id, end_id, start_uid, end_uid FROM {sequence_sql('uid')}")
def cep1_keyed(spark, folder):
    return sequence_ids(sequences(behaviour(spark, folder), ["uid"]))


ALERTS = f"""SELECT start_id, end_id, end_uid AS uid, 'user ' || start_uid || ' at ' ||
    strftime(start_time, '%Y-%m-%d %H:%M:%S') || ' followed by user ' || end_uid || ' at ' ||
    strftime(end_time, '%Y-%m-%d %H:%M:%S') AS message FROM {sequence_sql()}"""


@query("cep2_match_message", ALERTS)
def cep2(spark, folder):
    return alert_rows(sequences(behaviour(spark, folder)), "time")
