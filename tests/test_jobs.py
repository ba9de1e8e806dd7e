"""Whole jobs on a small topic of JSON lines."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pulseboard.plans import jobs
from pulseboard.session import new_path, stream_session
from pulseboard.sinks.keyed import KeyedTable
from pulseboard.sources.topic import Topic
from pulseboard.streaming.dashboards import running_users


@pytest.fixture()
def run(spark):
    """Run a job over the given records (or lines) to its end and return session and settings."""
    session = stream_session(spark)

    def go(job, records, *args, **kwargs):
        base = new_path(spark, "job")
        topic = Path(base.removeprefix("file:")) / "topic"
        topic.mkdir(parents=True)
        lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
        (topic / "0.json").write_text("\n".join(lines))
        settings = jobs.Settings(Topic(path=str(topic)), base)
        job(session, settings, *args, **kwargs).awaitTermination()
        return session, settings

    return go


def rows(df):
    return sorted(map(tuple, df.collect()))


def click(uid, clock, phone, count):
    return {"uid": uid, "time": f"2020-07-16 {clock}", "phoneType": phone, "clickCount": count}


CLICKS = [
    click("a", "10:00:00", "iOS", 1), click("b", "10:30:00", "Android", 9), click("a", "10:30:05", "iOS", 2), "broken",
    click("a", "10:59:00", "Android", 8), click("b", "11:10:00", "iOS", 3), click("c", "13:00:00", "iOS", 4),
]


def test_hourly_views(run):
    spark, s = run(jobs.hourly_views, CLICKS)
    schema = spark.createDataFrame([], "hour string, pv bigint, uv bigint").schema
    got = rows(jobs.keyed_result(spark, s, schema, ["hour"]).read())
    assert got == [("2020-07-16 10:00", 4, 2), ("2020-07-16 11:00", 1, 1)]


def test_click_alerts(run):
    spark, s = run(jobs.click_alerts, CLICKS)
    got = jobs.read_alerts(spark, s).collect()
    assert [r["message"] for r in got] == [
        "user b at 2020-07-16 10:30:00 followed by user a at 2020-07-16 10:30:05"
    ]


def test_day_clicks(run):
    # 16:00 UTC is the next local day.
    late = click("a", "16:00:00", "iOS", 50)
    spark, s = run(jobs.day_clicks, [*CLICKS, late])
    schema = spark.createDataFrame(
        [], "window_start timestamp, window_end timestamp, uid string, phone_type string, cnt bigint"
    ).schema
    table = jobs.keyed_result(spark, s, schema, ["window_start", "uid", "phone_type"]).read()
    got = rows(table.select(F.date_format("window_start", "dd HH").alias("d"), "uid", "phone_type", "cnt"))
    assert got == [
        ("15 16", "a", "Android", 8), ("15 16", "a", "iOS", 3), ("15 16", "b", "Android", 9), ("15 16", "b", "iOS", 3),
        ("15 16", "c", "iOS", 4), ("16 16", "a", "iOS", 50),
    ]


USERS = [
    {"uid": 1, "sex": "f", "age": 20, "created_time": 1595506395000},
    {"uid": 1, "sex": "f", "age": 21, "created_time": 1595506395000 + 60_000},
    {"uid": 2, "sex": "m", "age": 30, "created_time": 1595506395000 + 1_200_000},
    "no record",
]


def test_running_users(run):
    spark, s = run(jobs.running_users, USERS)
    schema = spark.createDataFrame([], "uid bigint, label string").schema
    table = jobs.keyed_result(spark, s, schema, ["uid"]).read()
    assert rows(running_users(table)) == [("2020-07-23 12:10", 1), ("2020-07-23 12:30", 2)]


def test_profile_rows(run):
    spark, s = run(jobs.profile_rows, USERS)
    schema = spark.createDataFrame(
        [], "rowkey string, cf struct<uid:bigint,sex:string,age:int,created_time:bigint>"
    ).schema
    got = jobs.keyed_result(spark, s, schema, ["rowkey"]).read().orderBy("cf.age").collect()
    assert [r["cf"]["age"] for r in got] == [20, 21, 30]
    # md5("1") starts with c4ca42; the key is cut from the epoch text 1595506395000.
    assert got[0]["rowkey"].startswith("c4ca42" + "1595506395" + "f") and len(got[0]["rowkey"]) == 23


def test_room_top(run):
    base = 1594906740000
    events = [{"uid": i, "roomId": r, "action": a, "ts": base + t * 1000} for i, (r, a, t) in enumerate([
        (1, 1, 1), (1, 1, 2), (2, 1, 3), (3, -1, 4), (4, 1, 5), (4, 1, 6), (4, 1, 7), (5, 1, 200),
    ])]
    spark, s = run(jobs.room_top, events)
    top = spark.read.parquet(s.table).where(F.col("window_end") == F.timestamp_millis(F.lit(base + 60_000)))
    assert rows(top.select("rownum", "room_id", "cnt")) == [(1, 4, 3), (2, 1, 2), (3, 2, 1)]


def test_location_rows(run):
    place = {"uid": 1, "longitude": 40.75890919, "latitude": -73.96974759, "tag1": "t", "ts": 1}
    spark, s = run(jobs.location_rows, [place, {**place, "tag1": "u", "ts": 2}])
    schema = spark.createDataFrame(
        [], "rowkey string, cf struct<uid:bigint,longitude:double,latitude:double,tag1:string,ts:bigint>"
    ).schema
    got = jobs.keyed_result(spark, s, schema, ["rowkey"]).read().collect()
    assert [(r["rowkey"], r["cf"]["tag1"]) for r in got] == [("hfugpqpwzrtkC4CA42", "u")]


def test_table_sync(run):
    user = {"uid": 7, "sex": "f", "age": 1, "created_time": 0}
    feed = [{"op": "+I", "seq": 1, "id": 1, **user}, {"op": "+U", "seq": 3, "id": 1, **user, "age": 3},
            {"op": "-U", "seq": 2, "id": 1, **user}, {"op": "+I", "seq": 4, "id": 2, **user},
            {"op": "-D", "seq": 5, "id": 2, **user}]
    spark, s = run(jobs.table_sync, feed)
    schema = spark.createDataFrame([], "id bigint, uid bigint, sex string, age int, created_time bigint").schema
    assert rows(jobs.keyed_result(spark, s, schema, ["id"]).read()) == [(1, 7, "f", 3, 0)]


def test_credit_totals(run):
    lines = [{"message": "85517,20200429,1000,384,3,700"}, {"message": "85517,20200429,1,0.5"}, {"message": "x,1"}, "no"]
    spark, s = run(jobs.credit_totals, lines)
    schema = spark.createDataFrame([], "uid bigint, date_of bigint, num bigint, result_credit decimal(38,18)").schema
    table = KeyedTable(spark, s.table, schema, ["uid", "date_of"], "add", ["num", "result_credit"]).read()
    assert [(r["uid"], r["num"], float(r["result_credit"])) for r in table.collect()] == [(85517, 1001, 384.5)]


def test_dated_files(run):
    spark, s = run(jobs.dated_files, ["1,1594906746454,x", "2,soon,y"])
    got = rows(spark.read.schema("value string, dt string").text(s.table))
    assert got == [("1,1594906746454,x", "20200716"), ("2,soon,y", "00000000")]


def test_profile_lookup(run, spark):
    written = []
    dim = spark.createDataFrame([(1, "one")], "uid1 bigint, name string")
    run(jobs.profile_lookup, USERS, lambda: dim, "uid", "uid1",
        lambda b, i: written.extend(map(tuple, b.select("uid", "age", "name").collect())))
    assert sorted(written) == [(1, 20, "one"), (1, 21, "one")]


def test_warehouse(run):
    spark, s = run(jobs.warehouse, USERS)
    data = Path(s.table.removeprefix("file:")) / "data"
    done = sorted(str(p.parent.relative_to(data)) for p in data.glob("*/*/*/_SUCCESS"))
    assert done == ["ts_date=2020-07-23/ts_hour=12/ts_minute=13", "ts_date=2020-07-23/ts_hour=12/ts_minute=14"]
    assert spark.read.parquet(str(data)).count() == 3
