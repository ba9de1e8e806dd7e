"""Streaming forms over several micro-batches, restarts, late rows, state and timers."""

import os
import time
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pulseboard.operators.aggregates import page_and_user_views
from pulseboard.operators.lookup import RefreshingDimension
from pulseboard.plans import dashboard_queries as dq
from pulseboard.plans.inputs import as_amounts, as_behaviour, as_rooms, behaviour, events, rooms
from pulseboard.session import new_path, shared_dir, stream_session
from pulseboard.sinks import files
from pulseboard.sinks.keyed import KeyedTable
from pulseboard.sources.generated import RandomInt, Sequence, generated_stream
from pulseboard.sources.tables import monitored_table
from pulseboard.streaming import dashboards as db
from pulseboard.streaming.runtime import drain, drop_checkpoint, event_time, print_rows, processing_time, start
from pulseboard.streaming.state import idle_totals, top_rooms_with_timers


def rowset(df):
    return sorted(map(tuple, df.collect()))


class Feed:
    """A folder of files that a test adds to, in order."""

    def __init__(self, spark, session):
        self.spark = spark
        self.session = session
        self.base = new_path(spark, "feed")
        self.local = Path(self.base.removeprefix("file:")) / "in"
        self.local.mkdir(parents=True)
        self.count = 0
        self.schema = None

    def add(self, df):
        """One file per call; the files' times follow the calls."""
        self.schema = self.schema or df.schema
        target = self.local / f"{self.count:04d}.parquet"
        pdf = df.toPandas()
        pdf.to_parquet(target, coerce_timestamps="us", allow_truncated_timestamps=True, index=False)
        stamp = 1_700_000_000 + self.count
        os.utime(target, (stamp, stamp))
        self.count += 1

    def stream(self):
        return monitored_table(self.session, str(self.local), self.schema, files_per_batch=1)

    def path(self, name):
        return f"{self.base}/{name}"


@pytest.fixture()
def feed(spark):
    return Feed(spark, stream_session(spark))


@pytest.fixture()
def event_feed(spark, folder, feed):
    """The events in five files by time."""
    rows = events(spark, folder)
    for part in range(5):
        feed.add(rows.where(f"event_id >= {part * 200} and event_id < {part * 200 + 200}").orderBy("event_id"))
    return feed


def test_hourly_views_over_batches(spark, folder, event_feed):
    out = event_feed.path("out")
    drain(db.hourly_views(as_behaviour(event_feed.stream())), files.append_batch(out), event_feed.path("cp"))
    got = {r["hour"]: (r["pv"], r["uv"]) for r in spark.read.parquet(out).collect()}
    want = {r["hour"]: (r["pv"], r["uv"]) for r in page_and_user_views(behaviour(spark, folder)).collect()}
    # All hours but the last, which the watermark has not passed.
    want.pop(max(want))
    assert got == want


def test_top_rooms_over_batches(spark, folder, event_feed):
    out = event_feed.path("out")
    totals = db.window_totals(as_rooms(event_feed.stream()), "ts", "action", ["room_id"], "1 hour", "10 minutes")
    drain(totals, db.top_rooms_writer(out), event_feed.path("cp"))
    got = spark.read.parquet(out).select("window_end", "room_id", "cnt", "rownum")
    border = rooms(spark, folder).agg(F.max("ts").alias("t")).first()["t"] - timedelta(seconds=3)
    want = dq.top2(spark, folder).where(F.col("window_end") <= F.lit(border).cast("timestamp_ntz"))
    assert rowset(got.withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))) == rowset(want)


def test_overall_top_over_batches(spark, folder, event_feed):
    totals = db.window_totals(as_rooms(event_feed.stream()), "ts", "action", ["room_id"], "1 hour")
    schema = totals.withColumn("rownum", F.lit(1).cast("bigint")).schema
    table = KeyedTable(event_feed.session, event_feed.path("top"), schema, ["rownum"])
    drain(totals, db.overall_top_writer(table, "room_id"), event_feed.path("cp"))
    want = dq.top1(spark, folder).select("room_id", "cnt", "rownum")
    assert rowset(table.read().select("room_id", "cnt", "rownum")) == rowset(want)


def test_running_users_over_batches(spark, folder, event_feed):
    first = db.first_seen(as_behaviour(event_feed.stream()))
    table = KeyedTable(event_feed.session, event_feed.path("users"), first.schema, ["uid"])
    drain(first, table.write, event_feed.path("cp"), "update")
    assert rowset(db.running_users(table.read())) == rowset(dq.win1_by_label(spark, folder))


def test_rolling_sum_over_batches_and_restart(spark, folder, feed):
    rows = events(spark, folder)
    state_schema = as_amounts(rows).select("category", "value").schema

    def run():
        amounts = as_amounts(feed.stream()).select("event_id", "ts", "category", "value")
        state = KeyedTable(feed.session, feed.path("state"), state_schema, ["category"], "add", ["value"])
        writer = db.rolling_sum_writer(state, feed.path("out"), "category", "value", ["ts", "event_id"])
        drain(amounts, writer, feed.path("cp"))

    for part in range(3):
        feed.add(rows.where(f"event_id >= {part * 400} and event_id < {part * 400 + 400}").orderBy("event_id"))
        # Each run goes on from the checkpoint of the last one.
        run()
    got = spark.read.parquet(feed.path("out")).select("event_id", "category", "rolling")
    assert rowset(got) == rowset(dq.agg8(spark, folder))


def sequences(spark, feed, delay=timedelta(0), keys=()):
    writer = db.SequenceWriter(
        feed.path("cep"), dq.SEQUENCE_START, dq.SEQUENCE_END, timedelta(hours=1), "time", "event_id", ["uid"], keys, delay
    )
    drain(as_behaviour(feed.stream()), writer, feed.path("cp"))
    return dq.sequence_ids(spark.read.parquet(feed.path("cep") + "/matches"))


def test_sequences_over_batches(spark, folder, event_feed):
    assert rowset(sequences(spark, event_feed)) == rowset(dq.cep1(spark, folder))


def test_sequences_across_many_small_batches(spark, folder, feed):
    """Matches whose start and end lie in different batches."""
    rows = events(spark, folder).where("event_id < 200")
    for part in range(10):
        feed.add(rows.where(f"event_id div 20 = {part}").orderBy("event_id"))
    want = dq.sequence_ids(dq.sequences(as_behaviour(rows)))
    assert rowset(want) and rowset(sequences(spark, feed)) == rowset(want)


def test_late_starts_and_ends_are_kept_apart(spark, folder, feed):
    rows = events(spark, folder).where("event_id < 200")
    feed.add(rows.where("event_id >= 100"))
    feed.add(rows.where("event_id < 100"))
    sequences(spark, feed)
    late = spark.read.parquet(feed.path("cep") + "/late")
    want = as_behaviour(rows.where("event_id < 100")).where(f"({dq.SEQUENCE_START}) or ({dq.SEQUENCE_END})")
    assert want.count() > 0 and rowset(late.select("event_id")) == rowset(want.select("event_id"))


def test_sequences_of_disordered_rows(spark, folder, feed):
    """Rows swapped between neighbouring files are put in order while the watermark waits."""
    rows = events(spark, folder).where("event_id < 200")
    for part in range(4):
        feed.add(rows.where(
            f"(event_id div 50 = {part} and event_id % 50 < 47) or (event_id div 50 = {part - 1} and event_id % 50 >= 47)"
        ))
    feed.add(rows.where("event_id >= 197"))
    # The waiting rest needs later rows that push the watermark.
    feed.add(events(spark, folder).where("event_id = 999").withColumn("value", F.lit(0.0)).withColumn("event_type", F.lit("view")))
    want = dq.sequence_ids(dq.sequences(as_behaviour(rows)))
    assert rowset(sequences(spark, feed, timedelta(hours=12))) == rowset(want)


def test_changelog_over_batches(spark, feed):
    schema = "op string, seq bigint, id bigint, v string"
    feed.add(spark.createDataFrame([("+I", 1, 1, "a"), ("+I", 2, 2, "b"), ("+I", 3, 3, "c")], schema))
    feed.add(spark.createDataFrame([("-U", 4, 1, "a"), ("+U", 5, 1, "a2"), ("-D", 6, 2, "b")], schema))
    # An older change of key 3 arrives behind a newer one, key 2 comes back.
    feed.add(spark.createDataFrame([("+U", 9, 3, "c9")], schema))
    feed.add(spark.createDataFrame([("+U", 8, 3, "c8"), ("+I", 10, 2, "b10")], schema))
    table = KeyedTable(feed.session, feed.path("t"), spark.createDataFrame([], "id bigint, v string").schema, ["id"])
    drain(feed.stream(), db.change_writer(table, ["id"]), feed.path("cp"))
    assert rowset(table.read()) == [(1, "a2"), (2, "b10"), (3, "c9")]


def test_additive_totals_do_not_grow_after_a_failed_batch(spark, feed):
    for n in range(3):
        feed.add(spark.createDataFrame([(1, n + 1), (2, 1)], "id bigint, cnt bigint"))
    schema = spark.createDataFrame([], "id bigint, cnt bigint").schema
    table = KeyedTable(feed.session, feed.path("t"), schema, ["id"], "add", ["cnt"])
    failing = [True]

    def write(batch, batch_id):
        table.write(batch, batch_id)
        if batch_id == 1 and failing:
            failing.clear()
            raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        drain(feed.stream(), write, feed.path("cp"))
    drain(feed.stream(), write, feed.path("cp"))
    drain(feed.stream(), write, feed.path("cp"))
    assert rowset(table.read()) == [(1, 6), (2, 3)]


def test_late_rows_are_dropped_and_counted(spark, feed):
    def batch(*clocks):
        return spark.createDataFrame([(c,) for c in clocks], "c string").select(
            F.to_timestamp(F.concat(F.lit("2024-01-01 "), "c")).alias("ts"), F.lit(1).alias("one")
        )

    # Rows count as late from the second batch after the one that moved the watermark.
    feed.add(batch("00:00:01", "00:02:10"))
    feed.add(batch("00:02:12"))
    feed.add(batch("00:00:02", "00:05:00"))
    out = feed.path("out")
    query = drain(db.window_totals(feed.stream(), "ts", "one"), files.append_batch(out), feed.path("cp"))
    got = {r["window_start"].strftime("%H:%M"): r["cnt"] for r in spark.read.parquet(out).collect()}
    assert got == {"00:00": 1, "00:02": 2}
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    assert dropped == 1


@pytest.mark.parametrize("idle_inputs, windows", [(True, 1), (False, 0)])
def test_an_idle_input_can_be_passed_over(spark, idle_inputs, windows):
    session = stream_session(spark, idle_inputs)
    silent, busy = Feed(spark, session), Feed(spark, session)
    one = spark.createDataFrame([(1,)], "one int")
    silent.add(one.withColumn("ts", F.to_timestamp(F.lit("2024-01-01 00:00:10"))))
    busy.add(one.withColumn("ts", F.to_timestamp(F.lit("2024-01-01 00:00:20"))))
    busy.add(one.withColumn("ts", F.to_timestamp(F.lit("2024-01-01 00:05:00"))))
    # Zero delay: the watermark is the largest time itself.
    both = event_time(silent.stream(), "ts", "0 seconds").unionByName(event_time(busy.stream(), "ts", "0 seconds"))
    counts = both.groupBy(F.window("ts", "1 minute").alias("w")).agg(F.sum("one").alias("n"))
    seen = []
    drain(counts, lambda b, i: seen.extend(r["n"] for r in b.collect()), busy.path("cp"))
    assert seen == [2] * windows


def test_file_dimension_is_seen_when_it_grows(spark, feed):
    dim = feed.path("dim")
    spark.createDataFrame([(1, "one")], "k bigint, name string").write.parquet(dim)
    feed.add(spark.createDataFrame([(1,), (2,)], "id bigint"))
    dimension = RefreshingDimension(lambda: feed.session.read.parquet(dim))
    append = files.append_batch(feed.path("out"))

    def run():
        drain(feed.stream(), db.lookup_writer(dimension, "id", "k", append), feed.path("cp"))

    run()
    spark.createDataFrame([(2, "two")], "k bigint, name string").write.mode("append").parquet(dim)
    feed.add(spark.createDataFrame([(2,), (3,)], "id bigint"))
    run()
    assert rowset(spark.read.parquet(feed.path("out")).select("id", "name")) == [(1, "one"), (2, "two")]


def test_partition_commit_over_batches(spark, folder, event_feed):
    rows = event_feed.stream().select("event_id", "ts", F.date_format("ts", "yyyy-MM-dd").alias("ts_date"))
    sink = files.CommittingPartitions(
        event_feed.session, event_feed.path("out"), ["ts_date"], "ts", timedelta(days=1), timedelta(seconds=3)
    )
    drain(rows, sink, event_feed.path("cp"))
    days = sorted(r["ts_date"] for r in sink.committed().collect())
    every = sorted({r[0] for r in events(spark, folder).select(F.date_format("ts", "yyyy-MM-dd")).collect()})
    assert days == every[:-1]
    data = Path(event_feed.path("out").removeprefix("file:")) / "data"
    assert sorted(p.parent.name.removeprefix("ts_date=") for p in data.glob("*/_SUCCESS")) == days


def test_timers_equal_the_chained_form(spark, folder, event_feed):
    totals = db.window_totals(as_rooms(event_feed.stream()), "ts", "action", ["room_id"], "1 day")
    counts = totals.select("window_end", "room_id", "cnt")
    out = event_feed.path("out")
    drain(top_rooms_with_timers(counts), files.append_batch(out), event_feed.path("cp"))
    got = rowset(spark.read.parquet(out).select(
        F.date_format("window_end", "yyyy-MM-dd").alias("d"), "room_id", "cnt", "rownum"
    ))
    daily = rooms(spark, folder).groupBy(F.window("ts", "1 day").alias("w"), "room_id").agg(F.sum("action").alias("cnt"))
    want = {}
    for r in daily.collect():
        want.setdefault(r["w"]["end"].strftime("%Y-%m-%d"), []).append((-r["cnt"], r["room_id"]))
    flat = sorted(
        (d, room, -neg, n) for d, items in want.items() for n, (neg, room) in enumerate(sorted(items)[:3], 1)
    )
    # The last two days wait for the watermark of a later day.
    done = {d for d, *_ in got}
    assert len(done) >= 27 and got == [row for row in flat if row[0] in done]


def test_idle_state_is_forgotten(spark, feed):
    """Totals go on while the key is active and start again after it was idle."""
    feed.add(spark.createDataFrame([("a", 5), ("b", 1)], "k string, v bigint"))
    seen = []
    totals = idle_totals(feed.stream(), "k", "v", idle_minutes=6)
    query = start(
        totals, lambda b, i: seen.extend(map(tuple, b.collect())), feed.path("cp"), "update", every="1 second"
    )
    try:
        deadline = time.time() + 90
        while len(seen) < 2 and time.time() < deadline:
            time.sleep(0.5)
        feed.add(spark.createDataFrame([("a", 2)], "k string, v bigint"))
        while len(seen) < 3 and time.time() < deadline:
            time.sleep(0.5)
    finally:
        query.stop()
    assert sorted(seen[:2]) == [("a", 5), ("b", 1)] and seen[2] == ("a", 7)


def test_early_results_per_trigger(spark, event_feed):
    """Update mode gives a running result each time; the last one per key is the total."""
    totals = db.window_totals(as_amounts(event_feed.stream()), "ts", "value", ["category"], "30 days")
    seen = {}
    emitted = []

    def write(batch, batch_id):
        for r in batch.collect():
            emitted.append(r)
            seen[(r["window_start"], r["category"])] = r["cnt"]

    drain(totals, write, event_feed.path("cp"), "update")
    assert len(emitted) > len(seen)
    rows = as_amounts(spark.read.parquet(str(event_feed.local)))
    assert sum(seen.values()) == rows.agg(F.sum("value")).first()[0]


def test_generated_stream_ends_with_its_sequence(spark, feed):
    rows = generated_stream(feed.session, {"n": Sequence(1, 30), "r": RandomInt(1, 5)}, rows_per_second=200)
    seen = []
    query = start(rows, lambda b, i: seen.extend(b.select("n", "r").collect()), feed.path("cp"), every="1 second")
    try:
        deadline = time.time() + 60
        while len(seen) < 30 and time.time() < deadline:
            time.sleep(0.5)
        time.sleep(1.5)
    finally:
        query.stop()
    assert sorted(r["n"] for r in seen) == list(range(1, 31))
    assert all(1 <= r["r"] <= 5 for r in seen)


def test_print_and_processing_time(spark, event_feed):
    stamped = processing_time(event_feed.stream().select("event_id"))
    query = print_rows(stamped, event_feed.path("cp"), rows=3)
    assert dict(stamped.dtypes)["proc_time"] == "timestamp"
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1000
    assert "Console" in query.recentProgress[0]["sink"]["description"]


def test_checkpoint_can_be_dropped(spark, event_feed):
    cp = event_feed.path("cp")
    drain(event_feed.stream(), lambda b, i: None, cp)
    assert Path(cp.removeprefix("file:")).exists()
    drop_checkpoint(spark, cp)
    assert not Path(cp.removeprefix("file:")).exists()


def test_zone_free_time_becomes_an_instant(spark, feed):
    feed.add(spark.createDataFrame([(1,)], "id int").withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")))
    assert dict(event_time(feed.stream(), "ts").dtypes)["ts"] == "timestamp"


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert new_path(spark, "x").startswith((named or shared_dir(spark)).rstrip("/"))
