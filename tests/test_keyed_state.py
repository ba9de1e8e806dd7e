"""Running results in keyed state and sequences by a stream join, over many micro-batches."""

import datetime

from pyspark.sql import functions as F

from pulseboard.operators.pattern import followed_by
from pulseboard.plans import stream_queries as sq
from pulseboard.plans.registry import QUERIES
from pulseboard.session import new_path, stream_session
from pulseboard.sinks.files import append_batch
from pulseboard.sources.tables import monitored_table
from pulseboard.streaming.runtime import drain
from pulseboard.streaming.sequence import followed_by_join
from pulseboard.streaming.totals import best_overall, rolling_totals

SCHEMA = "id long, ts timestamp, kind string, value long"


def feed(spark, rows, parts):
    """Rows as files that are written one after the other."""
    path = new_path(spark, "feed")
    for n in range(parts):
        part = rows[n * len(rows) // parts:(n + 1) * len(rows) // parts]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


def rows_at(n):
    start = datetime.datetime(2024, 1, 1)
    return [(k, start + datetime.timedelta(seconds=20 * k), "hot" if k % 3 else f"k{k % 7}", None if k % 11 == 5 else k % 13 - 4) for k in range(n)]


def test_rolling_totals_go_on_over_batches_and_state_stays_flat(spark):
    rows, parts = rows_at(600), 12
    session = stream_session(spark, partitions=2)
    stream = monitored_table(session, feed(spark, rows, parts), spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)
    out, checkpoint = new_path(spark, "out"), new_path(spark, "cp")
    done = drain(rolling_totals(stream, "kind", "value", ["ts", "id"]), append_batch(out), checkpoint)
    totals, want = {}, {}
    for k, _, kind, value in rows:
        totals[kind] = totals.get(kind, 0) + (value or 0)
        want[k] = totals[kind]
    assert {r["id"]: r["rolling"] for r in spark.read.parquet(out).collect()} == want
    held = [p["stateOperators"][0]["numRowsTotal"] for p in done.recentProgress if p["numInputRows"] > 0]
    assert len(held) == parts and held[-1] == len(totals) and max(held[3:]) == held[-1]


def test_best_rows_equal_the_ranking_after_each_batch(spark):
    rows, parts = rows_at(240), 8
    session = stream_session(spark, partitions=2)
    stream = monitored_table(session, feed(spark, rows, parts), spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)
    out = new_path(spark, "out")
    best = best_overall(stream.na.fill(0, ["value"]), [("value", False), ("id", True)], 4, "id", buckets=3)
    drain(best, append_batch(out), new_path(spark, "cp"))
    last = {}
    for n in range(parts):
        seen = sorted(((-(v or 0), k) for k, _, _, v in rows[:(n + 1) * len(rows) // parts]))[:4]
        got = spark.read.parquet(out).where(f"batch <= {n}").groupBy("rownum").agg(F.max_by("id", "batch").alias("id"))
        last = {r["rownum"]: r["id"] for r in got.collect()}
        assert last == {i: k for i, (_, k) in enumerate(seen, 1)}
    times = {r["id"]: r["ts"] for r in spark.read.parquet(out).collect()}
    assert all(times[k] == rows[k][1] for k in last.values())


def test_a_stream_join_finds_the_sequences_of_the_table(spark):
    rows = sorted(rows_at(400), key=lambda r: r[0] + (r[0] * 7) % 10)
    schema = spark.createDataFrame([], SCHEMA).schema
    path, session = feed(spark, rows, 8), stream_session(spark, partitions=2)
    start, end = F.col("value") > 6, F.col("value") == 0
    for keys in ([], ["kind"]):
        sides = [monitored_table(session, path, schema, files_per_batch=1) for _ in range(2)]
        out = new_path(spark, "out")
        done = drain(followed_by_join(*sides, start, end, 300, "ts", "id", ["kind"], keys, delay="200 seconds"), append_batch(out), new_path(spark, "cp"))
        whole = followed_by(spark.createDataFrame(rows, SCHEMA), start, end, "300 seconds", "ts", "id", ["kind"], keys)
        newest = max(r[1] for r in rows)
        due = whole.where(F.col("start.ts") <= F.lit(newest) - F.expr("interval 500 seconds"))
        ids = lambda df: sorted((r["start"]["id"], r["end"]["id"]) for r in df.collect())
        found = ids(spark.read.parquet(out))
        assert found == ids(due) and len(found) > 20
        # A start waits for the span and the delay, an end for the delay; nothing else is held.
        held = [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in done.recentProgress]
        assert max(held) < len(rows)


def test_a_crowded_cell_of_the_stream_join_makes_no_pairs(spark):
    """Equal times and repeated rows among 1,200 events of a few minutes; before, each event and each start's pairs were rows of the state."""
    first = datetime.datetime(2024, 1, 1)
    rows = [(k, first + datetime.timedelta(seconds=k // 7), "hot", k % 3 or None) for k in range(1_200)]
    rows += rows[:50] + [(9_000, first + datetime.timedelta(hours=2), "hot", 1), (9_001, first + datetime.timedelta(hours=4), "hot", 2)]
    session, path = stream_session(spark, partitions=2), feed(spark, rows, 3)
    start, end = F.col("value") == 1, F.col("value") == 2
    sides = [monitored_table(session, path, spark.createDataFrame([], SCHEMA).schema, files_per_batch=1) for _ in range(2)]
    out = new_path(spark, "out")
    done = drain(followed_by_join(*sides, start, end, 300, "ts", "id", ["kind"], delay="200 seconds"), append_batch(out), new_path(spark, "cp"))
    want = {(k, next(e for e in range(k + 1, 1_200) if e % 3 == 2)) for k in range(1, 1_200, 3) if k < 1_199}
    got = [(r["start"]["id"], r["end"]["id"]) for r in spark.read.parquet(out).collect()]
    assert len(got) == len(want) and set(got) == want
    assert max(sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in done.recentProgress) < 100


def test_stream_queries_take_their_input_in_several_batches(spark, folder):
    for name in ("agg1_hourly_pv_uv_stream", "snk15_several_sinks_stream", "jn3_refreshed_lookup_stream"):
        QUERIES[name].run(spark, folder).count()
    assert {n: b for n, b in sq.Job.batches.items() if b < 4} == {}
