"""Bucketed keyed tables, the lookup cache and dead letters."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseboard.functions import records
from pulseboard.operators.cache import LookupCache
from pulseboard.plans import jobs
from pulseboard.session import new_path
from pulseboard.sinks import files
from pulseboard.sinks.buckets import BucketedTable
from pulseboard.sources.topic import Topic

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType()), T.StructField("note", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v long, note string, seq long, gone boolean")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def folders(table):
    return sorted(str(p.relative_to(Path(table.path.removeprefix("file:")))) for p in Path(table.path.removeprefix("file:")).rglob("_bucket=*"))


def test_a_batch_rewrites_its_buckets_only(spark):
    table = BucketedTable(spark, new_path(spark, "buckets"), SCHEMA, ["k"], buckets=8)
    assert table.read().count() == 0
    keys = [f"k{n}" for n in range(60)] + [None]
    table.write(frame(spark, [(k, 1, "a", 1, False) for k in keys]), 0, "seq", "gone")
    assert len(table.touched) == 8
    table.write(frame(spark, [("k1", 2, "b", 2, False), ("k1", 3, "c", 3, False), ("new", 9, None, 1, False)]), 1, "seq", "gone")
    assert len(table.touched) <= 2 and len([f for f in folders(table) if f.startswith("v=1/")]) == len(table.touched)
    want = {k: (1, "a") for k in keys} | {"k1": (3, "c"), "new": (9, None)}
    assert {r["k"]: (r["v"], r["note"]) for r in table.read().collect()} == want
    # Late, older and deleted rows.
    table.write(frame(spark, [("k1", 0, "old", 1, False), ("k2", None, None, 5, True)]), 2, "seq", "gone")
    table.write(frame(spark, [("k2", 7, "older than its removal", 4, False)]), 3, "seq", "gone")
    del want["k2"]
    assert {r["k"]: (r["v"], r["note"]) for r in table.read().collect()} == want
    few = frame(spark, [("k3", 0, "", 0, False), ("k2", 0, "", 0, False), ("k1", 0, "", 0, False)])
    assert {r["k"] for r in table.read_buckets(few).collect()} == {"k1", "k3"}
    table.write(frame(spark, []), 4, "seq", "gone")
    assert table.touched == [] and table.read().count() == len(want)


@pytest.mark.parametrize("mode", ["replace", "add"])
def test_repeated_and_broken_batches_change_nothing(spark, mode, monkeypatch):
    table = BucketedTable(spark, new_path(spark, "buckets"), SCHEMA, ["k"], mode, ["v"], buckets=4)
    plain = {}
    for n in range(6):
        batch = [(f"k{(n * 7 + j) % 10}", n + j, f"n{n}", n, False) for j in range(4)]
        if n == 3:
            # The batch fails before its list is written, and is then repeated.
            with monkeypatch.context() as patch:
                patch.setattr(spark.__class__, "createDataFrame", lambda *a, **b: (_ for _ in ()).throw(OSError("lost")))
                given = spark.range(0)  # noqa: F841
                with pytest.raises(OSError):
                    table.write(spark.sql("SELECT " + " UNION ALL SELECT ".join(
                        f"'{k}' k, {v}L v, '{t}' note, {s}L seq, false gone" for k, v, t, s, _ in batch)), n, "seq", "gone")
            before = {k: v for k, v in plain.items()}
            assert {r["k"]: r["v"] for r in table.read().collect()} == before
        for _ in range(2):
            table.write(frame(spark, batch), n, "seq", "gone")
        for k, v, _, _, _ in batch:
            plain[k] = plain.get(k, 0) + v if mode == "add" else v
        assert {r["k"]: r["v"] for r in table.read().collect()} == plain


def test_folders_do_not_grow_with_the_batches(spark):
    table = BucketedTable(spark, new_path(spark, "buckets"), SCHEMA, ["k"], buckets=3)
    counts = []
    for n in range(10):
        table.write(frame(spark, [(f"k{j}", n, "", n, False) for j in range(20)]), n, "seq", "gone")
        counts.append(len(folders(table)))
    assert max(counts) == 6 and counts[2:] == [6] * 8 and table.read().where("v = 9").count() == 20


def cache_of(spark, rows, clock, **options):
    """A cache on a dimension that can change, and the calls that reached it."""
    calls = []

    def load(keys):
        calls.append(sorted(r["id"] for r in keys.collect()))
        if rows.get("down", 0):
            rows["down"] -= 1
            raise ConnectionError("busy")
        return spark.createDataFrame([(k, n) for k, n in rows.items() if k != "down"], "id long, name string").join(keys, "id", "left_semi")

    schema = spark.createDataFrame([], "id long, name string").schema
    return LookupCache(spark, load, schema, ["id"], clock=lambda: clock[0], **options), calls


def joined(spark, cache, ids):
    facts = spark.createDataFrame([(i,) for i in ids], "who long")
    return sorted((r["who"], r["name"]) for r in cache.join(facts, ["who"]).collect())


def test_the_cache_asks_for_new_and_old_keys_only(spark):
    clock, rows = [0.0], {1: "a", 2: "b", 3: "c"}
    cache, calls = cache_of(spark, rows, clock, ttl=10)
    assert joined(spark, cache, [1, 1, 2, 9, None]) == [(1, "a"), (1, "a"), (2, "b")]
    rows |= {1: "A", 9: "nine"}
    clock[0] = 5.0
    # Held rows are served as they were; a key without a row is remembered too.
    assert joined(spark, cache, [1, 3, 9]) == [(1, "a"), (3, "c")]
    assert calls == [[1, 2, 9], [3]] and (cache.asked, cache.reads) == (4, 2)
    clock[0] = 12.0
    assert joined(spark, cache, [1, 3, 9]) == [(1, "A"), (3, "c"), (9, "nine")]
    assert calls[2:] == [[1, 9]]
    assert joined(spark, cache, [1, 3]) == [(1, "A"), (3, "c")] and len(calls) == 3


def test_the_cache_is_bounded_and_its_old_versions_go(spark):
    clock, rows = [0.0], {k: f"n{k}" for k in range(10)}
    cache, calls = cache_of(spark, rows, clock, ttl=100, max_keys=3)
    for n in range(6):
        clock[0] = float(n)
        assert joined(spark, cache, [n, n + 1]) == [(n, f"n{n}"), (n + 1, f"n{n + 1}")]
        assert cache.held().count() <= 3
    assert calls == [[0, 1], [2], [3], [4], [5], [6]]
    assert joined(spark, cache, [0]) == [(0, "n0")] and calls[-1] == [0]
    # One batch may ask for more keys than are held afterwards.
    assert len(joined(spark, cache, range(10))) == 10 and cache.held().count() == 3
    assert len(list(Path(cache.path.removeprefix("file:")).glob("n=*"))) == 2


def test_the_cache_reads_again_after_a_failure(spark):
    clock, rows = [0.0], {1: "a", "down": 2}
    cache, calls = cache_of(spark, rows, clock, retries=2)
    assert joined(spark, cache, [1]) == [(1, "a")] and cache.reads == 3
    rows["down"] = 9
    with pytest.raises(ConnectionError):
        joined(spark, cache, [2])
    rows["down"] = 0
    assert joined(spark, cache, [1, 2]) == [(1, "a")] and calls[-1] == [2]


LINES = ['{"id": 1, "n": 5, "at": "2024-01-02 03:04:05"}', '{"id": 2, "n": "x", "at": "2024-01-02 03:04:05"}', '{"id": 3, "at": "soon"}', "{cut", "", None,
         '{"id": 4, "n": null}', '{}', "[1]", '{"other": 1}', '{"id": "y", "n": "x"}']
FIELDS = "id long, n long, at string"


def test_every_line_is_kept_or_refused_with_a_reason(spark):
    schema = spark.createDataFrame([], FIELDS).schema
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    tagged = records.tagged_json(lines, schema, times={"at": "yyyy-MM-dd HH:mm:ss"})
    got = {r["_raw"]: (r["_reason"], r["id"]) for r in tagged.collect()}
    assert len(got) == len(LINES) and dict(tagged.dtypes)["at"] == "timestamp"
    assert {k: v[0] for k, v in got.items()} == {
        LINES[0]: None, LINES[1]: "field n", LINES[2]: "time at", "{cut": "no record", "": "no record", None: "no record",
        LINES[6]: None, "{}": None, "[1]": got["[1]"][0], '{"other": 1}': None, LINES[10]: "field id"}
    path, counts = new_path(spark, "dead"), {}
    write = files.kept_and_dead(files.append_batch(f"{path}/kept"), f"{path}/dead", counts)
    for _ in range(2):
        # Repeated as after a failure.
        write(tagged, 0)
    kept, dead = spark.read.parquet(f"{path}/kept"), spark.read.parquet(f"{path}/dead")
    assert kept.count() + dead.count() == len(LINES) and counts[0] == (len(LINES), dead.count())


def job_of(spark, lines, **options):
    path = new_path(spark, "job")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{path}/topic")
    return jobs.Settings(Topic(path=f"{path}/topic"), path, **options)


def test_jobs_put_refused_lines_aside(spark):
    s = job_of(spark, ['{"message": "1,20200429,3,5"}', '{"message": "1,20200429,x,5"}', '{"message": "short"}', "no record", '{"other": 1}'])
    jobs.credit_totals(spark, s).awaitTermination()
    assert rows_of(spark.read.parquet(s.dead).select("value", "reason")) == sorted([
        ('{"message": "1,20200429,x,5"}', "field num"), ('{"message": "short"}', "field uid"), ("no record", "no record"), ('{"other": 1}', "no record")], key=str)
    s = job_of(spark, ['{"op": "+I", "seq": 1, "id": 1, "uid": 7, "sex": "f", "age": 1, "created_time": 0}',
                       '{"op": "+I", "seq": 2, "id": 2, "uid": "seven"}', "cut {"])
    jobs.table_sync(spark, s).awaitTermination()
    assert [r["reason"] for r in spark.read.parquet(s.dead).orderBy("value").collect()] == ["no record", "field uid"]
    jobs.dead_letters(spark, jobs.Settings(s.topic, f"{s.path}/beside"), jobs.CHANGE).awaitTermination()
    assert spark.read.parquet(f"{s.path}/beside/dead").select(F.count("reason")).first()[0] == 2
