"""Operators against brute force on small, skewed inputs."""

import random

import pytest
from pyspark.sql import functions as F

from pulseboard.operators import aggregates as ag
from pulseboard.operators import changes as ch
from pulseboard.operators import lookup, search, shape
from pulseboard.operators.ordered import global_row_number, next_match, ordered_blocks, running, running_distinct
from pulseboard.operators.pattern import followed_by
from pulseboard.operators.topk import ranked_pages, top_overall, top_per_group
from pulseboard.sources import generated, jdbc, tables, topic


def skewed(n=400, seed=3):
    """(id, t, key, v): a third of the rows has one key, a third one time."""
    r = random.Random(seed)
    return [
        (i, 50 if r.random() < 0.33 else r.randrange(100), "hot" if r.random() < 0.33 else f"k{r.randrange(20)}",
         r.randrange(-5, 10))
        for i in range(n)
    ]


SKEWED = "id bigint, t bigint, key string, v bigint"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(skewed(), SKEWED).repartition(5)


def test_blocks_follow_the_order(rows):
    got = ordered_blocks(rows, ["t", "id"]).collect()
    ordered = sorted(got, key=lambda r: (r["t"], r["id"]))
    blocks = [r["_block"] for r in ordered]
    assert blocks == sorted(blocks) and len(got) == 400
    # The crowded time is cut into several blocks.
    assert len({r["_block"] for r in got if r["t"] == 50}) > 1


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_running_totals(rows, keys):
    got = running(rows, ["t", "id"], {"s": ("sum", "v"), "m": ("max", "v"), "l": ("min", "v")}, keys)
    assert got.columns == ["id", "t", "key", "v", "s", "m", "l"]
    seen = {}
    want = set()
    for i, t, k, v in sorted(skewed(), key=lambda r: (r[1], r[0])):
        group = seen.setdefault(k if keys else "", [])
        group.append(v)
        want.add((i, sum(group), max(group), min(group)))
    assert {(r["id"], r["s"], r["m"], r["l"]) for r in got.collect()} == want


def test_running_totals_of_a_null_key(spark):
    df = spark.createDataFrame([(1, None, 2), (2, "a", 3), (3, None, 4)], "id int, key string, v bigint")
    got = running(df, ["id"], {"s": ("sum", "v")}, ["key"]).select("id", "s").collect()
    assert {tuple(r) for r in got} == {(1, 2), (2, 3), (3, 6)}


def test_running_distinct(rows):
    got = running_distinct(rows, ["t", "id"], "key").collect()
    seen, want = set(), set()
    for i, _, k, _ in sorted(skewed(), key=lambda r: (r[1], r[0])):
        seen.add(k)
        want.add((i, len(seen)))
    assert {(r["id"], r["cnt"]) for r in got} == want


def test_running_distinct_skips_null(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, "a")], "id int, u string")
    assert {(r["id"], r["cnt"]) for r in running_distinct(df, ["id"], "u").collect()} == {(1, 1), (2, 1), (3, 2), (4, 2)}


def test_global_row_number_descending(rows):
    got = {r["id"]: r["rownum"] for r in global_row_number(rows, [("v", "desc"), "id"]).collect()}
    want = {r[0]: n for n, r in enumerate(sorted(skewed(), key=lambda r: (-r[3], r[0])), 1)}
    assert got == want


@pytest.mark.parametrize("keys", [[], ["key"]])
@pytest.mark.parametrize("share", [0.02, 0.5, 0.0])
def test_next_match(spark, keys, share):
    r = random.Random(9)
    data = [(*row, r.random() < share) for row in skewed()]
    df = spark.createDataFrame(data, SKEWED + ", hit boolean")
    got = {
        row["id"]: row["_next"] and row["_next"]["id"]
        for row in next_match(df, ["t", "id"], "hit", ["t", "id"], keys=keys).collect()
    }
    ordered = sorted(data, key=lambda d: (d[1], d[0]))
    want = {}
    for n, row in enumerate(ordered):
        later = [d[0] for d in ordered[n + 1:] if d[4] and (not keys or d[2] == row[2])]
        want[row[0]] = later[0] if later else None
    assert got == want


def test_sequence_rules(spark):
    """Several starts share an end; an end can start; the span is strict; ties go by id."""
    data = [
        (1, "00:00:00", 9, "a"), (2, "00:00:02", 8, "a"), (3, "00:00:03", 1, "b"), (4, "00:00:05", 9, "iOS"),
        (5, "00:00:14", 1, "iOS"), (6, "00:00:20", 9, "a"), (7, "00:00:30", 0, "iOS"), (8, "00:00:30", 9, "a"),
    ]
    df = spark.createDataFrame(data, "event_id int, clock string, clicks int, phone string").withColumn(
        "ts", F.to_timestamp(F.concat(F.lit("2024-01-01 "), "clock"))
    )
    pairs = followed_by(df, F.col("clicks") > 7, F.col("phone") == "iOS", "10 seconds", payload=["clicks"])
    got = {(r["start"]["event_id"], r["end"]["event_id"]) for r in pairs.collect()}
    # 6 -> 7 is exactly ten seconds and no match, 8 has no later end.
    assert got == {(1, 4), (2, 4), (4, 5)}


def test_top_per_group_with_few_rows(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 5), (2, "c", 1)], "w int, room string, cnt int")
    got = {(r["w"], r["room"], r["rownum"]) for r in top_per_group(df, ["w"], [("cnt", "desc"), "room"], 3).collect()}
    assert got == {(1, "a", 1), (1, "b", 2), (2, "c", 1)}


def test_two_phase_top_is_exact(rows):
    got = [r["id"] for r in top_overall(rows, [("v", "desc"), "id"], 7, "key", buckets=4).orderBy("rownum").collect()]
    assert got == [r[0] for r in sorted(skewed(), key=lambda r: (-r[3], r[0]))[:7]]


def test_pages(rows):
    got = ranked_pages(rows, [("v", "desc"), "id"]).groupBy("page").count().collect()
    assert {(r["page"], r["count"]) for r in got} == {(p, 10) for p in range(40)}


def test_sliding_sum_by_steps_equals_direct(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet").withColumn("one", F.lit(1))
    stepped = ag.window_sum(events, "ts", "one", ["event_type"], "1 hour", "10 minutes")
    direct = ag.with_borders(
        events.groupBy(F.window("ts", "1 hour", "10 minutes").alias("window"), "event_type").agg(F.sum("one").alias("cnt"))
    )
    assert stepped.exceptAll(direct).count() == 0 and direct.exceptAll(stepped).count() == 0


def test_sliding_window_that_steps_do_not_cut(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet").withColumn("one", F.lit(1))
    got = ag.window_sum(events, "ts", "one", [], "25 minutes", "10 minutes")
    direct = ag.with_borders(
        events.groupBy(F.window("ts", "25 minutes", "10 minutes").alias("window")).agg(F.sum("one").alias("cnt"))
    )
    assert got.exceptAll(direct).count() == 0 and direct.exceptAll(got).count() == 0


def test_approximate_users(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet").selectExpr("ts as time", "user_id as uid")
    exact = {r["hour"]: r["uv"] for r in ag.page_and_user_views(events).collect()}
    rough = {r["hour"]: r["uv"] for r in ag.page_and_user_views(events, approximate=True).collect()}
    assert exact.keys() == rough.keys() and all(abs(exact[h] - rough[h]) <= 1 for h in exact)


CHANGES = [("+I", 1, 1, "a"), ("-U", 2, 1, "a"), ("+U", 3, 1, "b"), ("-D", 5, 2, "x"), ("+I", 4, 2, "x"), ("+I", 6, 3, "c"),
           ("-D", 7, 3, "c"), ("+I", 8, 3, "d")]


def test_changes_by_sequence(spark):
    feed = spark.createDataFrame(CHANGES, "op string, seq bigint, id int, v string")
    assert {tuple(r) for r in ch.apply_changes(feed, ["id"]).collect()} == {(1, "b"), (3, "d")}
    kept = ch.apply_changes(feed, ["id"], ignore_deletes=True)
    assert {tuple(r) for r in kept.collect()} == {(1, "b"), (2, "x"), (3, "d")}


def test_lookup_keeps_double_keys_and_drops_the_rest(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    dim = spark.createDataFrame([("a", 1), ("a", 2), (None, 9)], "key string, v int")
    for joined in (
        lookup.lookup_join(facts, dim, "k", "key"),
        lookup.counted_lookup_join(facts, dim, "k", "key"),
        lookup.counted_lookup_join(facts, dim, "k", "key", max_rows=1),
        lookup.keyed_lookup(facts, dim, [("k", "key")]),
        lookup.keyed_lookup(facts, dim, [("k", "key")], max_keys=1),
    ):
        assert {(r["id"], r["v"]) for r in joined.collect()} == {(1, 1), (1, 2)}


def test_broadcast_only_below_the_limit(spark):
    facts, dim = spark.range(100).withColumnRenamed("id", "k"), spark.range(50).withColumnRenamed("id", "key")

    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()

    assert hinted(lookup.counted_lookup_join(facts, dim, "k", "key", max_rows=50))
    assert not hinted(lookup.counted_lookup_join(facts, dim, "k", "key", max_rows=49))
    wide = dim.select("key", F.repeat(F.lit("x"), 1000).alias("t"), F.struct("key").alias("s"))
    assert hinted(lookup.counted_lookup_join(facts, wide, "k", "key", max_bytes=100_000))
    assert not hinted(lookup.counted_lookup_join(facts, wide, "k", "key", max_bytes=50_000))


def test_keyed_lookup_pushes_the_keys(spark, folder):
    facts = spark.createDataFrame([(3,), (4,)], "k int")
    nations = spark.read.parquet(f"{folder}/nation.parquet")
    plan = lookup.keyed_lookup(facts, nations, [("k", "n_nationkey")])._jdf.queryExecution().executedPlan().toString()
    assert "In(n_nationkey, [3,4])" in plan


def test_refreshing_dimension():
    calls = []
    dim = lookup.RefreshingDimension(lambda: calls.append(1) or len(calls), ttl=3600)
    assert (dim(), dim()) == (1, 1)
    eager = lookup.RefreshingDimension(lambda: calls.append(1) or len(calls), ttl=0)
    assert eager() != eager()


def test_refreshing_dimension_retries():
    left = [2]

    def load():
        if left[0]:
            left[0] -= 1
            raise OSError("down")
        return "dim"

    assert lookup.RefreshingDimension(load, retries=2)() == "dim"
    left[0] = 5
    with pytest.raises(OSError):
        lookup.RefreshingDimension(load, retries=2)()


def brute_search(docs, term):
    import math
    import re

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    words = {i: [w for w in re.split(r"[^\w]+|_", t.lower()) if w] for i, t in docs}
    limit = 0 if len(term) <= 2 else 1 if len(term) <= 5 else 2
    close = {w for ws in words.values() for w in ws if w.startswith(term[:3]) and distance(w, term) <= limit}
    chosen = sorted(close, key=lambda w: (distance(w, term), w))[:10]
    mean = sum(map(len, words.values())) / len(words)
    scores = {}
    for w in chosen:
        df = sum(w in ws for ws in words.values())
        for i, ws in words.items():
            if tf := ws.count(w):
                idf = math.log(1 + (len(words) - df + 0.5) / (df + 0.5))
                part = idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ws) / mean))
                scores[i] = scores.get(i, 0) + part
    return {i: round(s, 6) for i, s in scores.items()}


def test_search_against_brute_force(spark):
    texts = ["The service was a SERVICE, served.", "Serve the servant; serviced service", "nothing here", "servise",
             "", "service " * 50 + "end", "sévice serv1ce"]
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    for term in ("service", "serve", "th"):
        got = {r["doc_id"]: r["score"] for r in search.fuzzy_search(df, term).collect()}
        assert got == pytest.approx(brute_search(docs, term), abs=2e-6)


def test_match_counts_of_many_searches(spark):
    docs = spark.createDataFrame([(1, "alpha beta"), (2, "alpha"), (3, "beta betas")], "doc_id bigint, text string")
    found = search.fuzzy_searches(docs, ["alpha", "beta"])
    assert {(r["search_id"], r["doc_id"]) for r in found.collect()} == {(1, 1), (1, 2), (2, 1), (2, 3)}
    best = search.top_hits(found, 1)
    assert best.count() == 2 and best.columns == ["search_id", "doc_id", "score"]


def test_positional_and_target_columns(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert shape.by_position(df, ["c", "d"]).columns == ["c", "d"]
    target = spark.createDataFrame([], "id bigint, gname string, extra int").schema
    row = shape.into_columns(df, target, ["id", "gname"]).first()
    assert tuple(row) == (1, "x", None)
    with pytest.raises(ValueError):
        shape.into_columns(df, target, ["id"])


def test_elements(spark):
    df = spark.createDataFrame([(1, [("a", 1), ("b", 2)])], "id int, l array<struct<n:string,v:int>>")
    assert {tuple(r) for r in shape.elements(df, "l", ["id"]).collect()} == {(1, "a", 1), (1, "b", 2)}


def test_generated_table(spark):
    made = generated.generated_table(spark, 5000, {
        "f_sequence": generated.Sequence(1, 1000), "f_random": generated.RandomInt(-1, 2),
        "f_random_str": generated.RandomText(100),
    }, seed=5)
    rows = made.drop("ts").collect()
    assert sorted(r["f_sequence"] for r in rows) == list(range(1, 1001))
    assert {r["f_random"] for r in rows} == {-1, 0, 1, 2}
    assert {len(r["f_random_str"]) for r in rows} == {100} and len({r["f_random_str"] for r in rows}) == 1000
    again = generated.generated_table(spark, 5000, {"f_sequence": generated.Sequence(1, 1000), "f_random": generated.RandomInt(-1, 2)}, seed=5)
    assert {(r["f_sequence"], r["f_random"]) for r in again.collect()} == {(r["f_sequence"], r["f_random"]) for r in rows}


def test_in_memory_source(spark):
    pairs = tables.from_elements(spark, [("apple", 3), ("banana", 2), ("banana", 4)], "name string, n bigint")
    numbered = pairs.withColumn("seq", F.when(F.col("n") == 3, 0).when(F.col("n") == 2, 1).otherwise(2))
    got = running(numbered, ["seq"], {"sum": ("sum", "n")}, ["name"]).orderBy("seq").select("name", "sum").collect()
    assert [tuple(r) for r in got] == [("apple", 3), ("banana", 2), ("banana", 6)]
    total = tables.from_elements(spark, [(2,), (3,), (4,)], "n bigint").agg(F.sum("n")).first()[0]
    assert total == 9


def test_topic_options():
    t = topic.Topic(name="user_log", servers="a:9092", starting={1: 300, 0: 55})
    assert topic.kafka_options(t) == {
        "kafka.bootstrap.servers": "a:9092", "subscribe": "user_log",
        "startingOffsets": '{"user_log": {"0": 55, "1": 300}}',
    }
    assert topic.kafka_options(topic.Topic(name="t", servers="s"))["startingOffsets"] == "earliest"


def test_offsets(spark):
    df = spark.createDataFrame([(p, o) for p in range(3) for o in range(4)], "partition int, offset bigint")
    assert topic.from_offsets(df, "earliest").count() == 12
    assert topic.from_offsets(df, "latest").count() == 0
    assert {tuple(r) for r in topic.from_offsets(df, {0: 3, 2: 2}, unlisted="latest").collect()} == {(0, 3), (2, 2), (2, 3)}
    others = {tuple(r) for r in df.collect() if r[0] not in (0, 2)}
    assert others and {tuple(r) for r in topic.from_offsets(df, {0: 3, 2: 2}).collect()} == others | {(0, 3), (2, 2), (2, 3)}


def test_jdbc_reader_options():
    db = jdbc.Database("jdbc:x://h/d", user="u", password="p")
    split = jdbc.Split("id", 0, 1000, 8)
    assert jdbc.table_options(db, "t", split) == {
        "url": "jdbc:x://h/d", "user": "u", "password": "p", "dbtable": "t", "fetchsize": "10000",
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "1000", "numPartitions": "8",
    }
    assert jdbc.query_options(db, "select 1")["query"] == "select 1"
    assert jdbc.query_options(db, "select 1", split)["dbtable"] == "(select 1) q"


def test_typed_rows(spark):
    schema = spark.createDataFrame([], "id bigint, price bigint, cnt int").schema
    df = spark.createDataFrame([("1", 2.0, 3)], "a string, b double, c bigint")
    typed = jdbc.typed_rows(df, schema)
    assert typed.schema == schema and tuple(typed.first()) == (1, 2, 3)
