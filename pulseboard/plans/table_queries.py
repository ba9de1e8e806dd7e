"""Sources, lookups, change feeds, search and sinks over whole tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseboard.functions import records, text, times
from pulseboard.operators import changes as ch
from pulseboard.operators import lookup, search
from pulseboard.operators.inverted import index_of_table
from pulseboard.operators.pattern import alert_rows
from pulseboard.operators.shape import wide_row
from pulseboard.operators.topk import ranked_pages
from pulseboard.plans.dashboard_queries import ALERTS, RUNNING_USERS_ROWS, running_user_rows, sequences
from pulseboard.plans.functions_queries import (
    CREDITS, DECODED, PROFILE_KEY_SQL, RECORD_SCHEMA, as_lines, credits,
)
from pulseboard.plans.inputs import BEHAVIOUR, CHANGES, CLICK_HASH, PROFILES, behaviour, changes, events, profiles
from pulseboard.plans.registry import query
from pulseboard.session import new_path, stage
from pulseboard.sinks import files
from pulseboard.sinks.keyed import KeyedTable
from pulseboard.sources.generated import RandomInt, RandomText, Sequence, with_fields
from pulseboard.sources.tables import change_feed, named_table, partitioned_scan
from pulseboard.sources.topic import Topic, from_offsets, json_topic, raw_topic

# ---------------------------------------------------------------- sources


def stored_topic(spark, folder) -> str:
    """The events as a topic of JSON lines, broken ones among them."""
    path = new_path(spark, "topic")
    as_lines(events(spark, folder)).write.text(path)
    return path


@query("src1_json_topic", f"SELECT event_id, user_id, event_type, clicks FROM {DECODED}")
def src1(spark, folder):
    return json_topic(spark, Topic(path=stored_topic(spark, folder)), RECORD_SCHEMA, stream=False)


@query("src2_raw_topic", """
    SELECT count(*) AS records, count(*) FILTER (WHERE event_id % 50 = 0) AS broken FROM events""")
def src2(spark, folder):
    lines = raw_topic(spark, Topic(path=stored_topic(spark, folder)), stream=False)
    return lines.agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("value").startswith("{broken")).alias("broken")
    )


@query("src3_start_offsets", """
    SELECT user_id % 4 AS partition, event_id AS "offset", event_type FROM events
    WHERE (user_id % 4 = 0 AND event_id >= 500) OR (user_id % 4 = 1 AND event_id >= 2000)
        OR user_id % 4 = 2 OR (user_id % 4 = 3 AND event_id >= 0)""")
def src3(spark, folder):
    topic = events(spark, folder).select(
        (F.col("user_id") % 4).alias("partition"), F.col("event_id").alias("offset"), "event_type"
    )
    return from_offsets(topic, {0: 500, 1: 2000, 3: 0})


GENERATED = """
    SELECT user_id, count(*) AS rows, CAST(min(event_id + 1) AS INTEGER) AS first_number,
        CAST(max(event_id + 1) AS INTEGER) AS last_number, TRUE AS in_range, TRUE AS right_length
    FROM events GROUP BY user_id"""
GENERATED_FIELDS = {"f_sequence": Sequence(1, 2**31 - 1), "f_random": RandomInt(1, 1000), "f_random_str": RandomText(10)}


def generated_facts(made):
    return made.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("f_sequence").alias("first_number"),
        F.max("f_sequence").alias("last_number"),
        F.bool_and(F.col("f_random").between(1, 1000)).alias("in_range"),
        F.bool_and(F.length("f_random_str") == 10).alias("right_length"),
    )


@query("src4_generated_columns", GENERATED)
def src4(spark, folder):
    return generated_facts(with_fields(events(spark, folder), "event_id", GENERATED_FIELDS, seed=7))


@query("src7_change_feed", f"SELECT op, seq, id, uid, sex, amount FROM {CHANGES}")
def src7(spark, folder):
    return changes(spark, folder)


_TABLE_OF = "CASE WHEN uid % 3 = 2 THEN 'gift_log' ELSE 'user_' || CAST(uid % 3 AS VARCHAR) END"


@query("src8_tables_by_pattern", f"""
    SELECT table_name, op, seq, id FROM (SELECT *, {_TABLE_OF} AS table_name FROM {CHANGES})
    WHERE regexp_full_match(table_name, 'user_.*')""")
def src8(spark, folder):
    feed = changes(spark, folder)
    feeds = {
        "user_0": feed.where("uid % 3 = 0"), "user_1": feed.where("uid % 3 = 1"), "gift_log": feed.where("uid % 3 = 2"),
    }
    return change_feed(feeds, "user_.*").select("table_name", "op", "seq", "id")


def daily_table(spark, folder) -> str:
    """Events as a warehouse table with day and hour partitions."""
    path = new_path(spark, "daily")
    rows = events(spark, folder).select(
        "event_id", "user_id", times.at_rest("ts").alias("ts"),
        F.date_format("ts", "yyyy-MM-dd").alias("ts_date"), F.date_format("ts", "HH").alias("ts_hour"),
    )
    # One shuffle by day, so that a folder gets few files; run-time splitting cuts a crowded day.
    rows.hint("rebalance", "ts_date").write.partitionBy("ts_date").parquet(path)
    return path


@query("src9_partitioned_scan", """
    SELECT event_id, user_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H') AS ts_hour FROM events
    WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-21'""")
def src9(spark, folder):
    where = F.col("ts_date").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-20").cast("date"))
    table = partitioned_scan(spark, daily_table(spark, folder), where)
    return table.select("event_id", "user_id", F.col("ts_date").cast("string").alias("day"), "ts_hour")


@query("src10_start_time", """
    SELECT event_id, user_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-15 23:30:00'""")
def src10(spark, folder):
    start = (F.col("ts_date") >= F.lit("2024-01-15").cast("date")) & (
        F.col("ts") >= F.lit("2024-01-15 23:30:00").cast("timestamp_ntz")
    )
    return partitioned_scan(spark, daily_table(spark, folder), start).select("event_id", "user_id", "ts")


# ---------------------------------------------------------------- search

SEARCH_TERM = "thatin"
SECOND_TERM = "thing"


def documents_index(spark, folder):
    """The stored index of the documents, built once for all searches of the application."""
    return index_of_table(named_table(spark, folder, "documents"), f"{folder}/documents.parquet")


def search_sql(term: str, prefix_length: int = search.PREFIX_LENGTH, most: int | None = search.MAX_EXPANSIONS) -> str:
    edits, prefix = search.allowed_edits(term), term[:prefix_length]
    nearest = f"ORDER BY levenshtein(word, '{term}'), word LIMIT {most}" if most else ""
    words = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')"
    return f"""(WITH scanned AS (SELECT doc_id, {words} AS ws FROM documents),
        lengths AS (SELECT doc_id, len(ws) AS length, ws FROM scanned),
        corpus AS (SELECT count(*) AS docs, avg(length) AS avg_length FROM lengths),
        counts AS (SELECT doc_id, length, word, count(*) AS tf FROM (
            SELECT doc_id, length, unnest(ws) AS word FROM lengths)
            WHERE starts_with(word, '{prefix}') AND levenshtein(word, '{term}') <= {edits} GROUP BY ALL),
        expansions AS (SELECT word, count(*) AS df FROM counts GROUP BY word
            {nearest})
        SELECT doc_id, round(sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * {search.K1 + 1}
            / (tf + {search.K1} * (1 - {search.B} + {search.B} * length / avg_length))), 6) AS score
        FROM counts JOIN expansions USING (word) CROSS JOIN corpus GROUP BY doc_id)"""


@query("srch1_fuzzy_search", f"SELECT doc_id, score FROM {search_sql(SEARCH_TERM)} ORDER BY score DESC, doc_id LIMIT 10")
def srch1(spark, folder):
    return search.top_hits(documents_index(spark, folder).search(SEARCH_TERM))


@query("srch1_fuzzy_search_unlimited", f"SELECT doc_id, score FROM {search_sql(SEARCH_TERM, 0, None)}")
def srch1_unlimited(spark, folder):
    """All words within the edits count, whatever they begin with, and all documents are returned."""
    return documents_index(spark, folder).search(SEARCH_TERM, prefix_length=0, most=None)


@query("top3_ranked_hits", f"SELECT doc_id, score FROM {search_sql(SECOND_TERM)} ORDER BY score DESC, doc_id LIMIT 10")
def top3(spark, folder):
    return search.top_hits(documents_index(spark, folder).search(SECOND_TERM))


@query("src11_search_records", f"""
    SELECT lang AS field1, CAST(n_chars AS INTEGER) AS field2 FROM documents JOIN (
        SELECT doc_id FROM {search_sql(SEARCH_TERM)} ORDER BY score DESC, doc_id LIMIT 10) USING (doc_id)""")
def src11(spark, folder):
    docs = named_table(spark, folder, "documents")
    # Ten hits at most, so they go to every task.
    hits = F.broadcast(search.top_hits(documents_index(spark, folder).search(SEARCH_TERM)).select("doc_id"))
    return docs.join(hits, "doc_id").select(
        F.col("lang").alias("field1"), F.col("n_chars").cast("int").alias("field2")
    )


@query("src12_multi_search_json", f"""
    SELECT search_id, '{{"doc_id":' || CAST(doc_id AS VARCHAR) || '}}' AS doc FROM (
        (SELECT 1 AS search_id, doc_id FROM {search_sql(SEARCH_TERM)} ORDER BY score DESC, doc_id LIMIT 10)
        UNION ALL (SELECT 2, doc_id FROM {search_sql(SECOND_TERM)} ORDER BY score DESC, doc_id LIMIT 10)
        UNION ALL (SELECT 3, doc_id FROM documents ORDER BY doc_id LIMIT 10))""")
def src12(spark, folder):
    docs = named_table(spark, folder, "documents")
    found = search.top_hits(documents_index(spark, folder).searches([SEARCH_TERM, SECOND_TERM]))
    # A match-all search scores every document alike, so the order is that of the ids.
    every = docs.select(F.lit(3).alias("search_id"), "doc_id").orderBy("doc_id").limit(10)
    return found.select("search_id", "doc_id").unionByName(every).select(
        "search_id", records.encode_json("doc_id").alias("doc")
    )


@query("src13_scroll_pages", f"""
    SELECT doc_id, score, (rownum - 1) // 10 AS page FROM (
        SELECT doc_id, score, row_number() OVER (ORDER BY score DESC, doc_id) AS rownum
        FROM {search_sql(SEARCH_TERM)})""")
def src13(spark, folder):
    scored = documents_index(spark, folder).search(SEARCH_TERM)
    return ranked_pages(scored, [("score", "desc"), "doc_id"]).select("doc_id", "score", "page")


# ---------------------------------------------------------------- lookups


def _orders(spark, folder):
    return named_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")


LOOKUP = """SELECT o_orderkey, o_orderstatus, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey"""


@query("jn1_lookup", LOOKUP)
def jn1(spark, folder):
    customers = named_table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    joined = lookup.counted_lookup_join(_orders(spark, folder), customers, "o_custkey", "c_custkey")
    return joined.select("o_orderkey", "o_orderstatus", "c_name", "c_mktsegment")


@query("jn2_wide_column_lookup", LOOKUP)
def jn2(spark, folder):
    customers = wide_row(
        named_table(spark, folder, "customer"), F.col("c_custkey").cast("string"),
        {"name": "c_name", "segment": "c_mktsegment"},
    )
    keyed = _orders(spark, folder).withColumn("uid", F.col("o_custkey").cast("string"))
    return lookup.lookup_join(keyed, customers, "uid", "rowkey").select(
        "o_orderkey", "o_orderstatus", F.col("cf.name").alias("c_name"), F.col("cf.segment").alias("c_mktsegment")
    )


@query("jn3_warehouse_lookup", LOOKUP)
def jn3(spark, folder):
    path = new_path(spark, "dimension")
    named_table(spark, folder, "customer").write.partitionBy("c_mktsegment").parquet(path)
    customers = partitioned_scan(spark, path).select("c_custkey", "c_name", "c_mktsegment")
    return lookup.lookup_join(_orders(spark, folder), customers, "o_custkey", "c_custkey").select(
        "o_orderkey", "o_orderstatus", "c_name", "c_mktsegment"
    )


@query("jn4_lookup_then_upsert", """
    SELECT c_custkey AS uid, c_mktsegment AS segment, max(o_orderkey) AS last_order FROM orders
    JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def jn4(spark, folder):
    customers = named_table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    joined = lookup.lookup_join(_orders(spark, folder), customers, "o_custkey", "c_custkey").select(
        F.col("c_custkey").alias("uid"), F.col("c_mktsegment").alias("segment"), F.col("o_orderkey").alias("last_order")
    )
    target = KeyedTable(spark, new_path(spark, "jn4"), joined.schema, ["uid"])
    target.write(joined, 0, seq="last_order")
    return target.read()


@query("jn5_refreshed_lookup", LOOKUP)
def jn5(spark, folder):
    dimension = lookup.RefreshingDimension(
        lambda: named_table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment"), ttl=60.0
    )
    return lookup.lookup_join(_orders(spark, folder), dimension(), "o_custkey", "c_custkey").select(
        "o_orderkey", "o_orderstatus", "c_name", "c_mktsegment"
    )


@query("jn6_composite_key_lookup", """
    SELECT event_id, n_name FROM events JOIN nation ON user_id % 25 = n_nationkey AND user_id % 5 = n_regionkey""")
def jn6(spark, folder):
    facts = events(spark, folder).select(
        "event_id", (F.col("user_id") % 25).cast("int").alias("nation"), (F.col("user_id") % 5).cast("int").alias("region")
    )
    nations = named_table(spark, folder, "nation")
    joined = lookup.keyed_lookup(facts, nations, [("nation", "n_nationkey"), ("region", "n_regionkey")])
    return joined.select("event_id", "n_name")


# ---------------------------------------------------------------- change feeds

FINAL_TABLE = f"""SELECT id, uid, sex, amount FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS r FROM {CHANGES} WHERE op <> '-U')
    WHERE r = 1 AND op <> '-D'"""


@query("mut1_apply_changes", FINAL_TABLE)
def mut1(spark, folder):
    return ch.apply_changes(changes(spark, folder), ["id"])


@query("snk6_ignore_retractions", f"""
    SELECT id, uid, sex, amount FROM (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS r FROM {CHANGES} WHERE op IN ('+I', '+U'))
    WHERE r = 1""")
def snk6(spark, folder):
    return ch.apply_changes(changes(spark, folder), ["id"], ignore_deletes=True)


# ---------------------------------------------------------------- sinks

PROFILE_TYPES = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("uid", T.LongType()), T.StructField("sex", T.StringType()),
    T.StructField("age", T.IntegerType()), T.StructField("created_time", T.LongType()),
])


@query("snk2_append", f"SELECT id, uid, sex, age, created_time FROM {PROFILES}")
def snk2(spark, folder):
    path = new_path(spark, "snk2")
    append = files.append_batch(path)
    rows = profiles(spark, folder)
    # Two batches, the second one repeated as after a failure.
    append(rows.where("uid % 2 = 0"), 0)
    append(rows.where("uid % 2 = 1"), 1)
    append(rows.where("uid % 2 = 1"), 1)
    return spark.read.parquet(path).drop("batch")


@query("snk3_keyed_upsert", f"""
    SELECT uid, arg_max(id, (created_time, id)) AS id, arg_max(sex, (created_time, id)) AS sex,
        arg_max(age, (created_time, id)) AS age, max(created_time) AS created_time FROM {PROFILES} GROUP BY uid""")
def snk3(spark, folder):
    target = KeyedTable(spark, new_path(spark, "snk3"), PROFILE_TYPES, ["uid"])
    # The sequence is the time with the id behind it; the later half is written first.
    rows = profiles(spark, folder).withColumn("seq", F.expr("created_time * 1000000 + id"))
    target.write(rows.where("age >= 40"), 0, seq="seq")
    target.write(rows.where("age < 40"), 1, seq="seq")
    target.compact()
    return target.read()


CREDIT_TYPES = T.StructType([
    T.StructField("uid", T.LongType()), T.StructField("date_of", T.LongType()), T.StructField("num", T.LongType()),
    T.StructField("credit", T.DecimalType(38, 18)),
])


@query("snk4_additive_upsert", f"""
    SELECT uid, date_of, CAST(sum(num) AS BIGINT) AS num, CAST(sum(credit) AS VARCHAR) AS credit
    FROM {CREDITS} WHERE uid IS NOT NULL GROUP BY uid, date_of""")
def snk4(spark, folder):
    target = KeyedTable(
        spark, new_path(spark, "snk4"), CREDIT_TYPES, ["uid", "date_of"], mode="add", measures=["num", "credit"]
    )
    # Decoded once; a stream decodes each record in its own batch only.
    rows = stage(credits(spark, folder).where("uid is not null"), "credits")
    target.write(rows.where("num <= 3"), 0)
    # The second batch is repeated as after a failure and counts once.
    target.write(rows.where("num > 3"), 1)
    target.write(rows.where("num > 3"), 1)
    return target.read().withColumn("credit", F.col("credit").cast("string"))


@query("snk5_replace_upsert", FINAL_TABLE)
def snk5(spark, folder):
    feed = changes(spark, folder)
    schema = feed.select("id", "uid", "sex", "amount").schema
    target = KeyedTable(spark, new_path(spark, "snk5"), schema, ["id"])
    last = ch.latest_changes(feed, ["id"]).withColumn("gone", F.col("op") == ch.DELETE)
    target.write(last, 0, seq="seq", deleted="gone")
    return target.read()


@query("snk7_wide_column", f"""
    SELECT {PROFILE_KEY_SQL.format(c='CAST(created_time AS VARCHAR)')} AS rowkey,
        arg_max(uid, id) AS uid, arg_max(age, id) AS age FROM {PROFILES} GROUP BY rowkey""")
def snk7(spark, folder):
    rows = profiles(spark, folder)
    key = text.profile_row_key("uid", "created_time", "sex")
    wide = wide_row(rows, key, {"uid": "uid", "sex": "sex", "age": "age", "created_time": "created_time", "id": "id"})
    target = KeyedTable(spark, new_path(spark, "snk7"), wide.schema, ["rowkey"])
    target.write(wide.withColumn("seq", F.col("cf.id")), 0, seq="seq")
    return target.read().select("rowkey", "cf.uid", "cf.age")


@query("snk8_hash_fields", f"""
    SELECT '{CLICK_HASH}' AS hash, uid || '_' || phone_type AS field,
        CAST(CAST(sum(click_count) AS BIGINT) AS VARCHAR) AS value FROM {BEHAVIOUR} GROUP BY uid, phone_type""")
def snk8(spark, folder):
    counts = behaviour(spark, folder).groupBy("uid", "phone_type").agg(F.sum("click_count").alias("cnt"))
    fields = counts.select(
        F.lit(CLICK_HASH).alias("hash"),
        text.hash_field("uid", "phone_type").alias("field"),
        F.col("cnt").cast("string").alias("value"),
    )
    target = KeyedTable(spark, new_path(spark, "snk8"), fields.schema, ["hash", "field"])
    target.write(fields, 0)
    return target.read()


@query("snk9_documents", """
    SELECT 'customers' AS index_name, '{"name":"' || c_name || '","num":' || CAST(c_nationkey AS VARCHAR) || '}' AS doc
    FROM customer UNION ALL SELECT 'events', props FROM events""")
def snk9(spark, folder):
    path = new_path(spark, "snk9")
    people = named_table(spark, folder, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("num"))
    files.save_documents(files.write_documents(people, "customers"), path, 0)
    # The second batch is repeated as after a failure and counts once.
    for _ in range(2):
        files.save_documents(files.raw_documents(events(spark, folder), "events", "props"), path, 1)
    stored = spark.read.schema("value string, index_name string").text(path)
    return stored.select("index_name", F.col("value").alias("doc"))


@query("snk10_dead_letters", """
    SELECT event_id % 50 = 0 AS malformed, count(*) AS docs FROM events GROUP BY malformed""")
def snk10(spark, folder):
    good, dead = files.well_formed(as_lines(events(spark, folder)), "value")
    path = new_path(spark, "snk10")
    files.append_batch(f"{path}/good")(good, 0)
    files.append_batch(f"{path}/dead")(dead, 0)
    stored = [
        spark.read.parquet(f"{path}/{kind}").select(F.lit(kind == "dead").alias("malformed")) for kind in ("good", "dead")
    ]
    return stored[0].unionByName(stored[1]).groupBy("malformed").agg(F.count(F.lit(1)).alias("docs"))


def dated_lines(rows):
    """Comma-separated lines with epoch milliseconds in the second field, in one of forty not readable."""
    return rows.select(F.concat_ws(
        ",", F.col("event_id").cast("string"),
        F.when(F.col("event_id") % 40 == 0, "soon").otherwise(F.unix_millis("ts").cast("string")), "event_type",
    ).alias("value"))


DATED = """SELECT CASE WHEN event_id % 40 = 0 THEN '00000000' ELSE strftime(ts, '%Y%m%d') END AS dt,
    CAST(event_id AS VARCHAR) || ',' || CASE WHEN event_id % 40 = 0 THEN 'soon' ELSE CAST(epoch_us(ts) // 1000 AS VARCHAR) END
        || ',' || event_type AS line FROM events"""


@query("snk12_event_time_folders", DATED)
def snk12(spark, folder):
    path = new_path(spark, "snk12")
    lines = dated_lines(events(spark, folder)).withColumn("dt", files.event_date("value"))
    lines.hint("rebalance", "dt").write.partitionBy("dt").text(path)
    stored = spark.read.schema("value string, dt string").text(path)
    return stored.select("dt", F.col("value").alias("line"))


COMMITTED = """
    SELECT strftime(ts, '%Y-%m-%d') AS ts_date, count(*) AS rows FROM events GROUP BY ts_date
    HAVING max(date_trunc('day', ts)) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 3 SECOND - INTERVAL 1 SECOND"""


@query("snk13_partition_commit", COMMITTED)
def snk13(spark, folder):
    path = new_path(spark, "snk13")
    rows = events(spark, folder).select(
        "event_id", "user_id", "ts", F.date_format("ts", "yyyy-MM-dd").alias("ts_date")
    )
    sink = files.CommittingPartitions(
        spark, path, ["ts_date"], "ts", grain=timedelta(days=1), delay=timedelta(seconds=3)
    )
    # Two batches: the border lies within a day, which commits with the second one.
    sink(rows.where("ts < '2024-01-15 12:00:00'"), 0)
    sink(rows.where("ts >= '2024-01-15 12:00:00'"), 1)
    committed = sink.committed()
    stored = spark.read.schema("event_id bigint, ts_date string").parquet(f"{path}/data")
    return stored.join(committed, "ts_date").groupBy("ts_date").agg(F.count(F.lit(1)).alias("rows"))


@query("snk14_topic_chain", f"SELECT label AS time, max(cnt) AS cnt FROM {RUNNING_USERS_ROWS} GROUP BY label")
def snk14(spark, folder):
    path = new_path(spark, "snk14")
    views = running_user_rows(behaviour(spark, folder)).select(F.col("label").alias("time"), "cnt")
    files.to_topic(views, path)
    schema = T.StructType([T.StructField("time", T.StringType()), T.StructField("cnt", T.LongType())])
    read_back = json_topic(spark, Topic(path=path), schema, stream=False)
    return read_back.groupBy("time").agg(F.max("cnt").alias("cnt"))


@query("snk16_alert_table", ALERTS)
def snk16(spark, folder):
    path = new_path(spark, "snk16")
    files.append_batch(path)(alert_rows(sequences(behaviour(spark, folder)), "time"), 0)
    return spark.read.parquet(path).drop("batch")
