"""Writers: keyed tables, partition commit, documents, database statements."""

from datetime import timedelta
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from pulseboard.session import new_path
from pulseboard.sinks import files
from pulseboard.sinks import jdbc as db
from pulseboard.sinks.keyed import KeyedTable
from pulseboard.sources.jdbc import Database

SCHEMA = "k string, v bigint, note string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def content(df):
    return {tuple(r) for r in df.collect()}


def keyed(spark, **how):
    return KeyedTable(spark, new_path(spark, "test"), frame(spark, []).schema, ["k"], **how)


def test_empty_table(spark):
    assert keyed(spark).read().count() == 0


def test_last_batch_wins_and_a_repeat_changes_nothing(spark):
    t = keyed(spark)
    t.write(frame(spark, [("a", 1, "x"), ("b", 2, "x")]), 0)
    t.write(frame(spark, [("a", 3, "y")]), 1)
    t.write(frame(spark, [("a", 3, "y")]), 1)
    assert content(t.read()) == {("a", 3, "y"), ("b", 2, "x")}
    assert content(t.read(before=1)) == {("a", 1, "x"), ("b", 2, "x")}


def test_an_older_sequence_loses(spark):
    t = keyed(spark)
    with_seq = SCHEMA + ", seq bigint, gone boolean"
    t.write(frame(spark, [("a", 1, "x", 5, False), ("b", 1, "x", 5, False)], with_seq), 0, "seq", "gone")
    t.write(frame(spark, [("a", 2, "old", 4, False), ("b", 0, None, 7, True)], with_seq), 1, "seq", "gone")
    assert content(t.read()) == {("a", 1, "x")}
    t.compact()
    # A late older change of a removed key does not bring it back.
    t.write(frame(spark, [("b", 3, "late", 6, False), ("c", 1, "n", 1, False)], with_seq), 2, "seq", "gone")
    assert content(t.read()) == {("a", 1, "x"), ("c", 1, "n")}


def test_added_measures_and_kept_columns(spark):
    t = keyed(spark, mode="add", measures=["v"])
    t.write(frame(spark, [("a", 1, "first"), ("a", 2, "first")]), 0)
    t.write(frame(spark, [("a", 10, "second"), ("b", 5, "b")]), 1)
    t.compact()
    t.compact()
    t.write(frame(spark, [("a", 100, "third")]), 2)
    t.write(frame(spark, [("a", 100, "third")]), 2)
    assert content(t.read()) == {("a", 113, "first"), ("b", 5, "b")}


def test_unfinished_batch_is_not_read(spark):
    t = keyed(spark)
    t.write(frame(spark, [("a", 1, "x")]), 0)
    t.write(frame(spark, [("a", 2, "y")]), 1)
    Path(t.path.removeprefix("file:"), "delta", "n=1", "_SUCCESS").unlink()
    assert content(t.read()) == {("a", 1, "x")}


def test_compaction_while_writing(spark):
    t = keyed(spark, mode="add", measures=["v"], compact_every=2)
    for n in range(4):
        t.write(frame(spark, [("a", 1, "x")]), n)
    # The batch that was compacted is repeated.
    t.write(frame(spark, [("a", 1, "x")]), 3)
    assert len(t._parts()) == 1 and content(t.read()) == {("a", 4, "x")}
    assert content(t.read(before=3)) == {("a", 3, "x")}


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        keyed(spark, mode="merge")


def test_partition_commit_over_batches(spark):
    path = new_path(spark, "commit")
    sink = files.CommittingPartitions(
        spark, path, ["ts_date"], "ts", timedelta(days=1), timedelta(seconds=3), timedelta(seconds=1)
    )

    def batch(*stamps):
        df = frame(spark, [(s,) for s in stamps], "t string").select(F.to_timestamp("t").alias("ts"))
        return df.withColumn("ts_date", F.date_format("ts", "yyyy-MM-dd"))

    def marked():
        root = Path(path.removeprefix("file:"), "data")
        return {p.name.removeprefix("ts_date=") for p in root.iterdir() if (p / "_SUCCESS").exists()}

    sink(batch("2024-01-01 10:00:00", "2024-01-02 00:00:03"), 0)
    assert marked() == set()
    sink(batch("2024-01-02 00:00:04"), 1)
    assert marked() == {"2024-01-01"}
    # Repeated as after a failure, then two days at once.
    sink(batch("2024-01-02 00:00:04"), 1)
    sink(batch("2024-01-04 12:00:00", "2024-01-03 12:00:00"), 2)
    assert marked() == {"2024-01-01", "2024-01-02", "2024-01-03"}
    assert content(sink.committed()) == {("2024-01-01",), ("2024-01-02",), ("2024-01-03",)}
    assert spark.read.schema("ts timestamp, ts_date string").parquet(f"{path}/data").count() == 5


def test_event_date_fallback(spark):
    lines = frame(spark, [("1,1594906746454,x",), ("1,soon,x",), ("alone",), ("",), (None,)], "value string")
    got = [r[0] for r in lines.select(files.event_date("value")).collect()]
    assert got == ["20200716", "00000000", "00000000", "00000000", "00000000"]


def test_document_kinds(spark):
    people = frame(spark, [("a", 10)], "name string, num int")
    raw = frame(spark, [('{"reason" : "business","airport" : "SFO"}',)], "value string")
    docs = files.write_documents(people, "one").unionByName(files.raw_documents(raw, "two"))
    path = new_path(spark, "docs")
    files.save_documents(docs, path)
    stored = spark.read.schema("value string, index_name string").text(path)
    assert content(stored.select("index_name", "value")) == {
        ("one", '{"name":"a","num":10}'), ("two", '{"reason" : "business","airport" : "SFO"}')
    }


def test_dead_letters(spark):
    docs = frame(spark, [('{"a":1}',), ("{}",), ("{broken",), ("[1]",), (None,)], "doc string")
    good, dead = files.well_formed(docs)
    assert content(good) == {('{"a":1}',), ("{}",)} and dead.count() == 3


def test_retry_policy():
    calls = []

    def overloaded(batch, batch_id):
        calls.append(batch_id)
        if len(calls) < 3:
            raise ConnectionError("full")

    files.with_retries(overloaded, 3)(None, 7)
    assert calls == [7, 7, 7]
    with pytest.raises(ConnectionError):
        calls.clear()
        files.with_retries(overloaded, 2)(None, 7)

    def broken(batch, batch_id):
        calls.append("broken")
        raise ValueError("bad request")

    calls.clear()
    with pytest.raises(ValueError):
        files.with_retries(broken, 3)(None, 7)
    assert calls == ["broken"]


def test_statements_of_the_dialects():
    columns = ["id", "price", "cnt"]
    assert db.upsert_statement("t", "s0", ["id"], columns) == (
        "MERGE INTO t t USING s0 s ON t.id = s.id WHEN MATCHED THEN UPDATE SET price = s.price, cnt = s.cnt "
        "WHEN NOT MATCHED THEN INSERT (id, price, cnt) VALUES (s.id, s.price, s.cnt)"
    )
    assert db.upsert_statement("t", "s0", ["id"], columns, ["cnt"], "duplicate_key") == (
        "INSERT INTO t (id, price, cnt) SELECT s.id, s.price, s.cnt FROM s0 s "
        "ON DUPLICATE KEY UPDATE cnt = t.cnt + s.cnt"
    )
    assert db.upsert_statement("t", "s0", ["id"], columns, dialect="upsert_into") == (
        "UPSERT INTO t (id, price, cnt) SELECT id, price, cnt FROM s0"
    )
    assert db.upsert_statement("t", "s0", ["id"], ["id"], dialect="duplicate_key").endswith("ON DUPLICATE KEY UPDATE id = t.id")
    with pytest.raises(ValueError):
        db.DatabaseUpsert(Database("jdbc:x"), "t", ["id"])
    with pytest.raises(ValueError):
        db.upsert_statement("t", "s0", ["id"], columns, ["cnt"], "upsert_into")
    with pytest.raises(ValueError):
        db.upsert_statement("t", "s0", ["id"], columns, dialect="other")


@pytest.mark.parametrize("add, want", [([], (1, 70, 5)), (["cnt"], (1, 50, 7))])
def test_merge_semantics(add, want):
    """The statement as the checking engine understands it."""
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id BIGINT PRIMARY KEY, price BIGINT, cnt INT)")
    con.execute("CREATE TABLE s0 (id BIGINT, price BIGINT, cnt INT)")
    con.execute("INSERT INTO t VALUES (1, 50, 2)")
    con.execute("INSERT INTO s0 VALUES (1, 70, 5), (2, 9, 1)")
    con.execute(db.upsert_statement("t", "s0", ["id"], ["id", "price", "cnt"], add))
    assert con.sql("SELECT * FROM t ORDER BY id").fetchall() == [want, (2, 9, 1)]


def test_ledger_goes_with_the_change():
    sink = db.DatabaseUpsert(Database("jdbc:x"), "t", ["id"], add=["cnt"], query="q1")
    asked, statements = sink.statements("t_staging", ["id", "cnt"], 4)
    assert asked.endswith("WHERE query_id = 'q1' AND batch_id = 4")
    assert statements[0].startswith("MERGE INTO t t USING t_staging s")
    assert statements[1] == "INSERT INTO pulseboard_ledger (query_id, batch_id) VALUES ('q1', 4)"
    other = db.DatabaseUpsert(Database("jdbc:x"), "t", ["id"], order=["cnt"], dialect="upsert_into", query="q2")
    assert other.statements("s", ["id"], 4)[1][1] == "UPSERT INTO pulseboard_ledger (query_id, batch_id) VALUES ('q2', 4)"
    assert sink.staging() != other.staging()


def test_fold_of_a_batch(spark):
    rows = frame(spark, [("a", 1, "x"), ("a", 2, "x"), ("b", 5, "y")])
    assert content(db.fold_batch(rows, ["k"], add=["v"])) == {("a", 3, "x"), ("b", 5, "y")}
    assert content(db.fold_batch(rows, ["k"], order=["v"])) == {("a", 2, "x"), ("b", 5, "y")}
    assert db.fold_batch(rows, ["k"]).count() == 2
