"""Sources given by a function."""

from __future__ import annotations

import time

import pytest

from pulseboard.session import new_path, stream_session
from pulseboard.sinks.files import append_batch
from pulseboard.sources.function import NUMBERS, cut, function_source, function_stream, function_table
from pulseboard.streaming.runtime import drain, run_to


@pytest.mark.parametrize("first, end, parts", [(0, 10, 3), (5, 6, 8), (4, 4, 2), (0, 1_000, 7), (3, 9, 1)])
def test_stretches_cover_each_number_once(first, end, parts):
    found = cut(first, end, parts)
    assert [n for s in found for n in range(s.first, s.end)] == list(range(first, end))
    assert len(found) <= parts and all(s.first < s.end for s in found)


def test_a_function_makes_a_table_in_parallel(spark):
    source = function_source("squares", "n bigint, square bigint, name string", lambda a, b: ((n, n * n, f"no {n}") for n in range(a, b)))
    table = function_table(spark, source, 1_000, parts=5)
    assert table.rdd.getNumPartitions() == 5
    assert sorted(map(tuple, table.collect())) == [(n, n * n, f"no {n}") for n in range(1_000)]
    assert function_table(spark, source, 0).count() == 0


def test_a_stopped_stream_goes_on_behind_its_checkpoint(spark):
    session = stream_session(spark)
    out, checkpoint = new_path(spark, "numbers"), new_path(spark, "checkpoint")
    begin = time.time()
    batches = []

    def failing(batch, batch_id):
        append_batch(out)(batch, batch_id)
        batches.append(batch_id)
        if len(batches) == 2:
            raise ValueError("stopped")

    with pytest.raises(Exception, match="stopped"):
        run_to(function_stream(session, NUMBERS, 3_000, 1_000, begin, parts=3), failing, checkpoint, {"n": 3_000})
    run_to(function_stream(session, NUMBERS, 3_000, 1_000, begin, parts=3), append_batch(out), checkpoint, {"n": 3_000})
    assert [r["value"] for r in spark.read.parquet(out).orderBy("value").collect()] == list(range(3_000))


def test_rows_that_are_due_are_drained(spark):
    session = stream_session(spark)
    out, checkpoint = new_path(spark, "numbers"), new_path(spark, "checkpoint")
    drain(function_stream(session, NUMBERS, 200_000, 10.0, begin=0.0), append_batch(out), checkpoint)
    assert spark.read.parquet(out).selectExpr("count(distinct value)", "min(value)", "max(value)").first()[:] == (200_000, 0, 199_999)
