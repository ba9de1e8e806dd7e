"""Roll-over of text files by size, age and inactivity."""

from __future__ import annotations

from datetime import timedelta

import pytest

from pulseboard.session import new_path
from pulseboard.sinks.rolling import RollingFiles


class Clock:
    now = 1_000.0

    def __call__(self):
        return self.now


@pytest.fixture
def sink(spark):
    clock = Clock()
    files = RollingFiles(spark, new_path(spark, "rolling"), ["dt"], 100, timedelta(seconds=60), timedelta(seconds=20), clock=clock)
    return files, clock, lambda rows: spark.createDataFrame(rows, "value string, dt string")


def done(files):
    return sorted((r["dt"] or "", r["value"]) for r in files.finished().collect())


def test_size_closes_a_folder_and_a_repeated_batch_replaces_itself(sink):
    files, _, batch = sink
    small, large = [("x" * 9, "a")] * 3, [(f"{k:09d}", "b") for k in range(50)]
    for _ in range(2):
        files(batch(small + large), 0)
    assert done(files) == sorted((d, v) for v, d in large)
    assert files.finished().select("file").distinct().count() == 5  # 500 bytes by 100
    files(batch([("y" * 9, "a")] * 7), 1)
    files(batch([("y" * 9, "a")] * 7), 1)
    assert [v for d, v in done(files) if d == "a"] == ["x" * 9] * 3 + ["y" * 9] * 7


def test_an_idle_folder_is_closed_by_a_tick(sink):
    files, clock, batch = sink
    files(batch([("one", "a"), ("none", None)]), 0)
    clock.now += 15
    files(batch([("two", "b")]), 1)
    clock.now += 6
    files.tick()
    assert done(files) == [("", "none"), ("a", "one")]
    clock.now += 14
    files.tick()
    files.tick()
    assert done(files) == [("", "none"), ("a", "one"), ("b", "two")]


def test_age_closes_a_folder_that_is_always_written(sink):
    files, clock, batch = sink
    for k in range(5):
        files(batch([(f"{k}", "a")]), k)
        assert done(files) == ([] if k < 4 else [("a", str(i)) for i in range(5)])
        clock.now += 15
    files(batch([("5", "a")]), 5)
    files(batch([("6", "a")]), 6)
    assert len(done(files)) == 5
    assert not files._exists(f"{files.path}/lines/batch=0") and files._exists(f"{files.path}/lines/batch=5")
