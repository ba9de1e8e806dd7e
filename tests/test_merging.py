"""Aggregates of create, add, merge and result against plain loops."""

import pytest
from pyspark.sql import functions as F

from pulseboard.operators import merging


def spread():
    """Made inside a function, so that it is sent to the tasks with its code."""

    class Spread:
        """Number, least and greatest of a column."""

        def create(self):
            return 0, None, None

        def add(self, state, rows):
            values = rows["v"].dropna()
            own = (len(rows), values.min(), values.max()) if len(values) else (len(rows), None, None)
            return self.merge(state, own)

        def merge(self, a, b):
            known = [x for x in (*a[1:], *b[1:]) if x is not None]
            return a[0] + b[0], min(known, default=None), max(known, default=None)

        def result(self, state):
            return state[0], None if state[1] is None else int(state[1]), None if state[2] is None else int(state[2])

    return Spread()


ROWS = [("hot" if n % 10 else None if n % 3 else f"k{n % 70}", (1 << 60) + n % 5 if n % 7 else None, None if n % 11 == 3 else n) for n in range(2_000)]


def plain(rows):
    groups = {}
    for a, b, v in rows:
        groups.setdefault((a, b), []).append(v)
    known = {k: [v for v in vs if v is not None] for k, vs in groups.items()}
    return {k: (len(vs), min(known[k], default=None), max(known[k], default=None)) for k, vs in groups.items()}


@pytest.mark.parametrize(("fan", "held"), [(32, 20_000), (2, 3)])
def test_groups_equal_a_plain_loop(spark, fan, held):
    df = spark.createDataFrame(ROWS, "a string, b long, v long").repartition(9)
    got = merging.merged(df, ["a", "b"], spread(), "n bigint, low bigint, high bigint", fan, held)
    assert {(r["a"], r["b"]): (r["n"], r["low"], r["high"]) for r in got.collect()} == plain(ROWS)
    assert got.columns == ["a", "b", "n", "low", "high"]


def test_all_rows_and_no_rows(spark):
    df = spark.createDataFrame(ROWS, "a string, b long, v long").repartition(5)
    total = merging.merged(df, [], merging.Reduce("v", lambda x, y: x + y), "total bigint", fan=2)
    assert [r["total"] for r in total.collect()] == [sum(v for _, _, v in ROWS if v is not None)]
    assert merging.merged(df.limit(0), ["a"], spread(), "n bigint, low bigint, high bigint").count() == 0
    assert merging.merged(df.limit(0), [], spread(), "n bigint, low bigint, high bigint").count() == 0


def test_a_hot_key_is_one_state_per_task(spark, monkeypatch):
    """What leaves a task is one state a key, however many rows the key has."""
    seen = {}
    keep = merging.stage

    def counted(df, name):
        stored = keep(df, name)
        seen.update({r["a"]: r["n"] for r in stored.groupBy("a").agg(F.count(F.lit(1)).alias("n")).collect()})
        return stored

    monkeypatch.setattr(merging, "stage", counted)
    df = spark.createDataFrame(ROWS, "a string, b long, v long").repartition(6)
    merging.merged(df, ["a"], spread(), "n bigint, low bigint, high bigint").collect()
    assert seen["hot"] <= 6 and sum(a == "hot" for a, _, _ in ROWS) == 1_800


def test_many_small_groups_are_added_at_once(spark):
    """One call a batch makes the states of all its groups; nulls of the order come last and large numbers stay whole."""

    def counted():
        class Counted(merging.LatestWithTotal):
            def add(self, state, rows):
                raise AssertionError("a call per group")

        return Counted(["t", "id"], "v", "m")

    rows = [(f"u{n % 700}" if n % 700 else None, None if n % 700 == 5 and n < 1_400 else n // 3_000, (1 << 60) + n, f"v{n}", None if n % 3 else (1 << 40) + n)
            for n in range(9_000)]
    want = {}
    for key, t, i, v, m in rows:
        best, total = want.get(key, ((), 0))
        want[key] = max(best, ((t is None, t or 0), i, v)), total + (m or 0)
    df = spark.createDataFrame(rows, "k string, t long, id long, v string, m long").repartition(6)
    got = merging.merged(df, ["k"], counted(), "v string, cnt bigint", fan=2, held=100)
    assert {r["k"]: (r["v"], r["cnt"]) for r in got.collect()} == {k: (best[2], total) for k, (best, total) in want.items()}
