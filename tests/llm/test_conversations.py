"""Conversation repair against trying all edits, and against a whole-table solution of each conversation."""

import hashlib
import re
import sys
import zlib
from collections import Counter
from itertools import product
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from pulseboard.llm import conversations  # noqa: E402
from pulseboard.llm.catalog import CONVERSATIONS_SQL, QUERIES  # noqa: E402

FIELDS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def all_edits(kinds):
    """Cost and edits by trying every way to edit every row."""
    follows = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = None
    for edits in product(*[["I" * k + e for k in range(3) for e in "DKR"] for _ in kinds]):
        for tail in ("", "I", "II"):
            state, cost, legal = "", 0, True
            for edit, kind in zip(edits, kinds, strict=True):
                for sign in edit:
                    if sign == "D":
                        cost += 3
                    elif sign == "I":
                        state, cost = follows[state], cost + 2
                    else:
                        new = kind.lower() if sign == "K" else follows[state]
                        legal &= kind != "-" and (new == follows[state] or (new == "s" and state == ""))
                        cost += (2 if sign == "R" else 0) + kind.isupper()
                        state = new
                    if not legal:
                        break
                if not legal:
                    break
            if not legal:
                continue
            for _ in tail:
                state, cost = follows[state], cost + 2
            if state in ("", "a"):
                found = (cost, "".join(edits) + tail)
                best = found if best is None else min(best, found)
    return best


@pytest.mark.parametrize("length", [0, 1, 2, 3, 4])
def test_crossings_find_the_least_of_the_cheapest_edits(length):
    rng = np.random.default_rng(length)
    every = ["".join(k) for k in product("suaoSUA-", repeat=length)]
    some = every if len(every) < 100 else [every[i] for i in rng.choice(len(every), 60, replace=False)]
    for kinds in some:
        edits, _, cost, end = conversations.edited(kinds, [k.lower() for k in kinds], [""] * length)
        assert (cost + conversations.FINISH[end][0], edits + conversations.FINISH[end][1]) == all_edits(kinds)


def whole_table(kinds):
    """Cost and edits of a whole conversation by costs to the end, kept for every row."""
    n = len(kinds)
    costs = [None] * (n + 1)
    costs[n] = [0, 4, 2, 0]
    moves = []
    for i in range(n - 1, -1, -1):
        own = conversations.STEPS[kinds[i]]
        costs[i] = [min(own[p][q][0] + costs[i + 1][q] for q in range(4)) for p in range(4)]
    state = 0
    for i in range(n):
        own = conversations.STEPS[kinds[i]]
        state, text = min(((q, own[state][q][1]) for q in range(4) if own[state][q][0] + costs[i + 1][q] == costs[i][state]), key=lambda x: x[1])
        moves.append(text)
    return costs[0][0], "".join(moves) + conversations.FINISH[state][1]


def test_long_stretches_equal_the_whole_table():
    rng = np.random.default_rng(1)
    for n in (5, 64, 65, 700):
        for letters in ("suaoSUAO-", "uaUA-", "u", "-", "aS"):
            kinds = "".join(rng.choice(list(letters), n))
            edits, _, cost, end = conversations.edited(kinds, [k.lower() for k in kinds], [""] * n)
            assert (cost + conversations.FINISH[end][0], edits + conversations.FINISH[end][1]) == whole_table(kinds)


def test_tables_compose_in_any_order():
    rng = np.random.default_rng(2)
    tables = [conversations.ROWS[k] for k in rng.choice(list("suaoSUAO-"), 40)]
    want = conversations.composed(tables)
    for _ in range(20):
        left = list(tables)
        while len(left) > 1:
            k = int(rng.integers(len(left) - 1))
            left[k:k + 2] = [conversations.composed(left[k:k + 2])]
        assert left[0].cost == want.cost
        reached = [[q for q in range(4) if want.cost[p][q] < conversations.NEVER] for p in range(4)]
        assert all(sorted(r, key=lambda q: left[0].rank[p][q]) == sorted(r, key=lambda q: want.rank[p][q]) for p, r in enumerate(reached))  # noqa: B023


def plain(rows, damage=True):
    """Every conversation by itself, in Python."""
    groups = {}
    for conv, turn, role, text in rows:
        c, t = (" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(f"{c}:{t}".encode()) % 20 if damage else 9
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        groups.setdefault(conv, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(fate, 1))
    out = []
    for conv, left in groups.items():
        left.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in left:
            shown = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
        signs = [r[1][:1] for r in left]
        kinds = "".join("-" if f in ("blank", "duplicate") else (s if s in ("s", "u", "a") else "o").upper() if f else (s if s in ("s", "u", "a") else "o")
                        for s, f in zip(signs, faults, strict=True))
        cost, audit = whole_table(kinds)
        lines, rest, last = [], iter(left), ""
        for sign in audit:
            follows = "assistant" if last == "u" else "user"
            row = None if sign == "I" else next(rest)
            if sign != "D":
                lines.append(f"{row[1]}:{row[2]}" if sign == "K" else f"{follows}:{row[2] if row else ''}")
                last = lines[-1][0]
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        turns = {r[0] for r in left if r[0] is not None}
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(x + y not in ("su", "ua", "au") for x, y in zip(signs[:-1], signs[1:], strict=True)), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return Counter(out)


def rows_of(df):
    return Counter(tuple(r[c] for c in FIELDS) for r in df.select(*FIELDS).collect())


@pytest.fixture(scope="module")
def odd():
    rng = np.random.default_rng(4)
    rows = [(None, 0, "user", "Hi."), (None, None, "assistant", None), (1, None, None, "x"), (1, 3, "", ""), (2, 5, "tool", "Ends here!"), (3, 0, "system", "Be brief."),
            (4, 0, "user", "word " * 20_000 + "."), (4, 1, "assistant", " \t\x0b"), (4, 1, "user", "nul \0 and line."), (4, 9, "user", "Öl? ")]
    rows += [(5, 7, "user", "Same.")] * 300 + [(6, int(t), "user", f"{t}.") for t in rng.integers(0, 50, 200)]
    roles, ends = ["user", "assistant", "system", "tool"], [".", "!", "", " ", "?"]
    # One conversation with a third of the rows, and repeats all over it.
    rows += [(7, k, roles[int(rng.choice(4, p=[.5, .4, .05, .05]))], f"Line {int(rng.integers(0, 400))}{ends[int(rng.integers(5))]}") for k in range(1_500)]
    for conv in range(10, 400):
        rows += [(conv, k, roles[int(rng.integers(3))], f"Text {int(rng.integers(0, 6))}{ends[int(rng.integers(5))]}") for k in range(int(rng.integers(1, 9)))]
    return rows


@pytest.mark.parametrize("damage", [True, False])
@pytest.mark.parametrize("block_rows", [conversations.BLOCK_ROWS, 7])
def test_repair_equals_each_conversation_by_itself(spark, odd, damage, block_rows):
    table = (spark.createDataFrame(odd, "conv_id long, turn long, role string, text string").repartition(6)
             .withColumn("key", F.lit(1)).withColumn("block", F.lit("x")).withColumn("copies", F.lit(3)))
    assert rows_of(conversations.repaired(table, damage=damage, block_rows=block_rows)) == plain(odd, damage)


def test_deep_trees_equal_flat_ones(spark, odd, monkeypatch):
    monkeypatch.setattr(conversations, "FAN", 2)
    table = spark.createDataFrame(odd, "conv_id long, turn long, role string, text string")
    assert rows_of(conversations.repaired(table, block_rows=20)) == plain(odd)


def test_conversations_without_rows_left(spark):
    gone = [(c, t, "user", "x.") for c in range(200) for t in range(1) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    assert gone
    table = spark.createDataFrame(gone, "conv_id long, turn long, role string, text string")
    got = rows_of(conversations.repaired(table))
    assert got == Counter((c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, *_ in gone)
    assert conversations.repaired(table.limit(0)).count() == 0


def test_query_equals_sql_and_plain(spark, folder):
    got = rows_of(QUERIES["op12_conversation_repair"].run(spark, folder))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    assert Counter(con.sql(f"SELECT {', '.join(FIELDS)} FROM ({CONVERSATIONS_SQL})").fetchall()) == got
    given = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert plain(given) == got
