"""Repair of conversations' turn structure by divide and conquer over four-state cost vectors.

A conversation's rows are edited (kept, given the other role, deleted, or preceded by inserted rows)
until its roles read: an optional system row, then user and assistant in turns. What has been
written so far is one of four states (nothing, system, user, assistant), so a stretch of rows is a
4 x 4 table of costs and of the order of its edits' texts. Such tables compose associatively.

Nothing but vectors is kept while solving (Hirschberg's linear space): the forward vector of the
left half and the backward vector of the right half meet in the middle of a stretch, the cheapest
crossing whose edits read least is taken, and both halves are solved again with their ends known. The
same recursion runs over rows inside a block, over the blocks of a task, and over tasks, so a
conversation of any length is spread over many tasks and no task holds it whole.

Texts of edits can be compared by ranks alone: two different texts of one stretch both end with a
row's own edit and have equally many of those, so neither begins with the other, and what follows
does not change their order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseboard.llm.arrow_text import bounded_batches
from pulseboard.session import stage

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Rows and characters of a block, and tables composed by one group of the tree.
BLOCK_ROWS, BLOCK_CHARS, FAN = 2048, 1 << 20, 256
#: Blocks of a task are numbered within this.
PER_TASK = 1 << 24
NEVER = 1 << 40
#: What is written next after nothing, system, user, assistant.
NEXT = (2, 2, 3, 2)
#: Kept system and user rows may come first.
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NAME = {2: "user", 3: "assistant"}
#: Cost and edits that complete a conversation from each state.
FINISH = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))
LEGAL = {"su", "ua", "au"}

_BLOCK = ("key string, conv_id bigint, block bigint, turns array<bigint>, roles array<string>, texts array<string>, "
          "faults array<string>, idents array<binary>")
_RESULT = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
           "audit string, repaired_sha256 string")
_PART = ("key string, conv_id bigint, block bigint, n bigint, low bigint, high bigint, turns bigint, blank bigint, duplicate bigint, "
         "truncated bigint, illegal bigint, first string, last string, leave bigint, cost bigint, audit string, repaired string")


class Table(NamedTuple):
    """Cost of a stretch between each pair of states, and the rank of its edits' text among those from the same state."""

    cost: tuple[tuple[int, ...], ...]
    rank: tuple[tuple[int, ...], ...]


def _row_steps(kind: str) -> list[list[tuple[int, str]]]:
    """Cheapest edits of one row between each pair of states, of equal ones the least text.

    ``kind`` is the role's initial (``o``: another one), in capitals if the row is truncated, or ``-`` if the row has to go.
    """
    best = [[(NEVER, "")] * 4 for _ in range(4)]
    extra = TRUNCATED if kind.isupper() else 0
    for start in range(4):
        now = start
        for inserted in range(3):
            paid, text = INSERT * inserted, "I" * inserted
            ways = [(now, DELETE, "D")]
            if kind != "-":
                ways.append((NEXT[now], REROLE + extra, "R"))
                if (now, kind.lower()) in AFTER:
                    ways.append((AFTER[now, kind.lower()], extra, "K"))
            for end, cost, edit in ways:
                best[start][end] = min(best[start][end], (paid + cost, text + edit), key=lambda x: (x[0], x[1]))
            now = NEXT[now]
    return best


STEPS = {kind: _row_steps(kind) for kind in "suaoSUAO-"}


def _ranked(rows: Sequence[Sequence[tuple]]) -> Table:
    """A table of (cost, order key) entries with the order keys as ranks."""
    ranks = []
    for row in rows:
        place = {k: i for i, k in enumerate(sorted({x[1] for x in row}))}
        ranks.append(tuple(place[x[1]] for x in row))
    return Table(tuple(tuple(x[0] for x in row) for row in rows), tuple(ranks))


ROWS = {kind: _ranked(steps) for kind, steps in STEPS.items()}
NOTHING = Table(tuple(tuple(0 if p == q else NEVER for q in range(4)) for p in range(4)), ((0,) * 4,) * 4)


def forward(vector: Sequence[tuple[int, int]], table: Table) -> list[tuple[int, int]]:
    """(cost, rank) of each state after a stretch, from those before it."""
    out = []
    for q in range(4):
        out.append(min((c + table.cost[p][q], r, table.rank[p][q]) for p, (c, r) in enumerate(vector)))
    place = {k: i for i, k in enumerate(sorted({x[1:] for x in out}))}
    return [(min(x[0], NEVER), place[x[1:]]) for x in out]


def backward(costs: Sequence[int], table: Table) -> list[int]:
    """Cost from each state before a stretch to the end, from those after it."""
    return [min(table.cost[p][q] + costs[q] for q in range(4)) for p in range(4)]


def start_at(state: int) -> list[tuple[int, int]]:
    return [(0 if p == state else NEVER, 0) for p in range(4)]


def composed(tables: Sequence[Table]) -> Table:
    """The table of adjacent stretches."""
    rows = []
    for p in range(4):
        vector = start_at(p)
        for t in tables:
            vector = forward(vector, t)
        rows.append(vector)
    return Table(tuple(tuple(c for c, _ in r) for r in rows), tuple(tuple(k for _, k in r) for r in rows))


def crossings(tables: Sequence[Table], entry: int, leave: int) -> list[int]:
    """The states between the stretches on the cheapest way from ``entry`` to ``leave`` whose edits read least.

    One state more than stretches, with both ends. Linear in space: vectors only, met in the middle.
    """
    states = [entry] + [leave] * len(tables)
    open_ = [(0, len(tables))]
    while open_:
        low, high = open_.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        vector = start_at(states[low])
        for t in tables[low:middle]:
            vector = forward(vector, t)
        costs = [0 if q == states[high] else NEVER for q in range(4)]
        for t in reversed(tables[middle:high]):
            costs = backward(costs, t)
        states[middle] = min(range(4), key=lambda m: (vector[m][0] + costs[m], vector[m][1]))
        open_ += [(low, middle), (middle, high)]
    return states


def last_state(table: Table) -> int:
    """The state in which a whole conversation of this table ends."""
    return min(range(4), key=lambda q: (table.cost[0][q] + FINISH[q][0], table.rank[0][q]))


@lru_cache(maxsize=50_000)
def _short(kinds: str) -> tuple[tuple[str, ...], int, int]:
    """Edits of each row of a short conversation, the last state and the cost."""
    return _solved(kinds, 0, None)


def _solved(kinds: str, entry: int, leave: int | None) -> tuple[tuple[str, ...], int, int]:
    tables = [ROWS[k] for k in kinds]
    if leave is None:
        leave = last_state(composed(tables) if tables else NOTHING)
    states = crossings(tables, entry, leave)
    steps = [STEPS[k][p][q] for k, p, q in zip(kinds, states[:-1], states[1:], strict=True)]
    return tuple(s for _, s in steps), leave, sum(c for c, _ in steps)


def edited(kinds: str, roles: Sequence[str], texts: Sequence[str], entry: int = 0, leave: int | None = None) -> tuple[str, str, int, int]:
    """Edits, repaired rows (``role:text``, by lines), cost and last state of a stretch; without ``leave`` it is a whole conversation."""
    edits, end, cost = _short(kinds) if leave is None and len(kinds) <= 64 else _solved(kinds, entry, leave)
    lines, now = [], entry
    for edit, role, text in zip(edits, roles, texts, strict=True):
        for sign in edit:
            if sign == "D":
                continue
            if sign == "K":
                now = AFTER[now, role[:1]]
                lines.append(f"{role}:{text}")
            else:
                now = NEXT[now]
                lines.append(f"{NAME[now]}:{text if sign == 'R' else ''}")
    return "".join(edits), "\n".join(lines), cost, end


def closing(state: int) -> list[str]:
    """The rows that are written at the end of a conversation."""
    out = []
    for _ in FINISH[state][1]:
        state = NEXT[state]
        out.append(f"{NAME[state]}:")
    return out


class Block:
    """Rows of one conversation that follow each other in a task."""

    def __init__(self, conv_id: int | None, place: int, goes_on: bool):
        self.conv_id, self.place, self.goes_on = conv_id, place, goes_on
        self.turns, self.roles, self.texts, self.faults = [], [], [], []
        self.seen: set[tuple[str, str]] = set()
        self.chars = 0

    def add(self, turn: int | None, role: str, text: str, blank: bool, cut: bool) -> None:
        known = (role, text) in self.seen
        self.seen.add((role, text))
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.faults.append("b" if blank else "d" if known else "t" if cut else "")
        self.chars += len(text) + len(role)

    def full(self) -> bool:
        return len(self.roles) >= BLOCK_ROWS or self.chars >= BLOCK_CHARS


def kinds_of(roles: Sequence[str], faults: Sequence[str]) -> str:
    out = []
    for role, fault in zip(roles, faults, strict=True):
        sign = role[:1] if role[:1] in ("s", "u", "a") else "o"
        out.append("-" if fault in ("b", "d") else sign.upper() if fault == "t" else sign)
    return "".join(out)


def _facts(turns: Sequence, roles: Sequence[str], faults: Sequence[str]) -> dict:
    """Counts of a block, and what its neighbours need to count across the border."""
    known = [t for t in turns if t is not None]
    signs = [r[:1] for r in roles]
    return {
        "n": len(roles), "low": min(known, default=None), "high": max(known, default=None), "turns": len(set(known)),
        "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
        "illegal": sum(a + b not in LEGAL for a, b in zip(signs[:-1], signs[1:], strict=True)),
        "first": signs[0] if signs else None, "last": signs[-1] if signs else None,
    }


def _result(block: Block) -> tuple:
    """The result row of a conversation that is one block."""
    f = _facts(block.turns, block.roles, block.faults)
    audit, body, cost, end = edited(kinds_of(block.roles, block.faults), block.roles, block.texts)
    lines = ([body] if body else []) + closing(end)
    gaps = f["high"] - f["low"] + 1 - f["turns"] if f["turns"] else 0
    return (block.conv_id, gaps, f["blank"], f["duplicate"], f["truncated"], f["illegal"], cost + FINISH[end][0],
            audit + FINISH[end][1], hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    types = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = []
    for name, kind in (part.split(" ") for part in schema.split(", ")):
        inner = kind.removeprefix("array<").removesuffix(">")
        fields.append(pa.field(name, types[kind] if kind == inner else pa.list_(types[inner])))
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=pa.schema(fields))


def _ident(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def _read(block_rows: int):
    """Ordered rows to results of the conversations that lie inside the task, and blocks of the others."""
    schema = f"{_RESULT}, {_BLOCK.replace('conv_id bigint', 'id bigint')}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() * PER_TASK
        none, out = (None,) * 9, []

        def row(b: Block) -> tuple:
            # The first and the last conversation may go on in the neighbours.
            key = " " if b.conv_id is None else str(b.conv_id)
            idents = [_ident(r, t) if f != "d" else None for r, t, f in zip(b.roles, b.texts, b.faults, strict=True)]
            return (*none, key, b.conv_id, b.place, b.turns, b.roles, b.texts, b.faults, idents)

        now = None
        for batch in batches:
            for conv_id, turn, role, text, copies, blank, cut in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None:
                    now = Block(conv_id, place, True)
                elif conv_id != now.conv_id:
                    out.append(row(now) if now.goes_on else (*_result(now), *(None,) * 8))
                    place += 1
                    now = Block(conv_id, place, False)
                elif now.full() or len(now.roles) >= block_rows:
                    out.append(row(now))
                    place += 1
                    now = Block(conv_id, place, True)
                for _ in range(copies):
                    now.add(turn, role, text, blank, cut)
            # Results are small, blocks are not.
            if out:
                yield _batch(schema, out)
                out = []
        if now is not None:
            yield _batch(schema, [*out, row(now)])

    return run, schema


def damaged(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """The rows with their damage, all by expressions: ``copies`` is 0 for a dropped row and 2 for a repeated one."""
    space = F.lit(" ")
    conv, turn = F.col(id_col).cast("long"), F.col(turn_col).cast("long")
    fate = F.crc32(F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space)).cast("binary")) % 20
    text = F.coalesce(F.col(text_col), space)
    return rows.select(
        conv.alias("conv_id"), turn.alias("turn"),
        F.when(fate == 4, "user").otherwise(F.coalesce(F.col(role_col), space)).alias("role"),
        F.when(fate.isin(0, 1), "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"))


def _faulty(text: Column) -> tuple[Column, Column]:
    """Whether a text is blank, and whether its last visible character ends no sentence."""
    seen = F.regexp_replace(text, r"[\x20\x09-\x0D]+$", "")
    return seen == "", ~F.substring(seen, -1, 1).isin(".", "!", "?")


def repaired(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
             damage: bool = True, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per conversation: its faults, the cost of its repair, the edits and the digest of the repaired rows.

    With ``damage`` rows are damaged first, by the checksum of their conversation and turn. Nulls count as one space, a null turn is before all
    others; rows of one turn are in the order of role, then of the MD5 of the text (equal rows can be exchanged). Rows that repeat another
    one are duplicates. A conversation without a row left, blank rows only or a null id has its row too. An empty table gives an empty result. Other columns are not read.
    """
    bounded_batches()
    if damage:
        left = damaged(rows, id_col, turn_col, role_col, text_col)
    else:
        space = F.lit(" ")
        left = rows.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                           F.coalesce(F.col(role_col), space).alias("role"), F.coalesce(F.col(text_col), space).alias("text"), F.lit(1).alias("copies"))
    blank, cut = _faulty(F.col("text"))
    left = left.withColumns({"blank": blank, "cut": cut, "digest": F.md5(F.col("text").cast("binary")), "nth": F.monotonically_increasing_id()})
    # The row number keeps a flood of equal rows from being one range.
    ordered = (left.repartitionByRange(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "digest", "nth")
               .sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "digest", "nth")
               .select("conv_id", "turn", "role", "text", "copies", "blank", "cut"))
    run, schema = _read(block_rows)
    read = stage(ordered.mapInArrow(run, schema), "conversations")
    whole = read.where("key is null").select(*(part.split(" ")[0] for part in _RESULT.split(", ")))
    blocks = read.where("key is not null").select(
        "key", F.col("id").alias("conv_id"), "block", "turns", "roles", "texts", "faults", "idents")
    return whole.unionByName(_joined(_solved_blocks(_without_repeats(blocks))))


def _without_repeats(blocks: DataFrame) -> DataFrame:
    """The blocks, with rows whose role and text an earlier block of the conversation has marked as duplicates."""
    said = blocks.select("key", "block", F.posexplode("idents").alias("at", "ident")).where("ident is not null")
    first = said.groupBy("key", "ident").agg(F.min("block").alias("home"), F.count(F.lit(1)).alias("times")).where("times > 1")
    again = (said.join(first, ["key", "ident"]).where("block > home").groupBy("key", "block").agg(F.collect_list("at").alias("again")))
    marked = F.transform("faults", lambda f, i: F.when((f != "b") & F.array_contains("again", i), "d").otherwise(f))
    return stage(blocks.drop("idents").join(again, ["key", "block"], "left")
                 .withColumn("faults", F.when(F.col("again").isNull(), F.col("faults")).otherwise(marked)).drop("again"), "blocks")


def _flat(t: Table) -> list[int]:
    return [x for part in t for row in part for x in row]


def _table(flat: Sequence[int]) -> Table:
    rows = [tuple(int(x) for x in flat[k:k + 4]) for k in range(0, 32, 4)]
    return Table(tuple(rows[:4]), tuple(rows[4:]))


def _solved_blocks(blocks: DataFrame) -> DataFrame:
    """The blocks' parts of the result: tables up the tree, states at the borders down again, then each block by itself."""

    @F.pandas_udf("array<bigint>")
    def table(roles: pd.Series, faults: pd.Series) -> pd.Series:
        return pd.Series([_flat(composed([ROWS[k] for k in kinds_of(list(r), list(f))])) for r, f in zip(roles, faults, strict=True)])

    def up(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        return pd.DataFrame({"key": group["key"][:1], "node": group["parent"][:1], "t": [_flat(composed([_table(t) for t in group["t"]]))]})

    def down(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        states = crossings([_table(t) for t in group["t"]], int(group["enter"].iloc[0]), int(group["leave"].iloc[0]))
        return pd.DataFrame({"key": group["key"], "node": group["node"], "enter": states[:-1], "leave": states[1:]})

    @F.pandas_udf("bigint")
    def end(t: pd.Series) -> pd.Series:
        return pd.Series([last_state(_table(x)) for x in t])

    level = stage(blocks.select("key", F.col("block").alias("node"), F.expr(f"block div {PER_TASK}").alias("parent"),
                                table("roles", "faults").alias("t")), "tables")
    levels = [level]
    while True:
        above = stage(level.groupBy("key", "parent").applyInPandas(up, "key string, node bigint, t array<bigint>"), "above")
        level = above.withColumn("parent", F.expr(f"node div {FAN}"))
        if level.where("node > 0").isEmpty():
            break
        levels.append(level)
    states = level.select("key", "node", F.lit(0).cast("long").alias("enter"), end("t").alias("leave"))
    for level in reversed(levels):
        known = states.withColumnRenamed("node", "parent")
        states = stage(level.join(known, ["key", "parent"]).groupBy("key", "parent")
                       .applyInPandas(down, "key string, node bigint, enter bigint, leave bigint"), "states")
    fields = ("blank", "duplicate", "truncated", "illegal", "first", "last", "n", "low", "high", "turns")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split(" ")[0] for part in _PART.split(", ")]
        for batch in batches:
            for r in batch.to_pylist():
                audit, body, cost, _ = edited(kinds_of(r["roles"], r["faults"]), r["roles"], r["texts"], r["enter"], r["leave"])
                f = _facts(r["turns"], r["roles"], r["faults"])
                row = {"key": r["key"], "conv_id": r["conv_id"], "block": r["block"], "leave": r["leave"], "cost": cost, "audit": audit, "repaired": body,
                       **{k: f[k] for k in fields}}
                yield _batch(_PART, [tuple(row[n] for n in names)])

    parts = blocks.join(states.withColumnRenamed("node", "block"), ["key", "block"])
    return parts.mapInArrow(solve, _PART)


def _joined(parts: DataFrame) -> DataFrame:
    """One result row per conversation from its blocks in order; the repaired rows are hashed as they pass and not held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None

        def row() -> pa.RecordBatch:
            state = now["state"]
            for line in closing(state):
                write(line)
            gaps = now["high"] - now["low"] + 1 - now["turns"] if now["turns"] else 0
            return _batch(_RESULT, [(now["conv_id"], gaps, now["blank"], now["duplicate"], now["truncated"], now["illegal"],
                                     now["cost"] + FINISH[state][0], "".join(now["audit"]) + FINISH[state][1], now["digest"].hexdigest())])

        def write(text: str) -> None:
            if text:
                now["digest"].update(("\n" if now["begun"] else "").encode() + text.encode())
                now["begun"] = True

        for batch in batches:
            for r in batch.to_pylist():
                if now is None or now["key"] != r["key"]:
                    if now is not None:
                        yield row()
                    now = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost", "turns"), 0) | {
                        "key": r["key"], "conv_id": r["conv_id"], "low": None, "high": None, "last": None, "audit": [],
                        "digest": hashlib.sha256(), "begun": False}
                for k in ("blank", "duplicate", "truncated", "illegal", "cost"):
                    now[k] += r[k]
                if r["n"]:
                    if now["last"] is not None and now["last"] + r["first"] not in LEGAL:
                        now["illegal"] += 1
                    now["last"] = r["last"]
                if r["turns"]:
                    now["turns"] += r["turns"] - (now["high"] == r["low"])
                    now["low"] = r["low"] if now["low"] is None else now["low"]
                    now["high"] = r["high"]
                now["state"] = r["leave"]
                now["audit"].append(r["audit"])
                write(r["repaired"])
        if now is not None:
            yield row()

    return parts.repartition("key").sortWithinPartitions("key", "block").mapInArrow(run, _RESULT)
