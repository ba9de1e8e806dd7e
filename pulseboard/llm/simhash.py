"""SimHash near-duplicates by multi-index hashing.

Fingerprints are cut into ``segments`` parts. Of two fingerprints within ``radius`` bits, at least
one part differs by no more than a small number of bits (pigeonhole). Each part has a table keyed
by its value; every fingerprint enumerates the small Hamming ball around its own part, fetches the
matches of that table, and the complete distance is verified. Components of the links are found by
passing the smallest label along links and jumping to the label's label.

Work is on distinct fingerprints, so exact copies and equal fingerprints never form pairs. Table
entries with more than ``light`` members are not joined: their members are dealt over tiles of at
most ``tile`` members, each tile pair checks all its distances and returns only a spanning
forest of the links, so the rows stay linear in the tile and nothing is capped.

Joins of fingerprints are sort merge joins by hint. Spark counts the rows behind an explode as those before it, so
left to itself it takes the probes, 66 rows of each fingerprint, for a table small enough to broadcast.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from pyspark.sql.window import Window

from pulseboard.llm.arrow_text import bounded_batches, free_name, pieces
from pulseboard.session import stage

SHINGLE = 3
SEED = 42
BITS = 64


def text_fingerprints(column: pa.Array) -> np.ndarray:
    """One unsigned 64-bit fingerprint per text (int64 view); see ``fingerprints``."""
    import xxhash

    h64 = xxhash.xxh64_intdigest
    out = np.zeros(len(column), np.uint64)
    for first, end, raw, offsets in pieces(column):
        data = raw.tobytes().translate(_LOWER)
        for row in range(first, end):
            words = data[offsets[row - first]:offsets[row - first + 1]].split()
            if not words:
                continue
            flat = b" ".join(words)
            lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
            stops = np.cumsum(lengths) - 1
            starts = stops + 1 - lengths
            if len(words) < SHINGLE:
                hashes = np.array([h64(flat, SEED)], np.uint64)
            else:
                hashes = np.fromiter(
                    (h64(flat[s:e], SEED) for s, e in
                     zip(starts[:1 - SHINGLE].tolist(), stops[SHINGLE - 1:].tolist(), strict=True)),
                    np.uint64, len(words) - SHINGLE + 1)
            out[row] = _majority(hashes)
    return out.view(np.int64)


#: bytes.split() with no argument splits at exactly space and \x09-\x0D.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _majority(hashes: np.ndarray) -> np.uint64:
    """The bits set in over half the hashes."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65_536):
        block = hashes[at:at + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes)).view(">u8")[0]


@F.arrow_udf(LongType())
def fingerprint(text: pa.Array) -> pa.Array:
    """Fingerprint of each text as the signed 64-bit value with the same bits."""
    return pa.array(text_fingerprints(text))


def ball(bits: int, radius: int) -> list[int]:
    """XOR masks of all changes of at most ``radius`` of ``bits`` bits."""
    return [sum(1 << i for i in at) for r in range(radius + 1) for at in combinations(range(bits), r)]


def plan(segments: int, radius: int) -> list[tuple[int, int, int]]:
    """Shift, bits and search radius of each part.

    With r' = radius // segments and a = radius % segments, a link has either one of the first a + 1
    parts within r' or one of the others within r' - 1; else the parts would differ by more in sum.
    """
    if segments < 2:
        raise ValueError("two segments at least")
    near, extra = divmod(radius, segments)
    out, low = [], 0
    for k in range(segments):
        bits = BITS * (k + 1) // segments - BITS * k // segments
        reach = near if k <= extra else near - 1
        if reach >= 0:
            out.append((low, bits, reach))
        low += bits
    return out


def links(prints: DataFrame, radius: int = 3, segments: int = 2, light: int = 16, tile: int = 2048) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) within ``radius`` bits.

    Every link is found; of the links inside a crowded table entry a spanning forest is returned,
    which joins the same fingerprints.
    """
    parts = plan(segments, radius)
    value = [F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << bits) - 1)) for low, bits, _ in parts]
    table = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("part"), v.alias("key")) for k, v in enumerate(value)])).alias("e")).select("fp", "e.*")
    crowded = table.groupBy("part", "key").count().where(F.col("count") > light)
    probes = prints.select("fp", F.explode(F.concat(*[
        _around(k, value[k], ball(bits, reach)) for k, (_, bits, reach) in enumerate(parts)])).alias("e")).select("fp", "e.*")
    sizes = crowded.select("part", "key", F.ceil(F.col("count") / tile).cast("int").alias("tiles"))
    members = table.join(sizes.hint("merge"), ["part", "key"], "left")
    found = (probes.alias("p").join(members.where("tiles is null").alias("t").hint("merge"), ["part", "key"])
             .where((F.col("p.fp") != F.col("t.fp"))
                    & (F.bit_count(F.col("p.fp").bitwiseXOR(F.col("t.fp"))) <= radius))
             .select(F.least("p.fp", "t.fp").alias("a"), F.greatest("p.fp", "t.fp").alias("b")))
    # Crowded entries: both sides dealt over tiles by hash; each pair of tiles is a task's group.
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    left = (probes.join(sizes.hint("merge"), ["part", "key"]).withColumn("i", own).withColumn("j", every)
            .select("part", "key", "i", "j", "fp", F.lit(True).alias("probe")))
    right = (members.where("tiles is not null").withColumn("j", own).withColumn("i", every)
             .select("part", "key", "i", "j", "fp", F.lit(False).alias("probe")))

    def forest(group: pd.DataFrame) -> pd.DataFrame:
        return _forest(group["fp"].to_numpy(np.int64), group["probe"].to_numpy(bool), radius)

    dense = left.unionByName(right).groupBy("part", "key", "i", "j").applyInPandas(forest, "a bigint, b bigint")
    return found.unionByName(dense).distinct()


def _around(part: int, value: Column, masks: list[int]) -> Column:
    """The keys of a part's ball around ``value``."""
    changes = F.array(*[F.lit(m).cast("long") for m in masks])
    return F.transform(changes, lambda m: F.struct(F.lit(part).alias("part"), value.bitwiseXOR(m).alias("key")))


def _forest(fp: np.ndarray, probe: np.ndarray, radius: int) -> pd.DataFrame:
    """Spanning forest of the links from probes to table members of one pair of tiles."""
    nodes, at = np.unique(fp.view(np.uint64), return_inverse=True)
    is_probe = np.zeros(len(nodes), bool)
    is_member = np.zeros(len(nodes), bool)
    is_probe[at[probe]] = True
    is_member[at[~probe]] = True
    open_ = np.ones(len(nodes), bool)
    a, b = [], []
    for root in range(len(nodes)):
        if not open_[root]:
            continue
        open_[root] = False
        stack = [root]
        while stack:
            x = stack.pop()
            rest = np.flatnonzero(open_ & ((is_member & is_probe[x]) | (is_probe & is_member[x])))
            near = rest[np.bitwise_count(nodes[rest] ^ nodes[x]) <= radius]
            open_[near] = False
            a += [nodes[x]] * len(near)
            b += nodes[near].tolist()
            stack += near.tolist()
    x, y = np.array(a, np.uint64).view(np.int64), np.array(b, np.uint64).view(np.int64)
    return pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y)})


def components(nodes: DataFrame, edges: DataFrame, rounds: int = 200) -> DataFrame:
    """(fp, label): the smallest ``label`` reachable over ``edges`` (a, b) from nodes (fp, label).

    Only nodes that have a link take part in the rounds. Each round takes the smallest label of the
    neighbours, then goes on from that label's own label; both are grouped minima, combined before the
    shuffle. Rounds end when no label changed.
    """
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    linked = both.select(F.col("a").alias("fp")).distinct()
    state = stage(nodes.join(linked.hint("merge"), "fp").select("fp", "label", F.col("label").alias("was")), "labels")
    owner = stage(state.select(F.col("label").alias("own"), "fp"), "owners")
    for _ in range(rounds):
        near = (both.join(state.select(F.col("fp").alias("b"), "label").hint("merge"), "b")
                .groupBy(F.col("a").alias("fp")).agg(F.min("label").alias("near")))
        lower = state.join(near.hint("merge"), "fp").select("fp", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        lower = stage(lower, "lower")
        # The label names a node by its own label; take that node's label over.
        jump = owner.join(lower.hint("merge"), "fp").select("own", F.col("label").alias("jump")).hint("merge")
        state = stage(lower.join(jump, lower["label"] == jump["own"], "left")
                      .select("fp", F.least("label", F.coalesce("jump", "label")).alias("label"), "was"), "labels")
        if state.where("label < was").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    alone = nodes.join(linked.hint("merge"), "fp", "left_anti").select("fp", "label")
    return alone.unionByName(state.select("fp", "label"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    radius: int = 3, segments: int = 2) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``.

    Null and empty texts have fingerprint zero and are linked like any other. A null id stands
    for itself: its row gets the smallest id reachable. Rows repeated under one id each get a row. A
    component without any id has a null ``component_id``. An empty table gives an empty result.
    """
    bounded_batches()
    marked = stage(docs.select(F.col(id_col).cast("long").alias("doc_id"), fingerprint(F.col(text_col)).alias("fp")), "prints")
    # Ids of nodes without an id sort last and are taken away in the end.
    nodes = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("label")), "nodes")
    known = nodes.where("label is not null")
    if not nodes.where("label is null").isEmpty():
        return _with_nameless(marked, nodes, radius, segments)
    found = links(known.select("fp"), radius, segments)
    parts = components(known, found)
    return _result(marked, parts)


def _with_nameless(marked: DataFrame, nodes: DataFrame, radius: int, segments: int) -> DataFrame:
    """As the main path, with fingerprints themselves as labels, named by their smallest id afterwards."""
    found = links(nodes.select("fp"), radius, segments)
    parts = components(nodes.select("fp", F.col("fp").alias("label")), found)
    named = parts.join(nodes.select("fp", F.col("label").alias("id")).hint("merge"), "fp")
    smallest = named.groupBy("label").agg(F.min("id").alias("smallest"))
    return _result(marked, named.join(smallest.hint("merge"), "label").select("fp", F.col("smallest").alias("label")))


def _result(marked: DataFrame, parts: DataFrame) -> DataFrame:
    return (marked.join(parts.hint("merge"), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.col("label").alias("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` without the others of their component: the smallest id stays.

    Rows without an id stay as they are. Rows that share an id are judged by their own texts. Of rows repeated with the same id and text one
    stays, that with the least hash of all its columns.
    """
    bounded_batches()
    key, look, gone, rows, copy = (free_name(docs.columns, n) for n in ("dup_id", "dup_look", "dup_gone", "dup_rows", "dup_copy"))
    marked = stage(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias(look),
                               fingerprint(F.col(text_col)).alias("fp")), "prints")
    nodes = stage(marked.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("label")), "nodes")
    # Fingerprints of rows without an id still link others; they never are the smallest.
    nameless = marked.where("doc_id is null").select("fp").distinct().join(nodes.select("fp").hint("merge"), "fp", "left_anti")
    if nameless.isEmpty():
        parts = components(nodes, links(nodes.select("fp")))
    else:
        every = stage(nodes.select("fp").unionByName(nameless), "every")
        parts = components(every.select("fp", F.col("fp").alias("label")), links(every))
        named = parts.join(nodes.select("fp", F.col("label").alias("id")).hint("merge"), "fp")
        parts = named.join(named.groupBy("label").agg(F.min("id").alias("smallest")).hint("merge"), "label").select("fp", F.col("smallest").alias("label"))
    flags = (marked.where("doc_id is not null").join(parts.hint("merge"), "fp").groupBy(F.col("doc_id").alias(key), look)
             .agg(F.max(F.col("doc_id") != F.col("label")).alias(gone), F.count("*").alias(rows))
             .where(F.col(gone) | (F.col(rows) > 1)))
    same = (docs[id_col].cast("long") == flags[key]) & (F.xxhash64(docs[text_col]) == flags[look])
    kept = docs.join(flags, same, "left").where(~F.coalesce(F.col(gone), F.lit(False)))
    order = Window.partitionBy(key, look).orderBy(F.xxhash64(*[F.col(c) for c in docs.columns]))
    once = kept.where(F.col(rows).isNotNull()).withColumn(copy, F.row_number().over(order)).where(F.col(copy) == 1)
    return kept.where(F.col(rows).isNull()).unionByName(once.drop(copy)).select(*docs.columns)
