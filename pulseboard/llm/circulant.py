"""MinHash near-duplicates from two permutations, one of them circularly shifted.

A shingle gets a slot by the first permutation. Coordinate k of a signature is the least value that
the second permutation, shifted by k places around its circle of slots, gives to the text's slots.
So all coordinates of a slot lie side by side in one table, and a signature is the minimum of such
stretches. Bands of coordinates are buckets; texts that share a bucket are candidates, and links are
confirmed on the full shingle sets.

Work is on distinct sets, so copies never form pairs, and no bucket is turned into all its pairs:

1. Every member of a bucket is compared with the bucket's least member only (rows as many as
   members). The links that hold give components.
2. Buckets whose members are not all in one component then are left. Their members meet in groups,
   each group cut into tiles of bounded size; a pair of tiles searches the links that run between
   different components and gives out a spanning forest of them.

No bucket is cut or passed over.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from pulseboard.llm.arrow_text import bounded_batches, pieces
from pulseboard.llm.simhash import components
from pulseboard.session import stage

SHINGLE = 5
PERCENT = 85
#: Slots of the circle, far above the words of usual texts; where a text fills it, its buckets only hold more candidates.
SLOTS = 1 << 22
BANDS, ROWS = 42, 6
#: Shingles of a tile.
TILE = 1_000_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def mixed(x: np.ndarray, turn: int = 0) -> np.ndarray:
    """A permutation of the unsigned 64-bit numbers, another one for each ``turn``."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (turn + 1)) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def circle(slots: int, coordinates: int) -> np.ndarray:
    """Row i: the values of slot i under the second permutation shifted by 0, 1, ... places."""
    order = np.argsort(mixed(np.arange(slots, dtype=np.uint64), 7), kind="stable")
    values = np.empty(slots, np.uint32)
    values[order] = np.arange(slots, dtype=np.uint32)
    around = np.concatenate([values, np.resize(values, coordinates)])
    return np.lib.stride_tricks.sliding_window_view(around, coordinates)[:slots]


def shingle_sets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes on end, and the bounds of the texts.

    ``raw`` holds the texts' bytes on end. A text of fewer words than a shingle has its whole sequence as one.
    """
    h64 = xxhash.xxh64_intdigest
    data = raw.tobytes().translate(_LOWER)
    words = [data[s:e].split() for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    count = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter(map(h64, chain.from_iterable(words)), np.uint64, int(count.sum()))
    start = np.cumsum(count) - count
    full = count >= SHINGLE
    # Shingles of the whole piece, then those that do not cross a text's end.
    if len(flat) >= SHINGLE:
        rolled = np.zeros(len(flat) - SHINGLE + 1, np.uint64)
        for k in range(SHINGLE):
            rolled = mixed(rolled ^ flat[k:len(flat) - SHINGLE + 1 + k], k)
    else:
        rolled = np.zeros(0, np.uint64)
    n = np.where(full, count - SHINGLE + 1, 0)
    at = np.repeat(start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    values, owner = rolled[at], np.repeat(np.arange(len(count)), n)
    short = np.flatnonzero(~full & (count > 0))
    if len(short):
        values = np.concatenate([values, [np.uint64(h64(b" ".join(words[i]), len(words[i]))) for i in short.tolist()]]).astype(np.uint64)
        owner = np.concatenate([owner, short])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[first], owner[first]
    return values, np.searchsorted(owner, np.arange(len(count) + 1))


def signatures(values: np.ndarray, bounds: np.ndarray, coordinates: int, slots: int = SLOTS, block: int = 4096) -> np.ndarray:
    """Signature of each set; that of an empty set has the greatest number everywhere."""
    table = circle(slots, coordinates)
    place = (mixed(values, 3) % np.uint64(slots)).astype(np.int64)
    out = np.full((len(bounds) - 1, coordinates), np.iinfo(np.uint32).max, np.uint32)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    for at in range(0, len(place), block):
        here = owner[at:at + block]
        starts = np.flatnonzero(np.concatenate([[True], here[1:] != here[:-1]]))
        least = np.minimum.reduceat(table[place[at:at + block]], starts, axis=0)
        out[here[starts]] = np.minimum(out[here[starts]], least)
    return out


def bands(signature: np.ndarray, n_bands: int, rows: int) -> np.ndarray:
    """Key of each band of each signature; keys of different bands differ."""
    parts = signature.reshape(len(signature), n_bands, rows).astype(np.uint64)
    key = np.broadcast_to(mixed(np.arange(n_bands, dtype=np.uint64), 11), parts.shape[:2])
    for k in range(rows):
        key = mixed(key ^ parts[:, :, k], k)
    return key.view(np.int64)


def _marks(n_bands: int, rows: int, slots: int):
    """Texts to the size of their sets, a 128-bit key of the set and the keys of its bands."""
    kind = pa.struct([("n", pa.int64()), ("key", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def mark(text: pa.Array) -> pa.Array:
        sizes, keys, found = [], [], []
        for _, _, raw, offsets in pieces(text):
            values, bounds = shingle_sets(raw, offsets)
            sizes.append(np.diff(bounds))
            data, at = values.tobytes(), (8 * bounds).tolist()
            keys += [xxhash.xxh3_128_digest(data[s:e]) for s, e in zip(at[:-1], at[1:], strict=True)]
            found.append(bands(signatures(values, bounds, n_bands * rows, slots), n_bands, rows))
        rows_ = np.concatenate(found) if found else np.zeros((0, n_bands), np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows_) + 1, dtype=np.int32) * n_bands), pa.array(rows_.ravel()))
        n = pa.array(np.concatenate(sizes) if sizes else np.zeros(0, np.int64), pa.int64())
        return pa.StructArray.from_arrays([n, pa.array(keys, pa.binary()), lists], fields=list(kind))

    return F.arrow_udf(mark, "n bigint, key binary, bands array<bigint>")


@F.arrow_udf(ArrayType(LongType()))
def shingles(text: pa.Array) -> pa.Array:
    """The distinct shingles of each text as sorted 64-bit hashes."""
    values, sizes = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for _, _, raw, offsets in pieces(text):
        found, bounds = shingle_sets(raw, offsets)
        values.append(found)
        sizes.append(np.diff(bounds))
    at = np.cumsum(np.concatenate(sizes)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(values).view(np.int64)))


def _alike(common: Column, n: Column, m: Column, percent: int) -> Column:
    return 100 * common >= percent * (n + m - common)


def _forest(table: pa.Table, percent: int) -> pa.Table:
    """Spanning forest of the links between members of different components in a pair of tiles."""
    node = table.column("node").to_numpy()
    node, first = np.unique(node, return_index=True)
    part = table.column("part").to_numpy()[first]
    lists = table.column("shingles").combine_chunks()
    sets = [lists[i].values.to_numpy() for i in first.tolist()]
    size = np.array([len(s) for s in sets], np.int64)
    _, group = np.unique(part, return_inverse=True)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    owner, flat = np.repeat(np.arange(len(sets)), size)[order], flat[order]
    parent = np.arange(group.max() + 1)
    left, right = [], []

    def top(g: int) -> int:
        while parent[g] != g:
            parent[g] = parent[parent[g]]
            g = parent[g]
        return g

    # The largest component needs no search of its own: every link to it is found from its other end.
    largest = int(np.bincount(group).argmax())
    for i in np.flatnonzero(group != largest).tolist():
        low, high = np.searchsorted(flat, sets[i], "left"), np.searchsorted(flat, sets[i], "right")
        n = high - low
        hits = owner[np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        common = np.bincount(hits, minlength=len(sets))
        linked = np.flatnonzero(100 * common >= percent * (size + size[i] - common))
        for j in linked.tolist():
            a, b = top(int(group[i])), top(int(group[j]))
            if a != b:
                parent[a] = b
                left.append(int(node[i]))
                right.append(int(node[j]))
    return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})


def _labelled(nodes: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """(node, part) for every node: the least node of its component over ``links`` (a, b)."""
    found = components(nodes.select(F.col("node").alias("fp"), F.col("node").alias("label")), links)
    return stage(found.select(F.col("fp").alias("node"), F.col("label").alias("part")), name)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                    n_bands: int = BANDS, rows: int = ROWS, slots: int = SLOTS, tile: int = TILE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    Texts whose sets have a Jaccard similarity of ``percent`` hundredths or more are linked; ``component_id`` is the smallest id
    that can be reached. Links are confirmed on 64-bit hashes of the shingles. At a similarity of 0.85 a pair shares no
    bucket with a probability of 2 in 10^9 (42 bands of 6 coordinates).

    Null and empty texts and texts of white space have no shingles and are linked with nothing, equal ones neither.
    Rows repeated under one id each get a row. A row without an id takes part; its ``component_id`` is the smallest id
    reachable, null if there is none, and it is ``kept`` only in that case. Other columns are not read. An empty table gives an empty result.
    """
    bounded_batches()
    mark = _marks(n_bands, rows, slots)
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    marked = stage(read.select("doc_id", F.xxhash64("text").alias("look"), mark("text").alias("m")).select("doc_id", "look", "m.*"), "marks")
    # One node per distinct set; its text is read from the row with the smallest id.
    nodes = (marked.where("n > 0").groupBy("key")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "look")).alias("row"),
                  F.first("n").alias("n"), F.first("bands").alias("bands")))
    nodes = stage(nodes.select(F.monotonically_increasing_id().alias("node"), "key", "row.doc_id", "row.look", "n", "bands"), "nodes")
    table = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    buckets = (table.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("hub"), F.min_by("n", "node").alias("hub_n"))
               .where("members > 1"))
    members = stage(table.join(buckets, "bucket").select(
        "bucket", "members", "node", "n", "hub", "hub_n"), "members")
    sets = _sets(read, nodes, members.select("node").distinct())
    pairs = members.where("node != hub").where(_alike(F.least("n", "hub_n"), F.col("n"), F.col("hub_n"), percent)).select("hub", "node").distinct()
    links = stage(
        pairs.join(sets, "node").withColumnRenamed("shingles", "own")
        .join(sets.select(F.col("node").alias("hub"), F.col("shingles").alias("other")), "hub")
        .where(_alike(F.size(F.array_intersect("own", "other")), F.size("own"), F.size("other"), percent))
        .select(F.col("hub").alias("a"), F.col("node").alias("b")), "links")
    # One link of each node is enough to begin with; what the others add are links between components.
    parts = _labelled(nodes, links.groupBy("b").agg(F.min("a").alias("a")), "parts")
    found = links.unionByName(_between(members, parts, sets, percent, tile))
    joined = (found.join(parts.select(F.col("node").alias("a"), F.col("part").alias("x")), "a")
              .join(parts.select(F.col("node").alias("b"), F.col("part").alias("y")), "b"))
    across = stage(joined.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "across")
    if not across.isEmpty():
        tops = _labelled(parts.select(F.col("part").alias("node")).distinct(), across, "tops")
        parts = parts.join(tops.select(F.col("node").alias("part"), F.col("part").alias("top")), "part").select("node", F.col("top").alias("part"))
    named = nodes.select("node", "key", "doc_id").join(parts, "node")
    ids = named.groupBy("part").agg(F.min("doc_id").alias("component_id"))
    groups = named.join(ids, "part").select("key", "component_id")
    out = marked.drop("bands", "look").where("n > 0").join(groups, "key").drop("key").unionByName(
        marked.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _sets(read: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the wanted nodes, from the text of one row each."""
    rows = nodes.join(wanted, "node").select("node", F.col("doc_id").alias("id"), "look")
    looked = read.select("doc_id", "text", F.xxhash64("text").alias("look"))
    found = looked.join(rows, (looked["look"] == rows["look"]) & looked["doc_id"].eqNullSafe(rows["id"])).select("node", "text")
    # Rows may be repeated; one of each text is enough.
    once = found.groupBy("node").agg(F.first("text").alias("text"))
    return stage(once.select("node", shingles("text").alias("shingles")), "sets")


def _between(members: DataFrame, parts: DataFrame, sets: DataFrame, percent: int, tile: int) -> DataFrame:
    """Links (a, b) between different components, from the buckets that hold several."""
    labelled = members.where("members > 2").join(parts, "node")
    several = (labelled.groupBy("bucket").agg(F.min("part").alias("least"), F.max("part").alias("most"))
               .where("least < most").select("bucket", "least"))
    inside = stage(labelled.join(several, "bucket").select("node", "part", "least").distinct(), "inside")
    # Components that meet in a bucket are one group.
    meet = inside.where("part != least").select(F.col("least").alias("a"), F.col("part").alias("b")).distinct()
    group = _labelled(inside.select(F.col("part").alias("node")).distinct(), meet, "groups")
    here = (inside.select("node", "part").distinct()
            .join(group.select(F.col("node").alias("part"), F.col("part").alias("grp")), "part").join(sets, "node"))
    here = stage(here, "grouped")
    sizes = here.groupBy("grp").agg(F.ceil(F.sum(F.size("shingles")) / tile).cast("int").alias("tiles"))
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    dealt = here.join(sizes, "grp").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).where(
        "own != other or tiles = 1")
    tiled = dealt.select("grp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "part", "shingles")
    # A pair of tiles is searched inside either of them too.
    return tiled.groupBy("grp", "i", "j").applyInArrow(lambda key, table: _forest(table, percent), "a bigint, b bigint")
