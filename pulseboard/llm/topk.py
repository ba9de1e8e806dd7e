"""Exact top-k search by multi-resolution segment statistics.

Vectors are cut into segments, at each resolution twice as many. A segment's mean m and deviation s (population) bound the
squared distance of two vectors from below by the sum of n * ((m - m')^2 + (s - s')^2) over the segments of n
components; for the inner product this is n * (m m' + s s') from above. Candidates are dropped coarse to fine as soon as the
bound cannot reach a query's k-th best score so far; survivors get the exact integer score.

Queries and candidates are stored in blocks of bounded size. Every query block meets every candidate block once, in a
task per query block and group of candidate blocks that keeps the k best per query; the groups' best are merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulseboard.session import stage

SCALE = 64
#: Bytes of candidate vectors that a task holds, on average.
GROUP_BYTES = 64_000_000
#: Candidates that are compared at once, and below which share of pairs left they are taken one by one.
FIRST_TILE, TILE, FEW = 64, 1_024, 0.03


def usable(vector: Column) -> Column:
    """Vectors that are not null, not empty, and hold neither null nor non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def _floor(x: Column) -> Column:
    """Floor as a double; beyond 2^52 a double has no fraction (and ``floor`` gives a long)."""
    return F.when(F.abs(x) < float(2**52), F.floor(x).cast("double")).otherwise(x)


def resolutions(dim: int) -> list[np.ndarray]:
    """Segment starts per resolution, coarse to fine: 1, 2, 4, ... segments, up to one per four components."""
    counts, n = [], 1
    while n == 1 or n * 4 <= dim:
        counts.append(n)
        n *= 2
    return [np.unique(np.linspace(0, dim, c + 1).astype(int)[:-1]) for c in counts]


def profile(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Rows whose inner products bound those of ``x`` from above: sqrt(n) * mean and sqrt(n) * deviation per segment."""
    n = np.diff([*starts, x.shape[1]])
    total = np.add.reduceat(x, starts, axis=1)
    square = np.add.reduceat(x * x, starts, axis=1)
    mean = total / n
    deviation = np.sqrt(np.maximum(square / n - mean * mean, 0))
    return np.concatenate([mean, deviation], axis=1) * np.sqrt(np.concatenate([n, n]))


class Best:
    """The k best (score, id) per query so far: higher scores first, ties to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.rows: list[list[tuple[int, int]]] = [[] for _ in range(queries)]
        self.floor = np.full(queries, -np.inf)

    def add(self, query: np.ndarray, score: np.ndarray, vec: np.ndarray) -> None:
        if not len(query):
            return
        order = (np.lexsort((vec, -score, query)) if score.dtype != object
                 else np.array(sorted(range(len(query)), key=lambda n: (query[n], -score[n], vec[n]))))
        query, score, vec = query[order], score[order], vec[order]
        found, first = np.unique(query, return_index=True)
        for q, lo, hi in zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(query)], strict=True):
            hi = min(hi, lo + self.k)
            rows = self.rows[q] + list(zip((-score[lo:hi]).tolist(), vec[lo:hi].tolist(), strict=True))
            rows.sort()
            self.rows[q] = rows[:self.k]
            if len(self.rows[q]) == self.k:
                self.floor[q] = -self.rows[q][-1][0]


def _exact(x: np.ndarray, most: float) -> np.ndarray:
    """Components in numbers that hold every partial sum of a product of up to ``most``: doubles, 64-bit or Python's integers."""
    if most < 2.0**53:
        return x
    return x.astype(np.int64) if most < 2.0**63 else np.array([[int(c) for c in row] for row in x], object)


def _lengths(x: np.ndarray) -> np.ndarray:
    """Euclidean lengths; components near the largest double do not overflow on the way."""
    unit = np.maximum(np.abs(x).max(axis=1, initial=0), 1)
    return unit * np.sqrt(np.einsum("ij,ij->i", x / unit[:, None], x / unit[:, None]))


def _products(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the rows ``a[i]`` and ``b[j]``, some at a time."""
    out = np.empty(len(i), a.dtype)
    for cut in range(0, len(i), 50_000):
        part = slice(cut, cut + 50_000)
        out[part] = (a[i[part]] * b[j[part]]).sum(axis=1) if a.dtype == object else np.einsum("ij,ij->i", a[i[part]], b[j[part]])
    return out


def search_block(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, best: Best) -> int:
    """Take the vectors of one candidate block into ``best``; returns how many exact scores were needed."""
    exact = 0
    levels = resolutions(queries.shape[1])
    ours = [profile(queries, s) for s in levels]
    reach, their_reach = _lengths(queries), _lengths(vectors)
    # Long vectors first raise the floors early; the first tile is small, as nothing can be dropped before the floors stand.
    order = np.argsort(-their_reach, kind="stable")
    starts = [0, *range(FIRST_TILE, len(order), TILE)]
    for at, end in zip(starts, [*starts[1:], len(order)], strict=True):
        part = order[at:end]
        # No partial sum of a product goes beyond the product of the lengths. Bounds are doubles and err by a small share of it.
        most = reach * their_reach[part[0]]
        floor = best.floor - 1e-6 * (1 + most)
        alive = query_ids[:, None] != ids[part][None, :]
        q = c = None
        for mine, starts_of in zip(ours, levels, strict=True):
            their = profile(vectors[part], starts_of)
            if q is None:
                alive &= ~(mine @ their.T < floor[:, None])
                if np.count_nonzero(alive) < FEW * alive.size:
                    q, c = np.nonzero(alive)
            else:
                keep = ~(_products(mine, their, q, c) < floor[q])
                q, c = q[keep], c[keep]
        # Survivors: pair by pair where few are left, else from one product of the tile.
        widest = most.max(initial=0) * 1.001
        ask, answer = _exact(queries, widest), _exact(vectors[part], widest)
        if q is None:
            exact += np.count_nonzero(alive)
            table = ask @ answer.T
            q, c = np.nonzero(alive & (table >= floor[:, None]))
            score = table[q, c]
        else:
            exact += len(q)
            score = _products(ask, answer, q, c)
            keep = score >= floor[q]
            q, c, score = q[keep], c[keep], score[keep]
        best.add(q, score.astype(np.int64) if score.dtype != object else score, ids[part[c]])
    return exact


def _packed(dim: int, part: pd.DataFrame) -> dict:
    return {"dim": [dim], "ids": [part["vec_id"].to_numpy(np.int64).tobytes()],
            "data": [np.stack(part["v"].to_numpy()).astype(np.float64).tobytes()]}


def candidate_blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """(block, dim, ids, data): vectors as packed blocks of at most ``rows``, numbered and made in the tasks without a shuffle."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = TaskContext.get().partitionId() << 32
        for frame in frames:
            for dim, own in frame.groupby("dim", sort=True):
                for at in range(0, len(own), rows):
                    yield pd.DataFrame({"block": [block]} | _packed(int(dim), own.iloc[at:at + rows]))
                    block += 1

    return vectors.mapInPandas(pack, "block long, dim int, ids binary, data binary")


def query_blocks(queries: DataFrame, count: int) -> DataFrame:
    """(qb, dim, ids, data): queries dealt over ``count`` blocks by their id."""

    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"qb": [key[0]]} | _packed(int(key[1]), frame))

    return (queries.withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int"))
            .groupBy("qb", "dim").applyInPandas(pack, "qb int, dim int, ids binary, data binary"))


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
           query_rows: int = 2_048, block_rows: int = 4_096, groups: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest inner products of each query row with all other rows.

    Components are taken as floor(64 x). Vectors that are null, empty, or hold null or non-finite components, and rows
    without an id, take no part. Vectors of different length are not compared. A query is not compared with rows of its own id;
    queries repeated under one id are one, with the smallest of their vectors. Scores are exact integers at any size of the components;
    one among a task's best that a long cannot hold ends the search with an ``OverflowError``. Fewer than ``k`` candidates are all given; an empty table gives no rows.
    The number of candidate groups, if not given, grows with the candidates, so that a group stays at about ``GROUP_BYTES``.
    """
    spark = vectors.sparkSession
    whole = (vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
             .select(F.col(id_col).cast("long").alias("vec_id"),
                     F.transform(vector_col, lambda x: _floor(x.cast("double") * SCALE)).alias("v"), is_query.alias("q"))
             .withColumn("dim", F.size("v")))
    candidates = stage(candidate_blocks(whole.select("vec_id", "v", "dim"), block_rows), "candidates")
    asked = whole.where("q").groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    asked = stage(asked, "queries")
    count = -(-asked.count() // query_rows) or 1
    held = candidates.agg(F.sum(F.octet_length("data").cast("long"))).first()[0] or 0
    groups = groups or max(spark.sparkContext.defaultParallelism, -(-held // GROUP_BYTES))
    asks = (query_blocks(asked, count).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
            .withColumn("ask", F.lit(True)))
    own = (candidates.withColumn("g", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int")).drop("block")
           .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))).withColumn("ask", F.lit(False)))

    def best_of(frame: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for dim, ids, data in frame.loc[frame["ask"], ["dim", "ids", "data"]].itertuples(index=False):
            query_ids = np.frombuffer(ids, np.int64)
            best = Best(len(query_ids), k)
            queries = np.frombuffer(data, np.float64).reshape(len(query_ids), dim)
            same = frame.loc[~frame["ask"] & (frame["dim"] == dim), ["ids", "data"]]
            for their_ids, their_data in same.itertuples(index=False):
                numbers = np.frombuffer(their_ids, np.int64)
                search_block(queries, query_ids, np.frombuffer(their_data, np.float64).reshape(len(numbers), dim), numbers, best)
            rows += [(int(q), -s, v) for q, found in zip(query_ids, best.rows, strict=True) for s, v in found]
        if any(abs(s) >= 2**63 for _, s, _ in rows):
            raise OverflowError("an inner product is beyond a long")
        return pd.DataFrame(rows, columns=["query_id", "score", "vec_id"]).astype("int64")

    near = own.unionByName(asks).groupBy("qb", "g").applyInPandas(best_of, "query_id long, score long, vec_id long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
