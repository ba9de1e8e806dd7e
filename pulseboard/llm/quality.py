"""Document quality by Bradley-Terry pairwise ranking.

Preference pairs put a document labelled good over one labelled bad. A linear score is learned by logistic loss on the
feature differences of the pairs. All labelled documents outside the held-out fold are compared, whole: they are dealt
into blocks by a hash, and in its block every good one meets every bad one. The quantile of all training scores that
leaves the labelled share of good documents above it is the decision point; scores are put on 0 to 1 so that this point
is 0.7. The features, the sums of each Newton step and the quantile are made by Spark; the driver sees sums only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseboard.llm.arrow_text import bounded_batches, pieces, runs
from pulseboard.llm.training_rows import held_out, labelled_ids
from pulseboard.operators.ordered import global_row_number
from pulseboard.session import stage

BLOCK = 1_024  # documents of the commoner class in a block of comparisons
OPPONENTS = 32  # documents of the rarer class in a block at least, if there are so many
RIDGE = 5e-4  # times the number of pairs
DECISION = 0.7

_CLASS = np.zeros(256, np.int64)  # 0 other control, then one class per kind of byte
_CLASS[32], _CLASS[9:14] = 1, 1
_CLASS[10] = 2
_CLASS[48:58] = 3
_CLASS[65:91] = 4
_CLASS[97:123] = 5
_CLASS[128:] = 6
_CLASS[[33, 63]] = 7
_CLASS[[44, 46, 58, 59]] = 8
_CLASS[[34, 39, 40, 41, 45]] = 9
_CLASS[[35, 36, 37, 38, 42, 43, 47, 60, 61, 62, 64, 91, 92, 93, 94, 95, 96, 123, 124, 125, 126]] = 10
CLASSES = 11
FEATURES = 2 * CLASSES + 15


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per text: shares of byte classes, word and line statistics, repetition. Empty texts are all zeros."""
    n = len(offsets) - 1
    out = np.zeros((n, FEATURES))
    size = np.diff(offsets)
    kinds = _CLASS[raw]
    text = np.repeat(np.arange(n), size)
    shares = np.bincount(text * CLASSES + kinds, minlength=n * CLASSES).reshape(n, CLASSES) / np.maximum(size, 1)[:, None]
    out[:, :CLASSES] = shares
    out[:, CLASSES:2 * CLASSES] = np.sqrt(shares)
    at = 2 * CLASSES
    out[:, at] = np.log1p(size)
    starts, ends, of = runs((kinds != 1) & (kinds != 2), offsets)
    words = np.bincount(of, minlength=n)
    some = np.maximum(words, 1)
    length = ends - starts
    out[:, at + 1] = np.bincount(of, length, minlength=n) / some
    out[:, at + 2] = np.sqrt(np.maximum(np.bincount(of, length * length, minlength=n) / some - out[:, at + 1] ** 2, 0))
    out[:, at + 3] = np.log1p(words)
    odd = (kinds == 10) | (kinds == 7)
    if len(starts):
        last, first = kinds[ends - 1], kinds[starts]
        out[:, at + 4] = np.bincount(of, odd[ends - 1], minlength=n) / some
        out[:, at + 5] = np.bincount(of, last == 8, minlength=n) / some
        out[:, at + 6] = np.bincount(of, first == 4, minlength=n) / some
        out[:, at + 7] = np.bincount(of, length == 1, minlength=n) / some
        # Numbers of words by their first and last bytes and length: how often a word follows itself, and how many differ.
        key = ((length.astype(np.uint64) << np.uint64(48)) ^ _word_key(raw, starts, ends))
        same = np.zeros(len(starts))
        same[1:] = (key[1:] == key[:-1]) & (of[1:] == of[:-1])
        out[:, at + 8] = np.bincount(of, same, minlength=n) / some
        order = np.lexsort((key, of))
        fresh = np.ones(len(starts))
        fresh[1:] = (key[order][1:] != key[order][:-1]) | (of[order][1:] != of[order][:-1])
        out[:, at + 9] = np.bincount(of[order], fresh, minlength=n) / some
        out[:, at + 10] = out[:, at + 9] * np.log1p(words)
    lines_s, lines_e, line_of = runs(kinds != 2, offsets)
    lines = np.bincount(line_of, minlength=n)
    out[:, at + 11] = np.log1p(lines)
    if len(lines_s):
        line_key = _word_key(raw, lines_s, lines_e) ^ ((lines_e - lines_s).astype(np.uint64) << np.uint64(40))
        order = np.lexsort((line_key, line_of))
        fresh = np.ones(len(lines_s))
        fresh[1:] = (line_key[order][1:] != line_key[order][:-1]) | (line_of[order][1:] != line_of[order][:-1])
        out[:, at + 12] = np.bincount(line_of[order], fresh, minlength=n) / np.maximum(lines, 1)
        out[:, at + 13] = np.log1p(size / np.maximum(lines, 1))
    out[:, at + 14] = (words < 20)
    out[size == 0] = 0
    return out


def _word_key(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number per stretch of bytes from running sums; equal stretches have equal numbers."""
    mixed = (raw.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    plain = np.concatenate([[np.uint64(0)], np.cumsum(mixed, dtype=np.uint64)])
    return plain[ends] - plain[starts]


@dataclass
class Model:
    """Feature scale, weights, decision point and spread of the training scores."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    decision: float
    width: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -6, 6) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (self.strength(x) - self.decision) / self.width + math.log(DECISION / (1 - DECISION))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _matrix(rows: pa.Array) -> np.ndarray:
    """The feature rows kept as bytes."""
    return np.frombuffer(b"".join(rows.to_pylist()), np.float64).reshape(len(rows), FEATURES)


def training_features(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(h, label, x) of every labelled document outside the held-out fold: a hash of the id, and the features as bytes. Stored.

    The features are made before the join, so that no text is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(raw, offsets) for _, _, raw, offsets in pieces(batch.column("text"))]
            rows = [r.tobytes() for r in np.concatenate(x)] if x else []
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.binary())], ["doc_id", "x"])

    bounded_batches()
    kept = docs.select("doc_id", "text").where(F.col("text").isNotNull() & ~held_out(4, 2))
    out = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("x", T.BinaryType())])
    rows = kept.mapInArrow(run, out).join(labelled_ids(labels, "quality", 4, 2), "doc_id")
    return stage(rows.select(F.xxhash64("doc_id").alias("h"), "label", "x"), "quality-features")


def _added(df: DataFrame, sums, size: int) -> np.ndarray:
    """The sum of ``sums(batch)``, a vector of ``size``, over all batches: one vector a task, added up by the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            total += sums(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["v"])

    total = np.zeros(size)
    for row in df.mapInArrow(run, "v binary").collect():
        total += np.frombuffer(row["v"])
    return total


def _blocks(rows: DataFrame, good: int, bad: int) -> DataFrame:
    """(good, bad): the features of the two sides of each block as bytes. Stored.

    Each document of the commoner class is in one block; one of the rarer class in as many as give each block ``OPPONENTS`` of it.
    """
    blocks = -(-max(good, bad) // BLOCK)
    copies = min(blocks, -(-OPPONENTS * blocks // min(good, bad)))
    rare = 1 if good <= bad else 0
    at = F.expr(f"transform(sequence(0, if(label = {rare}, {copies}, 1) - 1), k -> cast(pmod(h + k * {max(1, blocks // copies)}, {blocks}) as int))")

    def together(table: pa.Table) -> pa.Table:
        label, x = table.column("label").to_numpy(), table.column("x").to_pylist()
        sides = [b"".join(v for v, y in zip(x, label, strict=True) if y == side) for side in (1, 0)]
        return pa.table({"good": pa.array(sides[:1], pa.binary()), "bad": pa.array(sides[1:], pa.binary())})

    dealt = rows.select(F.explode(at).alias("block"), "label", "x")
    return stage(dealt.groupBy("block").applyInArrow(together, "good binary, bad binary"), "quality-blocks")


def pair_sums(good: np.ndarray, bad: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Over all pairs of a good and a bad row: their number, the gradient of the logistic loss and its Hessian, in one vector."""
    n = len(w)
    gradient, hessian = np.zeros(n), np.zeros((n, n))
    for i in range(0, len(good), BLOCK):
        for j in range(0, len(bad), BLOCK):
            g, b = good[i:i + BLOCK], bad[j:j + BLOCK]
            p = 1 / (1 + np.exp(np.clip((g @ w)[:, None] - (b @ w)[None, :], -30, 30)))
            gradient += g.T @ p.sum(axis=1) - b.T @ p.sum(axis=0)
            p *= 1 - p
            cross = g.T @ p @ b
            hessian += (g * p.sum(axis=1)[:, None]).T @ g + (b * p.sum(axis=0)[:, None]).T @ b - cross - cross.T
    return np.concatenate([[len(good) * len(bad)], gradient, hessian.ravel()])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Model from all labelled documents outside the held-out fold. With one label only, or no rows, all documents score the share of good ones."""
    rows = training_features(docs, labels)

    def moments(batch):
        x = _matrix(batch.column("x"))
        return np.concatenate([[len(x), batch.column("label").to_numpy().sum()], x.sum(axis=0), (x * x).sum(axis=0)])

    sums = _added(rows, moments, 2 + 2 * FEATURES)
    n, good = int(sums[0]), int(sums[1])
    if good in (0, n):
        share = (good + 1) / (n + 2) if n else 0.5
        logit = math.log(share / (1 - share)) - math.log(DECISION / (1 - DECISION))
        return Model(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), -logit, 1.0)
    mean = sums[2:2 + FEATURES] / n
    spread = np.maximum(np.sqrt(np.maximum(sums[2 + FEATURES:] / n - mean ** 2, 0)), 1e-6)
    w = _weights(_blocks(rows, good, n - good), mean, spread)
    model = Model(mean, spread, w, 0.0, 1.0)

    def strengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(model.strength(_matrix(batch.column("x"))))], ["s"])

    scored = global_row_number(rows.mapInArrow(strengths, "s double"), ["s"])
    # The quantile that leaves the labelled share above, between the two scores around it.
    at = (1 - good / n) * (n - 1)
    low = math.floor(at)
    found = scored.agg(F.max(F.when(F.col("rownum") == low + 1, F.col("s"))), F.max(F.when(F.col("rownum") == min(low + 2, n), F.col("s"))),
                       F.stddev_pop("s")).first()
    model.decision = float(found[0] + (at - low) * (found[1] - found[0]))
    model.width = float(max(found[2] / 2, 1e-6))
    return model


def _weights(blocks: DataFrame, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Bradley-Terry weights by Newton steps of the logistic loss on differences, with a ridge."""
    w = np.zeros(FEATURES)
    for _ in range(40):
        def step_sums(batch, w=w):
            total = np.zeros(1 + FEATURES + FEATURES ** 2)
            for good, bad in zip(batch.column("good").to_pylist(), batch.column("bad").to_pylist(), strict=True):
                sides = [np.clip((np.frombuffer(x).reshape(-1, FEATURES) - mean) / spread, -6, 6) for x in (good, bad)]
                total += pair_sums(*sides, w)
            return total

        sums = _added(blocks, step_sums, 1 + FEATURES + FEATURES ** 2)
        ridge = RIDGE * sums[0]
        step = np.linalg.solve(sums[1 + FEATURES:].reshape(FEATURES, FEATURES) + ridge * np.eye(FEATURES), sums[1:1 + FEATURES] - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-5:
            break
    return w


def score(text: Column, model: Model) -> Column:
    """Quality of each text, 0 to 1; null counts as empty."""
    bounded_batches()

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = [np.zeros(0)]
            for _, _, raw, offsets in pieces(batch):
                out.append(model.score(features(raw, offsets)))
            yield pa.array(np.concatenate(out))

    return run(text)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score``, ``predicted``."""
    model = fit(docs, labels)
    return (docs.select("doc_id", held_out(4, 2).alias("held_out"), score(F.col("text"), model).alias("score"))
            .withColumn("predicted", (F.col("score") >= DECISION).cast("int")))
