"""Toxicity by a subsequence string kernel and a support vector machine over Nyström landmarks.

The kernel of two strings sums their common subsequences of three characters, each weighted down by the gaps it
spans, so insults with left-out or inserted characters stay close to the plain form. A sentence meets a landmark as
closely as its closest word does. Landmarks are words that mark toxic training sentences; the Nyström map of the
landmarks' kernel matrix gives the features of a linear support vector machine. Documents are labelled, not
sentences: of a toxic document the sentence that scores highest is taken as the toxic one, in rounds. A document
is scored by a logistic curve over the machine's decisions on its words: the three highest, their sum, and the sum by length,
as one mild word in a long text means less than several.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseboard.llm.arrow_text import bounded_batches, free_name, pieces, texts
from pulseboard.llm.training_rows import held_out, sample

DECAY = np.float32(0.6)
WIDTH = 20  # characters of a compared string; longer words are compared in overlapping stretches, all of them
QUIET = 0.35  # kernel values below count as nothing in common
LANDMARKS = 96
TRAIN_DOCS = 3_000
TRAIN_CHARS = 40_000
#: Words of a generation that a scorer keeps. A full one becomes the former one, whose words count as known too.
KEPT_WORDS = 400_000
PAIRS = 2_000  # compared at a time: their tables stay in the processor's cache
SUMMARY = 7
_LOOKS_LIKE = str.maketrans("013457@$!", "oieastasi")
_MARKS = re.compile(r"[.!?]+")
_SENTENCE = re.compile(r"[.!?]+(?=\s|\Z)|\n+")
_INNER = re.compile(r"(?<=[^\s.!?])[.!?]+(?=[^\s.!?])")


def unit(word: str) -> str:
    """What is compared of a word: lower case, look-alike digits as letters, letters only, with a mark in front that counts twice."""
    if word.isalpha():  # nothing to change
        return "^^" + word
    bare = word.strip(".,;:!?()[]{}\"'*#%&|<>").translate(_LOOKS_LIKE)
    return "^^" + bare if bare.isalpha() else "^^" + "".join(c for c in bare if c.isalpha())


def joined(words: list[str]) -> list[str]:
    """Words of a sentence; three or more single characters in a row also count as one word."""
    lengths = list(map(len, words))
    if lengths.count(1) < 3 or b"\1\1\1" not in bytes([n == 1 for n in lengths]):
        return words
    out, run = list(words), []
    for w in [*words, "  "]:
        if len(w) == 1:
            run.append(w)
            continue
        if len(run) >= 3:
            out.append("".join(run))
        run = []
    return out


def read(text: str) -> tuple[list[str], list[tuple[str, list[str]]]]:
    """Words of a text in lower case, cut at every sentence mark; and the words that have such a mark inside, each with the words it
    was cut into, as 'id!ot' may be one word and 'end.Start' two. Single characters between marks are left to ``joined``."""
    words = joined(_MARKS.sub(" ", text).split())
    if not _INNER.search(text):
        return words, []
    whole = []
    for word in text.split():
        if not word.isalnum() and _INNER.search(word):
            cut = [p for p in _MARKS.split(word) if p]
            if len(cut) < 3 or any(len(p) > 1 for p in cut):
                whole.append((word, joined(cut)))
    return words, whole


def _grid(strings: list[str], pad: int) -> np.ndarray:
    width = max(1, max((len(s) for s in strings), default=1))
    codes = np.array(strings, dtype=f"U{width}").view(np.uint32).reshape(len(strings), width)
    return np.where(codes == 0, np.uint32(pad), codes)


def _letters(codes: np.ndarray, pad: int) -> np.ndarray:
    bits = np.where(codes == pad, np.uint64(0), np.uint64(1) << (codes % 61).astype(np.uint64))
    return np.bitwise_or.reduce(bits, axis=1)


def _raw_kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Subsequence kernel of length three of the pairs (row of a, row of b), by dynamic programming over all pairs at once."""
    n, t = len(a), b.shape[1]
    steps = np.arange(t)
    reach = np.where(steps[:, None] >= steps[None, :], DECAY ** np.maximum(steps[:, None] - steps[None, :], 0), 0).astype(np.float32)
    columns = np.ascontiguousarray(b.T)
    total = np.zeros(n, np.float32)
    match, once, twice, *state = (np.zeros((t, n), np.float32) for _ in range(7))
    sums, before = state[:2], state[2:]
    for i in range(a.shape[1]):
        np.multiply(columns == a[:, i], DECAY * DECAY, out=match)
        np.multiply(match[1:], before[0][:-1], out=once[1:])
        np.multiply(match[1:], before[1][:-1], out=twice[1:])
        total += twice.sum(axis=0)
        for p, ended in enumerate((match, once)):
            sums[p] *= DECAY
            sums[p] += ended
            np.matmul(reach, sums[p], out=before[p])
    return total


@dataclass
class Landmarks:
    """Strings that others are compared with."""

    strings: list[str]
    codes: np.ndarray = field(init=False)
    letters: np.ndarray = field(init=False)
    needed: np.ndarray = field(init=False)
    own: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.codes = _grid(self.strings, 1)
        self.letters = _letters(self.codes, 1)
        own = np.bitwise_count(self.letters)
        self.needed = np.minimum(own, np.maximum(4, np.ceil(own * 0.66))).astype(np.uint8)
        self.own = _raw_kernel(np.where(self.codes == 1, np.uint32(2), self.codes), self.codes)

    def compare(self, strings: list[str]) -> np.ndarray:
        """Normalised kernel of each string with each landmark; 0 below ``QUIET``, and with less than two thirds of the landmark's
        different characters (four at least, or all if it has fewer) in the string."""
        out = np.zeros((len(strings), len(self.strings)), np.float32)
        order = sorted(range(len(strings)), key=lambda k: len(strings[k]))
        for at in range(0, len(order), 4_000):
            rows = np.array(order[at:at + 4_000])
            codes = _grid([strings[k] for k in rows], 2)
            shared = np.bitwise_count(_letters(codes, 2)[:, None] & self.letters[None, :]) >= self.needed[None, :]
            w, m = np.nonzero(shared)
            if not len(w):
                continue
            used = np.unique(w)
            own = np.zeros(len(rows), np.float32)
            own[used] = _raw_kernel(codes[used], np.where(codes[used] == 2, np.uint32(1), codes[used]))
            for cut in range(0, len(w), PAIRS):
                a, b = w[cut:cut + PAIRS], m[cut:cut + PAIRS]
                k = _raw_kernel(codes[a], self.codes[b]) / np.sqrt(np.maximum(own[a] * self.own[b], 1e-12))
                out[rows[a], b] = np.where(k >= QUIET, k, 0)
        return out

    def words(self, words: list[str]) -> np.ndarray:
        """As ``compare`` for words of any length: the largest value over a long word's stretches. What several words share is compared once."""
        place: dict[str, int] = {}
        parts, starts = [], []
        for word in words:
            s = unit(word)
            starts.append(len(parts))
            if len(s) <= WIDTH:
                parts.append(place.setdefault(s, len(place)))
            else:
                parts += [place.setdefault(s[i:i + WIDTH], len(place)) for i in range(0, len(s) - WIDTH // 2, WIDTH // 2)]
        if not words:
            return np.zeros((0, len(self.strings)), np.float32)
        return np.maximum.reduceat(self.compare(list(place))[parts], starts, axis=0)


@dataclass
class Model:
    """Landmarks, their weights in the decision, and the scale of the score. Without landmarks all score the same."""

    landmarks: Landmarks | None
    weights: np.ndarray
    curve: np.ndarray

    def score(self, summary: np.ndarray) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, float(np.dot(summary, self.curve))))))


class Scorer:
    """Scores texts; keeps what it has found for words it has seen. ``values``: keep the kernel values too, which training needs."""

    def __init__(self, model: Model, values: bool = True):
        self.model = model
        self.values = values
        self.seen: set[str] = set()
        self.former: set[str] = set()
        self.loud: dict[str, np.ndarray] = {}
        self.marked: dict[str, float] = {}

    def decide(self, model: Model) -> None:
        """Take over the weights of ``model``, which has the same landmarks."""
        self.model = model
        self.marked = {w: d for w, row in self.loud.items() if (d := float(row @ model.weights)) > 0}

    def learn(self, words: set[str]) -> None:
        if self.model.landmarks is None:
            return
        missing = words - self.seen
        if len(self.seen) + len(missing) > KEPT_WORDS:
            self.former, self.seen, missing = self.seen, set(), words
            self.loud = {w: row for w, row in self.loud.items() if w in self.former}
            self.marked = {w: d for w, d in self.marked.items() if w in self.former}
        self.seen |= missing
        fresh = list(missing - self.former)
        for at in range(0, len(fresh), 20_000):
            part = fresh[at:at + 20_000]
            values = self.model.landmarks.words(part)
            decisions = values @ self.model.weights
            for k in np.flatnonzero(decisions > 0):
                self.marked[part[k]] = float(decisions[k])
            for k in np.flatnonzero(values.any(axis=1)) if self.values else ():
                self.loud[part[k]] = values[k].copy()

    def sentences(self, text: str) -> np.ndarray:
        """Kernel values of the sentences that have a word near a landmark."""
        rows = []
        for sentence in _SENTENCE.split(text.lower()):
            words, whole = read(sentence)
            near = [self.loud[w] for w in (*words, *(w for w, _ in whole)) if w in self.loud]
            if near:
                rows.append(np.maximum.reduce(near))
        return np.array(rows, np.float32)

    def summaries(self, batch: list[str]) -> np.ndarray:
        """One row per text: a constant, the three highest decisions on its words, their sum, and the sum by length.

        A word with marks inside counts as a whole where it decides more than the words between the marks do.
        """
        lists = [read(t.lower()) for t in batch]
        sets = [{*words, *(w for w, _ in whole)} for words, whole in lists]
        self.learn(set().union(*sets))
        out = np.zeros((len(batch), SUMMARY))
        out[:, 0] = 1
        for row, ((words, whole), own) in enumerate(zip(lists, sets, strict=True)):
            if self.marked.keys().isdisjoint(own):
                continue
            found = [self.marked[w] for w in words if w in self.marked]
            for word, cut in whole:
                parts = [self.marked[w] for w in cut if w in self.marked]
                if self.marked.get(word, 0.0) > sum(parts):
                    for d in parts:
                        if d in found:
                            found.remove(d)
                    found.append(self.marked[word])
            found.sort(reverse=True)
            total = sum(found)
            best = (found + [0.0, 0.0])[:3]
            out[row, 1:] = [*best, math.log1p(total), total / math.sqrt(len(words)), math.log1p(100 * total / len(words))]
        return out


def train(rows: list[tuple[str, int]], landmarks: int = LANDMARKS) -> Model:
    """``rows``: (text, 0 or 1). With one class only, or no marking word, every text gets the share of toxic rows."""
    toxic = [t for t, y in rows if y]
    clean = [t for t, y in rows if not y]
    prior = (len(toxic) + 1) / (len(rows) + 2)
    flat = Model(None, np.zeros(0), np.array([math.log(prior / (1 - prior)), *[0.0] * (SUMMARY - 1)]))
    if not toxic or not clean:
        return flat
    chosen = _choose(toxic, clean, landmarks)
    if not chosen:
        return flat
    marks = Landmarks(chosen)
    scorer = Scorer(Model(marks, np.ones(len(chosen)), np.zeros(SUMMARY)))
    _in_slices(scorer, rows)
    bags = [(scorer.sentences(t), y) for t, y in rows]
    matrix = marks.compare(chosen).astype(float)
    values, vectors = np.linalg.eigh((matrix + matrix.T) / 2)
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    negatives = [b for b, y in bags if not y and len(b)]
    x0 = np.concatenate([*negatives, np.zeros((1, len(chosen)))]) @ root
    weight0 = np.ones(len(x0))
    weight0[-1] = sum(1 for b, y in bags if not y and not len(b)) + 1
    weights = np.ones(len(chosen))
    for _ in range(4):
        best = [b[np.argmax(b @ weights)] @ root for b, y in bags if y and len(b)]
        if not best:
            return flat
        x = np.concatenate([x0, np.array(best)])
        y = np.concatenate([-np.ones(len(x0)), np.ones(len(best))])
        weights = root @ _svm(x, y, np.concatenate([weight0, np.ones(len(best))]))
    model = Model(marks, weights, np.zeros(SUMMARY))
    scorer.decide(model)
    model.curve = _logistic(_in_slices(scorer, rows), np.array([y for _, y in rows]))
    return model


def _in_slices(scorer: Scorer, rows: list[tuple[str, int]], size: int = 50) -> np.ndarray:
    """Summaries of all rows; words of few texts are held at a time."""
    return np.concatenate([scorer.summaries([t for t, _ in rows[at:at + size]]) for at in range(0, len(rows), size)])


def _choose(toxic: list[str], clean: list[str], most: int) -> list[str]:
    """Words that mark toxic documents, the clearest first; none that is nearly another one."""
    def found(group: list[str]) -> Counter:
        return Counter(u for t in group for u in units(t) if 4 <= len(u) <= WIDTH)

    def units(text: str) -> set[str]:
        words, whole = read(text.lower())
        return {unit(w) for w in (*words, *(w for w, _ in whole))}

    with_word, without = found(toxic), found(clean)
    ratio = {w: math.log((n + 0.1) / len(toxic)) - math.log((without[w] + 0.5) / len(clean)) for w, n in with_word.items() if n >= 2}
    ranked = sorted((w for w in ratio if ratio[w] > 1.5), key=lambda w: (-with_word[w] * ratio[w], w))[:8 * most]
    if not ranked:
        return []
    like = Landmarks(ranked).compare(ranked)
    chosen: list[int] = []
    for k in range(len(ranked)):
        if len(chosen) < most and (not chosen or like[k, chosen].max() < 0.9):
            chosen.append(k)
    return [ranked[k] for k in chosen]


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.02) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps on the rows inside the margin."""
    z = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    penalty = ridge * np.eye(z.shape[1])
    penalty[-1, -1] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(30):
        inside = y * (z @ w) < 1
        a = z[inside] * weight[inside, None]
        fresh = np.linalg.solve(a.T @ z[inside] + penalty, a.T @ y[inside])
        if np.allclose(fresh, w, atol=1e-6):
            break
        w = fresh
    return w[:-1]


def _logistic(x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Weights of the logistic curve from summaries to labels, by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 0.3 * np.eye(len(w))
        w = w - np.linalg.solve(hessian, x.T @ (p - label) + 0.3 * w)
    return w


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_DOCS, max_chars: int = TRAIN_CHARS) -> Model:
    """Model from at most ``rows`` labelled documents outside the held-out fold (bounded sample, see ``training_rows``)."""
    return train(sample(docs, labels, "toxic", 5, 0, rows, max_chars))


_SCORERS: dict[bytes, Scorer] = {}


def scorer(model: Model) -> Scorer:
    """The scorer of a worker process: the words it has met serve all its tasks. Only the last model's is kept."""
    marks = model.landmarks.strings if model.landmarks else []
    key = hashlib.sha256("\n".join(marks).encode() + model.weights.tobytes() + model.curve.tobytes()).digest()
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(model, values=False)
    return _SCORERS[key]


def score(text: Column, model: Model) -> Column:
    """Toxicity of each text, 0 to 1; null counts as empty."""
    bounded_batches()

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = scorer(model)
        for batch in batches:
            out: list[float] = []
            for first, end, _, _ in pieces(batch, 1_000_000):
                out += [model.score(row) for row in own.summaries(texts(batch.slice(first, end - first)))]
            yield pa.array(out, pa.float64())

    return run(text)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score``, ``predicted``."""
    model = fit(docs, labels)
    return (docs.select("doc_id", held_out(5, 0).alias("held_out"), score(F.col("text"), model).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without those that score at least ``threshold``, all columns as they were."""
    model = fit(docs, labels)
    name = free_name(docs.columns, "toxicity")
    return docs.withColumn(name, score(F.col("text"), model)).where(F.col(name) < threshold).drop(name)
