"""Circulant MinHash against all pairs of sets."""

import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from pulseboard.llm import circulant  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty".split()


def plain_set(text):
    words = (text or "").translate(LOWER).encode().split()
    return frozenset(tuple(words[k:k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def plain(rows, percent=85):
    """All pairs of different sets compared, components by depth-first search."""
    sets = [plain_set(t) for _, t in rows]
    distinct = list({s for s in sets if s})
    near = {s: [] for s in distinct}
    for k, s in enumerate(distinct):
        for t in distinct[:k]:
            common = len(s & t)
            if 100 * common >= percent * (len(s) + len(t) - common):
                near[s].append(t)
                near[t].append(s)
    ids = {}
    for (i, _), s in zip(rows, sets, strict=True):
        if s and i is not None:
            ids[s] = min(i, ids.get(s, i))
    label = {}
    for s in distinct:
        if s in label:
            continue
        reached, stack = {s}, [s]
        while stack:
            for t in near[stack.pop()]:
                if t not in reached:
                    reached.add(t)
                    stack.append(t)
        smallest = min((ids[t] for t in reached if t in ids), default=None)
        label |= dict.fromkeys(reached, smallest)
    return Counter((i, len(s), label[s] if s else i, i == (label[s] if s else i)) for (i, _), s in zip(rows, sets, strict=True))


def rows_of(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect())


def cluster(rng, first, size, changes, words=120):
    """Texts that differ from one text at some places each."""
    base = rng.choice(WORDS, words).tolist()
    out = []
    for k in range(size):
        text = list(base)
        for at in rng.choice(words, rng.integers(0, changes + 1), replace=False):
            text[at] = f"x{first}{k}{at}"
        out.append((first + k, " ".join(text)))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    found = [(0, None), (1, ""), (2, " \t"), (3, "One two"), (4, "one\ntwo"), (5, "two one"), (6, "one two three four five"), (6, "one two three four five"),
             (None, "no id but words here all the same"), (8, "no id but words here all the same"), (None, "nobody else has this text at all"), (9, "word " * 30_000), (10, "word " * 7)]
    # A chain: each links to the next only.
    chain = [f"c{k}" for k in range(60)]
    found += [(500 + k, " ".join(chain[k:k + 44])) for k in range(16)]
    for first, size, changes in ((1000, 60, 3), (2000, 40, 1), (3000, 30, 6), (4000, 2, 2)):
        found += cluster(rng, first, size, changes)
    return found


@pytest.mark.parametrize("tile", [circulant.TILE, 1_500])
def test_links_equal_all_pairs(spark, rows, tile):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bucket", F.lit("x")).withColumn("node", F.lit(1))
    want = plain(rows)
    assert len({r[2] for r in want}) > 40 and max(Counter(r[2] for r in want.elements()).values()) > 20
    assert rows_of(circulant.near_duplicates(docs, tile=tile)) == want
    assert circulant.near_duplicates(docs.limit(0)).count() == 0


def test_links_of_the_given_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    given = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(circulant.near_duplicates(docs)) == plain(given)


def test_few_slots_lose_nothing(spark, rows):
    """Slots that many shingles share only bring more candidates."""
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(circulant.near_duplicates(docs, slots=1 << 10)) == plain(rows)


def test_coordinates_are_shifts_of_one_permutation():
    table = circulant.circle(64, 12)
    assert sorted(table[:, 0].tolist()) == list(range(64))
    assert all((table[:, k] == np.roll(table[:, 0], -k)).all() for k in range(12))


def test_share_of_equal_coordinates_estimates_similarity():
    rng = np.random.default_rng(8)
    values = np.unique(rng.integers(0, 1 << 63, 3_000).astype(np.uint64))
    for share in (0.3, 0.6, 0.85):
        cut = int(len(values) * (1 - share) / 2)
        a, b = values[:len(values) - cut], values[cut:]
        found = circulant.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 1_000)
        assert abs((found[0] == found[1]).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.05


def test_sets_equal_plain_sets(rows):
    texts = [(t or "").encode() for _, t in rows]
    raw, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    values, bounds = circulant.shingle_sets(raw, offsets)
    assert np.diff(bounds).tolist() == [len(plain_set(t)) for _, t in rows]
    assert all((np.diff(values[s:e].astype(object)) > 0).all() for s, e in zip(bounds[:-1], bounds[1:], strict=True))
