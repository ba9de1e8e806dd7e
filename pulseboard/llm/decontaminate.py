"""Benchmark decontamination with suffix arrays over the training texts.

The documents of a batch form a shard. A shard's words are numbered by the vocabulary of the test
items; a suffix array over its word positions is sorted to the depth of a window, and every
suffix of every test item is looked up in it by binary search. The stretch of the array that starts with
the test suffix gives all its verbatim occurrences, with their places. Occurrences that follow each other on
one diagonal are one longest match.

Each document lies whole in one shard, so nothing is shuffled, and a passage that many documents share
costs each shard its own lookups only. A suffix enters the array only if its first words (as many as the shortest
window has) are all words of the test set; no other suffix can begin a match.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseboard.llm.arrow_text import ascii_lower, bounded_batches, free_name, pieces, runs

WINDOW = 13
#: Test texts of one pass, in bytes. More are handled in further passes over the documents.
PASS_BYTES = 32_000_000

RESULT = ("n_words long, n_hit long, items array<string>, "
          "matches array<struct<item:string,item_word:int,doc_word:int,words:int>>")

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[48:58] = _WORD_BYTE[97:123] = _WORD_BYTE[128:] = True


def _words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of all words; ``raw`` is lower-cased."""
    return runs(_WORD_BYTE[raw], offsets)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


@dataclass
class Tests:
    """The test items of one pass: vocabulary, and every suffix cut to a window."""

    vocabulary: np.ndarray  # sorted word numbers
    spelled: list[bytes]  # the words in that order
    suffixes: np.ndarray  # one row per test suffix, vocabulary number + 1, 0 beyond its length
    lengths: np.ndarray
    items: np.ndarray  # item of each suffix
    places: np.ndarray  # word of the item at which the suffix begins
    names: list[str]
    shortest: int
    window: int
    bits: int


def prepare(rows: list[tuple[str, str]], window: int) -> Tests | None:
    """``rows``: (item id, text). None when no item has a word."""
    names, lists = [], []
    for name, text in rows:
        raw = ascii_lower(np.frombuffer((text or "").encode(), np.uint8))
        starts, ends, _ = _words(raw, np.array([0, len(raw)]))
        if len(starts):
            names.append(name)
            data = raw.tobytes()
            lists.append([data[s:e] for s, e in zip(starts, ends, strict=True)])
    if not lists:
        return None
    spelled = sorted({w for words in lists for w in words})
    numbers = np.array([_one(w) for w in spelled], np.uint64)
    order = np.argsort(numbers)
    number_of = {spelled[k]: at + 1 for at, k in enumerate(order)}
    suffixes, lengths, items, places = [], [], [], []
    for item, words in enumerate(lists):
        ids = [number_of[w] for w in words]
        size = min(window, len(ids))
        for at in range(len(ids) - size + 1):
            suffixes.append(ids[at:at + size] + [0] * (window - size))
            lengths.append(size)
            items.append(item)
            places.append(at)
    return Tests(numbers[order], [spelled[k] for k in order], np.array(suffixes, np.int64), np.array(lengths),
                 np.array(items), np.array(places), names, min(lengths), window, len(spelled).bit_length())


def _one(word: bytes) -> np.uint64:
    raw = np.frombuffer(word, np.uint8)
    return _word_hashes(raw, np.array([0]), np.array([len(raw)]))[0]


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit number per word from running sums: sum of byte * base^place, divided by base^start."""
    n = len(raw)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(n), out=sums[1:])
    back = np.full(n + 1, _INVERSE, np.uint64)
    back[0] = 1
    back = np.multiply.accumulate(back)
    return (sums[ends] - sums[starts]) * back[starts]


def _packed(ids: np.ndarray, bits: int, fill: int) -> list[np.ndarray]:
    """Columns of 64-bit keys, as many words to a key as fit; comparing the keys in turn compares the words."""
    each = 64 // bits
    keys = []
    for at in range(0, ids.shape[1], each):
        key = np.zeros(len(ids), np.uint64)
        for k in range(at, at + each):
            column = ids[:, k].astype(np.uint64) if k < ids.shape[1] else np.full(len(ids), fill, np.uint64)
            key = (key << np.uint64(bits)) | column
        keys.append(key)
    return keys


def _bound(array: list[np.ndarray], wanted: list[np.ndarray], after: bool) -> np.ndarray:
    """Binary search of all wanted keys at once: first place not below (or, with ``after``, above) each."""
    n = len(array[0])
    low, high = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), n, np.int64)
    while True:
        busy = low < high
        if not busy.any():
            return low
        middle = np.minimum((low + high) // 2, n - 1)
        below = np.zeros(len(low), bool)
        equal = np.ones(len(low), bool)
        for column, key in zip(array, wanted, strict=True):
            here = column[middle]
            below |= equal & (here < key)
            equal &= here == key
        right = busy & (below | (equal if after else False))
        low = np.where(right, middle + 1, low)
        high = np.where(busy & ~right, middle, high)


def shard_matches(raw: np.ndarray, offsets: np.ndarray, tests: Tests | None) -> tuple[np.ndarray, ...]:
    """Words per text, and all occurrences of test suffixes: (text, word in text, suffix)."""
    raw = ascii_lower(raw)
    starts, ends, text = _words(raw, offsets)
    n_texts = len(offsets) - 1
    n_words = np.bincount(text, minlength=n_texts) if len(text) else np.zeros(n_texts, np.int64)
    none = np.zeros(0, np.int64)
    if tests is None or not len(starts):
        return n_words, none, none, none
    hashes = _word_hashes(raw, starts, ends)
    maybe = np.zeros(1 << 20, bool)
    maybe[(tests.vocabulary >> np.uint64(40)) & np.uint64((1 << 20) - 1)] = True
    likely = np.flatnonzero(maybe[(hashes >> np.uint64(40)) & np.uint64((1 << 20) - 1)])
    at = np.minimum(np.searchsorted(tests.vocabulary, hashes[likely]), len(tests.vocabulary) - 1)
    true = tests.vocabulary[at] == hashes[likely]
    ids = np.zeros(len(starts) + tests.window, np.int64)
    ids[likely[true]] = at[true] + 1
    # Positions whose next words, up to the shortest window, are test words of the same text.
    after = np.append(np.cumsum(n_words), 0)[text]  # first word behind the position's text
    known = ids[:len(starts)] > 0
    last_unknown = np.where(known, np.int64(len(starts)), np.arange(len(starts)))
    next_unknown = np.minimum(np.minimum.accumulate(last_unknown[::-1])[::-1], after)
    positions = np.flatnonzero(next_unknown - np.arange(len(starts)) >= tests.shortest)
    if not len(positions):
        return n_words, none, none, none
    grid = positions[:, None] + np.arange(tests.window)[None, :]
    heads = np.where(grid < next_unknown[positions][:, None], ids[np.minimum(grid, len(ids) - 1)], 0)
    columns = _packed(heads, tests.bits, 0)
    order = np.lexsort(columns[::-1])  # the suffix array, to the depth of a window
    array = [c[order] for c in columns]
    suffix_array = positions[order]
    top = (1 << tests.bits) - 1
    beyond = np.arange(tests.window)[None, :] >= tests.lengths[:, None]
    low = _bound(array, _packed(tests.suffixes, tests.bits, 0), after=False)
    high = _bound(array, _packed(np.where(beyond, top, tests.suffixes), tests.bits, top), after=True)
    counts = high - low
    suffix = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(suffix)) - np.repeat(np.cumsum(counts) - counts, counts)
    found = suffix_array[low[suffix] + within]
    # Equal numbers are not yet equal words: compare the bytes of each word that takes part once.
    if len(found):
        lengths = tests.lengths[suffix]
        covered = np.unique(np.concatenate([found[lengths > k] + k for k in range(tests.window)]))
        data = raw.tobytes()
        wrong = covered[[data[s:e] != tests.spelled[i] for s, e, i in
                         zip(starts[covered], ends[covered], (ids[covered] - 1).tolist(), strict=True)]]
        if len(wrong):
            bad = np.zeros(len(starts) + 1, np.int64)
            bad[wrong + 1] = 1
            bad = np.cumsum(bad)
            right = bad[found + lengths] == bad[found]
            found, suffix = found[right], suffix[right]
    first = np.cumsum(n_words) - n_words
    return n_words, text[found], found - first[text[found]], suffix


def _longest(place: np.ndarray, suffix: np.ndarray, tests: Tests) -> list[dict]:
    """Longest matches of one text: occurrences on one diagonal that follow each other are one."""
    item, at = tests.items[suffix], tests.places[suffix]
    order = np.lexsort((place, place - at, item))
    out: list[dict] = []
    for k in order:
        size = int(tests.lengths[suffix[k]])
        last = out[-1] if out else None
        if (last and last["item"] == tests.names[item[k]] and last["doc_word"] - last["item_word"] == place[k] - at[k]
                and place[k] <= last["doc_word"] + last["words"] - size + 1):
            last["words"] = int(place[k]) - last["doc_word"] + size
        else:
            out.append({"item": tests.names[item[k]], "item_word": int(at[k]), "doc_word": int(place[k]), "words": size})
    return out


def _apply(column: pa.Array, tests: list[Tests | None]) -> list[dict]:
    rows = []
    for first, end, raw, offsets in pieces(column):
        hits: list[list[tuple[np.ndarray, np.ndarray, Tests]]] = [[] for _ in range(end - first)]
        n_words = np.zeros(end - first, np.int64)
        for part in tests:
            n_words, text, place, suffix = shard_matches(raw, offsets, part)
            order = np.argsort(text, kind="stable")
            text, place, suffix = text[order], place[order], suffix[order]
            for t, lo, hi in zip(*_groups(text), strict=True):
                hits[t].append((place[lo:hi], suffix[lo:hi], part))
        for total, found in zip(n_words.tolist(), hits, strict=True):
            cover = np.zeros(total + 1, np.int64)
            names: set[str] = set()
            matches: list[dict] = []
            for place, suffix, part in found:
                np.add.at(cover, place, 1)
                np.add.at(cover, place + part.lengths[suffix], -1)
                names.update(part.names[i] for i in np.unique(part.items[suffix]).tolist())
                matches += _longest(place, suffix, part)
            rows.append({"n_words": total, "n_hit": int((np.cumsum(cover)[:total] > 0).sum()),
                         "items": sorted(names), "matches": matches})
    return rows


def _groups(sorted_values: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """Values, first places and ends of equal stretches."""
    if not len(sorted_values):
        return [], [], []
    values, first = np.unique(sorted_values, return_index=True)
    return values.tolist(), first.tolist(), [*first[1:].tolist(), len(sorted_values)]


_STRUCT = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
    ("matches", pa.list_(pa.struct([("item", pa.string()), ("item_word", pa.int32()),
                                    ("doc_word", pa.int32()), ("words", pa.int32())])))])


def overlap(benchmark: DataFrame, text: Column, item_col: str = "item_id", item_text: str = "text",
            window: int = WINDOW, pass_bytes: int = PASS_BYTES) -> Column:
    """Struct column of a text's test overlap: words, words hit, items, longest matches with their places.

    The test set is read in slices of about ``pass_bytes`` that are looked up one after the other, so a task
    holds a slice's text at a time. Rows with equal ids are parts of one item in the item list. A null text has no words.
    """
    size = benchmark.agg(F.sum(F.octet_length(item_text))).first()[0] or 0
    slices = -(-size // pass_bytes) or 1
    named = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("name"), F.col(item_text).alias("text"))
    bounded_batches()
    spark = benchmark.sparkSession
    shared = []
    for k in range(slices):
        rows = named.where(F.pmod(F.xxhash64("name", "text"), F.lit(slices)) == k) if slices > 1 else named
        shared.append(spark.sparkContext.broadcast([(r["name"], r["text"]) for r in rows.toLocalIterator()]))

    @F.arrow_udf(RESULT)
    def lookup(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tests = [prepare(part.value, window) for part in shared]
        for batch in batches:
            yield pa.array(_apply(batch, tests), _STRUCT)

    return lookup(text)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  window: int = WINDOW, share: int = 20) -> DataFrame:
    """One row per document: words, words hit by test windows, items, and whether it is contaminated.

    Contaminated: some word is hit and ``share`` times the hit words are at least all words. Null and empty texts
    have no words and are clean; repeated rows each get a row; empty tables give empty or all-clean results.
    """
    found = docs.select(F.col(id_col).alias("doc_id"), overlap(benchmark, F.col(text_col), window=window).alias("o"))
    return found.select("doc_id", "o.n_words", "o.n_hit", "o.items", "o.matches",
                        ((F.col("o.n_hit") > 0) & (share * F.col("o.n_hit") >= F.col("o.n_words"))).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", share: int = 20) -> DataFrame:
    """``docs`` without contaminated documents, all columns as they were."""
    name = free_name(docs.columns, "overlap")
    o = F.col(name)
    return (docs.withColumn(name, overlap(benchmark, F.col(text_col)))
            .where(~((o["n_hit"] > 0) & (share * o["n_hit"] >= o["n_words"]))).drop(name))


def items_digest(items: list[str]) -> str:
    """Lower-case hex SHA-256 of the sorted ids, comma-joined (for tests)."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
