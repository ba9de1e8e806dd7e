"""Removal of repeated byte strings with suffix arrays built by two-stage sorting.

Every byte covered by a string of ``SPAN`` bytes that also starts in a document with a smaller id is removed. Strings that
can match must meet in one task without moving the text's every suffix:

1. Each string of ``SPAN`` bytes picks the smallest hash among its grams as its anchor; equal strings pick equal anchors
   at the same place. Documents lie in shards; a shard sends its distinct anchor hashes, dealt by hash.
2. Anchors seen in two documents go back to the shards that have them.
3. Shards send, once for equal pieces, the text around those anchors, dealt by the anchor's hash, with the smallest id.
4. Over the pieces of whole anchors a suffix array is built: suffixes smaller than their successors are sorted directly,
   the others are induced by scanning the buckets of first bytes in turn. Adjacent common prefixes of at least ``SPAN``
   bytes join equal strings; the smallest id of each goes back to the shards.
5. Shards mark the strings that start in a document with a smaller id and cut the bytes they cover.

An anchor of many pieces (a separator, a template with varied surroundings) would fill one bucket. Step 2 adds up how often shards
hold it and marks it hot; steps 3 and 5 then cut its pieces by the place of the anchor in the string, ``HOT_PLACES`` places together.
All strings of such a part share ``SPAN + 1 - HOT_PLACES`` bytes, whose hash takes the anchor's part, so that they spread by their surroundings.

A string common to many documents is sent once per shard, so no group grows with the number of documents that hold it.
Steps 1, 3 and 5 read the same shuffled documents, which Spark keeps and reuses; rows of a shard are put in order first, so that
every evaluation numbers its pieces alike.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.llm.arrow_text import as_bytes

SPAN = 50
GRAM = 16
#: Text of one shard, and text whose anchors make one bucket, in bytes. A document is never cut.
SHARD_BYTES = 2_000_000
BUCKET_BYTES = 16_000_000
#: Text that is sorted at a time within a bucket; the pieces of one anchor stay together.
SORT_BYTES = 500_000
#: Pieces (counted before equal ones become one, within a factor of 4) from which an anchor is hot; 32,000 at most.
HOT_PIECES = 16_000
HOT_PLACES = 5
NO_ID = np.iinfo(np.int64).max  # a null id counts as larger than all others

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers; those of the usual size of a shard are remembered by the worker."""
    usual = 3 * SHARD_BYTES // 2
    return _accumulated(base, usual)[:n] if n <= usual else _accumulated.__wrapped__(base, n)


@lru_cache(2)
def _accumulated(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Shard:
    """Documents of a shard in a fixed order, and the runs of strings that share an anchor."""

    def __init__(self, table: pa.Table):
        ids = np.array([NO_ID if v is None else v for v in table.column("id").to_pylist()], np.int64)
        text = table.column("text").combine_chunks().cast(pa.large_binary()).fill_null(b"")
        order = np.argsort(ids, kind="stable")
        if len(ids) > 1 and (np.diff(ids[order]) == 0).any():
            spelled = text.to_pylist()
            order = np.array(sorted(range(len(ids)), key=lambda k: (ids[k], spelled[k])), np.int64)
        self.ids, self.null = ids[order], np.array([v is None for v in table.column("id").to_pylist()])[order]
        self.raw, self.offsets = as_bytes(text.take(pa.array(order)))
        n = len(self.raw)
        none = np.zeros(0, np.int64)
        self.start = self.end = self.doc = self.place = none
        self.anchor = np.zeros(0, np.uint64)
        if n < SPAN:
            return
        up, down = _powers(int(_BASE), n), _powers(int(_INVERSE), n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.raw.astype(np.uint64) + np.uint64(1)) * up, out=self.sums[1:])
        self.down = down
        del up
        grams = _mixed((self.sums[GRAM:] - self.sums[:-GRAM]) * down[:n - GRAM + 1])
        # The place in the low bits makes the leftmost of equal hashes the smallest.
        place_bits = np.uint64(max(1, n.bit_length()))
        low = (np.uint64(1) << place_bits) - np.uint64(1)
        keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        width, have = SPAN - GRAM + 1, 1
        least = keys
        del keys
        while have < width:
            step = min(have, width - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        length = np.diff(self.offsets)
        doc = np.repeat(np.arange(len(length)), length)[:len(least)]
        whole = np.arange(SPAN, len(least) + SPAN) <= np.repeat(self.offsets[1:], length)[:len(least)]
        begins = whole.copy()
        begins[1:] &= (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | ~whole[:-1]
        self.start = np.flatnonzero(begins)
        ends = whole.copy()
        ends[:-1] &= begins[1:] | ~whole[1:]
        self.end = np.flatnonzero(ends) + 1
        self.doc = doc[self.start]
        self.place = (least[self.start] & low).astype(np.int64)
        self.anchor = grams[self.place]

    def spread(self, hot: np.ndarray, *more: np.ndarray) -> list[np.ndarray]:
        """Cut the runs of hot anchors by the anchor's place in the string; values per run in ``more`` follow their runs."""
        cut = np.flatnonzero(np.isin(self.anchor & _KEPT, hot)) if len(hot) else np.zeros(0, np.int64)
        if not len(cut):
            return list(more)
        parts = -(-(SPAN - GRAM + 1) // HOT_PLACES)
        run, part = np.repeat(cut, parts), np.tile(np.arange(parts), len(cut))
        # Strings from ``highest - HOT_PLACES + 1`` to ``highest`` have the anchor at the places of this part.
        highest = self.place[run] - part * HOT_PLACES
        start = np.maximum(self.start[run], highest - HOT_PLACES + 1)
        end = np.minimum(self.end[run], highest + 1)
        there = start < end
        run, part, highest, start, end = (x[there] for x in (run, part, highest, start, end))
        common = SPAN + 1 - HOT_PLACES
        anchor = _mixed((self.sums[highest + common] - self.sums[highest]) * self.down[highest] + part.astype(np.uint64))
        whole = np.ones(len(self.start), bool)
        whole[cut] = False
        order = np.argsort(np.concatenate([self.start[whole], start]), kind="stable")
        joined = lambda old, new: np.concatenate([old[whole], new])[order]
        more = [joined(x, x[run]) for x in more]
        self.doc, self.place = joined(self.doc, self.doc[run]), joined(self.place, self.place[run])
        self.start, self.end, self.anchor = joined(self.start, start), joined(self.end, end), joined(self.anchor, anchor)
        return more

    def pieces(self) -> tuple[np.ndarray, np.ndarray]:
        """Number of the piece of each run, and the first run of each piece. Equal numbers: equal bytes around an equal anchor."""
        if not len(self.start):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        size = self.end - self.start + SPAN - 1
        content = _mixed((self.sums[self.start + size] - self.sums[self.start]) * self.down[self.start]) + size.astype(np.uint64)
        order = np.lexsort((self.start, content, self.anchor))
        same = np.zeros(len(order), bool)
        same[1:] = (content[order][1:] == content[order][:-1]) & (self.anchor[order][1:] == self.anchor[order][:-1])
        group = np.cumsum(~same) - 1
        first = order[~same]
        # Equal hashes are not yet equal bytes: compare each repeated run with the first of its group.
        again = np.flatnonzero(same)
        a, b = self.start[order[again]], self.start[first[group[again]]]
        length = np.minimum(size[order[again]], size[first[group[again]]])
        unequal = size[order[again]] != size[first[group[again]]]
        for cut in range(0, len(again), 20_000):
            part = slice(cut, cut + 20_000)
            flat = np.arange(length[part].sum()) - np.repeat(np.cumsum(length[part]) - length[part], length[part])
            differ = self.raw[np.repeat(a[part], length[part]) + flat] != self.raw[np.repeat(b[part], length[part]) + flat]
            owner = np.repeat(np.arange(len(length[part])), length[part])
            unequal[part] |= np.bincount(owner, differ, minlength=len(length[part])) > 0
        if unequal.any():
            alone = again[unequal]
            first = np.concatenate([first, order[alone]])
            group[alone] = len(first) - len(alone) + np.arange(len(alone))
        number = np.empty(len(order), np.int64)
        number[order] = group
        return number, first

    def smallest(self, number: np.ndarray, count: int) -> np.ndarray:
        """Smallest id per piece."""
        out = np.full(count, NO_ID, np.int64)
        np.minimum.at(out, number, self.ids[self.doc])
        return out


def _buckets_of(anchor: np.ndarray, buckets: int) -> np.ndarray:
    return ((anchor >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _split(bucket: np.ndarray) -> list[tuple[int, np.ndarray]]:
    if not len(bucket):
        return []
    order = np.argsort(bucket, kind="stable")
    values, first = np.unique(bucket[order], return_index=True)
    return [(int(b), part) for b, part in zip(values, np.split(order, first[1:]), strict=True)]


def shared_anchors(lists: list[np.ndarray], hot_pieces: int = HOT_PIECES) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per shard's list (hash, power of 4 of its pieces, in several documents already): hashes that two documents have, and the hot ones of them."""
    flat = np.concatenate(lists)
    seen, at, count = np.unique(flat >> np.uint64(4), return_inverse=True, return_counts=True)
    several = count > 1
    several[at[(flat & np.uint64(1)) == 1]] = True
    held = np.bincount(at, 4.0 ** ((flat >> np.uint64(1)) & np.uint64(7)).astype(np.int64))
    hot = several & (2 * held >= hot_pieces)
    out, lo = [], 0
    for x in lists:
        own = at[lo:lo + len(x)]
        out.append((seen[own[several[own]]], seen[own[hot[own]]]))
        lo += len(x)
    return out


def in_eights(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number, with zeros behind the end; readable up to ``SPAN`` places beyond it."""
    wide = np.zeros(len(raw) + SPAN + 16, np.uint64)
    wide[:len(raw)] = raw
    for width in (1, 2, 4):
        wide = (wide[:-width] << np.uint64(8 * width)) | wide[width:]
    return wide


def suffix_order(raw: np.ndarray, wanted: np.ndarray, eight: np.ndarray | None = None) -> np.ndarray:
    """The wanted suffixes of ``raw`` in lexicographic order, right for the first ``SPAN`` bytes.

    Two-stage sorting. A suffix is of type S if it is smaller than its successor. Wanted S suffixes are sorted
    directly by their bytes; each L suffix is induced when its successor is scanned, bucket of first byte by bucket.
    """
    n = len(raw)
    eight = in_eights(raw) if eight is None else eight
    text = np.concatenate([raw.astype(np.int16) + 1, np.zeros(1, np.int16)])  # an end mark below all bytes
    # A stretch of equal bytes rises or falls as a whole, by the byte behind it.
    last = np.flatnonzero(text[1:] != text[:-1])
    rising = np.append(np.repeat(text[last + 1] > text[last], np.diff(last, prepend=-1)), True)
    # An L suffix is induced from its successor, so the chain up to the next S suffix is needed as well.
    where = np.where(rising, np.arange(n + 1), n)
    next_s = np.minimum.accumulate(where[::-1])[::-1]
    falling = np.flatnonzero(wanted & ~rising[:n])
    cover = np.zeros(n + 2, np.int64)
    cover[falling] = 1
    cover -= np.bincount(next_s[falling] + 1, minlength=n + 2)
    needed = np.cumsum(cover)[:n + 1] > 0
    needed[:n] |= wanted
    direct = np.flatnonzero(needed & rising)
    direct = direct[direct < n]
    key = eight[direct]
    order = np.argsort(key, kind="stable")
    sorted_s = direct[order]
    place, group = _tied(key[order], np.zeros(len(order), np.int64))
    for at in range(8, SPAN, 8):
        if not len(place):
            break
        # Only suffixes whose bytes so far are those of a neighbour are sorted further, within their group.
        rows = sorted_s[place]
        key = eight[rows + at]
        by = np.lexsort((key, group))
        sorted_s[place] = rows[by]
        tied, number = _tied(key[by], group)
        place, group = place[tied], number
    first_s = text[sorted_s]
    induced: dict[int, list[np.ndarray]] = {}

    def induce(scanned: np.ndarray, same: int) -> np.ndarray:
        """Put the L predecessors of scanned suffixes into their buckets, in order; those of bucket ``same`` are returned."""
        before = scanned[scanned > 0] - 1
        before = before[needed[before] & ~rising[before]]
        first = text[before]
        own = before[first == same]
        rest, first = before[first != same], first[first != same]
        if not len(rest):
            return own
        by = np.argsort(first, kind="stable")
        chars, cut = np.unique(first[by], return_index=True)
        for c, part in zip(chars.tolist(), np.split(rest[by], cut[1:]), strict=True):
            induced.setdefault(c, []).append(part)
        return own

    result = []
    induce(np.array([n]), 0)
    for c in range(1, 257):
        lo, hi = np.searchsorted(first_s, [c, c + 1])
        front = induced.pop(c, [])
        if not front and lo == hi:
            continue
        part = np.concatenate(front) if front else np.zeros(0, np.int64)
        while len(part):
            result.append(part)
            part = induce(part, c)
        if hi > lo:
            result.append(sorted_s[lo:hi])
            induce(sorted_s[lo:hi], c)
    order = np.concatenate(result) if result else np.zeros(0, np.int64)
    return order[wanted[order]]


def _tied(key: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of sorted keys that equal a neighbour of their group, and a number for each set of equal ones."""
    same = (key[1:] == key[:-1]) & (group[1:] == group[:-1])
    tied = np.zeros(len(key), bool)
    tied[1:] |= same
    tied[:-1] |= same
    number = np.zeros(len(key), np.int64)
    np.cumsum(~same, out=number[1:])
    return np.flatnonzero(tied), number[tied]


#: Numbers below these bounds begin with 7, 6, ... 1 zero bytes.
_BOUNDS = np.uint64(1) << np.arange(8, 64, 8, dtype=np.uint64)


def common_prefixes(raw: np.ndarray, order: np.ndarray, eight: np.ndarray | None = None) -> np.ndarray:
    """Common prefix of each suffix with the one before it in ``order``, counted up to ``SPAN``; 0 for the first."""
    eight = in_eights(raw) if eight is None else eight
    out = np.zeros(len(order), np.int64)
    a, b = order[:-1], order[1:]
    live = np.arange(1, len(order))
    for at in range(0, SPAN, 8):
        differ = eight[a + at] ^ eight[b + at]
        alike = differ == 0
        out[live[~alike]] = at + 7 - np.searchsorted(_BOUNDS, differ[~alike], side="right")
        live, a, b = live[alike], a[alike], b[alike]
        if not len(live):
            break
    out[live] = SPAN
    # Zeros behind the end are no bytes.
    np.minimum(out[1:], len(raw) - np.maximum(order[:-1], order[1:]), out=out[1:])
    return np.minimum(out, SPAN)


def smallest_ids(raw: np.ndarray, at: np.ndarray, windows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For pieces (places in ``raw``, number of strings, id): the smallest id that has each string, strings in piece order."""
    total = int(windows.sum())
    piece = np.repeat(np.arange(len(at)), windows)
    start = np.repeat(at, windows) + np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows)
    wanted = np.zeros(len(raw), bool)
    wanted[start] = True
    number = np.full(len(raw), -1, np.int64)
    number[start] = np.arange(total)
    eight = in_eights(raw)
    order = suffix_order(raw, wanted, eight)
    begins = common_prefixes(raw, order, eight) < SPAN
    first = np.flatnonzero(begins)
    least = np.minimum.reduceat(ids[piece[number[order]]], first) if len(first) else np.zeros(0, np.int64)
    out = np.empty(total, np.int64)
    out[number[order]] = np.repeat(least, np.diff(np.append(first, len(order))))
    return out


def cut_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shard_bytes: int = SHARD_BYTES, bucket_bytes: int = BUCKET_BYTES, hot_pieces: int = HOT_PIECES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept`` (bytes that stay) and ``kept_sha256``.

    A null text is empty. A null id counts as larger than every id; rows with equal ids do not count as smaller than one another, so
    repeated rows keep what no smaller id has. Strings never cross documents. An empty table gives no rows.
    """
    if hot_pieces > 32_000:
        raise ValueError("a shard's count of pieces is sent up to 16,384 only: hot_pieces must be 32,000 or less")
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    shards, buckets = -(-size // shard_bytes) or 1, -(-size // bucket_bytes) or 1
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("id", "text"), F.lit(shards)).cast("int"))

    def send_anchors(table: pa.Table) -> pa.Table:
        shard = Shard(table)
        order = np.lexsort((shard.doc, shard.anchor))
        anchor, doc = shard.anchor[order], shard.doc[order]
        values, first = np.unique(anchor, return_index=True)
        last = np.append(first[1:], len(anchor)) - 1
        several = shard.ids[doc[last]] != shard.ids[doc[first]] if len(values) else np.zeros(0, bool)
        pieces = np.minimum(last + 1 - first, 4 ** 7)
        power = np.searchsorted(4 ** np.arange(1, 8), pieces, side="right")
        out = [(b, _short(values[part], power[part], several[part])) for b, part in _split(_buckets_of(values, buckets))]
        return pa.table({"bucket": pa.array([b for b, _ in out], pa.int32()),
                         "shard": pa.array([table.column("shard")[0].as_py()] * len(out), pa.int32()),
                         "hashes": pa.array([x for _, x in out], pa.binary())})

    def find_shared(table: pa.Table) -> pa.Table:
        lists = [_long(x) for x in table.column("hashes").to_pylist()]
        found = [(_short(known), _short(hot)) for known, hot in shared_anchors(lists, hot_pieces)]
        return pa.table({"shard": table.column("shard"), "hashes": pa.array([x for x, _ in found], pa.binary()),
                         "hot": pa.array([x for _, x in found], pa.binary())})

    def send_pieces(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("bucket", pa.int32()), ("shard", pa.int32()), ("numbers", pa.binary()), ("anchors", pa.binary()),
                            ("ids", pa.binary()), ("windows", pa.binary()), ("text", pa.binary())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        shard = Shard(left)
        known = np.sort(_hashes(right.column("hashes")))
        if not len(known):
            return schema.empty_table()
        own = shard.anchor & _KEPT
        found = known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own
        found, = shard.spread(_hashes(right.column("hot")), found)
        number, first = shard.pieces()
        least = shard.smallest(number, len(first))
        chosen = np.flatnonzero(found[first])
        windows = (shard.end - shard.start)[first[chosen]]
        out = []
        for b, part in _split(_buckets_of(shard.anchor[first[chosen]], buckets)):
            size = windows[part] + SPAN - 1
            start = shard.start[first[chosen[part]]]
            flat = np.repeat(start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            out.append({"bucket": b, "shard": left.column("shard")[0].as_py(), "numbers": chosen[part].astype(np.uint32).tobytes(),
                        "anchors": shard.anchor[first[chosen[part]]].tobytes(), "ids": least[chosen[part]].tobytes(),
                        "windows": windows[part].astype(np.uint8).tobytes(), "text": zlib.compress(shard.raw[flat].tobytes(), 1)})
        return pa.Table.from_pylist(out, schema)

    def sort_pieces(table: pa.Table) -> pa.Table:
        get = lambda name, kind: [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]
        numbers, windows = get("numbers", np.uint32), get("windows", np.uint8)
        of = np.repeat(np.arange(table.num_rows), [len(x) for x in numbers])
        numbers, anchors, ids, windows = (np.concatenate(x) for x in (numbers, get("anchors", np.uint64), get("ids", np.int64), windows))
        windows = windows.astype(np.int64)
        raw = np.frombuffer(b"".join(zlib.decompress(x) for x in table.column("text").to_pylist()), np.uint8)
        size = windows + SPAN - 1
        at = np.cumsum(size) - size
        answer: list[list[np.ndarray]] = [[] for _ in range(table.num_rows)]
        order = np.argsort(anchors, kind="stable")
        behind = np.cumsum(size[order])
        lo = 0
        while lo < len(order):
            hi = max(int(np.searchsorted(behind, (behind[lo - 1] if lo else 0) + SORT_BYTES)), lo + 1)
            while hi < len(order) and anchors[order[hi]] == anchors[order[hi - 1]]:
                hi += 1
            rows_ = order[lo:hi]
            flat = np.repeat(at[rows_], size[rows_]) + np.arange(size[rows_].sum()) - np.repeat(np.cumsum(size[rows_]) - size[rows_], size[rows_])
            part = raw[flat]
            least = smallest_ids(part, np.cumsum(size[rows_]) - size[rows_], windows[rows_], ids[rows_])
            piece = np.repeat(np.arange(len(rows_)), windows[rows_])
            within = np.arange(len(piece)) - np.repeat(np.cumsum(windows[rows_]) - windows[rows_], windows[rows_])
            # Runs of strings of a piece with one smaller id become one row of the answer.
            lower = least < ids[rows_][piece]
            begins = lower.copy()
            begins[1:] &= ~lower[:-1] | (piece[1:] != piece[:-1]) | (least[1:] != least[:-1])
            ends = lower.copy()
            ends[:-1] &= ~lower[1:] | begins[1:]
            a, b = np.flatnonzero(begins), np.flatnonzero(ends)
            rec = np.zeros(len(a), _ANSWER)
            rec["number"], rec["first"], rec["last"], rec["id"] = numbers[rows_[piece[a]]], within[a], within[b], least[a]
            for shard, mine in _split(of[rows_[piece[a]]]):
                answer[shard].append(rec[mine])
            lo = hi
        rows_out = [(s, np.concatenate(x).tobytes()) for s, x in zip(table.column("shard").to_pylist(), answer, strict=True) if x]
        return pa.table({"shard": pa.array([s for s, _ in rows_out], pa.int32()), "found": pa.array([x for _, x in rows_out], pa.binary())})

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _CUT.empty_table()
        shard = Shard(left)
        shard.spread(_hashes(right.column("hot")))
        number, first = shard.pieces()
        n = len(shard.raw)
        cover = np.zeros(n + 1, np.int64)
        least = shard.smallest(number, len(first))
        ids = shard.ids[shard.doc]
        local = np.flatnonzero(least[number] < ids) if len(first) else np.zeros(0, np.int64)
        np.add.at(cover, shard.start[local], 1)
        np.add.at(cover, shard.end[local] - 1 + SPAN, -1)
        found = np.concatenate([np.zeros(0, _ANSWER), *(np.frombuffer(x, _ANSWER) for x in right.column("found").to_pylist() if x)])
        if len(found):
            # All runs of a piece take its answers.
            by = np.argsort(number, kind="stable")
            begin = np.searchsorted(number[by], found["number"])
            count = np.searchsorted(number[by], found["number"], side="right") - begin
            rec = np.repeat(np.arange(len(found)), count)
            run = by[np.repeat(begin, count) + np.arange(len(rec)) - np.repeat(np.cumsum(count) - count, count)]
            hit = found["id"][rec] < ids[run]
            rec, run = rec[hit], run[hit]
            np.add.at(cover, shard.start[run] + found["first"][rec], 1)
            np.add.at(cover, shard.start[run] + found["last"][rec] + SPAN, -1)
        gone = np.cumsum(cover)[:n] > 0
        out = []
        for k, null in enumerate(shard.null):
            lo, hi = shard.offsets[k], shard.offsets[k + 1]
            mine = gone[lo:hi]
            kept = shard.raw[lo:hi][~mine].tobytes()
            spans = int(mine[:1].sum() + (mine[1:] & ~mine[:-1]).sum())
            out.append({"doc_id": None if null else int(shard.ids[k]), "n_bytes": int(hi - lo), "n_removed": int(mine.sum()),
                        "n_spans": spans, "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept})
        return pa.Table.from_pylist(out, _CUT)

    anchors = rows.groupBy("shard").applyInArrow(send_anchors, "bucket int, shard int, hashes binary")
    shared = anchors.groupBy("bucket").applyInArrow(find_shared, "shard int, hashes binary, hot binary")
    sent = (rows.groupBy("shard").cogroup(shared.groupBy("shard"))
            .applyInArrow(send_pieces, "bucket int, shard int, numbers binary, anchors binary, ids binary, windows binary, text binary"))
    found = sent.groupBy("bucket").applyInArrow(sort_pieces, "shard int, found binary")
    answers = (found.withColumn("hot", F.lit(b""))
               .unionByName(shared.where("hot <> X''").select("shard", F.lit(b"").alias("found"), "hot")))
    return (rows.groupBy("shard").cogroup(answers.groupBy("shard"))
            .applyInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"))


_CUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                  ("kept_sha256", pa.string()), ("kept", pa.binary())])
_ANSWER = np.dtype([("number", np.uint32), ("first", np.uint8), ("last", np.uint8), ("id", np.int64)])
#: 44 bits of a hash are sent; with the bucket, which other bits choose, they tell anchors apart, and a wrong
#: candidate costs a comparison only.
_KEPT = np.uint64((1 << 44) - 1)


def _short(hashes: np.ndarray, power: np.ndarray | int = 0, flag: np.ndarray | int = 0) -> bytes:
    """Six bytes per hash: 44 bits, a power of 4 up to 7, and a flag."""
    packed = ((hashes & _KEPT) << np.uint64(4)) | np.asarray(power, np.uint64) << np.uint64(1) | np.asarray(flag, np.uint64)
    return packed.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _long(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1)


def _hashes(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *(_long(x) >> np.uint64(4) for x in column.to_pylist() if x)])
