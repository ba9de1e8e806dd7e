"""Alignment of two tokenizers' tokens by an associative monoid of byte-range fragments.

Both tokenizers cut the same bytes (a space and the text). Where tokens of both end at one byte, a
group closes. A fragment is what is known of a byte range: the open prefix before its first such
byte, the closed groups between, the open suffix after its last. Two adjacent fragments compose
(the left suffix and the right prefix close one group), and composition is associative, so the
chunks of a very long document are reduced as a tree over Spark tasks; short documents are one
closed fragment of their task.

A byte where a word starts after a single space is a boundary of both tokenizers (the first one
starts a match of its pattern there, the second has no piece with a space inside). So the
stretches between such bytes are tokenized and aligned once per task and looked up afterwards.

Counts of linked id pairs are summed over the corpus as rows (pair, count): each batch of texts
gives its distinct pairs once and asks for the totals of exactly these.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import reduce
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.llm.arrow_text import bounded_batches
from pulseboard.session import stage

#: Bytes of a document's chunk, documents above it are reduced as a tree of chunks.
CHUNK = 1 << 16
#: Characters of text whose pairs are counted together. A piece is one row, and readers, writers and sorts hold several of a task's rows at once.
PIECE = 1 << 19
#: Fragments composed by one group of the tree.
FAN = 16
#: Words that are tokenized as one text.
RUN = 256
#: Words, and bytes of words, that a worker remembers from one batch to the next.
KNOWN_WORDS, KNOWN_BYTES = 100_000, 1 << 23

_CUT = re.compile(r"(?<=\S) (?=\S)")
_SHIFT = 32
_BATCH = ("batch bigint, row array<bigint>, pos array<bigint>, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, "
          "n_groups array<bigint>, n_links array<bigint>, sha array<string>, body array<binary>, "
          "words binary, word_n binary, links binary, link_n binary, keys array<bigint>, key_n array<bigint>")
_CHUNK = "row bigint, doc_id bigint, chunk bigint, a binary, a_end binary, b binary, b_end binary"
_FRAGMENT = ("row bigint, doc_id bigint, node bigint, at bigint, a1 binary, a1_end binary, b1 binary, b1_end binary, "
             "a2 binary, a2_end binary, b2 binary, b2_end binary, closed boolean")
_UNIT = ("row bigint, pos bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
         "count_sum bigint, sha string, body binary")


class Vocabularies(NamedTuple):
    """Contents of the two tokenizer files: a byte-level BPE as JSON, a piece model."""

    byte_level: bytes
    pieces: bytes


def read_vocabularies(byte_level: str, pieces: str) -> Vocabularies:
    with open(byte_level, "rb") as a, open(pieces, "rb") as b:
        return Vocabularies(a.read(), b.read())


def _byte_alphabet() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes as themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Aligned(NamedTuple):
    """Closed units: counts and text of each, and the pair of each link with the links' bounds per unit."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    text: list[bytes]
    pairs: np.ndarray


class Facts(NamedTuple):
    """What is known of stretches: whether they come back, their four counts, their groups as text, and the pairs of all their links on end."""

    whole: np.ndarray
    counts: np.ndarray
    text: np.ndarray
    pairs: np.ndarray

    def of(self, places: np.ndarray) -> Facts:
        n = self.counts[3]
        start, here = np.cumsum(n) - n, n[places]
        at = np.repeat(start[places], here) + np.arange(here.sum()) - np.repeat(np.cumsum(here) - here, here)
        return Facts(self.whole[places], self.counts[:, places], self.text[places], self.pairs[at])


class Aligner:
    """Both tokenizers of a worker process, and the words it has met."""

    _held: dict[bytes, Aligner] = {}

    @classmethod
    def of(cls, files: Vocabularies) -> Aligner:
        key = hashlib.sha256(files.byte_level + files.pieces).digest()
        if key not in cls._held:
            cls._held.clear()
            cls._held[key] = cls(files)
        return cls._held[key]

    def __init__(self, files: Vocabularies):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_str(files.byte_level.decode())
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_proto=files.pieces)
        letters = _byte_alphabet()
        vocabulary = self.first.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(self.first.get_vocab().values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(letters[c] for c in token)
        for token, i in self.first.get_vocab().items():
            if token not in vocabulary:
                self.bytes_a[i] = token.encode()
        self.bytes_b = []
        for i in range(self.second.get_piece_size()):
            piece = self.second.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:-1], 16)]) if self.second.is_byte(i) else piece.replace("▁", " ").encode())
        self.len_a = np.array([len(b) for b in self.bytes_a], np.int64)
        self.len_b = np.array([len(b) for b in self.bytes_b], np.int64)
        # Every id as decimal text before each of the three marks.
        ids = range(max(len(self.bytes_a), len(self.bytes_b)))
        self.width = len(ids)
        self.shown = np.array([b"%d%s" % (i, mark) for mark in (b",", b"|", b";") for i in ids], object)
        # Some words are enough to see whether a piece reaches over a word's start.
        self.splits = not any("▁" in self.second.id_to_piece(i).lstrip("▁") for i in range(self.second.get_piece_size()))
        pre = json.loads(files.byte_level)["pre_tokenizer"] or {}
        self.splits &= pre.get("type") == "ByteLevel" and bool(pre.get("use_regex", True))
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        self.learned: list[Facts] = []

    def stretches(self, text: str) -> list[str]:
        """The stretches of ``text`` between single spaces inside it; each is read with a space before it."""
        return _CUT.split(text) if self.splits else [text]

    def tokens(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the words, each after a space, by both tokenizers on end; their bytes; whether both hold exactly these bytes.

        A word that one of them does not give back has no ids and no bytes.
        """
        # Words that begin and end visibly are read as one text: a space between them is a boundary.
        plain = [self.splits and bool(w) and not (w[0].isspace() or w[-1].isspace()) for w in words]
        runs, start = [], 0
        for k in range(1, len(words) + 1):
            if k == len(words) or k - start == RUN or not (plain[k] and plain[k - 1]):
                runs.append((start, k))
                start = k
        a, b, whole = [], [], np.ones(len(words), bool)
        first = self.first.encode_batch_fast([" " + " ".join(words[s:e]) for s, e in runs], add_special_tokens=False)
        second = self.second.encode([" ".join(words[s:e]) for s, e in runs], num_threads=1)
        for (s, e), x, y in zip(runs, first, second, strict=True):
            ids, raw = x.ids, (" " + " ".join(words[s:e])).encode()
            if self._gives(self.bytes_a, ids, raw) and self._gives(self.bytes_b, y, raw):
                a.append(ids)
                b.append(y)
            elif e - s == 1:
                whole[s] = False
            else:
                for k in range(s, e):
                    own_a, own_b, _, own = self.tokens(words[k:k + 1])
                    a.append(own_a.tolist())
                    b.append(own_b.tolist())
                    whole[k] = own[0]
        size = np.fromiter((1 + len(w.encode()) for w in words), np.int64, len(words)) * whole
        return np.fromiter(chain.from_iterable(a), np.int64), np.fromiter(chain.from_iterable(b), np.int64), size, whole

    @staticmethod
    def _gives(table: list[bytes], ids: list[int], raw: bytes) -> bool:
        return b"".join(map(table.__getitem__, ids)) == raw

    def align(self, a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray, stops: np.ndarray) -> Aligned:
        """Groups and links of closed units that lie on end and stop at the bytes ``stops`` (counted from 0)."""
        n = len(stops)
        if n == 0 or len(a) == 0:
            none = np.zeros(n, np.int64)
            return Aligned(none, none, none, none, [b""] * n, np.zeros(0, np.int64))
        marks = np.zeros(int(stops[-1]) + 1, np.uint8)
        marks[a_end] |= 1
        marks[b_end] |= 2
        ends = np.flatnonzero(marks)
        kind = marks[ends]
        is_a, is_b, both = (kind & 1) > 0, (kind & 2) > 0, kind == 3
        seen_a, seen_b, seen = np.cumsum(is_a), np.cumsum(is_b), np.cumsum(both)
        # The bytes up to each end belong to one token of either side: one link.
        pairs = (a[seen_a - is_a].astype(np.int64) << _SHIFT) | b[seen_b - is_b]
        group = seen - both
        before_b = np.concatenate([[0], seen_b[both]])
        through_a = seen_a[both]
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + before_b[group[is_a]]] = a + self.width * both[is_a]
        order[np.arange(len(b)) + through_a[group[is_b]]] = b + 2 * self.width * both[is_b]
        at = np.concatenate([[0], np.searchsorted(ends, stops, side="right")])
        cum = [np.concatenate([[0], s])[at] for s in (seen_a, seen_b, seen)]
        text = self.shown[order].tolist()
        token_at = (cum[0] + cum[1]).tolist()
        return Aligned(np.diff(cum[0]), np.diff(cum[1]), np.diff(cum[2]), np.diff(at),
                       [b"".join(text[s:e])[:-1] for s, e in zip(token_at[:-1], token_at[1:], strict=True)], pairs)

    def learn(self, words: list[str]) -> None:
        """Tokenize and align words that are not known yet."""
        a, b, size, whole = self.tokens(words)
        got = self.align(a, np.cumsum(self.len_a[a]), b, np.cumsum(self.len_b[b]), np.cumsum(size))
        first = len(self.known)
        self.learned.append(Facts(whole, np.stack([got.n_a, got.n_b, got.n_groups, got.n_links]), np.array(got.text, object), got.pairs))
        self.known.update(zip(words, range(first, first + len(words)), strict=True))
        self.held += sum(map(len, words))

    def look_up(self, words: list[str]) -> np.ndarray:
        """The place of each word among the known ones."""
        new = list({w: None for w in words if w not in self.known})
        if new:
            self.learn(new)
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def facts(self) -> Facts:
        """The facts of all known words."""
        if len(self.learned) != 1:
            parts = list(zip(*self.learned, strict=True)) or [[np.zeros(0, bool)], [np.zeros((4, 0), np.int64)], [np.zeros(0, object)], [np.zeros(0, np.int64)]]
            self.learned = [Facts(*(np.concatenate(p, axis=-1) for p in parts))]
        return self.learned[0]

    def full(self) -> bool:
        """Whether the known words have become too many."""
        return len(self.known) > KNOWN_WORDS or self.held > KNOWN_BYTES


def _per_text(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between the bounds ``at``."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[at[1:]] - total[at[:-1]]


def _packed(values: np.ndarray) -> bytes:
    """Counts or places in the fewest bytes that hold the largest, behind the width."""
    width = next(w for w in (1, 2, 4, 8) if not len(values) or values.max() < 1 << 8 * w)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def _bounds(sizes: np.ndarray | list[int]) -> np.ndarray:
    """Bounds of stretches of the given sizes that lie on end."""
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


class _Piece(NamedTuple):
    """Units and the stretches they consist of."""

    row: list
    pos: list
    doc_id: list
    facts: Facts
    words: np.ndarray
    word_at: np.ndarray
    hashed: bool


def _batch_row(number: int, p: _Piece) -> dict[str, list]:
    """One row with the units of a piece, their stretches, the stretches' links and the distinct pairs."""
    n_links = p.facts.counts[3]
    often = np.bincount(p.words, minlength=len(n_links))
    keys, links = np.unique(p.facts.pairs, return_inverse=True)
    key_n = np.bincount(links, weights=np.repeat(often, n_links), minlength=len(keys)).astype(np.int64)
    counts = [_per_text(x[p.words], p.word_at) for x in p.facts.counts]
    text = p.facts.text[p.words].tolist()
    bodies = [b";".join(text[s:e]) for s, e in zip(p.word_at[:-1].tolist(), p.word_at[1:].tolist(), strict=True)]
    values = {
        "batch": number, "row": p.row, "pos": p.pos, "doc_id": p.doc_id,
        "n_a": counts[0], "n_b": counts[1], "n_groups": counts[2], "n_links": counts[3],
        "sha": [hashlib.sha256(t).hexdigest() if t else "" for t in bodies] if p.hashed else [None] * len(bodies),
        "body": [None] * len(bodies) if p.hashed else bodies,
        "words": _packed(p.words), "word_n": _packed(np.diff(p.word_at)), "links": _packed(links), "link_n": _packed(n_links),
        "keys": keys, "key_n": key_n,
    }
    return {k: [v] for k, v in values.items()}


def _arrow(schema: str, columns: dict[str, list]) -> pa.RecordBatch:
    """A record batch of the given columns, null where a column is not given."""
    rows = len(next(iter(columns.values())))
    types = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    arrays, names = [], []
    for name, kind in (part.split(" ") for part in schema.split(", ")):
        inner = kind.removeprefix("array<").removesuffix(">")
        what = pa.list_(types[inner]) if kind != inner else types[kind]
        names.append(name)
        given = columns.get(name)
        if given is None:
            arrays.append(pa.nulls(rows, what))
        elif kind != inner and len(given) == 1 and isinstance(given[0], np.ndarray):
            arrays.append(pa.ListArray.from_arrays(pa.array([0, len(given[0])], pa.int32()), pa.array(given[0]).cast(types[inner])))
        else:
            arrays.append(pa.array(given, what))
    return pa.RecordBatch.from_arrays(arrays, names)


def _chunks(row: int, doc_id: int | None, a: np.ndarray, b: np.ndarray, tool: Aligner, chunk: int) -> dict[str, list]:
    """A document's tokens by the byte range that their ends fall into."""
    a_end, b_end = np.cumsum(tool.len_a[a]), np.cumsum(tool.len_b[b])
    edges = np.arange(chunk, int(a_end[-1]) + chunk, chunk)
    out = {"row": [row] * len(edges), "doc_id": [doc_id] * len(edges), "chunk": list(range(len(edges)))}
    for name, ids, end in (("a", a, a_end), ("b", b, b_end)):
        at = np.concatenate([[0], np.searchsorted(end, edges, side="right")]).tolist()
        out[name] = [ids[s:e].tobytes() for s, e in zip(at[:-1], at[1:], strict=True)]
        out[f"{name}_end"] = [end[s:e].tobytes() for s, e in zip(at[:-1], at[1:], strict=True)]
    return out


def _numbers(task: int) -> Iterator[int]:
    """Numbers that no other task of the stage gives out."""
    at = task << 33
    while True:
        yield at
        at += 1


def _tokenized(files: Vocabularies, chunk: int, piece: int):
    """Texts to rows that hold a batch of whole documents, or one chunk of a longer one."""
    schema = f"{_BATCH}, {_CHUNK.replace('row bigint, doc_id bigint', 'long_row bigint, long_id bigint')}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, number = Aligner.of(files), _numbers(TaskContext.get().partitionId())

        def flush() -> pa.RecordBatch:
            places = np.concatenate(found)
            # A text with a stretch that does not come back has no tokens at all.
            keep = np.repeat(_per_text(~tool.facts().whole[places], _bounds(sizes)) == 0, sizes)
            distinct, numbers = np.unique(places[keep], return_inverse=True)
            at = np.concatenate([[0], np.cumsum(keep)])[_bounds(sizes)]
            out = _batch_row(next(number), _Piece([next(number) for _ in ids], [0] * len(ids), ids, tool.facts().of(distinct), numbers, at, True))
            return _arrow(schema, out)

        ids, found, sizes, held = [], [], [], 0
        for batch in batches:
            texts = batch.column(1).to_pylist()
            words = [tool.stretches(t) if t else [] for t in texts]
            places = tool.look_up(list(chain.from_iterable(words)))
            at = _bounds(list(map(len, words)))
            for k, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), texts, strict=True)):
                own = places[at[k]:at[k + 1]]
                if text and len(text.encode()) >= chunk:
                    if tool.facts().whole[own].all():
                        yield from _long(schema, next(number), doc_id, words[k], tool, chunk)
                        continue
                    own = own[:0]
                ids.append(doc_id)
                found.append(own)
                sizes.append(len(own))
                held += len(text or "")
                if held >= piece:
                    yield flush()
                    ids, found, sizes, held = [], [], [], 0
            # The places hold until words are forgotten.
            if tool.full():
                if ids:
                    yield flush()
                    ids, found, sizes, held = [], [], [], 0
                tool.forget()
        if ids:
            yield flush()
        # Workers outlive their task; what they hold is not there for the next stage.
        tool.forget()

    return run, schema


def _long(schema: str, row: int, doc_id: int | None, words: list[str], tool: Aligner, chunk: int) -> Iterator[pa.RecordBatch]:
    """The chunk rows of a long document."""
    a, b, _, _ = tool.tokens(words)
    rows = _chunks(row, doc_id, a, b, tool, chunk)
    rows["long_row"], rows["long_id"] = rows.pop("row"), rows.pop("doc_id")
    yield _arrow(schema, rows)


class Tokens(NamedTuple):
    """A run of both tokenizers' ids with the bytes where they end."""

    a: np.ndarray
    a_end: np.ndarray
    b: np.ndarray
    b_end: np.ndarray

    def __add__(self, other: Tokens) -> Tokens:  # type: ignore[override]
        return Tokens(*(np.concatenate(pair) for pair in zip(self, other, strict=True)))

    def up_to(self, byte: int) -> tuple[Tokens, Tokens]:
        """The tokens that end at ``byte`` or before, and those after it."""
        i, j = np.searchsorted(self.a_end, byte, side="right"), np.searchsorted(self.b_end, byte, side="right")
        return (Tokens(self.a[:i], self.a_end[:i], self.b[:j], self.b_end[:j]),
                Tokens(self.a[i:], self.a_end[i:], self.b[j:], self.b_end[j:]))


NO_TOKENS = Tokens(*[np.zeros(0, np.int64)] * 4)


class Fragment(NamedTuple):
    """What is open at both ends of a byte range; ``closed`` if a group ends in it, and then ``at`` is the chunk of the first such end.

    Without an end inside, all tokens are the prefix.
    """

    prefix: Tokens
    suffix: Tokens
    closed: bool
    at: int


def fragment(tokens: Tokens, chunk: int) -> tuple[Fragment, Tokens]:
    """The fragment of a chunk, and the tokens of its closed groups. A document's start counts as an end."""
    ends = np.intersect1d(tokens.a_end, tokens.b_end, assume_unique=True)
    if chunk == 0:
        ends = np.concatenate([[0], ends])
    if not len(ends):
        return Fragment(tokens, NO_TOKENS, False, -1), NO_TOKENS
    prefix, rest = tokens.up_to(int(ends[0]))
    inside, suffix = rest.up_to(int(ends[-1]))
    return Fragment(prefix, suffix, True, chunk), inside


def compose(x: Fragment, y: Fragment) -> tuple[Fragment, tuple[int, Tokens] | None]:
    """The fragment of two adjacent ranges, and the group that closes between them with the chunk it closes in."""
    if not x.closed:
        return Fragment(x.prefix + y.prefix, y.suffix, y.closed, y.at), None
    if not y.closed:
        return Fragment(x.prefix, x.suffix + y.prefix, True, x.at), None
    return Fragment(x.prefix, y.suffix, True, x.at), (y.at, x.suffix + y.prefix)


def _ints(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.int64)


def _units(tool: Aligner, number: int, rows: list[tuple[int, int, int | None, Tokens]]) -> dict[str, list]:
    """A batch row of closed token runs (document row, place, document id, tokens)."""
    shift, stop, parts = 0, [], []
    for _, _, _, t in rows:
        start = int(min(t.a_end[0] - tool.len_a[t.a[0]], t.b_end[0] - tool.len_b[t.b[0]]))
        parts.append(Tokens(t.a, t.a_end - start + shift, t.b, t.b_end - start + shift))
        shift += int(t.a_end[-1]) - start
        stop.append(shift)
    flat = Tokens(*(np.concatenate(x) for x in zip(*parts, strict=True)))
    got = tool.align(*flat, np.array(stop))
    facts = Facts(np.ones(len(rows), bool), np.stack([got.n_a, got.n_b, got.n_groups, got.n_links]), np.array(got.text, object), got.pairs)
    doc_row, pos, ids, _ = zip(*rows, strict=True)
    return _batch_row(number, _Piece(list(doc_row), list(pos), list(ids), facts, np.arange(len(rows)), np.arange(len(rows) + 1), False))


def _fragment_columns(row: int, doc_id: int | None, node: int, f: Fragment) -> dict[str, list]:
    held = zip(("a1", "a1_end", "b1", "b1_end", "a2", "a2_end", "b2", "b2_end"), (*f.prefix, *f.suffix), strict=True)
    return {"row": [row], "doc_id": [doc_id], "node": [node], "at": [f.at], "closed": [f.closed]} | {k: [v.tobytes()] for k, v in held}


def _fragments(files: Vocabularies, piece: int):
    """Chunk rows to their fragments and to batches of their closed groups."""
    kind = _FRAGMENT.replace("row bigint, doc_id bigint", "long_row bigint, long_id bigint")
    schema = f"{_BATCH}, {kind}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, number = Aligner.of(files), _numbers(TaskContext.get().partitionId() + (1 << 28))
        for batch in batches:
            units, held = [], 0
            for r in batch.to_pylist():
                f, inside = fragment(Tokens(*(_ints(r[c]) for c in ("a", "a_end", "b", "b_end"))), r["chunk"])
                if len(inside.a):
                    units.append((r["row"], 2 * r["chunk"] + 1, r["doc_id"], inside))
                    held += int(inside.a_end[-1] - inside.a_end[0])
                if held >= piece:
                    yield _arrow(schema, _units(tool, next(number), units))
                    units, held = [], 0
                columns = _fragment_columns(r["row"], r["doc_id"], r["chunk"], f)
                columns["long_row"], columns["long_id"] = columns.pop("row"), columns.pop("doc_id")
                yield _arrow(schema, columns)
            if units:
                yield _arrow(schema, _units(tool, next(number), units))

    return run, schema


def _reduced(group: pa.Table) -> pa.Table:
    """Compose the fragments of one node, in order. Groups that close are rows without a node (their place is in ``at``)."""
    group = group.sort_by("node")
    out, done, total = [], [], None
    rows = group.to_pylist()
    for r in rows:
        f = Fragment(Tokens(*(_ints(r[c]) for c in ("a1", "a1_end", "b1", "b1_end"))),
                     Tokens(*(_ints(r[c]) for c in ("a2", "a2_end", "b2", "b2_end"))), r["closed"], r["at"])
        if total is None:
            total = f
            continue
        total, closed = compose(total, f)
        if closed:
            done.append(closed)
    row, doc_id = rows[0]["row"], rows[0]["doc_id"]
    out.append(_arrow(_FRAGMENT, _fragment_columns(row, doc_id, rows[0]["node"] // FAN, total)))
    for at, tokens in done:
        if len(tokens.a):
            columns = _fragment_columns(row, doc_id, 0, Fragment(tokens, NO_TOKENS, True, at))
            out.append(_arrow(_FRAGMENT, columns | {"node": [None]}))
    return pa.Table.from_batches(out)


def _border_units(files: Vocabularies):
    """Groups that closed between chunks, as batch rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, number = Aligner.of(files), _numbers(TaskContext.get().partitionId() + (1 << 29))
        for batch in batches:
            rows = [(r["row"], 2 * r["at"], r["doc_id"], Tokens(*(_ints(r[c]) for c in ("a1", "a1_end", "b1", "b1_end"))))
                    for r in batch.to_pylist()]
            if rows:
                yield _arrow(_BATCH, _units(tool, next(number), rows))

    return run


def _tree(chunks: DataFrame, files: Vocabularies, piece: int) -> DataFrame:
    """Batch rows of long documents: the closed groups of each chunk, then those that close between chunks, level by level."""
    run, schema = _fragments(files, piece)
    spread = chunks.repartition("row", "chunk")
    leaves = stage(spread.mapInArrow(run, schema), "fragments")
    names = [part.split(" ")[0] for part in _BATCH.split(", ")]
    batches = leaves.where("batch is not null").select(*names)
    inner = [c for c in (part.split(" ")[0] for part in _FRAGMENT.split(", ")) if c not in ("row", "doc_id")]
    level = leaves.where("node is not null").select(F.col("long_row").alias("row"), F.col("long_id").alias("doc_id"), *inner)
    closed = []
    while not level.where("node > 0").isEmpty():
        reduced = stage(level.withColumn("up", F.expr(f"node div {FAN}")).groupBy("row", "up").applyInArrow(
            lambda key, table: _reduced(table.drop_columns(["up"])), _FRAGMENT), "reduced")
        closed.append(reduced.where("node is null"))
        level = reduced.where("node is not null")
    return batches.unionByName(reduce(DataFrame.unionByName, closed).mapInArrow(_border_units(files), _BATCH)) if closed else batches


def pair_totals(batches: DataFrame) -> DataFrame:
    """(pair, count, best): links of each id pair in the corpus, and whether no pair of its second id has more."""
    totals = (batches.select(F.explode(F.arrays_zip("keys", "key_n")).alias("e"))
              .groupBy(F.col("e.keys").alias("pair")).agg(F.sum("e.key_n").alias("count")))
    totals = stage(totals, "pairs").withColumn("b", F.col("pair").bitwiseAND((1 << _SHIFT) - 1))
    most = totals.groupBy("b").agg(F.max("count").alias("most"))
    return totals.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def _scored(left: pa.Table, right: pa.Table) -> pa.Table:
    """The units of a batch with the totals of their links."""
    out = []
    for r in range(left.num_rows):
        value = lambda name: left.column(name)[r].values  # noqa: B023, E731
        array = lambda name: _unpacked(left.column(name)[r].as_py())  # noqa: B023, E731
        # Each distinct pair of the batch has asked for its totals.
        count, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        place = right.column("place").to_numpy()
        count[place] = right.column("count").to_numpy()
        best[place] = right.column("best").to_numpy(zero_copy_only=False)
        links, words, link_at, word_at = array("links"), array("words"), _bounds(array("link_n")), _bounds(array("word_n"))
        sums = [_per_text(_per_text(x[links], link_at)[words], word_at) for x in (best, count)]
        plain = {c: value(c) for c in ("row", "pos", "doc_id", "n_a", "n_b", "n_groups", "n_links", "sha", "body")}
        out.append(_arrow(_UNIT, plain | {"n_best": sums[0], "count_sum": sums[1]}))
    return pa.Table.from_batches(out, _arrow(_UNIT, {"row": []}).schema)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units in the order of their documents and places to one row per document; the text is hashed as it passes."""
    now, sums, digest = None, None, None
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")

    def row() -> pa.RecordBatch:
        return _arrow(_UNIT, {"row": [now[0]], "pos": [0], "doc_id": [now[1]], "sha": [digest.hexdigest()]}
                      | {n: [s] for n, s in zip(names, sums, strict=True)})

    for batch in batches:
        for r in batch.to_pylist():
            if now is None or now[0] != r["row"]:
                if now is not None:
                    yield row()
                now, sums, digest = (r["row"], r["doc_id"]), [0] * len(names), hashlib.sha256()
            elif r["body"]:
                digest.update(b";")
            digest.update(r["body"])
            sums = [s + r[n] for s, n in zip(sums, names, strict=True)]
    if now is not None:
        yield row()


def aligned(docs: DataFrame, files: Vocabularies, id_col: str = "doc_id", text_col: str = "text",
            chunk: int = CHUNK, piece: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """One row per row of ``docs``, and the totals of all linked pairs.

    The first table has ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose pair is the most
    frequent of its second id, ties included), ``count_sum`` (over links) and ``groups_sha256``; the second
    ``a``, ``b``, ``count`` and ``best``.

    Null and empty texts, and texts that one of the tokenizers does not give back byte by byte, have no tokens:
    zeros and an empty ``groups_sha256``. Repeated rows each get a row and count each; a null id stays null. Texts are read whole.
    Columns other than the two named are not read. An empty table gives empty results.
    """
    bounded_batches()
    run, schema = _tokenized(files, chunk, piece)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    first = stage(texts.mapInArrow(run, schema), "aligned")
    names = [part.split(" ")[0] for part in _BATCH.split(", ")]
    batches = first.where("batch is not null").select(*names)
    chunks = (first.where("chunk is not null")
              .select(F.col("long_row").alias("row"), F.col("long_id").alias("doc_id"), "chunk", "a", "a_end", "b", "b_end"))
    if not chunks.isEmpty():
        batches = batches.unionByName(stage(_tree(chunks, files, piece), "long"))
    totals = stage(pair_totals(batches), "totals")
    asked = (batches.select(F.col("batch").alias("asking"), F.posexplode("keys").alias("place", "pair"))
             .join(totals, "pair").select("asking", "place", "count", "best"))
    units = batches.drop("keys", "key_n").groupBy("batch").cogroup(asked.groupBy("asking")).applyInArrow(_scored, _UNIT)
    units = stage(units, "units")
    parts = units.where("sha is null").repartition("row").sortWithinPartitions("row", "pos").mapInArrow(_joined, _UNIT)
    rows = units.where("sha is not null").unionByName(parts)
    out = rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("sha").alias("groups_sha256"))
    pairs = totals.select(F.shiftright("pair", _SHIFT).alias("a"), F.col("pair").bitwiseAND((1 << _SHIFT) - 1).alias("b"), "count", "best")
    return out, pairs


def align_documents(docs: DataFrame, files: Vocabularies, **options) -> DataFrame:
    """The first table of ``aligned``."""
    return aligned(docs, files, **options)[0]

