"""Byte-level BPE by recursive queries.

Each partition has one in-memory DuckDB session with the merge table. The words of its texts that it has not met
before become token-position rows. Byte pairs that no other merge can come before are contracted first; then a recursive
query joins neighbouring tokens to the merge table and contracts, in every word, the leftmost pair of the smallest rank,
until no pair of a word can be merged. An
ordered aggregation over the tokens' bytes decodes them. Texts are split by the pattern first; each match is
encoded separately, so a text's tokens are its words' tokens on end.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseboard.llm.arrow_text import bounded_batches, pieces, texts

#: Words of a generation that a worker keeps between batches. A full one becomes the former one, from which words that come again are taken over.
KEPT_WORDS = 200_000
#: Words of up to this many bytes are not looked through for places to cut.
UNCUT_BYTES = 64
#: Stretches of a word longer than this (bytes) go through ``CONTRACT_RUNS``: the same contractions, many in a step.
LONG_BYTES = 200
NEVER = 2**31 - 1

_FIXPOINT = """
SELECT word, array_to_string(list_transform(tokens, lambda t: t.id), ',') AS ids,
       unhex(array_to_string(list_transform(tokens, lambda t: t.hex), '')) AS decoded
FROM (SELECT s.word, list({'id': v.id, 'hex': v.hex} ORDER BY s.pos) AS tokens
      FROM state s JOIN vocabulary v ON v.token = s.token WHERE s.done GROUP BY s.word)
"""

#: Places count on from word to word, so one order serves all words.
CONTRACT = """
WITH RECURSIVE state(word, pos, token, done) AS (
    SELECT word, pos, token, false FROM start
  UNION ALL
    (WITH pairs AS MATERIALIZED (
        SELECT p.word, p.pos, p.token, p.before, m.rank
        FROM (SELECT word, pos, token, CASE WHEN lead(word) OVER w = word THEN lead(token) OVER w END AS follower, lag(pos) OVER w AS before
              FROM state WHERE NOT done WINDOW w AS (ORDER BY pos)) p
        LEFT JOIN merges m ON m.left_token = p.token AND m.right_token = p.follower),
      best AS (SELECT word, min(rank::BIGINT * 4294967296 + pos) AS best FROM pairs GROUP BY word)
     SELECT word, pos, CASE WHEN pos = best % 4294967296 THEN rank ELSE token END, best IS NULL
     FROM pairs JOIN best USING (word)
     WHERE best IS NULL OR before IS DISTINCT FROM best % 4294967296)
)""" + _FIXPOINT

#: A step takes a word's places of the smallest rank from the left, every second one where they overlap, up to the first
#: whose outcome could pair with a neighbour at a smaller rank still (``lower`` has those merges): there the order changes.
CONTRACT_RUNS = """
WITH RECURSIVE state(word, pos, token, done) AS (
    SELECT word, pos, token, false FROM start
  UNION ALL
    (WITH pairs AS MATERIALIZED (
        SELECT p.*, m.rank
        FROM (SELECT word, pos, token, lead(token) OVER w AS follower, lead(token, 2) OVER w AS second, lag(token) OVER w AS former,
                     lag(pos) OVER w AS before, row_number() OVER w AS k
              FROM state WHERE NOT done WINDOW w AS (PARTITION BY word ORDER BY pos)) p
        LEFT JOIN merges m ON m.left_token = p.token AND m.right_token = p.follower),
      best AS MATERIALIZED (SELECT word, min(rank) AS best FROM pairs GROUP BY word),
      hits AS (
        SELECT word, pos, former, second, best, k, k - row_number() OVER (PARTITION BY word ORDER BY k) AS run
        FROM pairs JOIN best USING (word) WHERE rank = best),
      chosen AS MATERIALIZED (
        SELECT word, pos, former, second, best FROM hits
        QUALIFY row_number() OVER (PARTITION BY word, run ORDER BY k) % 2 = 1),
      turns AS (
        SELECT c.word, min(c.pos) AS last FROM chosen c
        JOIN lower l ON l.made = c.best AND (l.left_token IN (c.former, c.best) AND l.right_token = c.best
                                             OR l.left_token = c.best AND l.right_token IN (c.second, c.best))
        GROUP BY c.word),
      taken AS MATERIALIZED (
        SELECT c.word, c.pos, c.best FROM chosen c LEFT JOIN turns t USING (word) WHERE t.last IS NULL OR c.pos <= t.last)
     SELECT p.word, p.pos, coalesce(t.best, p.token), b.best IS NULL
     FROM pairs p JOIN best b ON b.word = p.word
     LEFT JOIN taken t ON t.word = p.word AND t.pos = p.pos
     LEFT JOIN taken gone ON gone.word = p.word AND gone.pos = p.before
     WHERE gone.pos IS NULL)
)""" + _FIXPOINT


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


class Coder:
    """Encodes and decodes words; ``ranks`` is the content of a rank file (base64 bytes and number per line)."""

    def __init__(self, ranks: bytes):
        import duckdb

        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.spelled = {number: token for token, number in self.ranks.items()}
        left, right, merged = [], [], []
        self.meets = np.zeros((256, 256), bool)
        # Of two bytes: the token they make, and the smallest rank at which a token that ends in the first takes in the
        # second, and at which the first takes in a token that begins with the second.
        self.makes, self.gives_second, self.gives_first = (np.full((256, 256), NEVER, np.int32) for _ in range(3))
        for token, number in self.ranks.items():
            for cut in range(1, len(token)):
                self.meets[token[cut - 1], token[cut]] = True
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(number)
                    for is_byte, least in ((cut == len(token) - 1, self.gives_second), (cut == 1, self.gives_first)):
                        if is_byte:
                            least[token[cut - 1], token[cut]] = min(least[token[cut - 1], token[cut]], number)
        self.byte_token = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB"})
        vocabulary = pa.table({"token": pa.array(self.spelled, pa.int32()), "id": [str(t) for t in self.spelled],
                               "bytes": pa.array(self.spelled.values(), pa.binary()), "hex": [b.hex() for b in self.spelled.values()]})
        names = ("left_token", "right_token", "rank", "made")
        merges = pa.table({n: pa.array(c, pa.int32()) for n, c in zip(names, (left, right, merged), strict=False)})
        # Merges that take in a token made at a larger rank.
        rows = [(a, b, m, made) for a, b, m in zip(left, right, merged, strict=True) for made in {a, b} if m < made]
        lower = pa.table({n: pa.array([r[k] for r in rows], pa.int32()) for k, n in enumerate(names)})
        turning = {made for *_, made in rows}
        for token, number in self.ranks.items():
            if len(token) == 2 and number not in turning:
                self.makes[token[0], token[1]] = number
        for name, table in (("vocabulary", vocabulary), ("merges", merges), ("lower", lower)):
            self.db.register("rows", table)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM rows")
            self.db.unregister("rows")
        self.known: dict[str, tuple[str, bytes]] = {}
        self.former: dict[str, tuple[str, bytes]] = {}

    def learn(self, words: Iterable[str]) -> None:
        """Encode and decode words and remember the outcome in ``known``: ids as text, decoded bytes."""
        missing = [w for w in words if w not in self.known]
        if len(self.known) + len(missing) > KEPT_WORDS:
            self.former, self.known = self.known, {}
            missing = list(words)
        fresh = []
        for word in missing:
            kept = self.former.get(word)
            if kept is None:
                fresh.append(word)
            else:
                self.known[word] = kept
        for at in range(0, len(fresh), 100_000):
            self._learn(fresh[at:at + 100_000])

    def _learn(self, words: list[str]) -> None:
        known, ranks = self.known, self.ranks
        plain: list[str] = []  # words of one stretch, and their bytes
        raws: list[bytes] = []
        whole: list[tuple[str, int]] = []
        cut: list[tuple[str, int, int]] = []  # words of several stretches: where those begin and end in ``stretches``
        stretches: list[bytes] = []
        for word in words:
            raw = word.encode()
            token = ranks.get(raw)
            if token is not None:  # a word that is a token itself is that token
                whole.append((word, token))
            elif len(raw) <= UNCUT_BYTES:
                plain.append(word)
                raws.append(raw)
            else:
                first = len(stretches)
                stretches += self._stretches(raw)
                cut.append((word, first, len(stretches)))
        known.update(zip(plain, self._recurse(raws, CONTRACT), strict=True))
        known.update(zip([w for w, _ in whole], self._decode([t for _, t in whole]), strict=True))
        if cut:
            long = [k for k, s in enumerate(stretches) if len(s) > LONG_BYTES]
            short = [k for k, s in enumerate(stretches) if len(s) <= LONG_BYTES]
            ready = dict(zip(short, self._recurse([stretches[k] for k in short], CONTRACT), strict=True))
            ready.update(zip(long, self._recurse([stretches[k] for k in long], CONTRACT_RUNS), strict=True))
            for word, first, end in cut:
                ids, decoded = zip(*(ready[k] for k in range(first, end)), strict=True)
                known[word] = ",".join(ids), b"".join(decoded)

    def _stretches(self, raw: bytes) -> list[bytes]:
        """Cut a long word where two bytes meet that no token holds together: no merge crosses there."""
        data = np.frombuffer(raw, np.uint8)
        cuts = np.flatnonzero(~self.meets[data[:-1], data[1:]]) + 1
        edges = [0, *cuts.tolist(), len(raw)]
        return [raw[a:b] for a, b in zip(edges, edges[1:], strict=False)]

    def _start(self, stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word, place and token of every byte, after the byte pairs that are contracted in any case.

        Such a pair has a smaller rank than every merge that could take its first byte to the left or its second to the
        right, so nothing takes them before; and its token is part of no merge of a smaller rank, so made early it
        changes no later choice. Two such pairs never overlap.
        """
        lengths = np.fromiter(map(len, stretches), np.int64, len(stretches))
        data = np.frombuffer(b"".join(stretches), np.uint8)
        word = np.repeat(np.arange(len(stretches), dtype=np.int32), lengths)
        token = self.byte_token[data]
        both = data[:-1], data[1:]
        apart = word[:-1] != word[1:]
        rank, left, right = (np.where(apart, NEVER, table[both]) for table in (self.makes, self.gives_second, self.gives_first))
        sure = rank < NEVER
        sure[1:] &= rank[1:] < left[:-1]
        sure[:-1] &= rank[:-1] < right[1:]
        at = np.flatnonzero(sure)
        token[at] = rank[at]
        left_over = np.ones(len(data), bool)
        left_over[at + 1] = False
        pos = np.flatnonzero(left_over)
        return word[pos], pos, token[pos]

    def _recurse(self, stretches: list[bytes], query: str) -> list[tuple[str, bytes]]:
        if not stretches:
            return []
        self.db.register("start", pa.table(dict(zip(("word", "pos", "token"), self._start(stretches), strict=True))))
        got = self.db.sql(query).to_arrow_table()
        self.db.unregister("start")
        got = got.take(pa.array(np.argsort(got.column("word").to_numpy())))
        return list(zip(*(got.column(c).to_pylist() for c in ("ids", "decoded")), strict=True))

    def _decode(self, tokens: list[int]) -> list[tuple[str, bytes]]:
        """Words that are one token, decoded by the vocabulary table."""
        if not tokens:
            return []
        self.db.register("given", pa.table({"pos": np.arange(len(tokens)), "token": np.array(tokens, np.int32)}))
        got = self.db.execute("SELECT v.id, v.bytes FROM given JOIN vocabulary v USING (token) ORDER BY pos").fetchall()
        self.db.unregister("given")
        return got


_CODERS: dict[bytes, Coder] = {}


def coder(ranks: bytes) -> Coder:
    """One coder per worker process and rank file."""
    key = hashlib.sha256(ranks).digest()
    if key not in _CODERS:
        _CODERS[key] = Coder(ranks)
    return _CODERS[key]


_STRUCT = pa.struct([("n_tokens", pa.int64()), ("ids", pa.string()), ("decoded", pa.binary())])
_DIGEST = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encoded_rows(column: pa.Array, ranks: bytes, pattern: str) -> Iterator[tuple[int, str, bytes]]:
    """Per text: number of tokens, ids joined by commas, and the bytes the ids decode to."""
    import regex

    split = regex.compile(pattern).findall
    own = coder(ranks)
    for first, end, _, _ in pieces(column):
        lists = [split(t) for t in texts(column.slice(first, end - first))]
        own.learn(set().union(*lists))
        known = own.known
        for words in lists:
            if not words:
                yield 0, "", b""
                continue
            found = [known[w] for w in words]
            ids = ",".join([i for i, _ in found])
            yield ids.count(",") + 1, ids, b"".join([d for _, d in found])


def encode(text: Column, ranks: bytes, pattern: str, digest: bool = False) -> Column:
    """Struct of a text's tokens: number, ids (decimal, comma-joined), decoded bytes; or the digests of both.

    Null and empty texts have no tokens. Special tokens' strings are ordinary text.
    """
    kind = _DIGEST if digest else _STRUCT
    ddl = ("n_tokens long, ids_sha256 string, decoded_sha256 string" if digest
           else "n_tokens long, ids string, decoded binary")
    bounded_batches()

    @F.arrow_udf(ddl)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = encoded_rows(batch, ranks, pattern)
            if digest:
                rows = ((n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(raw).hexdigest())
                        for n, ids, raw in rows)
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], fields=list(kind))

    return run(text)


def encode_documents(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_tokens``, ``ids`` and the ``decoded`` bytes."""
    return docs.select(F.col(id_col).alias("doc_id"), encode(F.col(text_col), ranks, pattern).alias("e")).select("doc_id", "e.*")
