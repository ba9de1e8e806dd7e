"""Alignment of two tokenizers against whole-text tokenization, text by text."""

import hashlib
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from pulseboard.llm import alignment  # noqa: E402
from pulseboard.llm.catalog import vocabularies  # noqa: E402

LONG = "Wörter und words, 漢字かな mixed; " * 400
ODD = [(0, "Hello  world.\n\tTabs and 漢字 🎉🎉 end "), (1, None), (2, ""), (3, " "), (4, "a ▁ lower block"), (5, LONG), (5, LONG), (None, "no id here"),
       (6, "<|endoftext|> </s> <0x41> <unk>"), (7, "x" * 3_000), (8, "漢" * 900), (9, " lead and trail  "), (10, "nul \0 and\u2028line\x1c sep"), (11, "don't it'S e\u0301 ﬁ ½"),
       (12, "▁" * 700), (13, LONG + "▁")]


def plain(rows, files):
    """Ids of the whole text by both tokenizers, every pair of tokens compared."""
    tool, found, links = alignment.Aligner(files), [], {}
    for _, text in rows:
        a = tool.first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = tool.second.encode(text) if text else []
        raw = b" " + text.encode() if text else b""
        if b"".join(tool.bytes_a[i] for i in a) != raw or b"".join(tool.bytes_b[i] for i in b) != raw:
            a, b = [], []
        spans = []
        for ids, size in ((a, tool.len_a), (b, tool.len_b)):
            stop = np.cumsum(size[ids]).tolist() if ids else []
            spans.append([(i, e - int(size[i]), e) for i, e in zip(ids, stop, strict=True)])
        here, first = [], 0
        for i, s, e in spans[0]:
            while first < len(spans[1]) and spans[1][first][2] <= s:
                first += 1
            at = first
            while at < len(spans[1]) and spans[1][at][1] < e:
                here.append((i, spans[1][at][0]))
                at += 1
        for pair in here:
            links[pair] = links.get(pair, 0) + 1
        cuts, parts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]}), []
        sides = [iter(x) for x in spans]
        for cut in cuts:
            side_texts = []
            for k, side in enumerate(sides):
                ids = []
                for i, _, e in side:
                    ids.append(str(i))
                    if e == cut:
                        break
                side_texts.append(",".join(ids))
            parts.append("|".join(side_texts))
        found.append((len(a), len(b), len(cuts), here, hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else ""))
    most = {}
    for (_, y), n in links.items():
        most[y] = max(most.get(y, 0), n)
    return sorted((str(i), n_a, n_b, n_g, len(here), sum(links[p] == most[p[1]] for p in here), sum(links[p] for p in here), sha)
                  for (i, _), (n_a, n_b, n_g, here, sha) in zip(rows, found, strict=True)), links


def rows_of(df):
    return sorted((str(r["doc_id"]), *(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))) for r in df.collect())


@pytest.fixture(scope="module")
def files():
    return vocabularies()


@pytest.mark.parametrize(("chunk", "piece"), [(1 << 16, 1 << 24), (200, 2_000), (7, 300)])
def test_alignment_equals_whole_texts(spark, files, chunk, piece):
    table = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("row", F.lit(1)).withColumn("batch", F.lit("x"))
    got, pairs = alignment.aligned(table, files, chunk=chunk, piece=piece)
    want, links = plain(ODD, files)
    assert rows_of(got) == want
    assert {(r["a"], r["b"]): r["count"] for r in pairs.collect()} == links


def test_alignment_of_the_given_documents(spark, folder, files):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(alignment.align_documents(docs, files, chunk=5_000)) == plain(rows, files)[0]
    assert alignment.align_documents(docs.limit(0), files).count() == 0


def test_fragments_compose_in_any_order():
    rng = np.random.default_rng(5)
    ends_a, ends_b = np.sort(rng.choice(np.arange(1, 400), 90, replace=False)), np.sort(rng.choice(np.arange(1, 400), 70, replace=False))
    ends_a, ends_b = np.append(ends_a, 400), np.append(ends_b, 400)
    whole = alignment.Tokens(np.arange(len(ends_a)), ends_a, np.arange(len(ends_b)), ends_b)
    parts, rest = [], whole
    for k, edge in enumerate(range(20, 401, 20)):
        here, rest = rest.up_to(edge)
        parts.append(alignment.fragment(here, k)[0])

    def folded(parts):
        """The composition by random neighbours, and the groups that closed."""
        closed = []
        while len(parts) > 1:
            k = int(rng.integers(len(parts) - 1))
            f, group = alignment.compose(parts[k], parts[k + 1])
            parts = [*parts[:k], f, *parts[k + 2:]]
            if group:
                closed.append((group[0], group[1].a.tolist(), group[1].b.tolist()))
        return [x.tolist() for x in (*parts[0].prefix, *parts[0].suffix)], sorted(closed)

    first = folded(parts)
    assert all(folded(parts) == first for _ in range(20))
    assert first[0] == [[]] * 8


def test_a_batch_of_texts_goes_out_in_small_rows(spark, files):
    words = F.transform(F.sequence(F.lit(1), F.lit(150)), lambda i: F.hex(F.xxhash64("id", i) % 5_000))
    texts = spark.range(0, 2_000, 1, 1).select(F.col("id").alias("doc_id"), F.concat_ws(" ", words).alias("text"))
    run, schema = alignment._tokenized(files, alignment.CHUNK, alignment.PIECE)
    rows = texts.mapInArrow(run, schema).collect()
    assert sorted(i for r in rows for i in r["doc_id"]) == list(range(2_000))
    held = [sum(len(v) * (8 if isinstance(v, list) else 1) for v in r if isinstance(v, (list, bytes, bytearray))) for r in rows]
    assert max(held) < 1 << 20


@pytest.mark.parametrize("values", [[], [0], [3, 255], [256, 0], [65_535], [65_536, 1], [1 << 32]])
def test_packed_numbers_come_back(values):
    assert alignment._unpacked(alignment._packed(np.array(values, np.int64))).tolist() == values
