"""The corpus operators against plain versions, and on nulls, empty and long texts, ties, repeats and empty tables."""

import base64
import hashlib
import math
import re
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from pulseboard.llm import bpe, decontaminate, html_text, pii, quality, simhash, suffix_dedup, topk, toxicity, warc  # noqa: E402
from pulseboard.llm.catalog import tokenizer  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 30_000
PROSE = "The quick brown fox jumps over the lazy dog while seven wise owls watch from the old oak tree at night."
ODD = [(0, PROSE), (1, PROSE), (2, "Before. " + PROSE + " After!"), (3, None), (4, ""), (5, "x"), (6, LONG), (7, "é" * 60), (8, "aé" + "é" * 60),
       (9, "a" * 3_000), (9, "a" * 3_000), (None, PROSE), (10, "nul \0 and   line")]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in ODD]
    # A column whose name the operators might use themselves.
    return spark.createDataFrame(rows, DOCS).withColumn("toxicity", F.lit(1)).withColumn("shard", F.lit("x"))


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="module")
def benchmark(spark, folder):
    return spark.read.parquet(f"{folder}/benchmark.parquet")


def plain_windows(rows, items, window=13):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    tests = {}
    for item, text in items:
        w = words(text)
        for at in range(max(1, len(w) - window + 1) if w else 0):
            tests.setdefault(tuple(w[at:at + window]), set()).add(str(item))
    out = []
    for i, text in rows:
        w = words(text)
        hit, found = set(), set()
        for size in {len(t) for t in tests}:
            for at in range(len(w) - size + 1):
                if (items_ := tests.get(tuple(w[at:at + size]))):
                    hit.update(range(at, at + size))
                    found |= items_
        out.append((i, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("pass_bytes", [1 << 20, 400])
def test_decontamination_equals_plain_search(spark, odd, monkeypatch, pass_bytes):
    items = [(1, PROSE), (2, "word"), (3, None), (4, "  !"), (5, "owls watch from"), (6, "word word word"), (10, PROSE.upper()), (7, "x " + PROSE)]
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = odd.select("doc_id", decontaminate.overlap(tests, F.col("text"), pass_bytes=pass_bytes).alias("o")).select("doc_id", "o.*").collect()
    want = plain_windows(ODD, items)
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"]) for r in got) == sorted((str(i), n, h, t) for i, n, h, t, _ in want)
    longest = next(r for r in got if r["doc_id"] == 2)["matches"]
    assert ("1", 0, 1, 21) in {(m["item"], m["item_word"], m["doc_word"], m["words"]) for m in longest}


def test_decontamination_keeps_columns_and_takes_empty_tables(spark, odd, docs, benchmark):
    kept = decontaminate.clean(docs, benchmark)
    assert kept.columns == docs.columns
    flagged = decontaminate.contamination(docs, benchmark).where("contaminated").count()
    assert 0 < flagged and kept.count() == docs.count() - flagged
    assert decontaminate.contamination(odd.limit(0), benchmark).count() == 0
    assert decontaminate.contamination(odd, benchmark.limit(0)).where("contaminated or n_hit > 0").count() == 0


def plain_cut(rows, span=50):
    first = {}
    order = lambda i: suffix_dedup.NO_ID if i is None else i
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - span + 1):
            first[b[p:p + span]] = min(first.get(b[p:p + span], suffix_dedup.NO_ID), order(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - span + 1):
            if first[b[p:p + span]] < order(i):
                gone[p:p + span] = True
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((str(i), len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("sizes", [(2_000_000, 16_000_000), (2_000, 4_000)])
def test_suffix_dedup_equals_plain_search(odd, sizes):
    got = suffix_dedup.cut_documents(odd, shard_bytes=sizes[0], bucket_bytes=sizes[1]).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == plain_cut(ODD)
    assert suffix_dedup.cut_documents(odd.limit(0)).count() == 0


def test_hot_anchors_spread_by_their_surroundings(spark):
    rng = np.random.default_rng(5)
    mark = "=-=-=-=-=-=-=-=-=-="
    noise = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    lines = [noise(40) for _ in range(60)]
    # One separator with ever new text on one side or both, some of it shared by documents at all distances from the separator.
    rows = [(i, mark.join([noise(30), lines[i % 7], noise(25) + lines[i % 11][:20], lines[i % 5][:35] + noise(5)] * 3)) for i in range(80)]
    docs = spark.createDataFrame([*rows, (None, rows[3][1]), (5, rows[5][1])], "doc_id long, text string").repartition(3)
    want = plain_cut([*rows, (None, rows[3][1]), (5, rows[5][1])])
    for hot in (1, 100, 16_000):
        got = suffix_dedup.cut_documents(docs, shard_bytes=3_000, bucket_bytes=10_000, hot_pieces=hot).collect()
        assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == want


def test_hot_anchors_are_told_by_the_sum_of_all_shards():
    sent = lambda pairs, several=0: suffix_dedup._long(suffix_dedup._short(*map(np.array, zip(*pairs, strict=True)), several))
    lists = [sent([(np.uint64(9), 1), (np.uint64(10), 5)]), sent([(np.uint64(9), 2), (np.uint64(11), 0)]), sent([(np.uint64(12), 3)], 1)]
    found = suffix_dedup.shared_anchors(lists, hot_pieces=40)
    assert [(known.tolist(), hot.tolist()) for known, hot in found] == [([9], [9]), ([9], [9]), ([12], [12])]
    assert [hot.tolist() for _, hot in suffix_dedup.shared_anchors(lists, hot_pieces=41)] == [[], [], [12]]


@pytest.mark.parametrize("letters", [1, 2, 4, 250])
def test_two_stage_sorting_orders_suffixes(letters):
    rng = np.random.default_rng(letters)
    raw = rng.integers(0, letters, 700).astype(np.uint8)
    wanted = rng.random(len(raw)) < 0.4
    got, data = suffix_dedup.suffix_order(raw, wanted), raw.tobytes()
    assert sorted(got) == np.flatnonzero(wanted).tolist()
    assert [data[k:k + 50] for k in got] == sorted(data[k:k + 50] for k in np.flatnonzero(wanted))
    common = suffix_dedup.common_prefixes(raw, got)
    for k in range(1, len(got)):
        a, b = data[got[k - 1]:][:50], data[got[k]:][:50]
        assert common[k] == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def test_lists_quotations_code_and_captions_are_main_text(spark, folder):
    sample = [r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").where("html <> ''").limit(200).collect()]
    body = ("<h1>Title</h1><p>First paragraph of the text.</p><ul><li>one item</li><li>second item here</li></ul><pre>x = 1\ny = 2</pre>"
            "<blockquote>To be or not to be.</blockquote><figure><img src=a><figcaption>The caption of it</figcaption></figure>"
            "<table><tr><th>Name</th><td>Bob</td></tr></table><dl><dt>Term</dt><dd>Its meaning.</dd></dl><h4>Sub</h4><p>Last words.</p>")
    want = ["Title", "First paragraph of the text.", "one item", "second item here", "x = 1 y = 2", "To be or not to be.", "The caption of it",
            "Name", "Bob", "Term", "Its meaning.", "Sub", "Last words."]
    # The second model has no page that marks its main text.
    for model in (html_text.train(sample), html_text.train([p.replace("article>", "div>") for p in sample])):
        for first, last in (("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>")):
            page = (f"<html><head><title>x</title></head><body><nav><ul><li><a href=x>Home</a></li><li><a href=y>About us</a></li></ul></nav>"
                    f'<div class="ad">Buy this now</div>{first}{body}{last}<footer>Imprint</footer></body></html>')
            assert html_text.extracted([page], model)[0].split("\n") == want
    long = "<body><article><p>" + "word " * 400_000 + "</p></article></body>"
    assert len(html_text.extracted([long], model)[0]) == 5 * 400_000 - 1
    clash = spark.createDataFrame([(1, "u", sample[0], "a", 3)], "page_id long, url string, html string, text string, n_chars int")
    assert html_text.extract_pages(clash, model).columns == ["page_id", "url", "text", "n_chars"]


def test_html_text_of_marked_and_unmarked_pages(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    model = html_text.fit(pages)
    rows = html_text.extract_pages(pages, model).join(pages.select("page_id", "html"), "page_id").collect()
    for r in rows:
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        want = [" ".join(html_text.html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", body))]
        assert r["text"] == "\n".join(w for w in want if w)
        assert r["n_chars"] == len(r["text"])
    odd = ["", None, "<", "<p", "<!-- open", "<script>x", "<p>a<p", "<a href='" + "x" * 50_000, "<div>" * 3_000 + "deep", "&lt;&#233;&bogus;"]
    table = spark.createDataFrame([(k, "u", h) for k, h in enumerate(odd)] + [(1, "u", "")], "page_id long, url string, html string")
    assert html_text.extract_pages(table, model).count() == len(odd) + 1
    assert html_text.extract_pages(table.limit(0)).count() == 0
    assert html_text.extract_pages(table.where("html = ''")).first()["text"] == ""


def test_blocks_end_where_elements_do():
    page = "<body><ul><li>one<li>two</ul><p>a <b>b</b><br>c &amp; d<p>e<script>no</script> f</body>"
    assert [b.text for b in html_text.blocks(page)] == ["one", "two", "a b c & d", "e f"]


@pytest.mark.parametrize("page, want", [
    ("<html><head><title>x</title><meta charset=utf-8><body><article><h1>a</h1><p>b</article></html>", ["a", "b"]),
    ("<head><title>x</title><header>top</header><p>a</p>", ["top", "a"]),
    ("<head><title>x<link rel=y><script>'<p>'</script></head><body><p>a<p>b", ["a", "b"]),
    ("<title>x<body><p>a</p><svg><title>icon</title></svg><p>b", ["a", "b"]),
    *[(f"<p>a</p><{n} id=k>no<i>no</i><p>b</p><p>c <{n}>no</{n}>d</p>", ["a", "b", "c d"])
      for n in ("title", "noscript", "template", "textarea", "select", "svg", "iframe", "object")],
    ("<p>a<select><option>no<option>no</p><p>b", ["a", "b"]),
    ("<p>a<object><object>no<p>no</p></object><p>no</object>b<svg><!-- <svg> --><div>no</div></svg>c", ["abc"]),
    ("<p>a<script>no</scripts>no<p>no</script >b<style>no", ["ab"]),
])
def test_elements_without_end_tag_do_not_end_the_page(page, want):
    assert [b.text for b in html_text.blocks(page)] == want


def test_many_open_elements_are_read_in_one_pass():
    page = "<svg><p>a</p>" * 20_000
    assert len(html_text.blocks(page)) == 20_000


def test_lstm_gradients():
    rng = np.random.default_rng(3)
    one = html_text._fresh(rng).forward
    one.w, one.u, one.b = (x.astype(np.float64) for x in (one.w, one.u, one.b))
    x, mask = rng.standard_normal((4, 2, html_text.INPUT)), np.array([[1, 1], [1, 1], [1, 0], [1, 0]], float)
    weight = rng.standard_normal((4, 2, html_text.HIDDEN))
    loss = lambda: float((one.run(x, mask)[0] * weight).sum())
    grads = one.back(x, one.run(x, mask, keep=True)[1], weight)
    for array, grad in zip((one.w, one.u, one.b), grads, strict=True):
        at = tuple(0 for _ in array.shape)
        array[at] += 1e-2
        high = loss()
        array[at] -= 2e-2
        low = loss()
        array[at] += 1e-2
        assert abs((high - low) / 2e-2 - grad[at]) < 1e-2 * max(1, abs(grad[at]))


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "u", "é" * 200, "x"), (2, None, "é" * 200, "x"), (None, "u\r\nX: y", "é" * 200, "x"), (3, "", None, "x"), (4, "k", "", "x"),
            (5, "b", "short\r\n\r\nWARC/1.1", "x"), (5, "b", "short\r\n\r\nWARC/1.1", "x"), (6, "z", "a\0b" * 100, "x"), (1, "u", "é" * 200, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record string")
    out = f"file://{tmp_path}/w"
    got = warc.round_trip(pages, payload=True, folder=out).collect()
    assert len(got) == len(rows)
    for r in got:
        body = next((h or "").encode() for i, _, h, _ in rows if i == r["page_id"])
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body), hashlib.sha256(body).hexdigest())
        revisit = len(body) >= 100 and r["page_id"] not in (1, 6)
        assert (r["record_type"], r["refers_to"]) == (("revisit", 1) if revisit else ("response", None))
        assert r["payload"] == (None if revisit else body.decode())
    assert sorted(map(str, (r["url"] for r in got))) == sorted(map(str, (u for _, u, _, _ in rows)))
    # Any gzip reader takes the archives whole: members on end, zero padding behind.
    import gzip
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in Path(tmp_path).rglob("archives/*/*.txt"))
    assert whole.count(b"WARC-Type: ") == len(rows)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_broken_streams_are_refused():
    with pytest.raises(ValueError):
        list(warc.split_stream(warc.member(b"no record\r\n\r\n")))
    with pytest.raises(ValueError):
        list(warc.split_stream(warc.member(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n")))


def test_bpe_equals_the_library(odd, docs):
    import tiktoken
    ranks, pattern = tokenizer()
    own = bpe.Coder(ranks)
    theirs = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=own.ranks, special_tokens={})
    texts = [t for _, t in ODD] + ["ab" * 4_000 + " it's <|endoftext|>  \n\n x\t y", "zq" * 500 + "é" * 900,
             "a" * 5_001, "the" * 2_000, "".join("aein"[(k * k + k // 7) % 4] for k in range(5_000))] + [r["text"] for r in docs.limit(60).collect()]
    import pyarrow as pa
    for text, (n, ids, raw) in zip(texts, bpe.encoded_rows(pa.array(texts), ranks, pattern), strict=True):
        want = theirs.encode_ordinary(text or "")
        assert (n, ids, raw) == (len(want), ",".join(map(str, want)), (text or "").encode())
    got = {r["doc_id"]: r for r in bpe.encode_documents(odd, ranks, pattern).collect()}
    assert got[3]["n_tokens"] == 0 and got[3]["ids"] == "" and bytes(got[7]["decoded"]) == ("é" * 60).encode()
    assert bpe.encode_documents(odd.limit(0), ranks, pattern).count() == 0


def plain_bpe(raw, ranks):
    parts = [raw] if raw in ranks else [bytes([b]) for b in raw]
    while found := [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]:  # noqa: B905
        k = min(found)[1]
        parts[k:k + 2] = [parts[k] + parts[k + 1]]
    return [ranks[x] for x in parts]


def test_bpe_by_any_table_of_ranks():
    rng = np.random.default_rng(3)
    early = 0
    for turn in range(24):
        letters = "abcdefgh"[:3 + turn % 6]
        tokens = sorted({"".join(rng.choice(list(letters), rng.integers(2, 5))) for _ in range(40)})
        # Ranks by length or, as no training would give them, in any order: tokens are also made of tokens of larger ranks.
        order = sorted(tokens, key=len) if turn % 4 == 0 else list(rng.permutation(tokens))
        ranks = {bytes([b]): b for b in range(256)} | {str(t).encode(): 256 + r for r, t in enumerate(order)}
        own = bpe.Coder(b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items()))
        words = sorted({"".join(rng.choice(list(letters), rng.integers(1, 14))) for _ in range(200)}) + ["abcab" * 60, "a" * 90]
        own.learn(words)
        want = {w: ",".join(map(str, plain_bpe(w.encode(), ranks))) for w in words}
        assert {w: own.known[w][0] for w in words} == want and all(own.known[w][1] == w.encode() for w in words)
        early += sum(map(len, words)) - len(own._start([w.encode() for w in words])[0])
    assert early > 1_000


def test_bpe_takes_known_words_over_when_its_memory_is_full(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 6)
    ranks, pattern = tokenizer()
    own, coded = bpe.Coder(ranks), []
    encode = own._learn
    own._learn = lambda words: (coded.extend(words), encode(words))
    for n in range(8):
        own.learn({"the", "house", f"word{n}", f"other{n}"})
        assert own.known.keys() >= {"the", "house", f"word{n}"}
    assert len(coded) == len(set(coded)) == 18 and len(own.known) + len(own.former) <= 12


def plain_spans(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 12 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m[0])) <= 15]


def test_pii_base_spans_equal_the_patterns(docs):
    hard = ["a@b.c@d.e", "..@x.y", "@a.b", "a@b", "é1.2.3.4.5.6.7.8", "1.2.3.256 01.002.03.4", "4111 1111-1111 1111 4111111111111111", "+1 (23) 4567-890.",
            "++49 30 1234567+1 2", "x@y.z" * 30, "a" * 5_000 + "@", "1" * 5_000, "1." * 2_000, "+" * 3_000]
    for text in hard + [r["text"] for r in docs.collect()]:
        assert pii.base_spans(text) == plain_spans(text), text[:80]


def test_pii_adds_spans_and_masks(spark, odd):
    rows = [(k, f"write to user{k}@mail.example.com or call phone (212) 555-01{k:02d}, card 4111111111111111 and host 10.0.0.{k}") for k in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(table)
    got = pii.find_documents(table, model).collect()
    assert all((r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (1, 1, 1, 0) for r in got)
    assert set(model.reliability) == {"email", "ip", "card", "phone"}
    masked = table.select(pii.redact(F.col("text"), model).alias("t")).first()["t"]
    assert "[EMAIL]" in masked and "[CARD]" in masked and "[IP]" in masked and "@" not in masked
    found = {r["doc_id"]: r for r in pii.find_documents(odd).collect()}
    assert found[3]["spans"] == "" and found[3]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert odd.where("doc_id = 3").select(pii.redact(F.col("text"), model).alias("t")).first()["t"] is None
    assert pii.find_documents(odd.limit(0)).count() == 0


def test_written_out_addresses_have_no_longest_part():
    long = f"{'a' * 100} [at] {'b' * 80}{'.c' * 12}"
    assert pii.candidates(f"to {long} today") == [("email", 3, 3 + len(long), False)]
    assert pii.candidates("a" * 50_000 + " [at] " + "b." * 20_000) == [("email", 0, 50_000 + 6 + 39_999, False)]
    assert pii.candidates("a[at]" * 20_000 + "." * 20_000) == []


def test_labelers_reliabilities_are_found():
    rng = np.random.default_rng(3)
    right = np.array([0.95, 0.9, 0.8, 0.7, 0.6])
    truth = rng.random(40_000) < 0.4
    says = np.where((rng.random((len(truth), 5)) < right) == truth[:, None], 1, -1) * (rng.random((len(truth), 5)) < 0.8)
    vote, of, count = np.unique(says, axis=0, return_inverse=True, return_counts=True)
    accurate, found = pii.reliabilities(vote, count.astype(float))
    assert np.abs(accurate - right).max() < 0.02
    # The same by Bayes' rule with the true reliabilities.
    odds = np.log(0.4 / 0.6) + (vote * np.log(right / (1 - right))).sum(axis=1)
    assert np.abs(found - 1 / (1 + np.exp(-odds))).mean() < 0.05
    assert ((found[of.ravel()] > 0.5) == truth).mean() > 0.93


def test_logistic_regression_equals_a_plain_descent():
    rng = np.random.default_rng(4)
    x = np.column_stack([np.ones(300), rng.normal(size=(300, 4))])
    truth, weight = 1 / (1 + np.exp(-x @ [0.3, 1, -2, 0, 0.5])), np.full(300, 1 / 300)
    w = np.zeros(5)
    for _ in range(20_000):
        w -= 1.0 * (x.T @ (weight * (1 / (1 + np.exp(-x @ w)) - truth)) + 1e-4 * w)
    assert np.abs(pii.logistic(x, truth, weight) - w).max() < 1e-4


def test_span_classifier_tells_spans_with_equal_votes_apart():
    good, bad, loose = (1, 1, 1, 1, 1), (-1, 0, -1, -1, -1), (-1, 1, 0, 0, 0)
    # Loose spans with these votes stand where the certain ones stand, or where the rejected ones do.
    rows = [("email", good, (2, 2, 1, 0), 900), ("email", bad, (0, 4, 3, 2), 900), ("email", loose, (2, 2, 1, 0), 40), ("email", loose, (0, 4, 3, 2), 40)]
    model = pii.fit_counts(rows)
    assert model.probability("email", (2, 2, 1, 0)) > 0.9 and model.probability("email", (0, 4, 3, 2)) < 0.1
    assert model.probability("ip", (2, 2, 1, 0)) == 0.0 and pii.fit_counts([]).weights == {}


def test_numbers_that_fail_their_rule_are_never_added():
    rows = [("card", (1, 1, 1, 1, 1), (1, 0, 3, 0), 500), ("card", (-1, -1, 1, 0, 1), (1, 0, 3, 0), 400)]
    model = pii.fit_counts(rows)
    model.threshold = 0.0
    assert pii.spans("pay 4111 1111 1111 1112 now", model) == ([], [])


@pytest.mark.parametrize("operator, folds, fold, label, most_wrong", [(quality, 4, 2, "quality", 0.05), (toxicity, 5, 0, "toxic", 0.08)])
def test_classifiers_on_held_out_rows(spark, odd, operator, folds, fold, label, most_wrong):
    big = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    got = operator.score_documents(docs, labels).join(labels, "doc_id").where("held_out")
    n, wrong = got.count(), got.where(F.col("predicted") != F.col(label)).count()
    assert n > 50 and wrong <= most_wrong * n + 1
    everything = operator.score_documents(odd, labels).collect()
    assert len(everything) == len(ODD) and all(0 <= r["score"] <= 1 for r in everything)
    assert all(r["held_out"] is not None for r in everything)
    assert operator.score_documents(odd, labels.limit(0)).count() == len(ODD)
    assert operator.score_documents(odd.limit(0), labels).count() == 0


def test_quality_is_trained_on_every_labelled_document(spark):
    rows = [(n, f"plain words of text {n}. " * (6_000 if n == 1 else 3)) for n in range(60)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.range(60).selectExpr("id as doc_id", "int(id % 5 > 0) as quality")
    known = labels.where(~quality.held_out(4, 2))
    got = quality.training_features(docs, labels)
    assert got.count() == known.count() and max(np.frombuffer(r["x"])[2 * quality.CLASSES] for r in got.collect()) > np.log(100_000)
    good = known.where("quality = 1").count()
    blocks = quality._blocks(got, good, known.count() - good).collect()
    assert [(len(b["good"]), len(b["bad"])) for b in blocks] == [tuple(8 * quality.FEATURES * m for m in (good, known.count() - good))]
    many = spark.range(9_000).selectExpr("xxhash64(id) as h", "int(id % 100 > 0) as label", "cast(lpad(id, 8, '0') as binary) as x")
    dealt = quality._blocks(many, 8_910, 90).collect()
    assert len(dealt) == 9 and all(b["bad"] for b in dealt) and sum(len(b["good"]) for b in dealt) == 8 * 8_910


def test_sums_over_all_pairs():
    rng = np.random.default_rng(1)
    good, bad, w = rng.normal(size=(1_030, 3)), rng.normal(size=(5, 3)), np.array([0.5, -0.2, 0.1])
    d = (good[:, None] - bad[None]).reshape(-1, 3)
    p = 1 / (1 + np.exp(d @ w))
    want = np.concatenate([[len(d)], d.T @ p, ((d * (p * (1 - p))[:, None]).T @ d).ravel()])
    assert np.allclose(quality.pair_sums(good, bad, w), want)


def test_gapped_words_stay_near():
    marks = toxicity.Landmarks([toxicity.unit("worthless")])
    near = marks.words(["worthless", "w.o.r.t.h.l.e.s.s", "worxthless", "wrthless", "W0RTHLESS".lower(), "meadow", "x" * 500])[:, 0]
    assert near[0] > 0.99 and near[1] > 0.99 and near[2] > 0.5 and near[3] > 0.5 and near[4] > 0.99 and near[5] == near[6] == 0


def test_sentence_marks_inside_words():
    marks = toxicity.Landmarks([toxicity.unit(w) for w in ("idiot", "stupid", "scum", "ass", "zz")])
    model = toxicity.Model(marks, np.ones(5), np.zeros(toxicity.SUMMARY))
    best = lambda text: toxicity.Scorer(model).summaries([text])[0][1:4]
    for plain, hidden in (("idiot", "id!ot"), ("stupid", "stu.pid"), ("scum", "sc.um"), ("idiot", "i.d i.o.t")):
        assert best(f"you {hidden} there. Go")[0] >= 0.99 * best(f"you {plain} there. Go")[0] > 0
    for short in ("ass", "zz"):
        assert best(f"you {short}!")[0] > 0.9
    # A missing space still ends a word, and no word counts twice.
    assert list(best("you idiot.Scum there")) == list(best("you idiot. Scum there"))
    assert list(best("an id!ot"))[1:] == [0, 0]
    assert not best("see www.meadow.example at 3.14 or 10.30")[0]
    rows = [("what a stu.pid rule", 1)] * 5 + [("what a fine rule", 0)] * 20
    assert "^^stupid" in toxicity.train(rows).landmarks.strings


def test_words_are_compared_once(monkeypatch):
    marks = toxicity.Landmarks([toxicity.unit(w) for w in ("idiot", "stupid")])
    compared, compare = [], marks.compare
    marks.compare = lambda strings: (compared.extend(strings), compare(strings))[1]
    model = toxicity.Model(marks, np.ones(2), np.ones(toxicity.SUMMARY))
    first = toxicity.scorer(model)
    texts = ["an idiot, (idiot) said", 'the "idiot" and another', "", "one more"]
    want = toxicity.Scorer(toxicity.Model(toxicity.Landmarks(marks.strings), np.ones(2), np.ones(toxicity.SUMMARY))).summaries(texts)
    assert (first.summaries(texts) == want).all() and want[0, 1] == want[0, 2] > 0.9
    assert len(compared) == len(set(compared)) == 8
    # The next task of the worker knows these words, and so does one after the memory was full.
    again = toxicity.scorer(toxicity.Model(marks, np.ones(2), np.ones(toxicity.SUMMARY)))
    monkeypatch.setattr(toxicity, "KEPT_WORDS", 12)
    for n in range(9):
        assert (again.summaries([*texts, f"word{n}x", f"b{n}"]) == toxicity.Scorer(model).summaries([*texts, "word", "b"])).all()
    assert again is first and len(again.seen | again.former) <= 24 and not again.loud
    assert set(again.marked) == {"idiot,", "(idiot)", '"idiot"'}
    assert toxicity.scorer(toxicity.Model(marks, 2 * np.ones(2), np.ones(toxicity.SUMMARY))) is not first


def test_kernel_and_units_equal_plain_ones():
    def plain(a, b):
        spans = lambda s: [(s[i] + s[j] + s[k], k - i + 1) for i in range(len(s)) for j in range(i + 1, len(s)) for k in range(j + 1, len(s))]
        return sum(0.6 ** (m + n) for x, m in spans(a) for y, n in spans(b) if x == y)

    rng = np.random.default_rng(8)
    strings = ["".join(rng.choice(list("abc"), n)) for n in (1, 2, 3, 4, 5, 7, 9, 9)]
    got = [toxicity._raw_kernel(toxicity._grid([a] * len(strings), 2), toxicity._grid(strings, 1)) for a in strings]
    assert np.allclose(got, [[plain(a, b) for b in strings] for a in strings], rtol=1e-4)
    assert [toxicity.unit(w) for w in ("plain", "(id1ot!)", "ßé", "x\u0301y", "3", "")] == ["^^plain", "^^idiot", "^^ßé", "^^xy", "^^e", "^^"]
    assert toxicity.joined(["a", "b", "cd", "e", "f", "g"]) == ["a", "b", "cd", "e", "f", "g", "efg"]
    assert toxicity.joined(["a", "b", "cd", "e"]) == ["a", "b", "cd", "e"]


def test_topk_equals_plain_search(spark):
    rng = np.random.default_rng(5)
    rows = [(k, [float(v) for v in rng.normal(size=10)]) for k in range(400)]
    rows += [(400, None), (401, []), (402, [None] * 10), (403, [float("nan")] * 10), (404, [float("inf")] * 10), (None, rows[0][1]), (420, [1.0, 2.0]), (421, [3.0, 4.0])]
    rows += [(k, rows[7][1]) for k in range(500, 540)]  # ties
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("q", F.lit(0)).withColumn("dim", F.lit(0))
    got = sorted(tuple(r) for r in topk.search(table, F.col("vec_id") % 20 == 0, query_rows=7, block_rows=16, groups=3).collect())
    usable = [(i, np.floor(np.array(v) * 64)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for i, q in usable:
        if i % 20 == 0:
            scored = sorted((-int(q @ v), j) for j, v in usable if j != i and len(v) == len(q))
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:20])]
    assert got == sorted(want)
    assert topk.search(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_topk_is_exact_for_large_components(spark):
    rng = np.random.default_rng(3)
    for size in (4e5, 1e7):  # scores about and far beyond 2^53
        rows = [(i, (rng.standard_normal(6) * size).tolist()) for i in range(60)]
        got = sorted(tuple(r) for r in topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"),
                                                   F.col("vec_id") % 20 == 0, k=7, query_rows=2, block_rows=16, groups=2).collect())
        whole = {i: [math.floor(x * 64) for x in v] for i, v in rows}
        want = []
        for i in range(0, 60, 20):
            scored = sorted((-sum(a * b for a, b in zip(whole[i], v, strict=True)), j) for j, v in whole.items() if j != i)
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:7])]
        assert got == sorted(want)
    best = topk.Best(1, 2)
    huge = np.array([[1e17, -1e17, 3.0]])
    topk.search_block(huge, np.array([1]), np.vstack([huge, huge + [[0, 0, 1]]]), np.array([5, 4]), best)
    assert [(-s, v) for s, v in best.rows[0]] == [(2 * 10**34 + 12, 4), (2 * 10**34 + 9, 5)]
    table = spark.createDataFrame([(0, [1e17, 1.0]), (1, [1e17, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond a long"):
        topk.search(table, F.col("vec_id") % 20 == 0).collect()


def plain_components(prints):
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("light, tile, segments", [(16, 2048, 2), (0, 3, 2), (2, 4, 3), (1, 2, 4)])
def test_multi_index_links_join_what_plain_search_joins(spark, light, tile, segments):
    import random
    rng = random.Random(1)
    values = [rng.getrandbits(64) for _ in range(40)] + [0, 1, 3, 7, 15, (1 << 64) - 1]
    for _ in range(60):
        v = rng.choice(values)
        for bit in rng.sample(range(64), rng.randint(0, 4)):
            v ^= 1 << bit
        values.append(v)
    prints = dict(enumerate(dict.fromkeys(values)))
    signed = [(v - (1 << 64) if v >> 63 else v, i) for i, v in prints.items()]
    table = spark.createDataFrame(signed, "fp long, label long")
    found = simhash.links(table.select("fp"), 3, segments, light, tile)
    got = {r["fp"]: r["label"] for r in simhash.components(table, found).collect()}
    assert {i: got[s] for s, i in signed} == plain_components(prints)
    assert all(((r["a"] ^ r["b"]) & ((1 << 64) - 1)).bit_count() <= 3 for r in found.collect())


def test_simhash_of_odd_rows_and_groups(spark, odd):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    by = {r["doc_id"]: r for r in got}
    assert by[3]["fingerprint"] == by[4]["fingerprint"] == "0" * 16 and by[4]["component_id"] == 3
    assert by[1]["component_id"] == 0 and by[None]["component_id"] == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for i in {0, 3, None} | {i for i, _ in ODD if i and by[i]["component_id"] == i})
    assert simhash.near_duplicates(odd.limit(0)).count() == 0 and simhash.keep_one(odd.limit(0)).count() == 0


def test_fingerprints_equal_a_plain_version(docs):
    import xxhash
    for r in docs.select("text", simhash.fingerprint("text").alias("fp")).limit(40).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"]))
        grams = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert r["fp"] & ((1 << 64) - 1) == want


def test_pipeline_stages_take_effect(spark, folder, benchmark):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    for name, function in corpus_pipeline.STAGES[:-1]:
        after = function(spark, docs, folder)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes, name
        after = corpus_pipeline.stage(after, name)
        if name == "toxicity":
            kept = {r["doc_id"] for r in toxicity.score_documents(docs, labels).where("predicted = 0").collect()}
            assert {r["doc_id"] for r in after.collect()} == kept
        elif name == "near_duplicates":
            prints = {r["doc_id"]: int(r["fingerprint"], 16) for r in simhash.near_duplicates(docs).collect()}
            assert {r["doc_id"] for r in after.collect()} == set(plain_components(prints).values())
        elif name == "decontamination":
            rows, items = [(r["doc_id"], r["text"]) for r in docs.collect()], [tuple(r) for r in benchmark.select("item_id", "text").collect()]
            assert {r["doc_id"] for r in after.collect()} == {i for i, *_, bad in plain_windows(rows, items) if not bad}
        else:
            assert after.count() == docs.count()
            assert all(not plain_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in after.collect())
        docs = after
    assert corpus_pipeline.run(spark, folder).count() == docs.count()
    for name, function in corpus_pipeline.STAGES[:-1]:
        assert function(spark, docs.limit(0), folder).count() == 0, name
