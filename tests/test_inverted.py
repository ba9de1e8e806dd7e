"""The stored index against searches that read every text."""

import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from pulseboard.operators import inverted, search
from pulseboard.session import new_path

DOCS = [(1, "Alpha beta, alpha; gamma"), (2, "alpha-beta ALPHAS alpine alpaca"), (3, None), (4, ""), (5, "Übergröße über straße"),
        (6, "a ab abc abcd " * 50), (7, "beta bets bet bat"), (8, "x" * 3_000 + " betas"), (9, "eta zeta theta beta9")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("shard", F.lit("x")).withColumn("word", F.lit(1))


@pytest.fixture(scope="module")
def index(spark, docs):
    return inverted.InvertedIndex.build(docs, new_path(spark, "test-index"), shards=8)


def scores(df):
    return {tuple(r[c] for c in df.columns if c != "score"): r["score"] for r in df.collect()}


@pytest.mark.parametrize(("prefix_length", "most"), [(0, None), (1, 2), (3, 10)])
def test_searches_equal_reading_all_texts(docs, index, prefix_length, most):
    terms = ["alpha", "beta", "BETAS", "ab", "abcd", "über", "strasse", "nothing"]
    want = scores(search.fuzzy_searches(docs, terms, prefix_length=prefix_length, max_expansions=most))
    assert scores(index.searches(terms, prefix_length, most)) == pytest.approx(want)


def test_words_within_the_edits_share_a_variant(spark):
    rng = random.Random(1)
    letters = "abc"
    terms = ["abcabc", "aabbccaabb", "cbacbacba"]
    near = {"abcabc"}
    for term in terms:
        for _ in range(300):
            word = list(term)
            for _ in range(rng.randint(0, 2)):
                kind, at = rng.choice("dis"), rng.randrange(len(word) + 1)
                if kind == "i":
                    word.insert(at, rng.choice(letters))
                elif at < len(word):
                    word[at:at + 1] = [] if kind == "d" else [rng.choice(letters)]
            near.add("".join(word))
    made = {r["w"]: set(r["v"]) for r in spark.createDataFrame([(w,) for w in near], "w string")
            .select("w", inverted.deletion_variants(F.col("w")).alias("v")).collect()}
    assert made["abcabc"] == set(inverted.variants_of("abcabc", 2))
    far = {t: set(inverted.variants_of(t, 2)) for t in terms}
    close = {(r["w"], r["t"]) for r in spark.createDataFrame([(w, t) for w, t in product(near, terms)], "w string, t string")
             .where(F.levenshtein("w", "t") <= 2).collect()}
    assert len(close) > 200 and all(made[w] & far[t] for w, t in close)


def test_a_search_reads_few_postings(index):
    plan = index.search("alpha")._jdf.queryExecution().explainString(
        index.spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "dynamicpruning" in plan.lower()
    only = index.expansions("alpha")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in only


def test_an_index_is_built_once_and_again_after_a_change(spark, docs):
    path = new_path(spark, "indexed")
    docs.select("doc_id", "text").write.parquet(path)
    first = inverted.index_of_table(spark.read.parquet(path), path)
    assert inverted.index_of_table(spark.read.parquet(path), path).path == first.path
    docs.limit(0).select("doc_id", "text").write.mode("append").parquet(path)
    spark.createDataFrame([(77, "alpha")], "doc_id long, text string").write.mode("append").parquet(path)
    again = inverted.index_of_table(spark.read.parquet(path), path)
    assert again.path != first.path and 77 in {r["doc_id"] for r in again.search("alpha").collect()}


def test_an_empty_table_finds_nothing(spark, docs):
    empty = inverted.InvertedIndex.build(docs.limit(0), new_path(spark, "empty-index"), shards=2)
    assert empty.search("alpha").count() == 0


def test_words_are_counted_in_their_document(spark, docs, monkeypatch):
    """The texts are read for one stored table of counts; rows of one document are added up, and no variant is made before a search needs it."""
    stored = []
    keep = inverted.stage
    monkeypatch.setattr(inverted, "stage", lambda df, name: stored.append(keep(df, name)) or stored[-1])
    twice = docs.unionByName(docs.where("doc_id < 3"))
    index = inverted.InvertedIndex.build(twice, new_path(spark, "counted-index"), shards=4)
    counts = {(r["doc_id"], r["word"]): r["tf"] for r in stored[0].select("doc_id", F.inline("counts")).where("doc_id > 2").collect()}
    assert counts[(6, "abc")] == 50 and stored[0].count() == len(DOCS) + 2
    assert scores(index.searches(["alpha", "beta"])) == pytest.approx(scores(search.fuzzy_searches(twice, ["alpha", "beta"])))
    assert not inverted.path_exists(spark, f"{index.path}/variants")
    wide = {"prefix_length": 0, "most": None}
    assert scores(index.searches(["alpha"], **wide)) == pytest.approx(scores(search.fuzzy_searches(twice, ["alpha"], prefix_length=0, max_expansions=None)))
    assert inverted.path_exists(spark, f"{index.path}/variants/_SUCCESS")
