"""Ranked fuzzy term search over a document table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseboard.operators.topk import top_per_group
from pulseboard.session import stage

PREFIX_LENGTH = 3
MAX_EXPANSIONS = 10
K1 = 1.2
B = 0.75


def allowed_edits(term: str) -> int:
    """Edits allowed by the length of the term: none up to 2 characters, one up to 5, else two."""
    return 0 if len(term) <= 2 else 1 if len(term) <= 5 else 2


def words(text: Column | str) -> Column:
    """Lower-case words of a text: maximal runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def fuzzy_searches(docs: DataFrame, terms: list[str], doc_id: str = "doc_id", text: str = "text",
                   prefix_length: int = PREFIX_LENGTH, max_expansions: int | None = MAX_EXPANSIONS) -> DataFrame:
    """Every document with a word close to a term, with its score: (search_id, doc_id, score).

    ``search_id`` counts the terms from 1. A word is close when it shares the first
    characters with the term and is few edits away; of all such words the nearest
    ``max_expansions`` count (None: all). ``prefix_length`` is the number of first characters to share (0: none); both
    are options of the search and not limits of the operator. The score is BM25 summed over these words. The texts are read once
    for all terms: only lengths and close words are kept, and stored.
    """
    terms = [t.lower() for t in terms]

    def close_to(word: Column, term: str) -> Column:
        near = F.levenshtein(word, F.lit(term)) <= allowed_edits(term)
        return word.startswith(term[:prefix_length]) & near

    def close_to_any(word: Column) -> Column:
        found = F.lit(False)
        for term in terms:
            found = found | close_to(word, term)
        return found

    scanned = stage(
        docs.select(doc_id, words(F.col(text)).alias("_words")).select(
            doc_id, F.size("_words").alias("_length"), F.filter("_words", close_to_any).alias("_close")
        ),
        "close-words",
    )
    # One row of totals, read as a scalar.
    corpus = scanned.agg(
        F.struct(F.count(F.lit(1)).alias("docs"), F.avg("_length").alias("avg_length")).alias("c")
    ).scalar()
    counts = (
        scanned.select(doc_id, "_length", F.explode("_close").alias("_word"))
        .groupBy(doc_id, "_length", "_word")
        .agg(F.count(F.lit(1)).alias("_tf"))
    )
    parts = [
        _scored(counts.where(close_to(F.col("_word"), term)), term, corpus, doc_id, max_expansions).select(
            F.lit(number).alias("search_id"), doc_id, "score"
        )
        for number, term in enumerate(terms, 1)
    ]
    return reduce(DataFrame.unionByName, parts)


def _scored(counts: DataFrame, term: str, corpus: Column, doc_id: str, most: int | None) -> DataFrame:
    expansions = (
        counts.groupBy("_word")
        .agg(F.count(F.lit(1)).alias("_df"))
    )
    if most is not None:
        # Sent to all tasks only with a bound on its rows.
        expansions = F.broadcast(expansions.orderBy(F.levenshtein("_word", F.lit(term)), "_word").limit(most))
    hits = counts.join(expansions, "_word").withColumn("_corpus", corpus)
    idf = F.log(1 + (F.col("_corpus.docs") - F.col("_df") + 0.5) / (F.col("_df") + 0.5))
    norm = K1 * (1 - B + B * F.col("_length") / F.col("_corpus.avg_length"))
    score = idf * F.col("_tf") * (K1 + 1) / (F.col("_tf") + norm)
    return hits.groupBy(doc_id).agg(F.round(F.sum(score), 6).alias("score"))


def fuzzy_search(docs: DataFrame, term: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document with a word close to ``term``, with its score."""
    return fuzzy_searches(docs, [term], doc_id, text).drop("search_id")


def top_hits(scored: DataFrame, n: int = 10, doc_id: str = "doc_id") -> DataFrame:
    """The best ``n`` documents; of several searches, of each."""
    if "search_id" in scored.columns:
        return top_per_group(scored, ["search_id"], [("score", "desc"), doc_id], n).drop("rownum")
    return scored.orderBy(F.col("score").desc(), doc_id).limit(n)
