"""A stored inverted index: dictionary, deletion neighbourhoods, postings and corpus totals as tables.

Built once from a document table, read by any number of searches. A search looks its terms up in the
dictionary (the part that shares the first characters, or the words that share a deletion variant),
takes the nearest words, and reads the postings of these words only: postings are partitioned by a
hash of the word, and the few expanded words prune the partitions at run time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseboard.operators.search import B, K1, MAX_EXPANSIONS, PREFIX_LENGTH, allowed_edits, words
from pulseboard.session import files_state, new_path, path_exists, stage

#: First characters whose hash places a word in the dictionary.
HEAD = 3
#: Characters from which deletion variants are made. Two words within ``EDITS`` edits share a variant of their first
#: characters with at most so many deletions, whatever follows.
REACH, EDITS = 7, 2
SHARDS = 32

_DICTIONARY = "word string, df bigint, shard int"
_VARIANTS = "variant string, word string, df bigint, shard int"
_POSTINGS = "word string, doc_id bigint, length int, tf bigint, shard int"
_CORPUS = "docs bigint, avg_length double"


def _shard(value: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(shards)).cast("int")


def _without_one(text: Column) -> Column:
    """All texts with one character less."""
    return F.transform(F.sequence(F.lit(1), F.length(text)),
                       lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))))


def deletion_variants(word: Column) -> Column:
    """The first characters of a word, and all that is left of them after one or two deletions."""
    start = F.substring(word, 1, REACH)
    once = F.when(F.length(start) > 0, _without_one(start)).otherwise(F.array().cast("array<string>"))
    twice = F.flatten(F.transform(once, lambda t: F.when(F.length(t) > 0, _without_one(t)).otherwise(F.array().cast("array<string>"))))
    return F.array_distinct(F.concat(F.array(start), once, twice))


def variants_of(term: str, edits: int) -> list[str]:
    """The same of a search term, with at most ``edits`` deletions."""
    start = term[:REACH]
    return sorted({"".join(c for i, c in enumerate(start) if i not in gone)
                   for n in range(min(edits, len(start)) + 1) for gone in combinations(range(len(start)), n)})


def term_counts(words: Column) -> Column:
    """The different words of each text with their numbers, so that a word leaves its document once."""

    @F.arrow_udf("array<struct<word string, tf int>>")
    def run(lists: pa.Array) -> pa.Array:
        flat = lists.flatten()
        sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        coded = flat.dictionary_encode()
        distinct = max(len(coded.dictionary), 1)
        at = np.repeat(np.arange(len(sizes)), sizes) * distinct + coded.indices.to_numpy(zero_copy_only=False)
        found, times = np.unique(at, return_counts=True)
        each = np.bincount(found // distinct, minlength=len(sizes))
        pairs = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(found % distinct)), pa.array(times, pa.int32())], ["word", "tf"])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(each)]), pa.int32()), pairs)

    return run(words)


class InvertedIndex:
    """The tables of an index in one folder."""

    def __init__(self, spark: SparkSession, path: str, shards: int = SHARDS):
        self.spark = spark
        self.path = path
        self.shards = shards

    @classmethod
    def build(cls, docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, spread: int = 4) -> InvertedIndex:
        """Write the index of ``docs`` to the new folder ``path``.

        Texts are read once: the counts of a document's words are made beside it and stored, and only these are shuffled, once. Postings of one shard
        are dealt over ``spread`` tasks by document, so the postings of a word that all documents share are not one task's work. A null text has no words
        and no length; its document counts in the totals. The deletion neighbourhoods are stored by the first search that looks words up in them.
        """
        index = cls(docs.sparkSession, path, shards)
        scanned = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), words(F.col(text)).alias("ws"))
        lengths = stage(scanned.select("doc_id", F.size("ws").alias("length"), term_counts(F.col("ws")).alias("counts")), "term-counts")
        placed = (lengths.select("doc_id", "length", F.inline("counts"))
                  .withColumn("shard", _shard(F.col("word"), shards)).withColumn("deal", F.pmod(F.xxhash64("doc_id"), F.lit(spread))))
        # Rows of one document that come several times are added up where they meet, without another shuffle.
        (placed.repartition("shard", "deal").groupBy("shard", "deal", "word", "doc_id", "length").agg(F.sum("tf").alias("tf"))
         .select("word", "doc_id", "length", "tf", "shard").sortWithinPartitions("shard", "word", "doc_id")
         .write.partitionBy("shard").parquet(f"{path}/postings"))
        dictionary = index.postings().groupBy("word").agg(F.count(F.lit(1)).alias("df"))
        (dictionary.withColumn("shard", _shard(F.substring("word", 1, HEAD), shards))
         .repartition("shard").sortWithinPartitions("shard", "word").write.partitionBy("shard").parquet(f"{path}/dictionary"))
        # The totals come last: an index without them is not finished.
        lengths.agg(F.count(F.lit(1)).alias("docs"), F.avg("length").alias("avg_length")).coalesce(1).write.parquet(f"{path}/corpus")
        return index

    def _table(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def postings(self) -> DataFrame:
        return self._table("postings", _POSTINGS)

    def dictionary(self) -> DataFrame:
        return self._table("dictionary", _DICTIONARY)

    def variants(self) -> DataFrame:
        """The deletion neighbourhoods, made from the dictionary if no search has needed them yet."""
        if not path_exists(self.spark, f"{self.path}/variants/_SUCCESS"):
            (self.dictionary().select(F.explode(deletion_variants(F.col("word"))).alias("variant"), "word", "df")
             .withColumn("shard", _shard(F.col("variant"), self.shards))
             .repartition("shard").sortWithinPartitions("shard", "variant").write.mode("overwrite").partitionBy("shard").parquet(f"{self.path}/variants"))
        return self._table("variants", _VARIANTS)

    def corpus(self) -> DataFrame:
        return self._table("corpus", _CORPUS)

    def expansions(self, term: str, prefix_length: int = PREFIX_LENGTH, most: int | None = MAX_EXPANSIONS) -> DataFrame:
        """(word, df): the words close to ``term``, the nearest ``most`` of them (None: all).

        A word is close when it shares the first ``prefix_length`` characters and is few edits away. If these are ``HEAD`` or more, one part of the
        dictionary has all such words; else they are found by the deletion variants they share with the term.
        """
        edits = allowed_edits(term)
        if edits == 0 or prefix_length >= HEAD:
            found = self.dictionary().where(F.col("shard") == _shard(F.lit(term[:HEAD]), self.shards))
        else:
            shared = variants_of(term, edits)
            shards = F.array_distinct(F.array(*[_shard(F.lit(v), self.shards) for v in shared]))
            found = self.variants().where(F.array_contains(shards, F.col("shard")) & F.col("variant").isin(shared))
            found = found.select("word", "df").distinct()
        near = F.levenshtein("word", F.lit(term))
        close = found.where(F.col("word").startswith(term[:prefix_length]) & (near <= edits)).select("word", "df")
        return close if most is None else close.orderBy(near, "word").limit(most)

    def searches(self, terms: Sequence[str], prefix_length: int = PREFIX_LENGTH, most: int | None = MAX_EXPANSIONS) -> DataFrame:
        """Every document with a word close to a term, with its BM25 score: (search_id, doc_id, score).

        ``search_id`` counts the terms from 1. The postings are read once for all terms.
        """
        parts = [self.expansions(t.lower(), prefix_length, most).select(F.lit(n).alias("search_id"), "word", "df") for n, t in enumerate(terms, 1)]
        wanted = reduce(DataFrame.unionByName, parts).withColumn("shard", _shard(F.col("word"), self.shards))
        if most is not None:
            # At most ``most`` rows a term.
            wanted = F.broadcast(wanted)
        total = self.corpus().select(F.struct("docs", "avg_length")).scalar()
        hits = self.postings().join(wanted, ["shard", "word"]).withColumn("c", total)
        idf = F.log(1 + (F.col("c.docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
        norm = K1 * (1 - B + B * F.col("length") / F.col("c.avg_length"))
        score = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + norm)
        return hits.groupBy("search_id", "doc_id").agg(F.round(F.sum(score), 6).alias("score"))

    def search(self, term: str, prefix_length: int = PREFIX_LENGTH, most: int | None = MAX_EXPANSIONS) -> DataFrame:
        return self.searches([term], prefix_length, most).drop("search_id")


_built: dict[tuple, str] = {}


def index_of_table(docs: DataFrame, source: str, doc_id: str = "doc_id", text: str = "text") -> InvertedIndex:
    """The application's index of the files at ``source``, built at first use and again when these files change."""
    spark = docs.sparkSession
    key = (spark.sparkContext.applicationId, source, doc_id, text, files_state(spark, source))
    if key not in _built:
        path = new_path(spark, "index")
        InvertedIndex.build(docs, path, doc_id, text)
        _built[key] = path
    return InvertedIndex(spark, _built[key])
