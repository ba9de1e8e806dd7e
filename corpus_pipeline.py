"""Cleaning a corpus: toxic documents and near-duplicates go, benchmark passages go, personal data is masked, the rest is encoded.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written and read again as the next stage's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseboard.llm import bpe, decontaminate, pii, simhash, toxicity
from pulseboard.llm.catalog import tokenizer
from pulseboard.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it is trained on the labelled ones among them."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; ``n_chars`` follows the new text."""
    changed = docs.withColumn("text", pii.redact(F.col("text"), pii.fit(docs)))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, number of tokens, and digests of the ids and of the bytes they decode to."""
    return docs.select("doc_id", bpe.encode(F.col("text"), *tokenizer(), digest=True).alias("e")).select("doc_id", "e.*")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("personal_data", masked),
    ("byte_level_bpe", encoded),
]

#: Classifier, fingerprints and tokens are beyond SQL; the stages are tested against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
