"""Labelled documents for training: all of them, or a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(folds: int, fold: int, id_col: str = "doc_id") -> Column:
    """Whether the CRC-32 of the id as text falls in ``fold`` of ``folds``; a null id does not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def labelled_ids(labels: DataFrame, label: str, folds: int, fold: int) -> DataFrame:
    """(doc_id, label) of every labelled document outside the held-out fold."""
    return (labels.where(F.col(label).isNotNull() & ~held_out(folds, fold) & F.col("doc_id").isNotNull())
            .groupBy("doc_id").agg(F.max(label).cast("int").alias("label")))


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, rows: int, max_chars: int) -> list[tuple[str, int]]:
    """(text, label) of at most ``rows`` labelled documents outside the held-out fold, ordered by a hash of the id.

    Texts over ``max_chars`` characters are not trained on. The ids are chosen from the labels alone, so that only their
    documents are joined; the list of ids is bounded by twice ``rows``.
    """
    ids = labelled_ids(labels, label, folds, fold).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * rows)
    chosen = (docs.select(F.col("doc_id"), "text").where(F.length("text") <= max_chars)
              .join(F.broadcast(ids), "doc_id")
              .orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(rows).select("text", "label"))
    return [(r["text"], r["label"]) for r in chosen.toLocalIterator()]
