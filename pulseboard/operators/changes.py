"""Changelog tables: rows with an operation and a source sequence number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The four kinds of change rows.
INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE = "+I", "-U", "+U", "-D"


def latest_changes(changes: DataFrame, keys: Sequence[str], seq: str = "seq", op: str = "op") -> DataFrame:
    """The last change of each key by source sequence, whatever the arrival order.

    Grouped maximum, so the changes of a hot key are combined before the shuffle.
    """
    values = [c for c in changes.columns if c not in keys]
    settled = changes.where(F.col(op) != UPDATE_BEFORE)
    last = settled.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col(seq)).alias("_last"))
    return last.select(*[F.col(k) if k in keys else F.col(f"_last.{k}").alias(k) for k in changes.columns])


def apply_changes(
    changes: DataFrame,
    keys: Sequence[str],
    seq: str = "seq",
    op: str = "op",
    ignore_deletes: bool = False,
) -> DataFrame:
    """The table that the changelog describes.

    With ``ignore_deletes`` only the accumulating rows count, as in a sink that
    drops retractions: a deleted key keeps its last value.
    """
    source = changes.where(F.col(op).isin(INSERT, UPDATE_AFTER)) if ignore_deletes else changes
    return latest_changes(source, keys, seq, op).where(F.col(op) != DELETE).drop(op, seq)


def accumulating(changes: DataFrame, op: str = "op") -> DataFrame:
    """Change rows as (flag, row): the flag is false for a row that takes a value back."""
    return changes.withColumn("flag", F.col(op).isin(INSERT, UPDATE_AFTER))
