"""Ranking and top-n.

A rank filter over ``row_number`` keeps at most n rows per group in each task
before the shuffle, so a hot group sends n rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseboard.functions.text import hash_bucket
from pulseboard.operators.ordered import Order, global_row_number, sort_columns


def top_per_group(df: DataFrame, group: Sequence[str], order: Order, n: int, name: str = "rownum") -> DataFrame:
    """The first ``n`` rows of each group, numbered."""
    ranked = Window.partitionBy(*group).orderBy(*sort_columns(order))
    return df.withColumn(name, F.row_number().over(ranked).cast("bigint")).where(F.col(name) <= n)


def top_overall(df: DataFrame, order: Order, n: int, spread_by: str, buckets: int = 128) -> DataFrame:
    """The first ``n`` rows of the table, numbered: first per hash bucket, then over the buckets.

    The second step ranks at most ``n * buckets`` rows.
    """
    local = top_per_group(df.withColumn("_bucket", hash_bucket(spread_by, buckets)), ["_bucket"], order, n, "_r")
    final = Window.orderBy(*sort_columns(order))
    return (
        local.drop("_bucket", "_r")
        .withColumn("rownum", F.row_number().over(final).cast("bigint"))
        .where(F.col("rownum") <= n)
    )


def ranked_pages(df: DataFrame, order: Order, page_size: int = 10) -> DataFrame:
    """The whole ranked result cut into pages."""
    numbered = global_row_number(df, order)
    return numbered.withColumn("page", F.floor((F.col("rownum") - 1) / F.lit(page_size)).cast("bigint"))
