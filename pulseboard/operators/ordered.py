"""Operators over one total order of all rows, without a one-task window.

The rows are range partitioned on the order into blocks of about equal size (a
hot key or a crowded second is split like any other stretch of rows) and stored
with their block number. What a block needs to know of the others is one row per
block: it enters the block as an extra row that sorts first, so a single window
per block gives the final value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseboard.session import stage

BLOCK = "_block"
CARRY = "_carry"

Order = Sequence["str | tuple[str, str]"]


def _names(order: Order) -> list[str]:
    return [o if isinstance(o, str) else o[0] for o in order]


def sort_columns(order: Order, reverse: bool = False) -> list[Column]:
    """Sort expressions of ``"a"`` / ``("a", "desc")`` items."""
    columns = []
    for item in order:
        name, way = (item, "asc") if isinstance(item, str) else item
        descending = (way == "desc") != reverse
        columns.append(F.col(name).desc_nulls_last() if descending else F.col(name).asc_nulls_first())
    return columns


def ordered_blocks(df: DataFrame, order: Order) -> DataFrame:
    """``df`` with a block number that never falls along ``order``.

    The number of blocks is the session's shuffle partition count at most. The
    result is stored: range borders come from a sample, and a recomputation
    could draw others.
    """
    ranged = df.repartitionByRange(*sort_columns(order))
    return stage(ranged.withColumn(BLOCK, F.spark_partition_id()), "blocks")


_TOTALS = {"sum": F.sum, "max": F.max, "min": F.min}


def running(
    df: DataFrame,
    order: Order,
    measures: dict[str, tuple[str, str]],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Running totals up to and including each row.

    ``measures`` maps a new column to ``(kind, input column)``, kind one of sum,
    max, min. ``order`` must be a total order. With ``keys`` the totals run per key.
    """
    blocks = ordered_blocks(df, order)
    kinds = {name: _TOTALS[kind] for name, (kind, _) in measures.items()}
    per_block = blocks.groupBy(*keys, BLOCK).agg(
        *[kinds[name](source).alias(f"_m_{name}") for name, (_, source) in measures.items()]
    )
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_block.select(
        *keys, BLOCK, *[kinds[name](f"_m_{name}").over(before).alias(f"_m_{name}") for name in measures]
    )
    rows = blocks.select(
        "*", *[F.col(source).alias(f"_m_{name}") for name, (_, source) in measures.items()], F.lit(1).alias(CARRY)
    )
    merged = rows.unionByName(carry.withColumn(CARRY, F.lit(0)), allowMissingColumns=True)
    local = (
        Window.partitionBy(*keys, BLOCK)
        .orderBy(F.col(CARRY), *sort_columns(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        merged.select("*", *[kinds[name](f"_m_{name}").over(local).alias(name) for name in measures])
        .where(F.col(CARRY) == 1)
        .drop(BLOCK, CARRY, *[f"_m_{name}" for name in measures])
    )


def global_row_number(df: DataFrame, order: Order, name: str = "rownum") -> DataFrame:
    """Row number over the whole table."""
    counted = df.withColumn("_one", F.lit(1).cast("bigint"))
    return running(counted, order, {name: ("sum", "_one")}).drop("_one")


def running_distinct(
    df: DataFrame,
    order: Order,
    value: str,
    name: str = "cnt",
    extra: dict[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Number of different values of ``value`` seen up to and including each row.

    The first row of each value adds one; it is found by a grouped minimum of the
    order (combined before the shuffle), so a hot value costs one row per task.
    ``extra`` adds other running measures in the same pass.
    """
    columns = _names(order)
    if any(not isinstance(o, str) for o in order):
        raise ValueError("running_distinct needs an ascending order")
    firsts = (
        df.where(F.col(value).isNotNull())
        .groupBy(value)
        .agg(F.min(F.struct(*columns)).alias("_first"))
        .select("_first.*", F.lit(1).cast("bigint").alias("_new"), F.lit(0).alias("_row"))
    )
    rows = df.withColumn("_new", F.lit(0).cast("bigint")).withColumn("_row", F.lit(1))
    merged = rows.unionByName(firsts, allowMissingColumns=True)
    measures = {name: ("sum", "_new"), **(extra or {})}
    return running(merged, [*columns, "_row"], measures).where(F.col("_row") == 1).drop("_new", "_row")


def next_match(
    df: DataFrame,
    order: Sequence[str],
    is_end: str,
    payload: Sequence[str],
    name: str = "_next",
    keys: Sequence[str] = (),
) -> DataFrame:
    """For each row the first later row that has ``is_end`` set, as a struct of ``payload``.

    Rows without such a follower get null.
    """
    blocks = ordered_blocks(df, order)
    position = F.struct(*order)
    found = F.when(F.col(is_end), F.struct(*payload))
    # Every block (of the key) with its own first end, null where it has none.
    known = blocks.groupBy(*keys, BLOCK).agg(
        F.min_by(F.struct(*payload), F.when(F.col(is_end), position)).alias("_end")
    )
    behind = (
        Window.partitionBy(*keys).orderBy(F.col(BLOCK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = known.select(
        *keys, BLOCK, F.last("_end", ignorenulls=True).over(behind).alias("_end"), F.lit(0).alias(CARRY)
    )
    rows = blocks.select("*", found.alias("_end"), F.lit(1).alias(CARRY))
    merged = rows.unionByName(carry, allowMissingColumns=True)
    # Backwards, so that the frame only grows: the nearest later end is the last one met.
    local = (
        Window.partitionBy(*keys, BLOCK)
        .orderBy(F.col(CARRY), *sort_columns(list(order), reverse=True))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        merged.select("*", F.last("_end", ignorenulls=True).over(local).alias(name))
        .where(F.col(CARRY) == 1)
        .drop(BLOCK, CARRY, "_end")
    )
