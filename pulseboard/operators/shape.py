"""Row shapes: positional sinks, target column lists, list elements."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename columns by position, as a sink does that maps fields in order."""
    return df.toDF(*names)


def into_columns(df: DataFrame, target: T.StructType, columns: Sequence[str]) -> DataFrame:
    """INSERT with a target column list: ``df`` fills ``columns`` in order, the rest is null."""
    given = dict(zip(columns, df.columns, strict=True))
    return df.select(
        *[
            (F.col(given[f.name]) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )


def wide_row(df: DataFrame, row_key: Column, fields: Mapping[str, Column | str], family: str = "cf") -> DataFrame:
    """Row key and one column family as a struct."""
    return df.select(
        row_key.alias("rowkey"),
        F.struct(
            *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in fields.items()]
        ).alias(family),
    )


def elements(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per list element; the fields of a struct element become columns."""
    item = df.schema[column].dataType.elementType
    exploded = df.select(*keep, F.explode(column).alias("_e"))
    if isinstance(item, T.StructType):
        return exploded.select(*keep, "_e.*")
    return exploded.select(*keep, F.col("_e").alias("element"))
