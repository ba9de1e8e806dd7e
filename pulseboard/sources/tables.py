"""Stored tables: warehouse scans, monitored tables, change feeds, small in-memory tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def named_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partitioned_scan(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """Partitioned table; a filter on partition columns skips whole folders."""
    table = spark.read.parquet(path)
    return table.where(where) if where is not None else table


def monitored_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    start: Column | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Table whose new files arrive as a stream.

    ``start`` is a filter on the partition time: it stands for a start offset, and
    older partitions are not read.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(path)
    return rows.where(start) if start is not None else rows


def change_feed(feeds: Mapping[str, DataFrame], pattern: str = ".*") -> DataFrame:
    """Change rows of all tables whose name matches ``pattern`` (whole name), tagged with the name."""
    tagged = [df.withColumn("table_name", F.lit(name)) for name, df in feeds.items()]
    union = tagged[0]
    for df in tagged[1:]:
        union = union.unionByName(df)
    return matching_tables(union, pattern)


def matching_tables(changes: DataFrame, pattern: str, table: str = "table_name") -> DataFrame:
    return changes.where(F.col(table).rlike(f"^(?:{pattern})$"))


def from_elements(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A few given records as a table."""
    return spark.createDataFrame(list(rows), schema)
