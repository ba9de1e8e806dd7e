"""Database tables and queries."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Database:
    url: str
    driver: str = ""
    user: str = ""
    password: str = ""
    options: Mapping[str, str] = field(default_factory=dict)

    def reader_options(self) -> dict[str, str]:
        given = {"url": self.url, "driver": self.driver, "user": self.user, "password": self.password}
        return {k: v for k, v in given.items() if v} | dict(self.options)


@dataclass(frozen=True)
class Split:
    """How a scan is cut into parallel range queries over a numeric or time column."""

    column: str
    lower: object
    upper: object
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


def table_options(db: Database, table: str, split: Split | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    parts = split.options() if split else {}
    return {**db.reader_options(), "dbtable": table, "fetchsize": str(fetch_size), **parts}


def query_options(db: Database, sql: str, split: Split | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    """A query as the scanned relation. A split needs a derived table in place of ``query``."""
    if split:
        return table_options(db, f"({sql}) q", split, fetch_size)
    return {**db.reader_options(), "query": sql, "fetchsize": str(fetch_size)}


def scan_table(spark: SparkSession, db: Database, table: str, split: Split | None = None) -> DataFrame:
    """Whole table; filters and columns are pushed into the database."""
    return spark.read.format("jdbc").options(**table_options(db, table, split)).load()


def scan_query(
    spark: SparkSession, db: Database, sql: str, schema: T.StructType | None = None, split: Split | None = None
) -> DataFrame:
    """Result of a query, cast to ``schema`` by column position."""
    rows = spark.read.format("jdbc").options(**query_options(db, sql, split)).load()
    return typed_rows(rows, schema) if schema else rows


def typed_rows(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns cast to a record type by position."""
    renamed = rows.toDF(*schema.fieldNames())
    return renamed.select(*[renamed[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
