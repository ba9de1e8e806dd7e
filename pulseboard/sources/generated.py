"""Synthetic tables: sequences, integers in a range, random text, a rate of rows per second."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Sequence:
    start: int = 1
    end: int = 1000


@dataclass(frozen=True)
class RandomInt:
    low: int = 1
    high: int = 1000


@dataclass(frozen=True)
class RandomText:
    length: int = 10


Field = Sequence | RandomInt | RandomText


def _value(spec: Field, row: Column, seed: int) -> Column:
    if isinstance(spec, Sequence):
        return (row + spec.start).cast("int")
    if isinstance(spec, RandomInt):
        span = spec.high - spec.low + 1
        return (F.pmod(F.xxhash64(row, F.lit(seed)), F.lit(span)) + spec.low).cast("int")
    # A digest holds 64 hexadecimal characters; more are chained from further digests.
    pieces = [F.sha2(F.concat_ws(":", row, F.lit(seed), F.lit(i)), 256) for i in range(-(-spec.length // 64))]
    return F.substring(F.concat(*pieces), 1, spec.length)


def with_fields(rows: DataFrame, row: str, fields: dict[str, Field], seed: int = 0) -> DataFrame:
    """Add generated columns to ``rows``; equal rows and seeds give equal values in any partitioning.

    A sequence ends the table: rows behind its last value are dropped.
    """
    number = F.col(row)
    for spec in fields.values():
        if isinstance(spec, Sequence):
            rows = rows.where(number <= spec.end - spec.start)
    return rows.select(
        "*", *[_value(spec, number, seed + i).alias(name) for i, (name, spec) in enumerate(fields.items())]
    )


def generated_table(spark: SparkSession, rows: int, fields: dict[str, Field], seed: int = 0) -> DataFrame:
    """Bounded table, made in parallel."""
    return with_fields(spark.range(rows), "id", fields, seed).drop("id").withColumn("ts", F.localtimestamp())


def generated_stream(spark: SparkSession, fields: dict[str, Field], rows_per_second: int = 5, seed: int = 0) -> DataFrame:
    """Unbounded table at a fixed rate, with the time of each row in ``ts``."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return with_fields(rate, "value", fields, seed).drop("value").withColumnRenamed("timestamp", "ts")
