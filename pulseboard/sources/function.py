"""Sources given by a function: numbered rows made in parallel, as a table or as a stream with a rate and an end.

The function makes the rows of any stretch of numbers, and makes the same ones each time; a lost task or a repeated micro-batch is
made again from its numbers alone. A stream's position is the number of rows due by the clock since ``begin``, so a job that was
stopped goes on from its checkpoint and catches up with the rate.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

Rows = Callable[[int, int], Iterator[Any]]


@dataclass
class Stretch(InputPartition):
    """Numbers from ``first`` up to, not including, ``end``."""

    first: int
    end: int


def cut(first: int, end: int, parts: int) -> list[Stretch]:
    """At most ``parts`` stretches of like length; none of them is empty."""
    size = max(1, -(-(end - first) // max(1, parts)))
    return [Stretch(at, min(at + size, end)) for at in range(first, end, size)]


def function_source(name: str, schema: str, rows: Rows) -> type[DataSource]:
    """Data source whose rows numbered ``first`` to ``end - 1`` are ``rows(first, end)``: tuples or Arrow batches.

    Options: ``rows`` (the end), ``parts`` (tasks a read), and for streams ``rowsPerSecond`` and ``begin`` (seconds since 1970).
    """

    class TableReader(DataSourceReader):
        def __init__(self, options: dict[str, str]):
            self.end = int(options["rows"])
            self.parts = int(options.get("parts", "1"))

        def partitions(self) -> list[Stretch]:
            return cut(0, self.end, self.parts) or [Stretch(0, 0)]

        def read(self, partition: Stretch) -> Iterator[Any]:
            return iter(rows(partition.first, partition.end))

    class StreamReader(DataSourceStreamReader):
        def __init__(self, options: dict[str, str]):
            self.end = int(options["rows"])
            self.parts = int(options.get("parts", "1"))
            self.rate = float(options["rowspersecond"])
            self.begin = float(options.get("begin", "0"))

        def initialOffset(self) -> dict:
            return {"n": 0}

        def latestOffset(self) -> dict:
            return {"n": max(0, min(self.end, int((time.time() - self.begin) * self.rate)))}

        def partitions(self, start: dict, end: dict) -> list[Stretch]:
            return cut(start["n"], end["n"], self.parts)

        def read(self, partition: Stretch) -> Iterator[Any]:
            return iter(rows(partition.first, partition.end))

        def commit(self, end: dict) -> None:
            pass

        def stop(self) -> None:
            pass

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> DataSourceReader:
            return TableReader({k.lower(): v for k, v in self.options.items()})

        def streamReader(self, schema) -> DataSourceStreamReader:
            return StreamReader({k.lower(): v for k, v in self.options.items()})

    return Source


def function_table(spark: SparkSession, source: type[DataSource], rows: int, parts: int | None = None) -> DataFrame:
    """The first ``rows`` rows of a source."""
    spark.dataSource.register(source)
    return spark.read.format(source.name()).option("rows", rows).option("parts", parts or spark.sparkContext.defaultParallelism).load()


def function_stream(spark: SparkSession, source: type[DataSource], rows: int, rows_per_second: float,
                    begin: float | None = None, parts: int | None = None) -> DataFrame:
    """The first ``rows`` rows of a source at a rate. Give a job that shall resume the same ``begin`` again."""
    spark.dataSource.register(source)
    return (spark.readStream.format(source.name()).option("rows", rows).option("rowsPerSecond", rows_per_second)
            .option("begin", time.time() if begin is None else begin)
            .option("parts", parts or spark.sparkContext.defaultParallelism).load())


def numbers(first: int, end: int) -> Iterator[Any]:
    """The numbers themselves, in Arrow batches of bounded size."""
    import numpy as np
    import pyarrow as pa

    for at in range(first, end, 65_536):
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, min(at + 65_536, end)))], names=["value"])


NUMBERS = function_source("pulseboard_numbers", "value bigint", numbers)
