"""Register of queries: a Spark function and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from pulseboard.session import use_utc

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register the decorated function under ``name``."""

    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered already")
        def in_utc(spark: SparkSession, folder: str) -> DataFrame:
            return run(use_utc(spark), folder)

        QUERIES[name] = Query(name, in_utc, sql)
        return run

    return register
