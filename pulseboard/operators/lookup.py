"""Joins of a fact table or stream with a dimension."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from time import monotonic

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def lookup_join(facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str) -> DataFrame:
    """Inner equi join with a dimension; double keys in the dimension give double rows.

    No hint is given: the session's broadcast threshold compares the real size of
    the dimension, and a larger one is shuffled, with skewed keys split at run time.
    """
    return facts.join(dimension, facts[fact_key] == dimension[dimension_key], "inner")


def counted_lookup_join(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """As ``lookup_join`` for a source without size statistics, such as a database table.

    Rows and bytes are added up first, over at most ``max_rows + 1`` rows; a larger
    dimension is joined by shuffle.
    """
    side = F.broadcast(dimension) if fits(dimension, max_rows, max_bytes) else dimension
    return facts.join(side, facts[fact_key] == side[dimension_key], "inner")


def fits(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """Whether a table has at most so many rows and bytes."""
    sizes = df.select(_row_bytes(df).alias("b")).limit(max_rows + 1)
    found = sizes.agg(F.count(F.lit(1)).alias("rows"), F.sum("b").alias("bytes")).first()
    return found["rows"] <= max_rows and (found["bytes"] or 0) <= max_bytes


def _row_bytes(df: DataFrame) -> Column:
    """Size of a row in memory, roughly and from above."""
    total = F.lit(16).cast("bigint")
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            total = total + 2 * F.coalesce(F.octet_length(F.to_json(column)), F.lit(0)) + 16
        elif isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(column), F.lit(0)) + 16
        else:
            total = total + 16
    return total


def keyed_lookup(
    facts: DataFrame,
    dimension: DataFrame,
    keys: Sequence[tuple[str, str]],
    max_keys: int = 10_000,
) -> DataFrame:
    """Set-wise form of a point lookup by one or several key columns (all must match).

    When the batch holds few keys they are pushed into the dimension scan as an IN
    list per key column, so a database returns only candidate rows; a batch with
    more than ``max_keys`` keys reads the dimension as a whole.
    """
    fact_keys = [f for f, _ in keys]
    wanted = facts.select(*fact_keys).distinct().limit(max_keys + 1).collect()
    narrowed = dimension
    if len(wanted) <= max_keys:
        for fact_key, dimension_key in keys:
            values = sorted({row[fact_key] for row in wanted if row[fact_key] is not None})
            narrowed = narrowed.where(F.col(dimension_key).isin(values))
    condition = F.lit(True)
    for fact_key, dimension_key in keys:
        condition = condition & (facts[fact_key] == narrowed[dimension_key])
    return facts.join(narrowed, condition, "inner")


class RefreshingDimension:
    """Dimension that is loaded again once it is older than ``ttl`` seconds.

    Called in each micro-batch. A file table is listed anew on each load, so files
    that came later are seen; within the time to live the same plan is used again.
    """

    def __init__(self, load: Callable[[], DataFrame], ttl: float = 0.0, retries: int = 3):
        self._load = load
        self._ttl = ttl
        self._retries = retries
        self._current: DataFrame | None = None
        self._loaded_at = 0.0
        self.loads = 0

    def __call__(self) -> DataFrame:
        age = monotonic() - self._loaded_at
        if self._current is None or age >= self._ttl:
            self._current = self._attempt()
            self._loaded_at = monotonic()
            self.loads += 1
        return self._current

    def _attempt(self) -> DataFrame:
        for left in range(self._retries, -1, -1):
            try:
                return self._load()
            except Exception:
                if left == 0:
                    raise
        raise AssertionError("unreachable")
