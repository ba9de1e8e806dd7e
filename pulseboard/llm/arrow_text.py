"""Text columns as byte buffers, for numpy work on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

CHUNK_BYTES = 4_000_000
#: Rows of an Arrow batch. Texts run to 100 kB, and a batch is held several times over in a worker and in its executor.
BATCH_ROWS = 1_000


def bounded_batches() -> None:
    """Let the session send texts to Python in batches of at most ``BATCH_ROWS`` rows."""
    SparkSession.active().conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts on end, and the n+1 offsets of the texts. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: first row, end row, bytes, offsets.

    A text longer than the limit is a run of its own; texts are never cut.
    """
    raw, offsets = as_bytes(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(n, max(end, first + 1))
        yield first, end, raw[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def texts(column: pa.Array) -> list[str]:
    """Texts as Python strings; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def ascii_lower(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal true stretches that do not cross a text's end, and the text of each."""
    if len(inside) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(inside))]
    opens[edges] |= inside[edges]
    closes[edges - 1] |= inside[edges - 1]
    starts = np.flatnonzero(opens)
    ends = np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores added until no column has it (Spark does not tell upper and lower case apart)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
