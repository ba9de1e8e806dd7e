"""Starting and draining streaming queries."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BatchWriter = Callable[[DataFrame, int], None]


def event_time(df: DataFrame, ts: str, delay: str = "3 seconds") -> DataFrame:
    """Event time with bounded disorder; rows behind the watermark are dropped and counted.

    A zone-free time is read as UTC, since a watermark needs an instant. The
    watermark is one value per query, so an idle source partition never holds it.
    """
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def processing_time(df: DataFrame, name: str = "proc_time") -> DataFrame:
    """Time of the micro-batch, for jobs that go by arrival."""
    return df.withColumn(name, F.current_timestamp())


def start(
    df: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    """Start a job. ``every`` is the refresh interval; without it the available data is drained."""
    writer = df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return trigger.start()


def drain(df: DataFrame, write: BatchWriter, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run a job over everything that is there now and wait for its end."""
    query = start(df, write, checkpoint, mode)
    query.awaitTermination()
    return query


def run_to(df: DataFrame, write: BatchWriter, checkpoint: str, offset: dict, limit: float = 600.0) -> StreamingQuery:
    """Run a job whose source has an end until a batch that ends at ``offset`` is written, then stop it."""
    query = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()
    stop_at = time.monotonic() + limit
    try:
        while not any(p["numInputRows"] > 0 and p["sources"][0]["endOffset"] == offset
                      for p in (json.loads(progress.json) for progress in query.recentProgress)):
            if query.awaitTermination(0.2):
                raise RuntimeError("the job ended before its source did")
            if time.monotonic() > stop_at:
                raise TimeoutError(f"the source did not come to {offset} in {limit} seconds")
    finally:
        query.stop()
    return query


def print_rows(df: DataFrame, checkpoint: str, mode: str = "append", rows: int = 20) -> StreamingQuery:
    """Drain to the console."""
    query = (
        df.writeStream.format("console").outputMode(mode).option("numRows", rows)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def text_rows(df: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = (),
              every: str | None = None, rows_per_file: int | None = None) -> StreamingQuery:
    """Rolling text files: a new file per trigger, and after ``rows_per_file`` rows."""
    writer = df.writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def drop_checkpoint(spark, checkpoint: str) -> None:
    """Remove the checkpoint of a cancelled job; a job that shall resume keeps it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(checkpoint)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
