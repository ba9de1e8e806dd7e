"""File targets: text rows, event-time folders, committed partitions, JSON documents, topics."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pulseboard.functions.records import RAW, REASON, csv_field, encode_json
from pulseboard.functions.times import format_millis

# Fixed value: the folder of lines without a readable event time.
NO_DATE = "00000000"


def event_date(line: Column | str, position: int = 2, fmt: str = "yyyyMMdd", zone: str = "UTC") -> Column:
    """Folder of a comma-separated line by the epoch milliseconds in one of its fields."""
    return F.coalesce(format_millis(csv_field(line, position, "bigint"), fmt, zone), F.lit(NO_DATE))


def append_batch(path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """Append under the batch number; a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy(*partition_by).format(fmt).save(f"{path}/batch={batch_id}")

    return write


def write_documents(df: DataFrame, index: str, *columns: str) -> DataFrame:
    """Records as JSON documents of an index: (index_name, doc)."""
    return df.select(F.lit(index).alias("index_name"), encode_json(*(columns or df.columns)).alias("doc"))


def raw_documents(df: DataFrame, index: str, value: str = "value") -> DataFrame:
    """Documents that are JSON text already."""
    return df.select(F.lit(index).alias("index_name"), F.col(value).alias("doc"))


def save_documents(docs: DataFrame, path: str, batch_id: int | None = None) -> None:
    """One document per line, one folder per index. With ``batch_id`` a repeated batch replaces itself, else each call appends."""
    rows = docs.select("doc", "index_name").write.partitionBy("index_name")
    if batch_id is None:
        rows.mode("append").text(path)
    else:
        rows.mode("overwrite").text(f"{path}/batch={batch_id}")


def well_formed(docs: DataFrame, value: str = "doc") -> tuple[DataFrame, DataFrame]:
    """(documents, dead letters): text that is no JSON object goes to the second table."""
    fits = F.coalesce(F.json_object_keys(value).isNotNull(), F.lit(False))
    return docs.where(fits), docs.where(~fits)


def with_retries(write: Callable[[DataFrame, int], None], attempts: int = 3,
                 transient: tuple[type[Exception], ...] = (ConnectionError, TimeoutError)):
    """Repeat a batch whose target is overloaded; any other error fails it at once."""

    def guarded(batch: DataFrame, batch_id: int) -> None:
        for left in range(attempts - 1, -1, -1):
            try:
                return write(batch, batch_id)
            except transient:
                if left == 0:
                    raise

    return guarded


def to_topic(df: DataFrame, path: str = "", servers: str = "", name: str = "", batch_id: int | None = None) -> None:
    """Rows as JSON records of a topic. In a folder, a repeated batch replaces itself if ``batch_id`` is given; a message bus gets it twice."""
    records = df.select(encode_json(*df.columns).alias("value"))
    if path and batch_id is not None:
        records.write.mode("overwrite").text(f"{path}/batch={batch_id}")
    elif path:
        records.write.mode("append").text(path)
    else:
        records.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", name).save()


def kept_and_dead(write: Callable[[DataFrame, int], None], dead: str, counts: dict[int, tuple[int, int]] | None = None):
    """Writer of tagged records (``records.tagged_json``): good rows to ``write``, refused lines with their reasons under ``dead``.

    The batch is computed once. The refused lines lie under the batch number and are replaced when the batch is repeated, as are the good rows if
    ``write`` is repeatable. ``counts`` gets (rows, refused rows) of each batch, counted in passing.
    """
    refused = append_batch(dead)

    def split(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        kept = batch.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(REASON).alias("dead")).persist()
        try:
            refused(kept.where(F.col(REASON).isNotNull()).select(F.col(RAW).alias("value"), F.col(REASON).alias("reason")), batch_id)
            write(kept.where(F.col(REASON).isNull()).drop(RAW, REASON), batch_id)
            if counts is not None:
                counts[batch_id] = (seen.get["rows"], seen.get["dead"])
        finally:
            kept.unpersist()

    return split


def several(*writers: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """One micro-batch to several targets; it is computed once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for writer in writers:
                writer(kept, batch_id)
        finally:
            kept.unpersist()

    return write


def mark_folders(folders: DataFrame, root: str, parts: Sequence[str]) -> None:
    """Put a success file into each partition folder; the tasks that hold the rows do it. Marking twice does no harm."""
    names = list(parts)

    def mark(rows) -> None:
        from pyarrow.fs import FileSystem

        system, base = FileSystem.from_uri(root if "://" in root else f"file://{root.removeprefix('file:')}")
        for row in rows:
            folder = "/".join(f"{p}={row[p]}" for p in names)
            system.open_output_stream(f"{base}/{folder}/_SUCCESS").close()

    folders.select(*names).foreachPartition(mark)


class CommittingPartitions:
    """Partitioned parquet target that marks a partition once no more rows are due.

    A partition is complete when the watermark (largest event time minus ``delay``)
    has passed its end plus ``wait``. A complete partition gets a success file; the
    open ones are kept in a small table per batch, so a restart goes on where it stopped.
    """

    def __init__(self, spark: SparkSession, path: str, parts: Sequence[str], ts: str,
                 grain: timedelta, delay: timedelta, wait: timedelta = timedelta(seconds=1)):
        self.spark = spark
        self.path = path
        self.parts = list(parts)
        self.ts = ts
        self.grain = grain
        self.delay = delay
        self.wait = wait

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            # The batch number in the file folder makes a repeated batch replace its own files.
            tagged = kept.withColumn("batch", F.lit(batch_id))
            # One shuffle by folder keeps the files few; a crowded folder is split at run time.
            (
                tagged.hint("rebalance", *self.parts).write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(*self.parts, "batch")
                .parquet(f"{self.path}/data")
            )
            self._track(kept, batch_id)
        finally:
            kept.unpersist()

    def committed(self) -> DataFrame:
        """The complete partitions, as a catalogue of the table would list them."""
        return self.spark.read.parquet(f"{self.path}/committed").select(*self.parts).distinct()

    def publish(self, name: str) -> DataFrame:
        """Make the rows of complete partitions visible as the view ``name``."""
        rows = self.spark.read.parquet(f"{self.path}/data").drop("batch")
        done = self.committed()
        complete = rows.join(done, [rows[p].cast("string").eqNullSafe(done[p].cast("string")) for p in self.parts], "left_semi")
        complete.createOrReplaceTempView(name)
        return complete

    def _track(self, batch: DataFrame, batch_id: int) -> None:
        seconds = int(self.grain.total_seconds())
        start = F.timestamp_seconds(F.floor(F.unix_timestamp(self.ts) / seconds) * seconds)
        touched = batch.groupBy(*self.parts).agg(
            F.min(start).alias("part_start"), F.max(self.ts).alias("max_ts")
        )
        earlier = self._load("pending", batch_id - 1)
        known = touched.unionByName(earlier) if earlier is not None else touched
        known = known.groupBy(*self.parts).agg(
            F.min("part_start").alias("part_start"), F.max("max_ts").alias("max_ts")
        )
        known.write.mode("overwrite").parquet(f"{self.path}/open/n={batch_id}")
        state = self._load("open", batch_id)
        newest = state.agg(F.max(F.unix_micros("max_ts")).alias("t")).first()["t"]
        due = F.lit(False)
        if newest is not None:
            behind = (self.delay + self.wait + self.grain) // timedelta(microseconds=1)
            due = F.unix_micros("part_start") <= F.lit(newest - behind)
        state.where(due).select(*self.parts).write.mode("overwrite").parquet(f"{self.path}/committed/n={batch_id}")
        mark_folders(self._load("committed", batch_id), f"{self.path}/data", self.parts)
        # The newest row stays, it carries the watermark.
        rest = state.where(~due | (F.unix_micros("max_ts") == F.lit(newest)))
        rest.write.mode("overwrite").parquet(f"{self.path}/pending/n={batch_id}")

    def _load(self, kind: str, batch_id: int) -> DataFrame | None:
        path = f"{self.path}/{kind}/n={batch_id}"
        return self.spark.read.parquet(path) if self._exists(f"{path}/_SUCCESS") else None

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), target

    def _exists(self, path: str) -> bool:
        fs, target = self._fs(path)
        return fs.exists(target)
