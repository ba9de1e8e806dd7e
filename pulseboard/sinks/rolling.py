"""Rolling text files: a folder's open lines become finished files by size, age or inactivity.

Each micro-batch is put under its number among the open lines. A small table per step holds, for every folder with open lines, since
which batch and time they are open, their bytes, and the time of the last write. Folders that are due are read from their open
batches and written as finished files of about ``max_bytes``; readers look at finished files only. A repeated batch replaces its
own lines, files and table. ``tick`` closes what is due between batches, as an idle stream brings none.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseboard.session import drop_path


class RollingFiles:
    """Writer for ``foreachBatch``; ``value`` holds the lines, ``parts`` the folders. ``clock`` gives seconds."""

    def __init__(self, spark: SparkSession, path: str, parts: Sequence[str], max_bytes: int, max_age: timedelta, idle: timedelta,
                 value: str = "value", clock: Callable[[], float] = time.time):
        self.spark = spark
        self.path = path
        self.parts = list(parts)
        self.max_bytes = max_bytes
        self.max_age = max_age.total_seconds()
        self.idle = idle.total_seconds()
        self.value = value
        self.clock = clock
        self._kinds = ", ".join(f"{p} string" for p in self.parts)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        lines = batch.select(F.col(self.value).alias("value"), *[F.col(p).cast("string").alias(p) for p in self.parts])
        target = f"{self.path}/lines/batch={batch_id}"
        # One shuffle by folder keeps the open files few; a crowded folder is split at run time.
        lines.hint("rebalance", *self.parts).write.mode("overwrite").partitionBy(*self.parts).text(target)
        # Counted from what was written, so that the batch is computed once.
        written = self._lines([batch_id]).groupBy(*self.parts).agg(F.sum(F.octet_length("value").cast("long") + 1).alias("bytes"))
        now = F.lit(self.clock())
        written = written.select(*self.parts, "bytes", F.lit(batch_id).cast("long").alias("since"), now.alias("opened"), now.alias("last"))
        before = self._latest(batch_id - 1)
        self._step(written if before is None else written.unionByName(self._state(before)), batch_id, 0)
        if before is not None:
            self._forget(before)

    def tick(self) -> None:
        """Close the folders that are due by now; call it between batches."""
        last = self._last_batch()
        at = self._latest(last) if last is not None else None
        if at is not None:
            self._step(self._state(at), at[0], at[1] + 1)

    def finished(self) -> DataFrame:
        """The lines of finished files, with their folders."""
        kinds = f"value string, roll string, {self._kinds}, file int"
        if self._exists(f"{self.path}/finished"):
            rows = self.spark.read.schema(kinds).text(f"{self.path}/finished")
        else:
            rows = self.spark.createDataFrame([], kinds)
        return rows.select("value", *self.parts, "roll", "file")

    def _step(self, known: DataFrame, batch_id: int, turn: int) -> None:
        """Merge the open folders, write those that are due, keep the rest as the table of this step."""
        now = self.clock()
        merged = known.groupBy(*self.parts).agg(F.sum("bytes").alias("bytes"), F.min("since").alias("since"), F.min("opened").alias("opened"),
                                                F.max("last").alias("last"))
        due = (F.col("bytes") >= self.max_bytes) | (F.lit(now) - F.col("opened") >= self.max_age) | (F.lit(now) - F.col("last") >= self.idle)
        step = f"{batch_id}-{turn}"
        merged.withColumn("due", due).write.mode("overwrite").parquet(f"{self.path}/judged/step={step}")
        judged = self.spark.read.schema(merged.schema.add("due", "boolean")).parquet(f"{self.path}/judged/step={step}")
        first = judged.where("due").agg(F.min("since")).first()[0]
        if first is not None:
            self._finish(judged.where("due"), range(first, batch_id + 1), step)
        judged.where(~F.col("due")).drop("due").write.mode("overwrite").parquet(f"{self.path}/open/step={step}")

    def _finish(self, due: DataFrame, batches: Sequence[int], step: str) -> None:
        # Null folders are written and read back as null.
        asked = due.select(*[F.col(p).alias(f"due_{p}") for p in self.parts], "since",
                           F.ceil(F.col("bytes") / self.max_bytes).cast("int").alias("files"))
        same = [F.col(p).eqNullSafe(F.col(f"due_{p}")) for p in self.parts]
        rows = self._lines(batches).join(asked, [*same, F.col("batch") >= F.col("since")])
        # The hash deals a folder's lines over its files and is the same on a second run.
        rows = rows.select("value", *self.parts, F.pmod(F.xxhash64("value", "batch"), F.greatest("files", F.lit(1))).cast("int").alias("file"))
        rows.repartition(*self.parts, "file").write.mode("overwrite").partitionBy(*self.parts, "file").text(f"{self.path}/finished/roll={step}")

    def _lines(self, batches: Sequence[int]) -> DataFrame:
        return (self.spark.read.schema(f"value string, batch long, {self._kinds}").option("basePath", f"{self.path}/lines")
                .text([f"{self.path}/lines/batch={b}" for b in batches if self._exists(f"{self.path}/lines/batch={b}")]))

    def _state(self, at: tuple[int, int]) -> DataFrame:
        kinds = f"{self._kinds}, bytes long, since long, opened double, last double"
        return self.spark.read.schema(kinds).parquet(f"{self.path}/open/step={at[0]}-{at[1]}").select(*self.parts, "bytes", "since", "opened", "last")

    def _latest(self, batch_id: int) -> tuple[int, int] | None:
        """The last finished step of a batch: the batch itself or a tick after it."""
        turn = -1
        while self._exists(f"{self.path}/open/step={batch_id}-{turn + 1}/_SUCCESS"):
            turn += 1
        return (batch_id, turn) if turn >= 0 else None

    def _last_batch(self) -> int | None:
        system, root = self._fs(f"{self.path}/open")
        if not system.exists(root):
            return None
        return max((int(s.getPath().getName().split("=")[1].split("-")[0]) for s in system.listStatus(root)), default=None)

    def _forget(self, at: tuple[int, int]) -> None:
        """Remove open lines from before the oldest batch that the step ``at`` still needs, which a repeated batch starts from."""
        needed = self._state(at).agg(F.min("since")).first()[0]
        needed = at[0] + 1 if needed is None else needed
        system, root = self._fs(f"{self.path}/lines")
        for found in system.listStatus(root):
            if int(found.getPath().getName().split("=")[1]) < needed:
                drop_path(self.spark, found.getPath().toString())

    def _fs(self, path: str):
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), target

    def _exists(self, path: str) -> bool:
        system, target = self._fs(path)
        return system.exists(target)
