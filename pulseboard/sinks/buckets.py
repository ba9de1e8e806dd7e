"""A keyed table whose batches read and rewrite only the buckets they touch.

Rows lie in hash buckets of their key. A batch reads the buckets of its keys, merges, and writes them
as new files beside the old ones; a small list says which version of each bucket counts. The list is written last, so
a batch that fails midway leaves the table as it was, and a repeated batch starts from the list before it. Versions
that neither the newest list nor the one before it names are removed: the number of folders does not grow with the batches.
A batch that is repeated after its list was written replaces its own files; readers have to wait for its end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseboard.sinks.keyed import BATCH, DELETED, SEQ, KeyedTable

BUCKET = "_bucket"
NEVER = -1


class BucketedTable:
    """One row per key, as ``KeyedTable`` (same modes, sequences and deletions), stored in ``buckets`` rewritten parts.

    Deleted keys stay marked, so a late older change does not bring them back.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], mode: str = "replace",
                 measures: list[str] | tuple[str, ...] = (), buckets: int = 32):
        self.spark = spark
        self.path = path
        self.schema = schema
        self.keys = list(keys)
        self.buckets = buckets
        self._rules = KeyedTable(spark, path, schema, keys, mode, measures)
        #: Buckets that the last batch read and wrote.
        self.touched: list[int] = []

    def write(self, batch: DataFrame, batch_id: int, seq: str | None = None, deleted: str | None = None) -> None:
        """Upsert a batch. ``seq`` orders writes of one key, ``deleted`` marks removals."""
        rows = self._rules.folded_batch(batch, batch_id, seq, deleted)
        rows = rows.withColumn(BUCKET, self._bucket()).persist()
        try:
            # At most as many rows as there are buckets.
            self.touched = sorted(r[0] for r in rows.select(BUCKET).distinct().collect())
            before = self._versions(batch_id)
            old = self._rows({b: before[b] for b in self.touched if b in before})
            merged = rows if old is None else old.unionByName(rows)
            # The bucket is fixed by the key, so grouping by both keeps it.
            done = self._rules.fold(merged, [BUCKET])
            done.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/v={batch_id}")
        finally:
            rows.unpersist()
        now = before | dict.fromkeys(self.touched, batch_id)
        listed = [(b, v) for b, v in sorted(now.items())] or [(NEVER, NEVER)]
        self.spark.createDataFrame(listed, "bucket int, version bigint").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/list/n={batch_id}")
        self._clean(batch_id, now, before)

    def read(self) -> DataFrame:
        """The table as the newest list names it."""
        rows = self._rows(self._versions())
        if rows is None:
            return self.spark.createDataFrame([], self.schema)
        return rows.where(~F.col(DELETED)).select(*self.schema.fieldNames())

    def read_buckets(self, keys: DataFrame) -> DataFrame:
        """Rows of the given keys; only their buckets are read."""
        wanted = keys.select(self._bucket().alias(BUCKET)).distinct().collect()
        versions = self._versions()
        rows = self._rows({r[0]: versions[r[0]] for r in wanted if r[0] in versions})
        if rows is None:
            return self.spark.createDataFrame([], self.schema)
        return rows.where(~F.col(DELETED)).select(*self.schema.fieldNames()).join(keys.select(*self.keys).distinct(), self.keys, "left_semi")

    def _rows(self, versions: dict[int, int]) -> DataFrame | None:
        if not versions:
            return None
        # The folders are read by name: no part of their path becomes a column.
        paths = [f"{self.path}/v={v}/{BUCKET}={b}" for b, v in sorted(versions.items())]
        return self.spark.read.schema(self._rules.stored).parquet(*paths).withColumn(BUCKET, self._bucket())

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _versions(self, before: int | None = None) -> dict[int, int]:
        """The version of each bucket in the newest finished list."""
        numbers = [n for n in self._numbers("list", "n=") if before is None or n < before]
        for n in reversed(numbers):
            if self._exists(f"{self.path}/list/n={n}/_SUCCESS"):
                rows = self.spark.read.schema("bucket int, version bigint").parquet(f"{self.path}/list/n={n}").collect()
                return {r["bucket"]: r["version"] for r in rows if r["bucket"] != NEVER}
        return {}

    def _clean(self, batch_id: int, *kept: dict[int, int]) -> None:
        """Remove what no list that may still be read names."""
        named = {(v, b) for versions in kept for b, v in versions.items()}
        for v in self._numbers("", "v="):
            if v > batch_id:
                continue
            used = {b for version, b in named if version == v}
            if not used and v != batch_id:
                self._delete(f"{self.path}/v={v}")
                continue
            for b in self._numbers(f"v={v}", f"{BUCKET}="):
                if b not in used:
                    self._delete(f"{self.path}/v={v}/{BUCKET}={b}")
        lists = [n for n in self._numbers("list", "n=") if n < batch_id]
        for n in lists[:-1]:
            self._delete(f"{self.path}/list/n={n}")

    def _fs(self, path: str):
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), target

    def _numbers(self, folder: str, mark: str) -> list[int]:
        fs, target = self._fs(f"{self.path}/{folder}" if folder else self.path)
        if not fs.exists(target):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(target)]
        return sorted(int(n.removeprefix(mark)) for n in names if n.startswith(mark))

    def _exists(self, path: str) -> bool:
        fs, target = self._fs(path)
        return fs.exists(target)

    def _delete(self, path: str) -> None:
        fs, target = self._fs(path)
        fs.delete(target, True)
