"""Keyed tables on files: what one writes by upsert, another reads as one row per key.

Each write is one append of the batch under its batch number, so it costs what the
batch costs, and a repeated batch replaces its own folder. Readers group by key.
``compact`` folds the batches into one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "_batch"
DELETED = "_deleted"
SEQ = "_seq"


class KeyedTable:
    """One row per key.

    ``mode="replace"``: the last write of a key wins, by (sequence, batch).
    ``mode="add"``: ``measures`` are added up, other columns keep their first value.
    ``compact_every`` folds the batches after each so many writes.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        mode: str = "replace",
        measures: Sequence[str] = (),
        compact_every: int | None = None,
    ):
        if mode not in ("replace", "add"):
            raise ValueError("mode must be replace or add")
        self.spark = spark
        self.path = path
        self.schema = schema
        self.keys = list(keys)
        self.mode = mode
        self.measures = list(measures)
        self.compact_every = compact_every

    @property
    def stored(self) -> T.StructType:
        return T.StructType([
            *[T.StructField(f.name, f.dataType, True) for f in self.schema.fields],
            T.StructField(SEQ, T.LongType()),
            T.StructField(DELETED, T.BooleanType()),
            T.StructField(BATCH, T.LongType()),
        ])

    def write(self, batch: DataFrame, batch_id: int, seq: str | None = None, deleted: str | None = None) -> None:
        """Upsert a batch. ``seq`` orders writes of one key, ``deleted`` marks removals.

        A lower sequence than the stored one loses, so late changes do no harm.
        """
        rows = self.folded_batch(batch, batch_id, seq, deleted)
        rows.write.mode("overwrite").parquet(f"{self.path}/delta/n={batch_id}")
        if self.compact_every and (batch_id + 1) % self.compact_every == 0:
            self.compact()

    def folded_batch(self, batch: DataFrame, batch_id: int, seq: str | None = None, deleted: str | None = None) -> DataFrame:
        """The batch in its stored form, one row per key."""
        return self.fold(batch.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields],
            (F.col(seq).cast("bigint") if seq else F.lit(0).cast("bigint")).alias(SEQ),
            (F.col(deleted) if deleted else F.lit(False)).alias(DELETED),
            F.lit(batch_id).cast("bigint").alias(BATCH),
        ))

    def fold(self, rows: DataFrame, also: Sequence[str] = ()) -> DataFrame:
        """One row per key; ``also`` names columns that the key fixes."""
        keys = [*self.keys, *also]
        if self.mode == "add":
            return self._added(rows, keys)
        others = [c for c in rows.columns if c not in keys]
        last = rows.groupBy(*keys).agg(
            F.max_by(F.struct(*others), F.struct(SEQ, BATCH)).alias("_last")
        )
        return last.select(
            *[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in rows.columns]
        )

    def _added(self, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        kept = [c for c in self.schema.fieldNames() if c not in self.keys and c not in self.measures]
        totals = [F.sum(m).cast(self.schema[m].dataType).alias(m) for m in self.measures]
        # Without kept columns all parts have a fixed size, and the totals are hashed and not sorted.
        first = [F.min_by(F.struct(*kept), F.col(BATCH)).alias("_first")] if kept else []
        grouped = rows.groupBy(*keys).agg(
            *totals, *first, F.max(SEQ).alias(SEQ), F.min(BATCH).alias(BATCH), F.bool_and(DELETED).alias(DELETED)
        )
        return grouped.select(*[F.col(f"_first.{c}").alias(c) if c in kept else F.col(c) for c in rows.columns])

    def _numbers(self, kind: str) -> list[int]:
        """Finished folders, oldest first. A folder counts once its job has committed."""
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        return sorted(
            int(s.getPath().getName().removeprefix("n="))
            for s in fs.listStatus(root)
            if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))
        )

    def _parts(self, before: int | None = None) -> list[str]:
        bases = [n for n in self._numbers("base") if before is None or n < before]
        newest = bases[-1] if bases else None
        deltas = [
            n for n in self._numbers("delta")
            if (newest is None or n > newest) and (before is None or n < before)
        ]
        base = [f"{self.path}/base/n={newest}"] if bases else []
        return base + [f"{self.path}/delta/n={n}" for n in deltas]

    def read(self, before: int | None = None) -> DataFrame:
        """The current table, or the table as it was before batch ``before``."""
        parts = self._parts(before)
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.stored).parquet(*parts)
        return self.fold(rows).where(~F.col(DELETED)).select(*self.schema.fieldNames())

    def compact(self) -> None:
        """Fold all batches so far into one base. Readers before and after see the same rows.

        Removed keys stay marked in the base, so that a late older change cannot bring them back.
        """
        deltas = self._numbers("delta")
        parts = self._parts()
        if not deltas or len(parts) < 2:
            return
        rows = self.spark.read.schema(self.stored).parquet(*parts)
        self.fold(rows).write.mode("overwrite").parquet(f"{self.path}/base/n={deltas[-1]}")
