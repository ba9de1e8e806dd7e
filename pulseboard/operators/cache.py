"""A bounded cache of looked-up dimension rows for streaming joins."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from time import monotonic

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseboard.session import drop_path, new_path

LOADED, USED, FOUND = "_loaded", "_used", "_found"


class LookupCache:
    """Rows of a dimension by key, kept for at most ``ttl`` seconds and for at most ``max_keys`` keys.

    Each batch asks the source only for the keys that the cache does not hold or holds too long; ``load`` gets them as a table and
    returns the dimension's rows of these keys (for a database by a pushed-down list, for a table by a semi join). A key without a row is
    remembered as such. The least recently used keys go first. A failing read is tried again ``retries`` times.

    The cache is a table in the shared folder, so it outlives executors; a batch writes its new version and the version before the last one is
    removed. ``asked`` counts the keys that were read from the source, ``reads`` the reads.
    """

    def __init__(self, spark: SparkSession, load: Callable[[DataFrame], DataFrame], schema: T.StructType, keys: Sequence[str],
                 ttl: float = 60.0, max_keys: int = 100_000, retries: int = 3, clock: Callable[[], float] = monotonic):
        self.spark = spark
        self.keys = list(keys)
        self.schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
        self.ttl = ttl
        self.max_keys = max_keys
        self.retries = retries
        self.asked = 0
        self.reads = 0
        self.path = new_path(spark, "cache")
        self._load = load
        self._clock = clock
        self._version = 0

    @property
    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(FOUND, T.BooleanType()), T.StructField(LOADED, T.DoubleType()), T.StructField(USED, T.DoubleType())])

    def held(self) -> DataFrame:
        """The newest version of the cache."""
        if not self._version:
            return self.spark.createDataFrame([], self._stored)
        return self.spark.read.schema(self._stored).parquet(f"{self.path}/n={self._version}/rows")

    def join(self, facts: DataFrame, fact_keys: Sequence[str]) -> DataFrame:
        """Inner join of a batch with the dimension's rows of its keys."""
        now = float(self._clock())
        facts = facts.persist()
        try:
            wanted = facts.select(*[F.col(f).alias(k) for f, k in zip(fact_keys, self.keys, strict=True)]).distinct().na.drop()
            rows = self._advance(wanted, now)
        finally:
            facts.unpersist()
        renamed = rows.where(FOUND).drop(FOUND, LOADED, USED)
        match = F.lit(True)
        for f, k in zip(fact_keys, self.keys, strict=True):
            match = match & (facts[f] == renamed[k])
        return facts.join(renamed, match, "inner")

    def _advance(self, wanted: DataFrame, now: float) -> DataFrame:
        """Write the next version; returns the rows of the wanted keys."""
        number, base = self._version + 1, f"{self.path}/n={self._version + 1}"
        fresh = self.held().where(F.lit(now) - F.col(LOADED) < self.ttl)
        wanted.join(fresh.select(*self.keys).distinct(), self.keys, "left_anti").write.mode("overwrite").parquet(f"{base}/asked")
        asked = self.spark.read.schema(wanted.schema).parquet(f"{base}/asked")
        missing = asked.count()
        if missing:
            self._fetch(asked, f"{base}/fetched")
            self.asked += missing
            got = self.spark.read.schema(self.schema).parquet(f"{base}/fetched").withColumn(FOUND, F.lit(True))
            none = asked.join(got.select(*self.keys).distinct(), self.keys, "left_anti").withColumn(FOUND, F.lit(False))
            new = got.unionByName(none, allowMissingColumns=True).withColumn(LOADED, F.lit(now)).withColumn(USED, F.lit(now))
        else:
            new = self.spark.createDataFrame([], self._stored)
        # Keys that this batch asks for are used now.
        touched = wanted.withColumn("_now", F.lit(True))
        kept = fresh.join(touched, self.keys, "left").withColumn(USED, F.when(F.col("_now"), F.lit(now)).otherwise(F.col(USED))).drop("_now")
        rows = kept.select(*self._stored.fieldNames()).unionByName(new.select(*self._stored.fieldNames()))
        rows.write.mode("overwrite").parquet(f"{base}/all")
        rows = self.spark.read.schema(self._stored).parquet(f"{base}/all")
        staying = rows.select(*self.keys, USED).distinct().orderBy(F.col(USED).desc(), *self.keys).limit(self.max_keys).select(*self.keys)
        rows.join(staying, self.keys, "left_semi").write.mode("overwrite").parquet(f"{base}/rows")
        # The batch before may still be read by its writer; what came before that is released.
        drop_path(self.spark, f"{self.path}/n={self._version - 1}")
        self._version = number
        return rows.join(wanted, self.keys, "left_semi")

    def _fetch(self, asked: DataFrame, path: str) -> None:
        for left in range(self.retries, -1, -1):
            try:
                self.reads += 1
                rows = self._load(asked)
                rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]).write.mode("overwrite").parquet(path)
                return
            except Exception:
                if left == 0:
                    raise
