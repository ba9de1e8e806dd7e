"""Database targets: append, keyed upsert and additive upsert."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.sources.jdbc import Database

DIALECTS = ("merge", "duplicate_key", "upsert_into")


def append_rows(df: DataFrame, db: Database, table: str, batch_size: int = 1000) -> None:
    """Append with ``batch_size`` rows per statement."""
    (
        df.write.format("jdbc")
        .options(**db.reader_options(), dbtable=table, batchsize=str(batch_size))
        .mode("append")
        .save()
    )


def upsert_statement(
    table: str,
    staging: str,
    keys: Sequence[str],
    columns: Sequence[str],
    add: Sequence[str] = (),
    dialect: str = "merge",
) -> str:
    """Statement that moves a staging table into its target.

    Columns in ``add`` are added to the stored value, other non-key columns are
    replaced; with ``add`` given, columns outside it keep the stored value.
    """
    if dialect not in DIALECTS:
        raise ValueError(f"dialect must be one of {DIALECTS}")
    names = ", ".join(columns)
    values = [c for c in columns if c not in keys]
    if dialect == "upsert_into":
        if add:
            raise ValueError("this dialect replaces whole rows")
        return f"UPSERT INTO {table} ({names}) SELECT {names} FROM {staging}"
    if dialect == "duplicate_key":
        sets = [f"{c} = {table}.{c} + s.{c}" for c in add] if add else [f"{c} = s.{c}" for c in values]
        sets = sets or [f"{keys[0]} = {table}.{keys[0]}"]  # keys only: a row that is there stays as it is
        picked = ", ".join(f"s.{c}" for c in columns)
        return (
            f"INSERT INTO {table} ({names}) SELECT {picked} FROM {staging} s "
            f"ON DUPLICATE KEY UPDATE {', '.join(sets)}"
        )
    match = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    sets = [f"{c} = t.{c} + s.{c}" for c in add] if add else [f"{c} = s.{c}" for c in values]
    update = f"WHEN MATCHED THEN UPDATE SET {', '.join(sets)} " if sets else ""
    inserted = ", ".join(f"s.{c}" for c in columns)
    return (
        f"MERGE INTO {table} t USING {staging} s ON {match} {update}"
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({inserted})"
    )


def fold_batch(
    df: DataFrame, keys: Sequence[str], add: Sequence[str] = (), order: Sequence[str] = ()
) -> DataFrame:
    """One row per key of a batch: sums with ``add``, else the last row by ``order``."""
    others = [c for c in df.columns if c not in keys]
    if add:
        kept = [F.first(c).alias(c) for c in others if c not in add]
        return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in add], *kept).select(*df.columns)
    if not order:
        return df.dropDuplicates(list(keys))
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_last"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in df.columns])


class DatabaseUpsert:
    """``foreachBatch`` writer with a keyed upsert.

    The batch goes to a staging table from the executors, then one transaction
    moves it into the target and notes (query, batch) in a ledger. A batch that is
    already noted is skipped, so additive upserts are applied once. Any error
    fails the batch, and the stream repeats it.
    """

    def __init__(
        self,
        db: Database,
        table: str,
        keys: Sequence[str],
        add: Sequence[str] = (),
        order: Sequence[str] = (),
        dialect: str = "merge",
        ledger: str = "pulseboard_ledger",
        query: str = "",
    ):
        if not add and not order:
            raise ValueError("replacing rows needs an order, or an arbitrary row of a key wins")
        self.db = db
        self.table = table
        self.keys = list(keys)
        self.add = list(add)
        self.order = list(order)
        self.dialect = dialect
        self.ledger = ledger
        self.query = query or table

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        folded = fold_batch(batch, self.keys, self.add, self.order)
        staging = self.staging()
        (
            folded.write.format("jdbc")
            .options(**self.db.reader_options(), dbtable=staging)
            .mode("overwrite")
            .save()
        )
        self._move(batch.sparkSession, staging, folded.columns, batch_id)

    def staging(self) -> str:
        """Staging table of this job; two jobs with one target have one each."""
        return f"{self.table}_staging_{zlib.crc32(self.query.encode()):08x}"

    def statements(self, staging: str, columns: Sequence[str], batch_id: int) -> tuple[str, list[str]]:
        """The ledger question and the statements of the transaction."""
        asked = f"SELECT 1 FROM {self.ledger} WHERE query_id = '{self.query}' AND batch_id = {batch_id}"
        return asked, [
            upsert_statement(self.table, staging, self.keys, columns, self.add, self.dialect),
            f"{'UPSERT' if self.dialect == 'upsert_into' else 'INSERT'} INTO {self.ledger} (query_id, batch_id) VALUES ('{self.query}', {batch_id})",
        ]

    def _move(self, spark, staging: str, columns: Sequence[str], batch_id: int) -> None:
        jvm = spark.sparkContext._jvm
        connection = jvm.java.sql.DriverManager.getConnection(self.db.url, self.db.user, self.db.password)
        try:
            connection.setAutoCommit(False)
            asked, statements = self.statements(staging, columns, batch_id)
            statement = connection.createStatement()
            if not statement.executeQuery(asked).next():
                for sql in statements:
                    statement.executeUpdate(sql)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()
