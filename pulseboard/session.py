"""Session settings and the shared folder for stored intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_test_dirs: dict[str, str] = {}


def build_session(app: str = "pulseboard", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings that every job here relies on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def share_code(spark: SparkSession) -> None:
    """Send this package to the executors of a cluster where it is not installed."""
    import shutil
    from pathlib import Path

    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='code-')}/{package.name}", "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times carry no zone; every operator reads them as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach.

    It is the one the cluster names; only a local session without one gets a
    temporary folder of its own.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _test_dirs:
        _test_dirs[app] = "file://" + tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _test_dirs[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; never reused, so a retry meets no old files."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def scratch_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_dir(spark)}/pulseboard/{spark.sparkContext.applicationId}"


def path_exists(spark: SparkSession, name: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def drop_path(spark: SparkSession, name: str) -> None:
    """Remove a folder, if it is there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_scratch(spark: SparkSession) -> None:
    """Remove the stored intermediate tables of this application, once its results are written elsewhere."""
    drop_path(spark, scratch_dir(spark))


def files_state(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """Names, sizes and times of the files at a path; another value means that they have changed."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in system.listStatus(root)))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Store ``df`` in the shared folder and go on from the stored table.

    Cuts the lineage and pins values such as partition numbers, so that a
    recomputation after a lost executor reads the same rows again.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stream_session(spark: SparkSession, idle_inputs: bool = False, partitions: int | None = None) -> SparkSession:
    """Session of a streaming job.

    State keeps the partition count it was created with, so it is ``partitions`` or else follows the
    cores of the cluster at this moment (too few if executors are still to come), not a batch default. With ``idle_inputs`` the
    watermark of a job with several inputs follows the fastest one, so an input
    that falls silent does not hold the others.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max" if idle_inputs else "min")
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.shuffle.partitions", str(partitions or spark.sparkContext.defaultParallelism))
    session.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return session
