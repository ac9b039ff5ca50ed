"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}


def build_session(app: str = "stratamart", master: str | None = None, shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A session with the settings the jobs assume; on a cluster leave ``master`` to spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Recording the call site of every column expression costs more than building it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may run without that setting; it then gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="stratamart-")
    return _local_scratch[context.applicationId]


def _app_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stratamart/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder, in this application's part of it."""
    return f"{_app_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    """A path and its store. Spark has no public call to ask for or delete one; all such use is here."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    folder, store = _folder(spark, path)
    return store.exists(folder)


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, from one call to the store."""
    folder, store = _folder(spark, pattern)
    return [str(found.getPath()) for found in store.globStatus(folder) or []]


def remove_path(spark: SparkSession, path: str) -> None:
    folder, store = _folder(spark, path)
    store.delete(folder, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's staged tables, once no frame still to be run depends on them."""
    remove_path(spark, _app_dir(spark))


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind.

    Spark otherwise keeps them until the driver collects its garbage, so a chain of written tables holds the shuffles of
    all its steps at once. Only for writes: a frame that is run again as it is would have to shuffle anew.
    """
    before = spark.conf.get(_FREE_SHUFFLES)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage with a written table: later passes over the result see the same rows even when
    executors are lost, and an expensive input is computed once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_freed(spark):
        df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)
