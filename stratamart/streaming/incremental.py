"""Incremental processing of growing tables with Structured Streaming.

One checkpoint per consumer plays the part of a table stream's offset: a file is delivered once, an
empty source gives no batch (the "run only when there is data" rule), and a failed batch is replayed
with the same files.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.merge import table_exists
from ..session import stage


def read_growing(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """A Parquet table that grows by files, as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.parquet(path)


_FILE = "_read_file"


def _ledger(checkpoint: str) -> str:
    return f"{checkpoint}-files"


def _noting_files(checkpoint: str, fn: Callable[[DataFrame, int], None], staged: bool) -> Callable[[DataFrame, int], None]:
    """After the work, the batch's files go to the consumer's ledger; a replayed batch overwrites its entry."""

    def run(batch: DataFrame, batch_id: int) -> None:
        if staged:
            batch = stage(batch, "batch")
        fn(batch if batch.columns == [_FILE] else batch.drop(_FILE), batch_id)
        (
            batch.select(_plain_path(F.col(_FILE)).alias("path")).distinct().withColumn("batch", F.lit(batch_id))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch").parquet(_ledger(checkpoint))
        )

    return run


def incremental(stream: DataFrame, checkpoint: str, fn: Callable[[DataFrame, int], None],
                interval: str | None = None, staged: bool = False) -> StreamingQuery:
    """Hand every new batch to ``fn(batch, batch_id)``.

    Without ``interval`` the query drains the source and ends (an outside scheduler repeats it); with
    one, such as ``5 minutes``, it keeps running. ``fn`` must be idempotent per batch id, as keyed
    merges and per-batch partitions are. The files of each finished batch are noted beside the checkpoint for
    ``stream_status``, in a second pass over the batch. ``stream`` is a file stream, as ``read_growing`` gives it.

    Every pass over a batch reads its files and computes the stream's columns anew. ``staged`` writes the batch once and
    passes on what was written: for a ``fn`` that reads it several times, and a stream that keeps few of its rows.
    """
    noted = stream.withColumn(_FILE, F.col("_metadata.file_path"))
    writer = noted.writeStream.foreachBatch(_noting_files(checkpoint, fn, staged)).option("checkpointLocation", checkpoint)
    if interval:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def drain(stream: DataFrame, checkpoint: str, fn: Callable[[DataFrame, int], None]) -> int:
    """Process everything unread now; the number of batches that ran."""
    ran = 0

    def counted(batch: DataFrame, batch_id: int) -> None:
        nonlocal ran
        fn(batch, batch_id)
        ran += 1

    incremental(stream, checkpoint, counted).awaitTermination()
    return ran


def drain_files(spark: SparkSession, path: str, schema: StructType, checkpoint: str, fn: Callable[[DataFrame, int], None],
                files_per_batch: int | None = None) -> int:
    """As ``drain`` over the Parquet table at ``path``, but a batch is a plain read of its files: Spark then reads only the
    columns and row groups that each pass of ``fn`` needs, where a batch of the stream is read whole every time. The
    stream carries nothing but the names of the files; those of one batch come to the driver."""

    def run(batch: DataFrame, batch_id: int) -> None:
        files = [row[0] for row in batch.select(_FILE).distinct().collect()]
        reader = batch.sparkSession.read.schema(schema).option("basePath", path)
        # Names come encoded, and a reader takes some signs for patterns.
        plain = [re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(name)) for name in files]
        fn(reader.parquet(*plain) if plain else reader.parquet(path).limit(0), batch_id)

    names = read_growing(spark, path, schema, files_per_batch).select(F.col("_metadata.file_path").alias(_FILE))
    return drain(names, checkpoint, run)


def append_only(stream: DataFrame, target: str, checkpoint: str,
                transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> StreamingQuery:
    """Append each batch to ``target``. A replayed batch overwrites its own partition."""

    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return incremental(stream, checkpoint, write)


def _plain_path(c: Column) -> Column:
    """Path without its scheme's slashes, as listing and stream log write them differently."""
    return F.regexp_replace(c, "^([a-zA-Z0-9]+):/+", "$1:/")


def pending_files(spark: SparkSession, source: str, checkpoint: str, glob: str = "*.parquet") -> DataFrame:
    """Files with rows of the source that the consumer's ledger does not name."""
    listed = (
        spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").parquet(source)
        .select(_plain_path(F.col("_metadata.file_path")).alias("path")).distinct()
    )
    if not table_exists(spark, _ledger(checkpoint)):
        return listed
    return listed.join(spark.read.parquet(_ledger(checkpoint)).select("path"), "path", "left_anti")


def stream_status(spark: SparkSession, streams: list[tuple[str, str, str]], glob: str = "*.parquet") -> DataFrame:
    """Does each ``(name, source, checkpoint)`` hold unread data?"""
    lines = []
    for name, source, checkpoint in streams:
        unread = (
            pending_files(spark, source, checkpoint, glob)
            if table_exists(spark, source) else spark.range(0).select(F.lit("").alias("path"))
        )
        lines.append(
            unread.agg(F.count(F.lit(1)).alias("pending_files"))
            .select(F.lit(name).alias("stream_name"), (F.col("pending_files") > 0).alias("has_data"), "pending_files")
        )
    return reduce(DataFrame.unionByName, lines)
