from pyspark.sql import functions as F

from stratamart.streaming import incremental

SCHEMA = "id int, v string"


def deliver(spark, path, *ids):
    spark.createDataFrame([(i, f"v{i}") for i in ids], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_append_only_reads_each_file_once(spark, tmp_path, rows):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ck"))
    for ids in ((1, 2), (3,), ()):
        if ids:
            deliver(spark, source, *ids)
        stream = incremental.read_growing(spark, source, spark.read.parquet(source).schema)
        incremental.append_only(stream, target, checkpoint).awaitTermination()
    assert rows(spark.read.parquet(target), "id", "batch") == [(1, 0), (2, 0), (3, 1)]


def test_replayed_batch_overwrites_itself(spark, tmp_path, rows):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ck"))
    deliver(spark, source, 1, 2)
    schema = spark.read.parquet(source).schema
    incremental.append_only(incremental.read_growing(spark, source, schema), target, checkpoint).awaitTermination()
    for name in ("0", ".0.crc"):
        (tmp_path / "ck" / "commits" / name).unlink()
    incremental.append_only(incremental.read_growing(spark, source, schema), target, checkpoint).awaitTermination()
    assert rows(spark.read.parquet(target), "id") == [(1,), (2,)]


def test_many_small_runs_equal_one(spark, tmp_path):
    source = str(tmp_path / "in")
    for i in range(4):
        deliver(spark, source, i)
    schema = spark.read.parquet(source).schema
    seen = []
    batches = incremental.drain(
        incremental.read_growing(spark, source, schema, files_per_batch=1), str(tmp_path / "ck"),
        lambda batch, _: seen.extend(r.id for r in batch.collect()))
    assert batches == 4 and sorted(seen) == [0, 1, 2, 3]
    # Nothing new: no batch runs.
    assert incremental.drain(incremental.read_growing(spark, source, schema), str(tmp_path / "ck"),
                             lambda batch, _: seen.append("again")) == 0
    assert "again" not in seen


def test_stream_status(spark, tmp_path, rows):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "ck")
    streams = [("S", source, checkpoint), ("MISSING", str(tmp_path / "none"), str(tmp_path / "ck2"))]
    deliver(spark, source, 1)
    status = lambda: rows(incremental.stream_status(spark, streams))
    assert status() == [("MISSING", False, 0), ("S", True, 1)]
    schema = spark.read.parquet(source).schema
    incremental.drain(incremental.read_growing(spark, source, schema), checkpoint, lambda batch, _: batch.count())
    assert status() == [("MISSING", False, 0), ("S", False, 0)]
    deliver(spark, source, 2)
    deliver(spark, source, 3)
    assert status() == [("MISSING", False, 0), ("S", True, 2)]
    # A file without rows is not data, and the ledger is the consumer's own.
    spark.createDataFrame([], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    incremental.drain(incremental.read_growing(spark, source, schema), checkpoint, lambda batch, _: batch.count())
    assert status() == [("MISSING", False, 0), ("S", False, 0)]
    assert rows(spark.read.parquet(f"{checkpoint}-files").groupBy("batch").count(), "batch", "count") == [(0, 1), (1, 2)]


def test_staged_batch_is_read_from_what_was_written(spark, tmp_path, rows):
    """Passes after the first do not go through the stream's columns again."""
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "ck")
    deliver(spark, source, 1, 2, 3)
    stream = incremental.read_growing(spark, source, spark.read.parquet(source).schema).where("id > 1")
    seen = []

    def run(batch, batch_id):
        seen.append((rows(batch, "id"), [f.split("/stratamart/")[-1].split("/")[1].split("-")[0] for f in batch.inputFiles()]))

    incremental.incremental(stream, checkpoint, run, staged=True).awaitTermination()
    assert [r for r, _ in seen] == [[(2,), (3,)]] and set(seen[0][1]) == {"batch"}
    assert incremental.pending_files(spark, source, checkpoint).count() == 0
