import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratamart.operators import layout, merge
from stratamart.plans import full_run
from stratamart.sources import load, scan


@pytest.fixture(scope="module")
def grid(spark):
    return spark.range(20_000).select(
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.xxhash64("id") % 180 + 180).cast("int")).alias("day"),
        F.concat(F.lit("CUST-"), F.lpad((F.xxhash64("id", F.lit(1)) % 1000 + 1000).cast("string"), 5, "0")).alias("who"),
        F.col("id"), F.lit("x").alias("c0"),
    )


def met(spark, path, key, value):
    stored = spark.read.parquet(path)
    r = layout.files_met(layout.file_spans(stored, ["day", "who"]), key, F.lit(value), F.lit(value)).first()
    return r["files"], r["files_met"], stored.where(F.col(key) == F.lit(value)).count()


def test_a_filter_on_either_key_meets_few_files(spark, grid, tmp_path):
    path = str(tmp_path / "curve")
    layout.along_curve(grid, ["day", "who"], 196).write.parquet(path)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == sorted(map(tuple, grid.collect()))
    some = grid.where("id % 997 = 5").collect()
    for key in ("day", "who"):
        for value in (r[key] for r in some[:4]):
            files, seen, found = met(spark, path, key, value)
            assert files >= 180 and seen * 5 < files and found == grid.where(F.col(key) == F.lit(value)).count()


def test_hot_pairs_nulls_and_long_texts(spark, tmp_path):
    hot = spark.range(3000).select(F.lit(dt.date(2024, 1, 1)).alias("day"), F.lit("hot" * 5000).alias("who"), "id")
    rest = spark.createDataFrame([(None, None, 1), (None, "ä", 2), (dt.date(2023, 1, 1), "", 3)], "day date, who string, id long")
    path = str(tmp_path / "hot")
    layout.along_curve(hot.unionByName(rest), ["day", "who"], 8).write.parquet(path)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy("_metadata.file_path").count().collect()]
    assert sum(sizes) == 3003 and max(sizes) < 1500


def test_empty_input_and_too_many_keys(spark, grid, tmp_path):
    layout.along_curve(grid.where("false"), ["day", "who"], 4).write.parquet(str(tmp_path / "none"))
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        layout.along_curve(grid, ["day", "who"], 4, bits=40)


def test_rewrite_keeps_the_rows_and_replaces_the_runs(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    frame = lambda *ids: spark.createDataFrame([(i, i % 3) for i in ids], "k int, v int")
    merge.merge_into_path(path, frame(1, 2), ["k"], [])
    merge.merge_into_path(path, frame(2, 3), ["k"], [])
    merge.rewrite_table(spark, path, lambda df: layout.along_curve(df, ["k", "v"], 2))
    assert rows(merge.read_table(spark, path)) == [(1, 1), (2, 2), (3, 0)]
    merge.merge_into_path(path, frame(3, 4), ["k"], [])
    assert rows(merge.read_table(spark, path), "k") == [(1,), (2,), (3,), (4,)]
    with pytest.raises(ValueError):
        merge.rewrite_table(spark, str(tmp_path / "nothing"), lambda df: df)


def test_raw_copy_holds_the_loaded_records(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "e.json").write_text("\n".join(
        f'{{"event_id": "E{i}", "event_type": "t{i % 3}", "event_timestamp": "2024-01-{i % 28 + 1:02d}T00:00:00"}}' for i in range(60)))
    house = full_run.Warehouse(str(tmp_path / "house"))
    load.load_raw(spark, load.RAW_EVENTS, str(tmp_path / "in"), house.bronze, fmt=scan.JSON_LINES)
    path = full_run.lay_out_raw(spark, house, load.RAW_EVENTS, 4)
    names = ("record_id", "event_id", "event_type", "event_timestamp", "filename")
    assert rows(spark.read.parquet(path), *names) == rows(load.read_raw(spark, load.RAW_EVENTS, house.bronze), *names)
