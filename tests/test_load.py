import gzip
import json

import pytest
from pyspark.sql import functions as F

from stratamart.schemas import PRODUCT_COLUMNS
from stratamart.sources import load, scan
from stratamart.testbed import landing as landed


def order(i, **extra):
    return {"order_id": f"O{i}", "order_date": "2025-03-15", **extra}


def test_each_file_is_loaded_once(spark, tmp_path, rows):
    landing, bronze = tmp_path / "landing", str(tmp_path / "bronze")
    landing.mkdir()
    (landing / "a.json").write_text(json.dumps([order(1), order(2, order_date="bad")]))
    first = load.load_raw(spark, load.RAW_ORDERS, str(landing), bronze)
    assert (first.batch_id, first.loaded, first.rejected, first.status) == (1, 2, 0, "SUCCESS")
    assert first.message() == "Loaded 2 records into RAW_ORDERS (Batch ID: 1)"
    (landing / "b.json").write_text(json.dumps([order(3)]))
    (landing / "c.json").write_text("{broken")
    second = load.load_raw(spark, load.RAW_ORDERS, str(landing), bronze)
    assert (second.loaded, second.rejected) == (1, 1)
    third = load.load_raw(spark, load.RAW_ORDERS, str(landing), bronze)
    assert (third.loaded, third.rejected) == (0, 0)

    table = load.read_raw(spark, load.RAW_ORDERS, bronze)
    assert [(r[0], r[1], r[2], str(r[3]) if r[3] else None) for r in
            rows(table, "order_id", "filename", "file_row_number", "order_date")] == [
        ("O1", "a.json", 1, "2025-03-15"), ("O2", "a.json", 2, None), ("O3", "b.json", 1, "2025-03-15")]
    ids = [r[0] for r in table.orderBy("order_id").select("record_id").collect()]
    assert len(set(ids)) == 3 and ids == sorted(ids)
    assert rows(load.read_quarantine(spark, load.RAW_ORDERS, bronze), "filename", "raw_record") == [
        ("c.json", "{broken")]
    log = load.read_batch_log(spark, bronze)
    assert rows(log, "batch_id", "records_loaded", "records_rejected", "load_status") == [
        (1, 2, 0, "SUCCESS"), (2, 1, 1, "SUCCESS"), (3, 0, 0, "SUCCESS")]


def test_failure_is_logged_and_raised(spark, tmp_path, rows):
    bronze = str(tmp_path / "bronze")
    with pytest.raises(Exception):
        load.load_raw(spark, load.RAW_PRODUCTS, str(tmp_path / "missing"), bronze)
    log = load.read_batch_log(spark, bronze)
    assert rows(log, "table_name", "records_loaded", "load_status") == [("RAW_PRODUCTS", 0, "FAILED")]
    assert log.where(F.col("error_message").isNotNull()).count() == 1


def test_replayed_epoch_is_not_doubled(spark, tmp_path):
    """Losing the commit of a batch makes the stream run it again."""
    landing, bronze = tmp_path / "landing", tmp_path / "bronze"
    landing.mkdir()
    (landing / "a.json").write_text(json.dumps([order(1), order(2)]))
    load.load_raw(spark, load.RAW_ORDERS, str(landing), str(bronze))
    before = load.read_raw(spark, load.RAW_ORDERS, str(bronze)).select("record_id", "order_id").collect()
    for name in ("0", ".0.crc"):
        (bronze / "checkpoints/load_raw_orders/commits" / name).unlink()
    load.load_raw(spark, load.RAW_ORDERS, str(landing), str(bronze))
    after = load.read_raw(spark, load.RAW_ORDERS, str(bronze)).select("record_id", "order_id").collect()
    assert sorted(before) == sorted(after)


def test_json_lines_and_glob(spark, tmp_path, rows):
    landing, bronze = tmp_path / "landing", str(tmp_path / "bronze")
    landing.mkdir()
    (landing / "e1.json").write_text('{"event_id": "E1", "event_type": "view", "event_timestamp": "2025-01-01T09:00:00Z"}\n')
    (landing / "other.json").write_text('{"event_id": "E2"}\n')
    one = load.load_raw(spark, load.RAW_EVENTS, str(landing), bronze, glob="e*.json", fmt=scan.JSON_LINES)
    assert one.loaded == 1
    # A file left out by the glob is still there for a later call.
    rest = load.load_raw(spark, load.RAW_EVENTS, str(landing), bronze, fmt=scan.JSON_LINES)
    assert rest.loaded == 1
    table = load.read_raw(spark, load.RAW_EVENTS, bronze)
    assert [(r[0], str(r[1])) for r in rows(table, "event_id", "event_timestamp")] == [
        ("E1", "2025-01-01 09:00:00"), ("E2", "None")]


def test_compressed_lines_are_loaded(spark, tmp_path, rows):
    """plain and compressed files of one landing area, with their own line numbers."""
    landing, bronze = tmp_path / "landing", str(tmp_path / "bronze")
    landing.mkdir()
    (landing / "a.json").write_text(json.dumps(order(1)) + "\n")
    with gzip.open(landing / "b.json.gz", "wt") as file:
        file.write(json.dumps(order(2)) + "\nbroken\n" + json.dumps(order(3)) + "\n")
    done = load.load_raw(spark, load.RAW_ORDERS, str(landing), bronze, fmt=scan.JSON_LINES)
    assert (done.loaded, done.rejected) == (3, 1)
    table = load.read_raw(spark, load.RAW_ORDERS, bronze)
    assert rows(table, "order_id", "filename", "file_row_number") == [
        ("O1", "a.json", 1), ("O2", "b.json.gz", 1), ("O3", "b.json.gz", 3)]


def test_landed_orders_take_no_more_than_a_third_of_their_text(spark, rows):
    """what fills the disk is the text of the order documents."""
    path = landed.orders_json(spark, "/root/testdata/sf0.001")
    text = spark.read.text(path).agg(F.sum(F.length("value") + 1)).first()[0]
    sizes = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
    assert 0 < 3 * sizes < text


def test_batches_are_bounded_by_files(spark, tmp_path):
    """k files in k batches; record ids stay unique and nothing is loaded twice."""
    landing, bronze = tmp_path / "landing", str(tmp_path / "bronze")
    landing.mkdir()
    for i in range(3):
        (landing / f"p{i}.csv").write_text(",".join(PRODUCT_COLUMNS) + "\n" + ",".join([f"P{i}"] * len(PRODUCT_COLUMNS)) + "\n")
    result = load.load_raw(spark, load.RAW_PRODUCTS, str(landing), bronze, files_per_batch=1)
    assert (result.loaded, result.rejected) == (3, 0)
    stored = spark.read.parquet(f"{bronze}/raw_products")
    assert stored.select("epoch").distinct().count() == 3
    assert stored.select("record_id").distinct().count() == 3
    assert load.load_raw(spark, load.RAW_PRODUCTS, str(landing), bronze, files_per_batch=1).loaded == 0


def test_record_ids_of_very_long_documents_do_not_meet(spark):
    """Places beyond 2**24, and numbers of texts near the largest."""
    places = [(1, 0), (1, 1 << 24), (1, (1 << 30) - 1), (2, 0), (2, 1), ((1 << 62), 0), ((1 << 62), (1 << 30) - 1)]
    numbered = spark.createDataFrame(places, "_batch_row long, _element int")
    ids = [r[0] for r in numbered.select(load.record_id(1 << 61).alias("id"), "_batch_row", "_element")
           .orderBy("_batch_row", "_element").collect()]
    assert None not in ids and len(set(ids)) == len(ids) and ids == sorted(ids)
