"""Duplicate keys settled without shuffling the rows whose key comes once; compressed tables."""

from pathlib import Path

from pyspark.sql import functions as F

from stratamart.operators.merge import latest_by_key, merge_into_path, read_table, repeated_hashes, settle_repeated
from stratamart.plans import facts, silver


def _settled(df, keys):
    return settle_repeated(df, keys, repeated_hashes(df, keys), lambda again: latest_by_key(again, keys, ["at"]))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keys_that_come_once_are_not_shuffled(spark, rows):
    once = spark.range(500).select(F.col("id").cast("string").alias("k"), F.col("id").alias("at"))
    settled = _settled(once, ["k"])
    assert "Exchange" not in _plan(settled) and "Window" not in _plan(settled)
    assert rows(settled) == rows(once)


def test_repeated_keys_and_null_keys_keep_the_latest(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, 1), ("a", 1, 3), ("a", 2, 2), (None, 1, 1), (None, 1, 5), ("b", None, 4), ("b", None, 6)], "k string, n int, at int")
    assert rows(_settled(df, ["k", "n"])) == rows(latest_by_key(df, ["k", "n"], ["at"]))
    assert _settled(df.limit(0), ["k"]).count() == 0


def test_merge_sets_rows_without_key_aside_and_writes_zstd(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 3, 1), (None, 4, 1), (None, 5, 1)], "k string, v int, at int")
    counts = merge_into_path(path, first, ["k"], ["v"], order_by=["at"])
    assert (counts.inserted, counts.updated, counts.unkeyed) == (2, 0, 2)
    counts = merge_into_path(path, first.where("k = 'a'"), ["k"], ["v"], order_by=["at"])
    assert (counts.inserted, counts.updated, counts.unkeyed) == (0, 1, 0)
    assert rows(read_table(spark, path)) == [("a", 2, 2), ("b", 3, 1)]
    assert rows(spark.read.parquet(f"{path}/unkeyed").select("k", "v")) == [(None, 4), (None, 5)]
    files = list(Path(path).glob("full-*/*.parquet"))
    assert files and all(f.name.endswith(".zstd.parquet") for f in files)


def test_items_of_an_order_sent_twice_count_once(spark, rows):
    docs = [("o1", 10, '{"items": [{"product_id": "old", "quantity": 1}]}'), ("o1", 11, '{"items": [{"product_id": "new", "quantity": 2}]}'),
            ("o2", 12, '{"items": [{"product_id": "x", "quantity": 3}, {"product_id": "y", "quantity": 4}]}')]
    raw = spark.createDataFrame(docs, "order_id string, record_id long, doc string").withColumn("raw_data", F.parse_json("doc")).drop("doc")
    assert rows(silver.silver_order_items(raw), "order_id", "line_number", "product_id") == [
        ("o1", 1, "new"), ("o2", 1, "x"), ("o2", 2, "y")]
    once = silver.silver_order_items(raw.where("record_id > 10"))
    assert "Window" not in _plan(once) and once.count() == 3


def test_places_join_sales_before_customers(spark):
    orders = spark.createDataFrame(
        [("o", "c", "x", "y", "z")], "order_id string, customer_id string, shipping_city string, shipping_state string, shipping_country string"
    ).selectExpr("*", "date'2000-01-01' order_date", "date'2000-01-02' ship_date", *(f"1.5 {c}" for c in (
        "subtotal", "discount_amount", "discount_percent", "tax_amount", "shipping_cost", "total_amount", "total_quantity")),
        *(f"'s' {c}" for c in ("order_status", "order_priority", "ship_mode")), "1 total_items", "1 unique_products")
    customers = spark.createDataFrame([("c", 7)], "customer_id string, customer_sk long")
    places = spark.createDataFrame([("x", "y", "z", 9)], "city string, state string, country string, geography_sk long")
    sales = facts.fact_sales(orders, customers, places)
    plan = sales._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter, (customer_id") < plan.index("Join LeftOuter, ((")  # the upper one comes first
    assert [tuple(r) for r in sales.select("customer_sk", "geography_sk").collect()] == [(7, 9)]
