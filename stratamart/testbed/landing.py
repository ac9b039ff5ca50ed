"""Landing files written from the benchmark tables, below the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import CUSTOMER_COLUMNS, PRODUCT_COLUMNS
from ..session import scratch_path, shuffles_freed
from . import inputs

#: Records per array file or per numbered file: bounds one unsplittable file.
LOT = 5000

#: Order documents compress to an eighth. A compressed file cannot be split, so it is bounded: to some 30 MB of text.
JSON_WRITE = {"compression": "gzip", "maxRecordsPerFile": "50000", "ignoreNullFields": "false"}

CSV_WRITE = {"header": "true", "quote": '"', "escape": '"', "nullValue": "NULL"}


def customers_csv(spark: SparkSession, sf_dir: str, where: str | None = None) -> str:
    rows = inputs.raw_customers(spark, sf_dir)
    path = scratch_path(spark, "landing-customers")
    (rows.where(where) if where else rows).select(*CUSTOMER_COLUMNS).write.options(**CSV_WRITE).csv(path)
    return path


def append_customers(spark: SparkSession, sf_dir: str, path: str, where: str) -> None:
    rows = inputs.raw_customers(spark, sf_dir).where(where).select(*CUSTOMER_COLUMNS)
    rows.write.mode("append").options(**CSV_WRITE).csv(path)


def products_csv(spark: SparkSession, sf_dir: str, header: bool = True) -> str:
    path = scratch_path(spark, "landing-products")
    options = {**CSV_WRITE, "header": str(header).lower()}
    inputs.raw_products(spark, sf_dir).select(*PRODUCT_COLUMNS).write.options(**options).csv(path)
    return path


def orders_json(spark: SparkSession, sf_dir: str, path: str | None = None) -> str:
    """A document per line, in compressed files."""
    path = path or scratch_path(spark, "landing-orders")
    with shuffles_freed(spark):
        inputs.order_documents(spark, sf_dir).select("document.*").write.options(**JSON_WRITE).json(path)
    return path


def events_json(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "landing-events")
    inputs.event_documents(spark, sf_dir).select("document.*").write.json(path)
    return path


def order_arrays(spark: SparkSession, sf_dir: str) -> str:
    """Order headers as one JSON array per file, ``lot=N`` folders; a lot is a bounded range of keys."""
    path = scratch_path(spark, "landing-arrays")
    orders = inputs.table(spark, sf_dir, "orders")
    header = F.struct(
        "o_orderkey",
        F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string")).alias("order_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
    )
    arrays = orders.groupBy(F.floor(F.col("o_orderkey") / LOT).alias("lot")).agg(
        F.to_json(F.sort_array(F.collect_list(header))).alias("value"))
    arrays.repartition("lot").write.partitionBy("lot").text(path)
    return path


def customer_lots(spark: SparkSession, sf_dir: str) -> str:
    """Customers as one headed CSV file per ``lot=N`` folder, in key order."""
    path = scratch_path(spark, "landing-lots")
    rows = inputs.table(spark, sf_dir, "customer").select(
        F.floor(F.col("c_custkey") / 100).alias("lot"), "c_custkey", "c_name", "c_mktsegment")
    rows.repartition("lot").sortWithinPartitions("lot", "c_custkey").write.partitionBy("lot").options(
        header="true").csv(path)
    return path


def supplier_pipes(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "landing-pipes")
    inputs.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string"), "s_name", F.col("s_nationkey").cast("string"),
    ).write.options(header="true", sep="|").csv(path)
    return path


def ragged_lines(spark: SparkSession, sf_dir: str) -> str:
    """Three-column lines, one cell short for negative balances and one too many for large ones."""
    path = scratch_path(spark, "landing-ragged")
    c = inputs.table(spark, sf_dir, "customer")
    key, balance = F.col("c_custkey").cast("string"), F.col("c_acctbal")
    line = (
        F.when(balance < 0, F.concat_ws(",", key, "c_name"))
        .when(balance > 9000, F.concat_ws(",", key, "c_name", "c_mktsegment", F.lit("extra")))
        .otherwise(F.concat_ws(",", key, "c_name", "c_mktsegment"))
    )
    c.select(line.alias("value")).write.text(path)
    return path


def mixed_files(spark: SparkSession, sf_dir: str) -> str:
    """Events as .json beside suppliers as .csv in one landing area."""
    path = events_json(spark, sf_dir)
    inputs.table(spark, sf_dir, "supplier").select("s_name").write.mode("append").csv(path)
    return path


def rows_to_parquet(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).parquet(path)
