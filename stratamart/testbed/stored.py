"""Stored silver and gold tables, as a warehouse holds them: what the gold queries read.

Each table is made by the plan functions from the raw documents or from the tables before it, and written once for a
session and table folder. ``build`` writes all of them anew, which is how their cost is timed. Files are written with zstd:
what a query at the end of the chain moves is mostly these tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..plans import dims, facts, silver
from ..session import path_exists, scratch_path, shuffles_freed
from . import inputs

Read = Callable[[str], DataFrame]

#: in the order in which the jobs run
TABLES: dict[str, Callable[[SparkSession, str, Read], DataFrame]] = {
    "raw_orders": lambda spark, sf_dir, read: inputs.raw_orders(spark, sf_dir),
    "orders": lambda spark, sf_dir, read: silver.silver_orders(_documents(spark, sf_dir)),
    "order_items": lambda spark, sf_dir, read: silver.silver_order_items(read("raw_orders")),
    "dim_customer": lambda spark, sf_dir, read: inputs.dim_customer(spark, sf_dir),
    "dim_product": lambda spark, sf_dir, read: inputs.dim_product(spark, sf_dir),
    "dim_geography": lambda spark, sf_dir, read: dims.dim_geography(read("orders")),
    "fact_sales": lambda spark, sf_dir, read: facts.fact_sales(
        read("orders"), read("dim_customer"), read("dim_geography")),
    "fact_sales_items": lambda spark, sf_dir, read: facts.fact_sales_items(
        read("order_items"), read("fact_sales"), read("dim_product")),
    "fact_daily_sales": lambda spark, sf_dir, read: facts.fact_daily_sales(read("orders")),
}

_roots: dict[tuple[str, str], str] = {}


def _path(spark: SparkSession, sf_dir: str, name: str) -> str:
    session = (spark.sparkContext.applicationId, sf_dir)
    return f"{_roots.setdefault(session, scratch_path(spark, 'layers'))}/{name}"


def _is_stored(spark: SparkSession, sf_dir: str, name: str) -> bool:
    return path_exists(spark, f"{_path(spark, sf_dir, name)}/_SUCCESS")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored documents if the items had them written; otherwise as they come, for one pass does not repay the copy."""
    if _is_stored(spark, sf_dir, "raw_orders"):
        return stored(spark, sf_dir, "raw_orders")
    return TABLES["raw_orders"](spark, sf_dir, lambda before: stored(spark, sf_dir, before))


def stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, written first if this session has not written it yet or its scratch folder was cleared."""
    path = _path(spark, sf_dir, name)
    if not _is_stored(spark, sf_dir, name):
        rows = TABLES[name](spark, sf_dir, lambda before: stored(spark, sf_dir, before))
        with shuffles_freed(spark):
            rows.write.mode("overwrite").parquet(path, compression="zstd")
    return spark.read.parquet(path)


def build(spark: SparkSession, sf_dir: str) -> None:
    """Every table, written anew into a folder of its own."""
    _roots.pop((spark.sparkContext.applicationId, sf_dir), None)
    for name in TABLES:
        stored(spark, sf_dir, name)
