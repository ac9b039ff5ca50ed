"""One order, customer and product hold a third of all lines: results stay whole."""

import shutil
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import check
from stratamart.plans import silver
from stratamart.testbed import inputs

BASE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory):
    out = tmp_path_factory.mktemp("skewed")
    for file in Path(BASE).glob("*.parquet"):
        shutil.copy(file, out / file.name)
    con = duckdb.connect()
    con.execute(f"""COPY (SELECT * REPLACE (
        CASE WHEN l_suppkey % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN l_linenumber % 3 = 0 THEN 11 ELSE l_partkey END AS l_partkey)
        FROM '{BASE}/lineitem.parquet') TO '{out}/lineitem.parquet' (FORMAT parquet)""")
    con.execute(f"""COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey)
        FROM '{BASE}/orders.parquet') TO '{out}/orders.parquet' (FORMAT parquet)""")
    return str(out)


@pytest.mark.parametrize("name", [
    "silver_orders", "silver_order_items", "flatten_items", "fact_sales", "fact_sales_items", "fact_daily_sales",
    "v_customer_segments", "v_product_performance", "v_category_performance", "v_top_customers",
    "fact_customer_activity", "fact_product_performance", "layer_counts",
])
def test_queries_match_sql_on_skewed_tables(spark, skewed_dir, name):
    assert check.compare(spark, check.connect(skewed_dir), skewed_dir, name).startswith("ok")


def test_heavy_order_is_sent_as_many_documents(spark, skewed_dir):
    """A third of all lines belong to one order; no cut depends on that, and nothing is lost."""
    documents = inputs.order_documents(spark, skewed_dir).selectExpr("order_id", "size(document.items) as n", "document.totals.total as t")
    con = check.connect(skewed_dir)
    shipments, lines = con.execute("SELECT count(DISTINCT (l_orderkey, l_suppkey)), count(*) FROM lineitem").fetchone()
    empty = con.execute("SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)").fetchone()[0]
    got = documents.selectExpr("count(*)", "count(distinct order_id)", "sum(greatest(n, 0))", "max(n)").first()
    assert (got[0], got[1], got[2]) == (shipments + empty, shipments + empty, lines)
    assert got[3] == con.execute("SELECT max(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_suppkey)").fetchone()[0]
    net = con.execute("""SELECT sum(l_extendedprice::DECIMAL(18,2))
        - sum((l_extendedprice::DECIMAL(18,2) * l_discount::DECIMAL(4,2))::DECIMAL(18,4))
        + sum((l_extendedprice::DECIMAL(18,2) * l_tax::DECIMAL(4,2))::DECIMAL(18,4)) FROM lineitem""").fetchone()[0]
    shipping = con.execute("""SELECT sum(CASE WHEN k % 3 = 0 THEN 15.0 ELSE 4.99 END) FROM (
        SELECT DISTINCT l_orderkey AS k, l_suppkey FROM lineitem UNION ALL
        SELECT o_orderkey, NULL FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))""").fetchone()[0]
    assert documents.agg(F.sum("t")).first()[0] == net + shipping


def test_no_job_runs_while_inputs_are_built(spark, skewed_dir):
    group = "building-inputs"
    spark.sparkContext.setJobGroup(group, group)
    try:
        for build in (inputs.order_documents, inputs.silver_orders, inputs.silver_order_items):
            build(spark, skewed_dir)
        # Reading a footer for its schema is the only job.
        ran = [spark.sparkContext.statusTracker().getJobInfo(j) for j in spark.sparkContext.statusTracker().getJobIdsForGroup(group)]
        tasks = [spark.sparkContext.statusTracker().getStageInfo(s).numTasks for info in ran for s in info.stageIds]
        assert all(n == 1 for n in tasks)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_documents_and_typed_shortcut_agree(spark):
    for from_documents, direct in (
        (silver.silver_orders(inputs.raw_orders(spark, BASE)), inputs.silver_orders(spark, BASE)),
        (silver.silver_order_items(inputs.raw_orders(spark, BASE)), inputs.silver_order_items(spark, BASE)),
    ):
        direct = direct.select(*(F.col(f.name).cast(f.dataType) for f in from_documents.schema))
        assert from_documents.exceptAll(direct).isEmpty() and direct.exceptAll(from_documents).isEmpty()


def test_every_query_has_its_sql():
    """The training-data queries may have none; their tests are their own."""
    def plain(names):
        return {n for n in names if not (n.startswith("op") and n[2].isdigit()) and n != "pipeline"}

    assert plain(entry.queries()) == plain(entry.oracle_sql())
