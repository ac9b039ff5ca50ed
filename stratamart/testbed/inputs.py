"""Pipeline inputs built from the benchmark tables (TPC-H-like star schema plus events).

Two shapes: raw (documents and text rows, as a source system would send them) and silver (the same
values already typed, straight from the tables), for queries that start at the stored silver layer.
Whole tables are used; text is dressed with the defects the cleansing rules look for.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.dates import day_of_week, is_weekend
from ..functions.numeric import MONEY, PERCENT
from ..plans import dims, silver

AS_OF = dt.date(2002, 1, 1)

# Fixed values of the test inputs.
STATES = ("CA", "OR", "WA", "NV", "AZ", "TX", "OK", "NM", "AR", "LA", "NY", "NJ", "PA", "MA", "CT", "IL", "FL", "GA",
          "CO", "OH", "MI", "MN", "WI", "IA", "UT")
COUNTRIES = ("United States", " canada", "United Kingdom", "australia ", "Germany")
SHIP_MODES = ("Express", "Standard", "Overnight")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id(prefix: str, c: str) -> Column:
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def _money(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


def _one_of(values: tuple[str, ...], index: Column) -> Column:
    """The value at a 0-based index; an empty text beyond the last."""
    return F.coalesce(F.get(F.array(*[F.lit(v) for v in values]), index.cast("int")), F.lit(""))


def calendar_bounds(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Whole years that hold every order date."""
    days = table(spark, sf_dir, "orders").agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    first, last = (d or AS_OF for d in days)
    return f"{first.year:04d}-01-01", f"{last.year:04d}-12-31"


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation attributes; small enough for Spark to broadcast on its own size estimate."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey",
        "r_name",
        _one_of(STATES, F.col("n_nationkey")).alias("state"),
        _one_of(COUNTRIES, F.col("n_regionkey")).alias("country"),
    )


# --- customers ---------------------------------------------------------------------------------


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, and suppliers as business customers that never order; every cell is text.

    ``r_name`` (the market region) is kept beside the text columns to cut delivery batches.
    """
    people = table(spark, sf_dir, "customer").select(
        _id("CUST-", "c_custkey").alias("customer_id"), F.col("c_custkey").alias("k"),
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("n"), F.col("c_mktsegment").alias("market"),
    )
    firms = table(spark, sf_dir, "supplier").select(
        _id("CUST-S", "s_suppkey").alias("customer_id"), F.col("s_suppkey").alias("k"),
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("n"), F.lit("BUILDING").alias("market"),
    )
    both = people.unionByName(firms).join(places(spark, sf_dir), F.col("n") == F.col("n_nationkey"))
    k, n = F.col("k"), F.col("n")
    ks = k.cast("string")
    registered = F.date_sub(F.lit(dt.date(2001, 12, 31)), (k % 1000).cast("int"))
    return both.select(
        "customer_id",
        F.concat(F.lit("  "), F.left("name", F.lit(8))).alias("first_name"),
        F.when(k % 17 != 0, F.concat(F.substr("name", F.lit(10)), F.lit(" "))).alias("last_name"),
        F.when(k % 13 == 0, None).when(k % 10 == 0, "bad-email")
        .otherwise(F.concat(F.lit(" User"), ks, F.lit("@Mail"), n.cast("string"), F.lit(".Example.COM ")))
        .alias("email"),
        F.when(k % 19 == 0, None).when(k % 11 == 0, "555-01")
        .otherwise(F.concat(F.lit("+1-"), (n + 200).cast("string"), F.lit("-555-"),
                            F.lpad((k % 10000).cast("string"), 4, "0"))).alias("phone"),
        F.concat(ks, F.lit(" Main Street ")).alias("address"),
        F.concat(F.lit(" City "), (k % 40).cast("string")).alias("city"),
        F.when(k % 23 != 0, F.lower("state")).alias("state"),
        F.lpad((k % 100000).cast("string"), 5, "0").alias("zip_code"),
        "country",
        F.when(k % 29 == 0, "unknown").when(k % 3 == 0, F.date_format(registered, "yyyy-MM-dd"))
        .when(k % 3 == 1, F.date_format(registered, "MM/dd/yyyy"))
        .otherwise(F.date_format(registered, "dd-MMM-yyyy")).alias("registration_date"),
        F.when(F.col("market") == "MACHINERY", "Premium").when(F.col("market") == "BUILDING", " vip")
        .when(F.col("market") == "AUTOMOBILE", "Regular ").when(F.col("market") == "FURNITURE", "Basic")
        .alias("customer_segment"),
        "r_name",
    )


def silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_customers(raw_customers(spark, sf_dir), AS_OF)


def customer_key(id_column: str = "customer_id") -> Column:
    """The surrogate key the tests give a customer: even for people, odd for firms."""
    c = F.col(id_column)
    return F.when(c.startswith("CUST-S"), F.substr(c, F.lit(7)).cast("long") * 2 + 1).otherwise(
        F.substr(c, F.lit(6)).cast("long") * 2)


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = silver_customers(spark, sf_dir).withColumn("customer_sk", customer_key())
    return dims.dim_customer(keyed).withColumn("is_current", F.lit(True))


# --- products ----------------------------------------------------------------------------------


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    price = (_money("p_retailprice") * F.col("p_size") * F.lit(Decimal("0.02"))).cast(MONEY)
    cost = (price * F.lit(Decimal("0.6"))).cast(MONEY)
    created = F.date_sub(F.lit(dt.date(2001, 6, 30)), (k % 700).cast("int"))
    return p.select(
        _id("PROD-", "p_partkey").alias("product_id"),
        F.concat(F.lit(" "), F.col("p_name"), F.lit("-"), F.col("p_size").cast("string"), F.lit('" (new) '))
        .alias("product_name"),
        F.lower("p_type").alias("category"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("subcategory"),
        F.concat(F.lit(" "), F.col("p_brand")).alias("brand"),
        F.when(k % 97 == 0, "n/a").otherwise(price.cast("string")).alias("unit_price"),
        F.when(k % 101 != 0, cost.cast("string")).alias("unit_cost"),
        F.concat(F.col("p_size").cast("string"), F.lit(".25")).alias("weight_kg"),
        F.concat(F.lit("SUP-"), (k % 10).cast("string")).alias("supplier_id"),
        F.when(k % 5 == 0, "TRUE").when(k % 5 == 1, " yes").when(k % 5 == 2, "0").when(k % 5 == 3, "Y")
        .alias("is_active"),
        F.date_format(created, "yyyy-MM-dd").alias("created_date"),
        F.when(k % 31 == 0, "2001-02-30").otherwise(F.date_format(F.date_add(created, 90), "yyyy-MM-dd"))
        .alias("updated_date"),
    )


def silver_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_products(raw_products(spark, sf_dir), AS_OF)


def product_key(id_column: str = "product_id") -> Column:
    return F.substr(F.col(id_column), F.lit(6)).cast("long")


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = silver_products(spark, sf_dir).withColumn("product_sk", product_key())
    return dims.dim_product(keyed).withColumn("is_current", F.lit(True))


# --- orders ------------------------------------------------------------------------------------


# Each supplier ships and bills its part of an order: a document holds the lines of one order and supplier, so an
# order that holds a third of all lines is as many documents as it has suppliers, with no count taken first.
SHIPMENT = ["l_orderkey", "l_suppkey"]


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def _by_shipment(lines: DataFrame, *columns: str) -> DataFrame:
    """The named columns of the lines with each shipment in one partition. Nearly every line is a shipment of its own, so
    grouping before the shuffle would sort the lines of every map task, saving nothing."""
    return lines.select(*SHIPMENT, *columns).repartition(*SHIPMENT)


def _with_headers(headers: DataFrame, documents: DataFrame, lines: DataFrame) -> DataFrame:
    """Shipments with their order, and orders without lines.

    One order can have many shipments; an inner join can divide such a key over tasks where an outer join from
    the orders cannot, so the orders without lines are added by an anti join.
    """
    same = F.col("o_orderkey") == F.col("l_orderkey")
    empty = headers.join(lines.select("l_orderkey").distinct(), same, "left_anti")
    return documents.join(headers, same).unionByName(empty, allowMissingColumns=True)


def order_id(key: Column, supplier: Column) -> Column:
    suffix = F.coalesce(F.concat(F.lit("-"), supplier.cast("string")), F.lit(""))
    return F.concat(F.lit("ORD-"), key.cast("string"), suffix)


LINE_ORDER = ["l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"]


def _unit_price(extended_price: Column) -> Column:
    return (extended_price.cast("decimal(18,2)") * F.lit(Decimal("0.01"))).cast(MONEY)


def _line_percent(discount: Column) -> Column:
    return (discount.cast("decimal(8,2)") * 100).cast(PERCENT)


def _units(column: str) -> Column:
    """A two-decimal amount as a whole number of hundredths."""
    return F.round(F.col(column) * 100).cast("long")


def _totals(total: Callable[[Column], Column] = F.sum) -> dict[str, Column]:
    """Document totals from its lines, summed as whole hundredths and ten-thousandths: exact."""
    def amount(units: Column, place: str) -> Column:
        return (total(units).cast("decimal(18,0)") * F.lit(Decimal(place))).cast(MONEY)

    gross = _units("l_extendedprice")
    return {
        "subtotal": amount(gross, "0.01"),
        "discount": amount(gross * _units("l_discount"), "0.0001"),
        "tax": amount(gross * _units("l_tax"), "0.0001"),
    }


def _order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their shipping place."""
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    shipped_to = people.join(places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
    return table(spark, sf_dir, "orders").join(
        shipped_to, F.col("o_custkey") == F.col("c_custkey"), "left"
    )


def _document_totals(lines: DataFrame, products: bool) -> DataFrame:
    """Per shipment: lines, quantity, amounts and, on request, distinct products."""
    unique = [F.countDistinct("l_partkey").alias("unique_products")] if products else []
    used = ["l_partkey"] if products else []
    shipped = _by_shipment(lines, "l_quantity", "l_shipdate", "l_extendedprice", "l_discount", "l_tax", *used)
    return shipped.groupBy(*SHIPMENT).agg(
        F.count(F.lit(1)).alias("total_items"),
        F.sum(F.round("l_quantity").cast("long")).alias("total_quantity"),
        *unique,
        F.min("l_shipdate").cast("date").alias("ship_date"),
        *(c.alias(f"_{n}") for n, c in _totals().items()),
    )


def _shipments(lines: DataFrame) -> DataFrame:
    """Per shipment: its lines in order, the first shipping date and the totals.

    A line alone in its shipment is passed on as it is: collecting lists sorts all rows twice more and makes a buffer for
    every group, so only lines that share a shipment go there.
    """
    counted = _by_shipment(lines, *LINE_ORDER, "l_tax", "l_shipdate").withColumn(
        "_n", F.count(F.lit(1)).over(Window.partitionBy(*SHIPMENT)))
    line = F.struct(*LINE_ORDER)
    alone = counted.where("_n = 1").select(
        *SHIPMENT, F.array(line).alias("_items"), F.col("l_shipdate").cast("date").alias("_shipped"),
        *(c.alias(f"_{n}") for n, c in _totals(lambda units: units).items()))
    together = counted.where("_n > 1").groupBy(*SHIPMENT).agg(
        F.sort_array(F.collect_list(line)).alias("_items"), F.min("l_shipdate").cast("date").alias("_shipped"),
        *(c.alias(f"_{n}") for n, c in _totals().items()))
    return alone.unionByName(together)


def _ship_mode() -> Column:
    return _one_of(SHIP_MODES, F.col("o_orderkey") % 3)


def _shipping_cost() -> Column:
    return F.when(F.col("o_orderkey") % 3 == 0, F.lit(Decimal("15.0000"))).otherwise(F.lit(Decimal("4.9900")))


def _total_amount(subtotal: Column, discount: Column, tax: Column) -> Column:
    return (subtotal - discount + tax + _shipping_cost()).cast(MONEY)


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested ``document`` per shipment, with its extracted keys.

    Orders without lines carry an empty or no item list and zero totals.
    """
    lines = order_lines(spark, sf_dir)
    joined = _with_headers(_order_headers(spark, sf_dir), _shipments(lines), lines)
    supplier = F.col("l_suppkey")
    key = F.col("o_orderkey")

    # The item's own fields are made after the shuffles: they repeat what the line's columns say.
    def item(i: Column) -> Column:
        return F.struct(
            F.concat(F.lit("PROD-"), i["l_partkey"].cast("string")).alias("product_id"),
            i["l_quantity"].cast("decimal(18,2)").alias("quantity"),
            _unit_price(i["l_extendedprice"]).alias("unit_price"),
            F.when(_line_percent(i["l_discount"]) > 0, _line_percent(i["l_discount"])).alias("discount_percent"),
        )

    # Spark compiles all but the lambda, so a single line does without it.
    lines_sent = F.col("_items")
    items = F.when(F.size(lines_sent) == 1, F.array(item(F.get(lines_sent, F.lit(0))))).otherwise(F.transform(lines_sent, item))
    no_items = F.when(key % 2 == 0, F.array().cast(
        "array<struct<product_id:string,quantity:decimal(18,2),unit_price:decimal(18,4),discount_percent:decimal(8,4)>>"))
    zero = F.lit(Decimal("0.0000"))
    amounts = {n: F.coalesce(f"_{n}", zero) for n in ("subtotal", "discount", "tax")}
    date_text = F.col("o_orderdate").cast("date").cast("string")
    document = F.struct(
        order_id(key, supplier).alias("order_id"),
        _id("CUST-", "o_custkey").alias("customer_id"),
        date_text.alias("order_date"),
        F.concat(date_text, F.lit("T10:30:00")).alias("order_timestamp"),
        F.lower("o_orderstatus").alias("order_status"),
        F.lower("o_orderpriority").alias("priority"),
        F.col("_shipped").cast("string").alias("ship_date"),
        _ship_mode().alias("ship_mode"),
        F.struct(
            F.concat(F.col("o_custkey").cast("string"), F.lit(" Main Street")).alias("address"),
            F.concat(F.lit("City "), (F.col("o_custkey") % 40).cast("string")).alias("city"),
            F.col("state").alias("state"),
            F.lpad((F.col("o_custkey") % 100000).cast("string"), 5, "0").alias("zip"),
            F.trim("country").alias("country"),
        ).alias("shipping"),
        F.coalesce(items, no_items).alias("items"),
        F.struct(
            *(c.alias(n) for n, c in amounts.items()),
            _shipping_cost().alias("shipping"),
            _total_amount(**amounts).alias("total"),
        ).alias("totals"),
    )
    return joined.select(
        document.alias("document"),
        order_id(key, supplier).alias("order_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order documents as variants."""
    return order_documents(spark, sf_dir).select(
        F.to_variant_object("document").alias("raw_data"), "order_id", "order_date")


def _typed_orders(headers: DataFrame, totals: DataFrame, lines: DataFrame) -> DataFrame:
    """Order columns that need no shipping place, and the customer key the stored fact would hold."""
    joined = _with_headers(headers, totals, lines)
    key, date = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    zero = F.lit(Decimal("0.0000"))
    amounts = {n: F.coalesce(f"_{n}", zero) for n in ("subtotal", "discount", "tax")}
    whole = {n: F.round(c, 0).cast("decimal(38,0)") for n, c in amounts.items()}
    unique = [F.coalesce("unique_products", F.lit(0)).alias("unique_products")] if "unique_products" in totals.columns else []
    place = [c for c in ("o_custkey", "state", "country") if "state" in headers.columns]
    return joined.select(
        *place,
        order_id(key, F.col("l_suppkey")).alias("order_id"),
        _id("CUST-", "o_custkey").alias("customer_id"),
        (F.col("o_custkey") * 2).alias("customer_sk"),
        date.alias("order_date"),
        F.concat(date.cast("string"), F.lit(" 10:30:00")).cast("timestamp_ntz")
        .alias("order_timestamp"),
        F.upper("o_orderstatus").alias("order_status"),
        F.upper("o_orderpriority").alias("order_priority"),
        "ship_date",
        _ship_mode().alias("ship_mode"),
        amounts["subtotal"].cast(MONEY).alias("subtotal"),
        amounts["discount"].cast(MONEY).alias("discount_amount"),
        silver.order_discount_percent(whole["subtotal"], whole["discount"]).alias("discount_percent"),
        amounts["tax"].cast(MONEY).alias("tax_amount"),
        _shipping_cost().cast(MONEY).alias("shipping_cost"),
        _total_amount(**amounts).alias("total_amount"),
        F.coalesce("total_items", F.when(key % 2 == 0, 0)).alias("total_items"),
        F.col("total_quantity").cast("decimal(38,0)").alias("total_quantity"),
        *unique,
    )


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver order headers straight from the tables."""
    lines = order_lines(spark, sf_dir)
    totals = _document_totals(lines, products=True)
    date = F.col("order_date")
    return _typed_orders(_order_headers(spark, sf_dir), totals, lines).select(
        "order_id", "customer_id", date, "order_timestamp", "order_status", "order_priority", "ship_date", "ship_mode",
        F.concat(F.col("o_custkey").cast("string"), F.lit(" Main Street")).alias("shipping_address"),
        F.concat(F.lit("City "), (F.col("o_custkey") % 40).cast("string")).alias("shipping_city"),
        F.col("state").alias("shipping_state"),
        F.lpad((F.col("o_custkey") % 100000).cast("string"), 5, "0").alias("shipping_zip"),
        F.trim("country").alias("shipping_country"),
        "subtotal", "discount_amount", "discount_percent", "tax_amount", "shipping_cost", "total_amount",
        "total_items", "total_quantity", "unique_products",
        F.year(date).alias("order_year"),
        F.month(date).alias("order_month"),
        F.quarter(date).alias("order_quarter"),
        F.weekofyear(date).alias("order_week"),
        day_of_week(date).alias("order_day_of_week"),
        is_weekend(date).alias("is_weekend"),
        F.lit(Decimal(silver.ORDER_DQ_SCORE)).cast("decimal(3,2)").alias("dq_score"),
    )


def _order_items(lines: DataFrame) -> DataFrame:
    position = Window.partitionBy(*SHIPMENT).orderBy(*LINE_ORDER)
    typed = lines.select(
        "l_orderkey",
        order_id(F.col("l_orderkey"), F.col("l_suppkey")).alias("order_id"),
        _id("PROD-", "l_partkey").alias("product_id"),
        F.row_number().over(position).cast("long").alias("line_number"),
        F.col("l_quantity").cast("decimal(18,2)").cast("decimal(38,0)").alias("quantity"),
        _unit_price(F.col("l_extendedprice")).alias("unit_price"),
        _line_percent(F.col("l_discount")).alias("discount_percent"),
    )
    return typed.withColumns(
        silver.line_amounts(F.col("quantity"), F.col("unit_price"), F.col("discount_percent")))


def silver_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver items straight from the lines; a window holds the lines of one shipment."""
    return _order_items(order_lines(spark, sf_dir)).drop("l_orderkey")


# --- events and run log ------------------------------------------------------------------------


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    document = F.struct(
        _id("EVT-", "event_id").alias("event_id"),
        F.col("event_type").alias("event_type"),
        F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")).alias("event_timestamp"),
        F.concat(F.lit("cat-"), F.col("event_type")).alias("category"),
        F.upper("event_type").alias("action"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("s"), F.floor(F.col("user_id") / 7).cast("string")).alias("session_id"),
        F.when(F.col("user_id") % 2 == 0, "mobile").otherwise("desktop").alias("device_type"),
        F.col("value").cast("decimal(18,2)").alias("event_value"),
        F.from_json("props", "k long").alias("properties"),
    )
    return e.select(document.alias("document"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_documents(spark, sf_dir).select(F.to_variant_object("document").alias("raw_data"))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as job runs: one of 20 jobs each, failed when the event is an error."""
    e = table(spark, sf_dir, "events")
    failed = F.col("event_type") == "error"
    return e.select(
        F.concat(F.lit("JOB_"), (F.col("user_id") % 20).cast("string")).alias("name"),
        F.lit("RETAIL").alias("database_name"),
        F.upper("event_type").alias("schema_name"),
        F.when(failed, "FAILED").otherwise("SUCCEEDED").alias("state"),
        F.col("ts").alias("scheduled_time"),
        F.col("ts").alias("query_start_time"),
        F.expr("ts + make_dt_interval(0, 0, 0, cast(value as decimal(18,2)))").alias("completed_time"),
        F.when(failed, "100").alias("error_code"),
        F.when(failed, "failed run").alias("error_message"),
        F.when(~failed, "ok").alias("return_value"),
    )
