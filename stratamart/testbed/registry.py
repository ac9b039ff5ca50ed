"""Every operator as a query over the benchmark tables: ``(spark, sf_dir) -> DataFrame``.

Results use portable types (long, double, date, timestamp, boolean, text) so that another SQL engine
can be compared. Clock values, generated paths and gap-prone keys are left out.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions.numeric import MONEY
from ..operators import audit, bitmaps, changes, checksums, flatten, layout, ranking, validity
from ..operators.maintained import MaintainedView, signed
from ..operators.merge import merge_into_path, merge_upsert, read_table
from ..operators.ordering import asc, desc
from ..operators.scd2 import OPEN_END, scd2
from ..plans import dims, facts, full_run, silver, views
from ..schemas import CUSTOMER_COLUMNS, PRODUCT_COLUMNS
from ..session import scratch_path, stage
from ..sources import load, scan
from ..streaming import event_state, incremental
from . import inputs, landing
from .inputs import AS_OF
from .stored import stored

# The market regions delivered first; the second delivery re-sends one region and adds another.
FIRST_BATCH = "r_name <> 'ASIA'"
SECOND_BATCH = "r_name in ('EUROPE', 'ASIA')"
DELETED_REGION = "AFRICA"

ORDERS_UNTIL, ORDERS_FROM = dt.date(2000, 1, 1), dt.date(1999, 7, 1)

# The days three deliveries of events arrive.
EVENT_CUTS = ("2024-01-11", "2024-01-21", "2024-01-31")

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    def column(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return c.cast("long").alias(field.name)
        return c

    return df.select(*(column(f) for f in df.schema))


def query(fn: Query) -> Query:
    _queries[fn.__name__.removesuffix("_query")] = lambda spark, sf_dir: portable(fn(spark, sf_dir))
    return fn


def queries() -> dict[str, Query]:
    return dict(_queries)


# --- scans and loads ---------------------------------------------------------------------------


@query
def scan_json_array(spark, sf_dir):
    good, _ = scan.scan_json(spark, landing.order_arrays(spark, sf_dir))
    text = lambda path: F.variant_get("raw_data", path, "string")
    return good.select(text("$.order_id").alias("order_id"), text("$.order_status").alias("order_status"),
                       text("$.order_date").alias("order_date"), "file_row_number")


@query
def scan_json_object(spark, sf_dir):
    good, _ = scan.scan_json(spark, landing.events_json(spark, sf_dir), multiline=False, strip_outer_array=False,
                              number=False)
    return good.select(
        F.variant_get("raw_data", "$.event_id", "string").alias("event_id"),
        F.variant_get("raw_data", "$.properties.k", "long").alias("k"),
        F.variant_get("raw_data", "$.event_value", MONEY).alias("event_value"),
    )


@query
def scan_csv(spark, sf_dir):
    good, _ = scan.scan_csv(spark, landing.customers_csv(spark, sf_dir), CUSTOMER_COLUMNS, number=False)
    return good.select(*CUSTOMER_COLUMNS)


@query
def scan_csv_noheader(spark, sf_dir):
    good, _ = scan.scan_csv(spark, landing.products_csv(spark, sf_dir, header=False), PRODUCT_COLUMNS,
                            scan.CSV_NO_HEADER, number=False)
    return good.select("product_id", "product_name", "category", "unit_price", "unit_cost", "is_active")


@query
def scan_pipe(spark, sf_dir):
    columns = ["supplier_id", "supplier_name", "nation", "comment"]
    good, _ = scan.scan_csv(spark, landing.supplier_pipes(spark, sf_dir), columns, scan.PIPE, number=False)
    return good.select(*columns)


@query
def scan_file_metadata(spark, sf_dir):
    path = landing.customer_lots(spark, sf_dir)
    records = scan.read_files(spark, path, scan.CSV, ["customer_key", "name", "segment"])
    numbered = scan.with_record_numbers(records)
    return numbered.select(
        "customer_key",
        F.regexp_extract("_file", "lot=([0-9]+)", 1).cast("long").alias("lot"),
        F.col("filename").endswith(".csv").alias("named_csv"),
        "file_row_number",
    )


@query
def scan_file_pattern(spark, sf_dir):
    path = landing.mixed_files(spark, sf_dir)
    good, _ = scan.scan_json(spark, path, pattern=r".*\.json$", multiline=False, number=False)
    return good.select(F.variant_get("raw_data", "$.event_id", "string").alias("event_id"),
                       F.variant_get("raw_data", "$.event_type", "string").alias("event_type"))


@query
def scan_rejects(spark, sf_dir):
    good, rejects = scan.scan_csv(spark, landing.ragged_lines(spark, sf_dir), ["id", "name", "segment"],
                                  scan.CSV_NO_HEADER, number=False)
    kept = good.select("id", "segment", F.lit("loaded").alias("outcome"))
    refused = rejects.select(
        F.split_part("raw_record", F.lit(","), F.lit(1)).alias("id"), F.lit(None).cast("string").alias("segment"),
        F.lit("rejected").alias("outcome"))
    return kept.unionByName(refused)


def _bronze(spark: SparkSession) -> str:
    return scratch_path(spark, "bronze")


@query
def load_raw_orders(spark, sf_dir):
    bronze = _bronze(spark)
    load.load_raw(spark, load.RAW_ORDERS, landing.orders_json(spark, sf_dir), bronze, fmt=scan.JSON_LINES)
    return load.read_raw(spark, load.RAW_ORDERS, bronze).select(
        "order_id", "order_date",
        F.variant_get("raw_data", "$.totals.total", MONEY).alias("total"),
        F.size(F.variant_get("raw_data", "$.items", "array<variant>")).alias("items"),
    )


@query
def load_raw_customers(spark, sf_dir):
    bronze = _bronze(spark)
    load.load_raw(spark, load.RAW_CUSTOMERS, landing.customers_csv(spark, sf_dir), bronze)
    return load.read_raw(spark, load.RAW_CUSTOMERS, bronze).select(*CUSTOMER_COLUMNS)


@query
def load_raw_products(spark, sf_dir):
    bronze = _bronze(spark)
    load.load_raw(spark, load.RAW_PRODUCTS, landing.products_csv(spark, sf_dir), bronze)
    return load.read_raw(spark, load.RAW_PRODUCTS, bronze).select(*PRODUCT_COLUMNS)


@query
def load_raw_events(spark, sf_dir):
    bronze = _bronze(spark)
    load.load_raw(spark, load.RAW_EVENTS, landing.events_json(spark, sf_dir), bronze, fmt=scan.JSON_LINES)
    return load.read_raw(spark, load.RAW_EVENTS, bronze).select("event_id", "event_type", "event_timestamp")


@query
def load_once(spark, sf_dir):
    """Two deliveries and a rerun: every record is loaded exactly once."""
    bronze = _bronze(spark)
    path = landing.customers_csv(spark, sf_dir, FIRST_BATCH)
    load.load_raw(spark, load.RAW_CUSTOMERS, path, bronze)
    landing.append_customers(spark, sf_dir, path, f"not ({FIRST_BATCH})")
    load.load_raw(spark, load.RAW_CUSTOMERS, path, bronze)
    rerun = load.load_raw(spark, load.RAW_CUSTOMERS, path, bronze)
    rows = load.read_raw(spark, load.RAW_CUSTOMERS, bronze)
    return rows.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("copies"), F.countDistinct("record_id").alias("record_ids"),
    ).withColumn("loaded_by_rerun", F.lit(rerun.loaded))


RAGGED = load.RawTable("raw_contacts", scan.CSV_NO_HEADER, ("id", "name", "segment"))


@query
def load_batch_log(spark, sf_dir):
    """Audit rows of three loads, one with rejects and one that failed."""
    bronze = _bronze(spark)
    load.load_raw(spark, load.RAW_CUSTOMERS, landing.customers_csv(spark, sf_dir), bronze)
    load.load_raw(spark, RAGGED, landing.ragged_lines(spark, sf_dir), bronze, glob="*.txt")
    try:
        load.load_raw(spark, load.RAW_PRODUCTS, f"{bronze}/no-such-landing-area", bronze)
    except Exception:  # the failure is the case under test: it is logged, then raised
        pass
    log = load.read_batch_log(spark, bronze)
    return log.select("batch_id", "table_name", "records_loaded", "records_rejected", "load_status",
                      F.col("error_message").isNotNull().alias("has_error"),
                      (F.col("load_end_time") >= F.col("load_start_time")).alias("times_ordered"))


@query
def raw_extracted_keys(spark, sf_dir):
    orders = load.RAW_ORDERS.with_extracted(inputs.raw_orders(spark, sf_dir).select("raw_data"))
    events = load.RAW_EVENTS.with_extracted(inputs.raw_events(spark, sf_dir))
    return orders.select(
        F.col("order_id").alias("record_key"), F.lit("order").alias("record_type"),
        F.col("order_date").alias("record_date"), F.lit(None).cast("timestamp_ntz").alias("record_time"),
    ).unionByName(events.select(
        F.col("event_id").alias("record_key"), F.col("event_type").alias("record_type"),
        F.col("event_timestamp").cast("date").alias("record_date"), F.col("event_timestamp").alias("record_time"),
    ))


# --- silver ------------------------------------------------------------------------------------


def _no_audit(df: DataFrame) -> DataFrame:
    return df.drop(*silver.AUDIT_COLUMNS.values())


@query
def silver_customers(spark, sf_dir):
    return inputs.silver_customers(spark, sf_dir)


@query
def silver_products(spark, sf_dir):
    return inputs.silver_products(spark, sf_dir)


@query
def silver_orders(spark, sf_dir):
    return silver.silver_orders(inputs.raw_orders(spark, sf_dir))


@query
def silver_order_items(spark, sf_dir):
    return silver.silver_order_items(inputs.raw_orders(spark, sf_dir))


@query
def silver_events(spark, sf_dir):
    """The stored events. Some are sent twice in the delivery, some have no id, and the whole delivery comes again."""
    number = F.regexp_extract("document.event_id", "([0-9]+)$", 1).cast("long")
    events = inputs.event_documents(spark, sf_dir).select("document", F.col("document.event_id").alias("sent_as"), number.alias("k"))
    unnamed = events.where("k % 100 = 1").withColumn(
        "document", F.col("document").withField("event_id", F.lit(None).cast("string")))
    house = full_run.Warehouse(scratch_path(spark, "events"))

    def delivery(frame: DataFrame, batch: int) -> DataFrame:
        raw = frame.select(F.to_variant_object("document").alias("raw_data"), "sent_as")
        return _lineage(raw, "sent_as", batch).drop("sent_as")

    first = delivery(events, 1).unionByName(delivery(events.where("k % 50 = 0"), 2)).unionByName(delivery(unnamed, 3))
    for raw in (first, delivery(events, 4)):
        full_run.merge_events(house, raw, AS_OF, NOW)
    events = house.read(spark, "silver", "events")
    return events.drop("event_sk", *_CLOCKS, "source_record_id").withColumn("properties", F.variant_get("properties", "$.k", "long"))


@query
def clustered_events(spark, sf_dir):
    """Silver events of two deliveries, laid out along a curve: per filter on one key the rows found, and whether it meets
    under a fifth of the files."""
    house = full_run.Warehouse(scratch_path(spark, "laid_out"))
    for delivery in _event_deliveries(spark, sf_dir):
        full_run.merge_events(house, _lineage(delivery, "event_id", 1), AS_OF, NOW)
    full_run.lay_out_events(spark, house, 144)
    events = house.read(spark, "silver", "events")
    spans = stage(layout.file_spans(events, full_run.EVENT_LAYOUT), "spans")
    hour = F.lit("2024-01-17 10:00:00").cast("timestamp_ntz")
    lines = []
    for key, low, high in (("event_timestamp", hour, hour + F.expr("interval 1 hour")), ("user_id", F.lit("7"), F.lit("7"))):
        few = layout.files_met(spans, key, low, high).select(F.col("files_met") * 5 < F.col("files")).scalar()
        found = events.where(F.col(key).between(low, high)).agg(F.count(F.lit(1)).alias("row_count"))
        lines.append(found.select(F.lit(key).alias("key"), "row_count", few.alias("under_a_fifth")))
    return reduce(DataFrame.unionByName, lines)


@query
def dq_score(spark, sf_dir):
    """Distribution of the three scores."""
    scored = [
        inputs.silver_customers(spark, sf_dir).select(F.lit("customers").alias("entity"), "dq_score"),
        inputs.silver_products(spark, sf_dir).select(F.lit("products").alias("entity"), "dq_score"),
        inputs.silver_orders(spark, sf_dir).select(F.lit("orders").alias("entity"), "dq_score"),
    ]
    return scored[0].unionByName(scored[1]).unionByName(scored[2]).groupBy("entity", "dq_score").agg(
        F.count(F.lit(1)).alias("row_count"))


@query
def flatten_items(spark, sf_dir):
    items = flatten.flatten_items(inputs.raw_orders(spark, sf_dir))
    return items.select(
        "order_id", "index",
        F.variant_get("value", "$.product_id", "string").alias("product_id"),
        F.variant_get("value", "$.quantity", flatten.QUANTITY).alias("quantity"),
        F.variant_get("value", "$.discount_percent", "decimal(8,4)").alias("discount_percent"),
    )


@query
def item_array_aggregates(spark, sf_dir):
    items = inputs.raw_orders(spark, sf_dir).select("order_id", flatten.counted_items(F.col("raw_data")).alias("items"))
    return items.select("order_id", *(c.alias(n) for n, c in flatten.item_aggregates("items").items()))


@query
def insert_only_new_items(spark, sf_dir):
    """Items whose order was not there before 2000: what a second run would insert."""
    items = inputs.silver_order_items(spark, sf_dir)
    dates = inputs.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string")).alias("_order"),
        F.col("o_orderdate").cast("date").alias("_date"))
    base = F.regexp_extract("order_id", "^(ORD-[0-9]+)", 1)
    existing = items.join(dates.where(F.col("_date") < ORDERS_UNTIL), base == F.col("_order"), "left_semi")
    return changes.anti_new(items, existing, ["order_id", "line_number"]).select(
        "order_id", "line_number", "product_id", "quantity")


# --- merges ------------------------------------------------------------------------------------


def _resent_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second delivery: changed first name and segment."""
    return inputs.raw_customers(spark, sf_dir).where(SECOND_BATCH).withColumns({
        "first_name": F.lit(" Renamed"), "customer_segment": F.lit("vip")})


def _lineage(df: DataFrame, key: str, batch: int) -> DataFrame:
    number = F.regexp_extract(key, "([0-9]+)$", 1).cast("long")
    return df.withColumns({
        "record_id": number * 10 + batch, "filename": F.lit(f"batch-{batch}"),
        "load_timestamp": F.lit(f"2002-01-0{batch} 00:00:00").cast("timestamp_ntz")})


NOW = dt.datetime(2002, 1, 2)
_CLOCKS = ["silver_load_ts", "silver_update_ts", "bronze_load_ts"]


def _merged(spark: SparkSession, name: str, deliveries: tuple[DataFrame, ...], keys: list[str], update: list[str],
            **options) -> DataFrame:
    """The stored table after the deliveries were merged one after the other."""
    path = scratch_path(spark, name)
    for delivery in deliveries:
        merge_into_path(path, delivery, keys, update, **options)
    return read_table(spark, path)


@query
def merge_upsert_query(spark, sf_dir):
    """The plain operator on a plain table: balances of re-sent customers are replaced."""
    people = inputs.table(spark, sf_dir, "customer").join(
        inputs.places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
    first = people.where(FIRST_BATCH).select("c_custkey", "c_name", F.col("c_acctbal").cast("decimal(18,2)").alias("balance"))
    second = people.where(SECOND_BATCH).select(
        "c_custkey", F.lit("ignored").alias("c_name"),
        (F.col("c_acctbal").cast("decimal(18,2)") + 100).alias("balance"))
    return merge_upsert(first, second, ["c_custkey"], ["balance"], with_action=True).withColumnRenamed(
        "_merge_action", "merge_action")


@query
def merge_customers(spark, sf_dir):
    house = full_run.Warehouse(scratch_path(spark, "merge"))
    first = _lineage(inputs.raw_customers(spark, sf_dir).where(FIRST_BATCH), "customer_id", 1).drop("r_name")
    second = _lineage(_resent_customers(spark, sf_dir), "customer_id", 2).drop("r_name")
    for raw in (first, second):
        full_run.merge_customers(house, raw, AS_OF, NOW)
    return house.read(spark, "silver", "customers").drop("customer_sk", *_CLOCKS)


@query
def merge_products(spark, sf_dir):
    """PROMO and LARGE products sent again, twice in one delivery: the later record wins and the
    creation date stays."""
    house = full_run.Warehouse(scratch_path(spark, "merge"))
    raw = inputs.raw_products(spark, sf_dir)
    resent = raw.where("category in ('promo', 'large')").withColumn("created_date", F.lit("2001-12-01"))
    cheap = resent.withColumn("unit_price", F.lit("10.5"))
    dear = resent.withColumn("unit_price", F.lit("120"))
    full_run.merge_products(house, _lineage(raw.where("category <> 'large'"), "product_id", 1), AS_OF, NOW)
    both = _lineage(cheap, "product_id", 2).unionByName(_lineage(dear, "product_id", 3))
    full_run.merge_products(house, both, AS_OF, NOW)
    return house.read(spark, "silver", "products").drop("product_sk", *_CLOCKS)


def _order_batches(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    first = orders.where(F.col("order_date") < ORDERS_UNTIL)
    second = orders.where(F.col("order_date") >= ORDERS_FROM).withColumns({
        "order_status": F.lit("SHIPPED"), "ship_date": F.date_add("order_date", 3),
        "total_amount": (F.col("total_amount") + F.lit(Decimal("1.5000"))).cast(MONEY),
        "ship_mode": F.lit("Resent")})
    return first, second


@query
def merge_orders(spark, sf_dir):
    first, second = _order_batches(stored(spark, sf_dir, "orders"))
    merged = _merged(spark, "orders", (first, second), ["order_id"], silver.ORDER_UPDATE_COLUMNS)
    return merged.select("order_id", "customer_id", "order_date", "order_status", "ship_date", "ship_mode",
                         "subtotal", "total_amount", "total_items")


@query
def merge_dim_customer(spark, sf_dir):
    dim = inputs.dim_customer(spark, sf_dir).join(
        inputs.raw_customers(spark, sf_dir).select("customer_id", "r_name"), "customer_id")
    first = dim.where(FIRST_BATCH).drop("r_name")
    second = dim.where(SECOND_BATCH).drop("r_name").withColumns({
        "customer_tier": F.lit("TIER_9"), "registration_date": F.lit(AS_OF)})
    merged = _merged(spark, "dim", (first, second), ["customer_id"], dims.CUSTOMER_UPDATE_COLUMNS)
    return merged.select(
        "customer_sk", "customer_id", "full_name", "region", "customer_tier", "registration_date", "tenure_band",
        "is_current")


@query
def merge_dim_product(spark, sf_dir):
    dim = inputs.dim_product(spark, sf_dir)
    first = dim.where("category <> 'LARGE'")
    second = dim.where("category in ('PROMO', 'LARGE')").withColumns({
        "price_band": F.lit("Resent"), "product_bk": F.lit("changed")})
    merged = _merged(spark, "dim", (first, second), ["product_id"], dims.PRODUCT_UPDATE_COLUMNS)
    return merged.select("product_sk", "product_id", "product_bk", "price_band", "unit_price", "is_current")


@query
def merge_fact_sales(spark, sf_dir):
    customers, places = stored(spark, sf_dir, "dim_customer"), stored(spark, sf_dir, "dim_geography")
    first, second = (
        facts.fact_sales(orders, customers, places) for orders in _order_batches(stored(spark, sf_dir, "orders")))
    merged = _merged(spark, "fact", (first, second), ["order_id"], facts.SALES_UPDATE_COLUMNS, surrogate="sales_sk",
                     cluster_by=["date_sk"])
    return merged.select(
        "order_id", "date_sk", "customer_sk", "order_status", "ship_mode", "total_amount", "profit_amount",
        "days_to_ship")


@query
def merge_daily_sales(spark, sf_dir):
    """Days from July 1999 are computed again after amounts grew; the stored new-customer count stays."""
    orders = stored(spark, sf_dir, "orders")
    first = facts.fact_daily_sales(orders, end=dt.date(1999, 12, 31)).withColumn("new_customers", F.lit(7).cast("long"))
    grown = orders.withColumn("total_amount", (F.col("total_amount") + 10).cast(MONEY))
    second = facts.fact_daily_sales(grown, start=ORDERS_FROM)
    merged = _merged(spark, "daily", (first, second), ["date_sk"], facts.DAILY_UPDATE_COLUMNS)
    return merged.select("date_sk", "snapshot_date", "new_customers", "total_orders", "net_revenue", "avg_order_value")


@query
def surrogate_keys(spark, sf_dir):
    ids = inputs.raw_customers(spark, sf_dir).select("customer_id")
    return ranking.with_surrogate_key(ids, "customer_sk", ["customer_id"], start=1000)


@query
def scd2_dimension(spark, sf_dir):
    keyed = inputs.dim_customer(spark, sf_dir).join(
        inputs.raw_customers(spark, sf_dir).select("customer_id", "r_name"), "customer_id"
    ).select("customer_id", "full_name", "customer_tier", "region", "r_name")
    dim = keyed.where(FIRST_BATCH).drop("r_name").withColumns({
        "effective_date": F.lit(dt.date(2001, 1, 1)), "expiration_date": F.lit(OPEN_END), "is_current": F.lit(True)})
    source = keyed.where(SECOND_BATCH).drop("r_name").withColumn("customer_tier", F.lit("TIER_1"))
    return scd2(dim, source, "customer_id", ["full_name", "customer_tier", "region"], AS_OF)


# --- global order ------------------------------------------------------------------------------


@query
def global_rank(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("order_date"))
    order = [desc("order_date")]
    return ranking.global_ranks(orders, order, {"overall_rank": (), "priority_rank": ("o_orderpriority",)})


@query
def global_ntile(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    return ranking.global_ntile(orders, 5, [desc("order_date"), asc("o_orderkey")], "tile")


@query
def pct_of_total(spark, sf_dir):
    revenue = inputs.table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("revenue"))
    return ranking.pct_of_total(revenue, "revenue", "share")


# --- change capture ----------------------------------------------------------------------------


@query
def cdc_changes(spark, sf_dir):
    columns = ["customer_id", "first_name", "customer_segment"]
    prev = inputs.raw_customers(spark, sf_dir).where(FIRST_BATCH)
    kept = prev.where(f"r_name not in ('EUROPE', '{DELETED_REGION}')")
    curr = kept.unionByName(_resent_customers(spark, sf_dir))
    return changes.table_changes(prev.select(*columns), curr.select(*columns), ["customer_id"]).withColumnsRenamed(
        {"_change_type": "change_type", "_is_update": "is_update"})


def _typed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.col("o_orderdate").cast("date").alias("order_date"))


@query
def cdc_checksum_tree(spark, sf_dir):
    """Two snapshots of the orders: the last hundredth of the keys changed, a few orders removed and added."""
    prev = stage(_typed_orders(spark, sf_dir).drop("order_date"), "snapshot")
    newest = prev.agg(F.max("o_orderkey")).scalar()
    late = F.col("o_orderkey") > newest - F.floor(newest / 100)
    added = prev.where("o_orderkey % 5000 = 18").withColumn("o_orderkey", -F.col("o_orderkey"))
    curr = (prev.where("o_orderkey % 5000 <> 17").withColumn("o_orderstatus", F.when(late, "X").otherwise(F.col("o_orderstatus")))
            .unionByName(added))
    found = checksums.changes_by_checksum(prev, stage(curr, "snapshot"), ["o_orderkey"])
    return found.withColumnsRenamed({"_change_type": "change_type", "_is_update": "is_update"})


DAILY_ORDERS = MaintainedView(("order_date",), {"revenue": "amount"}, {"customers": "o_custkey"})


@query
def incremental_daily_sales(spark, sf_dir):
    """Daily orders, customers and revenue, stored once and then kept by changes: new, corrected, moved and deleted orders."""
    orders = stage(_typed_orders(spark, sf_dir), "orders")
    prev = orders.where(F.col("order_date") < F.lit(ORDERS_UNTIL))
    sevenths, moved = F.col("o_orderkey") % 7 == 0, F.col("o_orderkey") % 14 == 0
    curr = orders.where("o_orderkey % 11 <> 0").withColumns({
        "amount": F.when(sevenths, F.col("amount") + F.lit(Decimal("1.50"))).otherwise(F.col("amount")).cast("decimal(18,2)"),
        "o_custkey": F.when(sevenths, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")),
        "order_date": F.when(moved, F.date_add("order_date", 1)).otherwise(F.col("order_date"))})
    view, members = DAILY_ORDERS.build(prev)
    view, members = stage(view, "view"), {n: stage(m, "members") for n, m in members.items()}
    changed = stage(signed(changes.table_changes(prev, curr, ["o_orderkey"])), "changes")
    kept, _ = DAILY_ORDERS.apply(view, members, changed)
    return kept.select("order_date", F.col("row_count").alias("orders"), "customers", "revenue",
                       (F.col("revenue").cast("double") / F.col("revenue_values")).alias("avg_order_value"))


@query
def distinct_customers_by_bitmap(spark, sf_dir):
    """Customers per month and year from stored bitmaps per day."""
    days = stage(bitmaps.distinct_bitmaps(_typed_orders(spark, sf_dir), ["order_date"], "o_custkey"), "bitmaps")
    months = stage(bitmaps.roll_up(days, F.date_format("order_date", "yyyy-MM").alias("period")), "bitmaps")
    years = bitmaps.roll_up(months, F.substring("period", 1, 4).alias("period"))
    return bitmaps.distinct_counts(months, ["period"], "customers").unionByName(bitmaps.distinct_counts(years, ["period"], "customers"))


def _tier_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the orders tells the customer's tier from its day on."""
    orders = inputs.table(spark, sf_dir, "orders").where("o_orderkey % 3 = 0")
    return orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("valid_from"),
                         F.col("o_orderpriority").alias("tier"), F.col("o_orderkey").alias("arrival"))


def _delivered_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Versions after the first and the second delivery, which fills gaps of the first, and the second delivery."""
    sent = _tier_versions(spark, sf_dir)
    late = sent.where("o_custkey % 4 = 1 and arrival % 2 = 1")
    early = sent.where("not (o_custkey % 4 = 1 and arrival % 2 = 1)")
    first = stage(validity.merge_versions(None, early, "o_custkey", "arrival"), "versions")
    return first, stage(validity.merge_versions(first, late, "o_custkey", "arrival"), "versions"), late


@query
def validity_intervals(spark, sf_dir):
    """Intervals after two deliveries out of order; the second computes only its own customers again."""
    first, both, late = _delivered_versions(spark, sf_dir)
    kept = stage(validity.intervals(first, "o_custkey", ["tier"]), "intervals")
    return validity.refresh_intervals(kept, both, late, "o_custkey", ["tier"])


@query
def fact_as_of_version(spark, sf_dir):
    """The other orders with the customer's tier on their day."""
    _, versions, _ = _delivered_versions(spark, sf_dir)
    sales = _typed_orders(spark, sf_dir).where("o_orderkey % 3 <> 0").select("o_orderkey", "o_custkey", "order_date")
    return validity.as_of_join(sales, versions, "o_custkey", "order_date", ["tier"])


def _event_deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    # Written once: a filter on an extracted column would build every document again.
    typed = stage(load.RAW_EVENTS.with_extracted(inputs.raw_events(spark, sf_dir)), "events")
    middle = F.col("event_timestamp") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return [typed.where(middle), typed.where(~middle)]


@query
def cdc_append_only(spark, sf_dir):
    """Two deliveries into a growing table, each consumed once into the target."""
    root = scratch_path(spark, "events")
    source, target = f"{root}/bronze", f"{root}/silver"
    for delivery in _event_deliveries(spark, sf_dir):
        landing.rows_to_parquet(delivery, source)
        stream = incremental.read_growing(spark, source, delivery.schema)
        incremental.append_only(stream, target, f"{root}/checkpoint", silver.silver_events).awaitTermination()
    return spark.read.parquet(target).select("event_id", "event_type", "event_timestamp", "event_value",
                                             F.col("batch").cast("long").alias("batch"))


@query
def events_by_state(spark, sf_dir):
    """Three deliveries, each event once as first delivered: some come late, many again, some without an id."""
    house = full_run.Warehouse(scratch_path(spark, "event_state"))
    ts, k = F.col("event_timestamp"), F.regexp_extract("event_id", "([0-9]+)$", 1).cast("long")
    events = stage(load.RAW_EVENTS.with_extracted(inputs.raw_events(spark, sf_dir)), "events").withColumn("rejected", F.lit(0))
    held_back, (first, second) = k % 20 == 3, (F.lit(day).cast("timestamp_ntz") for day in EVENT_CUTS[:2])
    unnamed = F.parse_json(F.lit('{"event_type": "click"}'))
    for day, part in zip(EVENT_CUTS, (
        (ts < first) & ~held_back,
        ((ts >= first) & (ts < second)) | ((ts < first) & (held_back | (k % 10 == 0))),
        (ts >= second) | (k % 7 == 0),
    )):
        sent = events.where(part).unionByName(
            events.where(part & (k % 100 == 1)).withColumns({"raw_data": unnamed, "event_id": F.lit(None).cast("string")}))
        lineage = {"record_id": k.cast("decimal(28,0)"), "filename": F.lit("events"), "file_row_number": k,
                   "load_timestamp": F.lit(day).cast("timestamp_ntz")}
        landing.rows_to_parquet(sent.withColumns(lineage), f"{house.bronze}/raw_events")
        full_run.stream_events(spark, house, "15 days")
    stored = event_state.read_events(spark, house.table("silver", "event_stream"))
    return stored.select("event_id", "event_type", "event_timestamp", "event_value",
                         F.col("bronze_load_ts").alias("first_delivered"))


@query
def incremental_silver(spark, sf_dir):
    """Landing files in two deliveries, loaded and merged incrementally; a third run finds nothing."""
    house = full_run.Warehouse(scratch_path(spark, "incremental"))
    path = landing.customers_csv(spark, sf_dir, FIRST_BATCH)
    batches = []
    for step in range(3):
        if step == 1:
            _resent_customers(spark, sf_dir).select(*CUSTOMER_COLUMNS).write.mode("append").options(
                **landing.CSV_WRITE).csv(path)
        load.load_raw(spark, load.RAW_CUSTOMERS, path, house.bronze)
        batches.append(full_run.consume(spark, house, load.RAW_CUSTOMERS, "silver_customers",
                                        full_run.merge_customers, AS_OF))
    return house.read(spark, "silver", "customers").select(
        "customer_id", "first_name", "customer_segment", "customer_tier", "dq_score",
    ).withColumn("idle_batches", F.lit(batches[2]))


@query
def stream_status(spark, sf_dir):
    """Four growing tables: two consumed, one with an unread second delivery, one never read."""
    root = scratch_path(spark, "status")
    deliveries = _event_deliveries(spark, sf_dir)
    streams = []
    for name, read_first, second in (("events", True, True), ("customers", True, False), ("products", False, False),
                                     ("orders", True, False)):
        source, checkpoint = f"{root}/{name}", f"{root}/checkpoints/{name}"
        frame = {
            "customers": lambda: inputs.raw_customers(spark, sf_dir),
            "products": lambda: inputs.raw_products(spark, sf_dir),
            "orders": lambda: inputs.silver_orders(spark, sf_dir),
            "events": lambda: deliveries[0],
        }[name]()
        landing.rows_to_parquet(frame, source)
        if read_first:
            incremental.append_only(incremental.read_growing(spark, source, frame.schema), f"{root}/out/{name}",
                                    checkpoint).awaitTermination()
        if second:
            landing.rows_to_parquet(deliveries[1], source)
        streams.append((f"STREAM_RAW_{name.upper()}", source, checkpoint))
    return incremental.stream_status(spark, streams).select("stream_name", "has_data")


# --- gold --------------------------------------------------------------------------------------


@query
def date_spine(spark, sf_dir):
    """Every day between the first and the last order, with its number of orders (0 when none)."""
    days = inputs.table(spark, sf_dir, "orders").groupBy(
        F.col("o_orderdate").cast("date").alias("full_date")).agg(F.count(F.lit(1)).alias("n"))
    first, last = days.agg(F.min("full_date"), F.max("full_date")).first()
    return dims.date_spine(spark, str(first), str(last)).join(days, "full_date", "left").select(
        "full_date", F.coalesce("n", F.lit(0)).alias("order_count"))


def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_date(spark, *inputs.calendar_bounds(spark, sf_dir))


@query
def dim_date(spark, sf_dir):
    """The calendar of the days on which lines were shipped, from the first to the last."""
    shipped = inputs.table(spark, sf_dir, "lineitem").agg(
        F.min("l_shipdate").cast("date"), F.max("l_shipdate").cast("date")).first()
    return dims.dim_date(spark, str(shipped[0]), str(shipped[1]))


@query
def dim_customer(spark, sf_dir):
    return inputs.dim_customer(spark, sf_dir)


@query
def dim_product(spark, sf_dir):
    return inputs.dim_product(spark, sf_dir)


@query
def dim_geography(spark, sf_dir):
    return dims.dim_geography(inputs.silver_orders(spark, sf_dir))


@query
def fact_sales(spark, sf_dir):
    tables = (stored(spark, sf_dir, name) for name in ("orders", "dim_customer", "dim_geography"))
    return facts.fact_sales(*tables).withColumn("geography_sk", F.col("geography_sk").isNotNull()).withColumnRenamed(
        "geography_sk", "has_geography").drop("source_order_sk", "product_sk")


@query
def fact_sales_items(spark, sf_dir):
    return facts.fact_sales_items(*(stored(spark, sf_dir, name) for name in ("order_items", "fact_sales", "dim_product")))


@query
def fact_daily_sales(spark, sf_dir):
    return facts.fact_daily_sales(stored(spark, sf_dir, "orders"))


@query
def daily_sales_trends(spark, sf_dir):
    return facts.daily_sales_trends(stored(spark, sf_dir, "fact_daily_sales"), stored(spark, sf_dir, "orders"))


@query
def fact_customer_activity(spark, sf_dir):
    return facts.fact_customer_activity(stored(spark, sf_dir, "fact_sales"), AS_OF)


@query
def fact_product_performance(spark, sf_dir):
    return facts.fact_product_performance(
        stored(spark, sf_dir, "fact_sales_items"), stored(spark, sf_dir, "dim_product"))


# --- views -------------------------------------------------------------------------------------


@query
def v_sales_overview(spark, sf_dir):
    return views.v_sales_overview(stored(spark, sf_dir, "fact_daily_sales"), _calendar(spark, sf_dir))


@query
def v_customer_segments(spark, sf_dir):
    return views.v_customer_segments(stored(spark, sf_dir, "dim_customer"), stored(spark, sf_dir, "fact_sales"))


@query
def v_product_performance(spark, sf_dir):
    return views.v_product_performance(stored(spark, sf_dir, "dim_product"), stored(spark, sf_dir, "fact_sales_items"))


@query
def v_monthly_trends(spark, sf_dir):
    return views.v_monthly_trends(stored(spark, sf_dir, "fact_sales"), _calendar(spark, sf_dir))


@query
def v_category_performance(spark, sf_dir):
    return views.v_category_performance(stored(spark, sf_dir, "dim_product"), stored(spark, sf_dir, "fact_sales_items"))


@query
def v_geographic_sales(spark, sf_dir):
    return views.v_geographic_sales(stored(spark, sf_dir, "dim_customer"), stored(spark, sf_dir, "fact_sales"))


@query
def v_top_customers(spark, sf_dir):
    return views.v_top_customers(stored(spark, sf_dir, "dim_customer"), stored(spark, sf_dir, "fact_sales"), AS_OF)


@query
def v_order_status_summary(spark, sf_dir):
    return views.v_order_status_summary(stored(spark, sf_dir, "fact_sales"))


# --- whole run and audits ----------------------------------------------------------------------


def land_all(spark: SparkSession, sf_dir: str) -> str:
    """A landing area with the three sources, orders as one document per line."""
    root = scratch_path(spark, "landing")
    landing.orders_json(spark, sf_dir, f"{root}/orders")
    inputs.raw_customers(spark, sf_dir).select(*CUSTOMER_COLUMNS).write.options(**landing.CSV_WRITE).csv(
        f"{root}/customers")
    inputs.raw_products(spark, sf_dir).select(*PRODUCT_COLUMNS).write.options(**landing.CSV_WRITE).csv(
        f"{root}/products")
    return root


def run_all(spark: SparkSession, sf_dir: str) -> full_run.Warehouse:
    house = full_run.Warehouse(scratch_path(spark, "warehouse"))
    first, last = inputs.calendar_bounds(spark, sf_dir)
    full_run.run_layers(spark, land_all(spark, sf_dir), house.root, AS_OF, dt.date.fromisoformat(first),
                        dt.date.fromisoformat(last), order_format=scan.JSON_LINES)
    full_run.populate_dim_date(spark, house, first, last)
    return house


def stored_sales_overview(spark: SparkSession, house: full_run.Warehouse) -> DataFrame:
    return views.v_sales_overview(
        house.read(spark, "gold", "fact_daily_sales"), house.read(spark, "gold", "dim_date"))


@query
def full_layer_run(spark, sf_dir):
    """Files to gold: the daily snapshots stored by the jobs."""
    house = run_all(spark, sf_dir)
    return house.read(spark, "gold", "fact_daily_sales").drop("etl_load_ts")


# Per gold table: the business key and a measure.
GOLD = {
    "dim_customer": (["customer_id"], "customer_tenure_days"), "dim_product": (["product_id"], "unit_price"),
    "dim_geography": (["city", "state", "country"], "geography_sk"), "fact_sales": (["order_id"], "total_amount"),
    "fact_sales_items": (["order_id", "line_number"], "line_net_amount"), "fact_daily_sales": (["date_sk"], "net_revenue"),
}


@query
def run_pipeline(spark, sf_dir):
    """Files to gold: rows, distinct keys and one measure of each of the six stored gold tables."""
    house = run_all(spark, sf_dir)
    parts = []
    for name, (keys, measure) in GOLD.items():
        # Surrogate keys depend on arrival order; only their presence counts.
        total = F.count(measure) if measure.endswith("_sk") else F.sum(measure)
        parts.append(house.read(spark, "gold", name).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
            F.countDistinct(F.struct(*keys)).alias("n_keys"), total.cast("double").alias("measure")))
    return reduce(DataFrame.unionByName, parts)


RUN_AS_OF = dt.datetime(2024, 1, 31)


@query
def run_summary(spark, sf_dir):
    """Jobs over the trailing 24 days of the log."""
    return audit.run_summary(inputs.run_log(spark, sf_dir), RUN_AS_OF, hours=24 * 24)


@query
def run_history(spark, sf_dir):
    return audit.run_history(inputs.run_log(spark, sf_dir), RUN_AS_OF, days=7)


@query
def constraint_audit(spark, sf_dir):
    tables = {
        "lineitem": inputs.table(spark, sf_dir, "lineitem"),
        "orders": inputs.table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("l_orderkey"), "o_custkey"),
        "customer": inputs.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey")),
        "silver_customers": inputs.silver_customers(spark, sf_dir),
    }
    return audit.constraint_audit(
        tables,
        unique=[("lineitem", ["l_orderkey", "l_linenumber"]), ("orders", ["l_orderkey"]),
                ("silver_customers", ["customer_id"])],
        not_null=[("silver_customers", ["customer_id", "email", "registration_date"]), ("lineitem", ["l_orderkey"])],
        foreign=[("lineitem", "l_orderkey", "orders", "l_orderkey"), ("orders", "o_custkey", "customer", "o_custkey"),
                 ("orders", "l_orderkey", "lineitem", "l_orderkey")],
    )


@query
def layer_counts(spark, sf_dir):
    raw = inputs.raw_customers(spark, sf_dir)
    customers = silver.silver_customers(raw, AS_OF)
    return audit.layer_counts({
        "bronze.raw_customers": raw,
        "silver.customers": customers,
        "gold.dim_customer": dims.dim_customer(customers),
        "bronze.raw_orders": inputs.raw_orders(spark, sf_dir),
        "silver.orders": inputs.silver_orders(spark, sf_dir),
        "silver.order_items": inputs.silver_order_items(spark, sf_dir),
        "gold.fact_daily_sales": facts.fact_daily_sales(inputs.silver_orders(spark, sf_dir)),
    })
