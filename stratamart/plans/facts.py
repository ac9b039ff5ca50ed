"""Gold facts."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import as_date, date_key
from ..functions.numeric import MONEY, PERCENT, percent_of, quotient, rounded_average, zero_percent
from ..operators.ordering import asc, desc
from ..operators.ranking import global_ranks, ntile_by_cuts, ntile_cuts
from ..session import stage

# Assumed profit share of the subtotal, score buckets, and merge column lists.
PROFIT_SHARE = "0.30"
SCORE_BUCKETS = 5
SALES_UPDATE_COLUMNS = ["order_status", "total_amount", "days_to_ship"]
DAILY_UPDATE_COLUMNS = [
    "total_orders", "total_customers", "total_items_sold", "total_quantity", "gross_revenue", "total_discounts",
    "net_revenue", "total_tax", "total_shipping", "avg_order_value", "avg_items_per_order",
    "avg_discount_percent", "unique_products_sold",
]


def _sum(name: str, kind: str = MONEY) -> Column:
    return F.sum(name).cast("decimal(38,4)" if kind == MONEY else kind)


def fact_sales(orders: DataFrame, customers: DataFrame, geography: DataFrame) -> DataFrame:
    """Order grain. Customers and places are joined on their unique keys; a customer with a large share
    of the orders is split by the adaptive skew join, and sizes decide at run time what is broadcast. The few places come
    first, so that their key goes through a shuffle by customer, not their three texts."""
    current = customers.where("is_current") if "is_current" in customers.columns else customers
    who = current.select("customer_id", "customer_sk")
    where = geography.select(
        F.col("city").alias("shipping_city"), F.col("state").alias("shipping_state"),
        F.col("country").alias("shipping_country"), "geography_sk",
    )
    source_key = F.col("order_sk") if "order_sk" in orders.columns else F.lit(None).cast("long")
    return (
        orders.join(where, ["shipping_city", "shipping_state", "shipping_country"], "left")
        .drop("shipping_city", "shipping_state", "shipping_country")
        .join(who, "customer_id", "left")
        .select(
            "order_id",
            date_key(F.col("order_date")).alias("date_sk"),
            "customer_sk",
            F.lit(None).cast("long").alias("product_sk"),
            "geography_sk", "order_date", "customer_id", "order_status", "order_priority", "ship_mode",
            "total_items", "total_quantity", "unique_products", "subtotal", "discount_amount",
            "discount_percent", "tax_amount", "shipping_cost", "total_amount",
            (F.col("subtotal") * F.lit(Decimal(PROFIT_SHARE))).try_cast(MONEY).alias("profit_amount"),
            F.datediff("ship_date", "order_date").cast("long").alias("days_to_ship"),
            source_key.alias("source_order_sk"),
        )
    )


def fact_sales_items(items: DataFrame, sales: DataFrame, products: DataFrame) -> DataFrame:
    """Line grain with cost, profit and margin."""
    sales_key = ["sales_sk"] if "sales_sk" in sales.columns else []
    header = sales.select("order_id", "date_sk", "customer_sk", "order_date", "customer_id", *sales_key)
    current = products.where("is_current") if "is_current" in products.columns else products
    costs = current.select("product_id", "product_sk", "unit_cost")
    lines = items.drop("source_record_id").join(header, "order_id", "left").join(costs, "product_id", "left")
    cost = (F.col("quantity").try_cast("decimal(14,0)") * F.col("unit_cost")).try_cast(MONEY)
    profit = (F.col("line_net_amount") - cost).try_cast(MONEY)
    margin = F.when(F.col("line_net_amount") > 0, percent_of(profit, F.col("line_net_amount"))).otherwise(zero_percent())
    return lines.select(
        *sales_key, "date_sk", "customer_sk", "product_sk", "order_id", "line_number", "order_date",
        "customer_id", "product_id", "quantity", "unit_price", "unit_cost", "discount_percent",
        "line_total", "line_discount", "line_net_amount",
        cost.alias("line_cost"), profit.alias("line_profit"), margin.try_cast(PERCENT).alias("line_margin_percent"),
    )


def fact_daily_sales(orders: DataFrame, start: dt.date | str | None = None,
                     end: dt.date | str | None = None) -> DataFrame:
    """Daily snapshot for the days from ``start`` to ``end`` (both included, open when None).

    One row per order is the grain of the input, so the order count needs no distinct. Customers are counted apart, from
    two columns: a distinct count beside the sums would shuffle a row of sums for each customer of a day.
    """
    day = F.col("order_date")
    wanted = orders.where(day.isNotNull())
    if start is not None:
        wanted = wanted.where(day >= as_date(start))
    if end is not None:
        wanted = wanted.where(day <= as_date(end))
    customers = wanted.where(F.col("customer_id").isNotNull()).select(day.alias("_day"), "customer_id").distinct().groupBy(
        "_day").agg(F.count(F.lit(1)).alias("_customers"))
    sums = wanted.groupBy(day.alias("snapshot_date")).agg(
        F.count("order_id").alias("total_orders"),
        F.lit(0).cast("long").alias("new_customers"),
        F.sum("total_items").alias("total_items_sold"),
        F.sum("total_quantity").alias("total_quantity"),
        _sum("subtotal").alias("gross_revenue"),
        _sum("discount_amount").alias("total_discounts"),
        _sum("total_amount").alias("net_revenue"),
        _sum("tax_amount").alias("total_tax"),
        _sum("shipping_cost").alias("total_shipping"),
        rounded_average(F.col("total_amount"), 4).try_cast(MONEY).alias("avg_order_value"),
        rounded_average(F.col("total_items"), 2).try_cast("decimal(8,2)").alias("avg_items_per_order"),
        rounded_average(F.col("discount_percent"), 4).try_cast(PERCENT).alias("avg_discount_percent"),
        F.sum("unique_products").alias("unique_products_sold"),
    )
    rest = [c for c in sums.columns if c not in ("snapshot_date", "total_orders")]
    return sums.join(customers, F.col("snapshot_date") == F.col("_day"), "left").select(
        date_key(F.col("snapshot_date")).alias("date_sk"), "snapshot_date", "total_orders",
        F.coalesce("_customers", F.lit(0).cast("long")).alias("total_customers"), *rest)


def previous_day(as_of: dt.date) -> dt.date:
    """Default day of a snapshot run."""
    return as_of - dt.timedelta(days=1)


def daily_sales_trends(daily: DataFrame, orders: DataFrame) -> DataFrame:
    """Year-to-date sums and changes against the day and the week before.

    Windows run per year; the two differences order the day grain, which a calendar bounds.
    """
    first_seen = (
        orders.where(F.col("order_date").isNotNull() & F.col("customer_id").isNotNull())
        .groupBy(F.year("order_date").alias("_y"), "customer_id").agg(F.min("order_date").alias("snapshot_date"))
        .groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("_new_in_year"))
    )
    ytd = Window.partitionBy(F.year("snapshot_date")).orderBy("snapshot_date").rowsBetween(
        Window.unboundedPreceding, 0)
    by_day = Window.orderBy(F.datediff("snapshot_date", F.lit(dt.date(1970, 1, 1))))
    day_before, week_before = by_day.rangeBetween(-1, -1), by_day.rangeBetween(-7, -7)
    return daily.join(first_seen, "snapshot_date", "left").select(
        "date_sk", "snapshot_date", "total_orders", "net_revenue",
        F.sum("total_orders").over(ytd).alias("ytd_orders"),
        F.sum("net_revenue").over(ytd).alias("ytd_revenue"),
        F.sum(F.coalesce("_new_in_year", F.lit(0))).over(ytd).alias("ytd_customers"),
        (F.col("net_revenue") - F.max("net_revenue").over(day_before)).alias("revenue_vs_prev_day"),
        (F.col("net_revenue") - F.max("net_revenue").over(week_before)).alias("revenue_vs_prev_week"),
        (F.col("total_orders") - F.max("total_orders").over(day_before)).alias("orders_vs_prev_day"),
    )


def rfm_keys() -> dict[str, list]:
    """Sort keys of the three scores, ties settled by customer."""
    return {
        "recency": [desc("days_since_last_order"), asc("customer_id")],
        "frequency": [asc("lifetime_orders"), asc("customer_id")],
        "monetary": [asc("lifetime_value"), asc("customer_id")],
    }


def rfm_scores(customers: DataFrame) -> dict[str, Column]:
    """Score columns for a written frame with customer_id, days_since_last_order, lifetime_orders and
    lifetime_value: each is a comparison with at most four cut rows."""
    return {
        name: ntile_by_cuts(ntile_cuts(customers, SCORE_BUCKETS, keys), keys)
        for name, keys in rfm_keys().items()
    }


def rfm_segment(recency: Column, frequency: Column, monetary: Column) -> Column:
    return (
        F.when((recency >= 4) & (frequency >= 4) & (monetary >= 4), "Champions")
        .when(frequency >= 4, "Loyal")
        .when(recency >= 4, "Recent")
        .when((recency <= 2) & (frequency >= 3), "At Risk")
        .when(recency <= 2, "Lapsed")
        .otherwise("Regular")
    )


def fact_customer_activity(sales: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Customer-day grain with lifetime, recency, frequency and RFM columns.

    Orders are first summed per customer and day, so a customer's window holds at most one row per
    calendar day however many orders there are. Scores come from each customer's latest totals.
    """
    days = (
        sales.where(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
        .groupBy("customer_id", "customer_sk", F.col("order_date").alias("activity_date"))
        .agg(
            F.count("order_id").alias("orders_placed"),
            F.sum("total_quantity").alias("items_purchased"),
            _sum("total_amount").alias("total_spend"),
        )
    )
    everything = Window.partitionBy("customer_id")
    ordered = everything.orderBy("activity_date")
    running = ordered.rowsBetween(Window.unboundedPreceding, 0)
    day = F.col("activity_date")
    history = days.select(
        "*",
        F.sum("orders_placed").over(running).alias("lifetime_orders_to_date"),
        F.sum("total_spend").over(running).alias("lifetime_spend"),
        F.sum("items_purchased").over(running).alias("lifetime_items"),
        F.datediff(day, F.min(day).over(everything)).cast("long").alias("days_since_first_order"),
        F.datediff(day, F.lag(day).over(ordered)).cast("long").alias("days_since_prev_order"),
        F.sum("orders_placed").over(everything).alias("lifetime_orders"),
        F.sum("total_spend").over(everything).alias("lifetime_value"),
        F.datediff(as_date(as_of), F.max(day).over(everything)).alias("days_since_last_order"),
        (day == F.max(day).over(everything)).alias("_latest"),
    )
    history = stage(history, "activity")
    scores = rfm_scores(history.where("_latest"))
    scored = history.select("*", *(c.alias(f"_{n}") for n, c in scores.items()))
    orders_to_date = F.col("lifetime_orders_to_date")
    return scored.select(
        date_key(day).alias("date_sk"), "customer_sk", "customer_id", "activity_date",
        "orders_placed", "items_purchased", "total_spend",
        orders_to_date.alias("lifetime_orders"), "lifetime_spend", "lifetime_items",
        "days_since_first_order", F.col("days_since_prev_order").alias("days_since_last_order"),
        quotient(F.col("lifetime_spend"), orders_to_date, 4).alias("avg_order_value"),
        quotient(F.col("days_since_first_order"), orders_to_date - 1, 2)
        .alias("avg_days_between_orders"),
        F.col("_recency").alias("rfm_recency_score"),
        F.col("_frequency").alias("rfm_frequency_score"),
        F.col("_monetary").alias("rfm_monetary_score"),
        rfm_segment(F.col("_recency"), F.col("_frequency"), F.col("_monetary")).alias("rfm_segment"),
    )


def fact_product_performance(sales_items: DataFrame, products: DataFrame) -> DataFrame:
    """Product-day grain with month- and year-to-date sums and revenue ranks.

    Running windows are per product (at most one row per calendar day). The ranks per day and per day
    and category use the distributed rank, as one day can hold every product.
    """
    category = products.select("product_id", "category")
    days = (
        sales_items.where(F.col("order_date").isNotNull())
        .groupBy("product_id", "product_sk", F.col("order_date").alias("performance_date"))
        .agg(
            F.countDistinct("order_id").alias("times_ordered"),
            F.sum("quantity").alias("quantity_sold"),
            _sum("line_total").alias("gross_revenue"),
            _sum("line_discount").alias("total_discounts"),
            _sum("line_net_amount").alias("net_revenue"),
            _sum("line_cost").alias("total_cost"),
            _sum("line_profit").alias("total_profit"),
        )
    )
    day = F.col("performance_date")
    per_year = Window.partitionBy("product_id", F.year(day)).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    per_month = Window.partitionBy("product_id", F.year(day), F.month(day)).orderBy(day).rowsBetween(
        Window.unboundedPreceding, 0)
    net, profit = F.col("net_revenue"), F.col("total_profit")
    # Year before month: the partitioning by product and year also serves the monthly window.
    running = days.select(
        "*",
        F.when(net > 0, percent_of(profit, net)).otherwise(zero_percent()).try_cast(PERCENT).alias("profit_margin"),
        F.sum("quantity_sold").over(per_year).alias("ytd_quantity"),
        F.sum(net).over(per_year).alias("ytd_revenue"),
    ).select(
        "*",
        F.sum("quantity_sold").over(per_month).alias("mtd_quantity"),
        F.sum(net).over(per_month).alias("mtd_revenue"),
    ).join(category, "product_id", "left")
    order = [desc("net_revenue")]
    ranked = global_ranks(running, order, {
        "daily_revenue_rank": ("performance_date",), "category_revenue_rank": ("performance_date", "category")})
    return ranked.select(date_key(day).alias("date_sk"), *(c for c in ranked.columns if c != "category"))
