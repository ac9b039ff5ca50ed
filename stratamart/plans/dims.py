"""Gold dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import as_date, date_key, day_of_week, is_weekend
from ..functions.text import country_code, price_band, region, tenure_band, trim_upper
from ..operators.ranking import with_surrogate_key
from ..operators.scd2 import OPEN_END

# Default calendar.
CALENDAR_START, CALENDAR_END = "2020-01-01", "2025-12-31"

# Columns a dimension merge overwrites.
CUSTOMER_UPDATE_COLUMNS = [
    "full_name", "email", "email_domain", "phone", "city", "state", "state_code", "country", "country_code",
    "region", "customer_segment", "customer_tier", "customer_tenure_days", "tenure_band", "is_active",
    "is_email_valid",
]
PRODUCT_UPDATE_COLUMNS = [
    "product_name", "category", "subcategory", "category_path", "brand", "unit_price", "unit_cost",
    "profit_margin", "margin_percent", "price_band", "weight_kg", "supplier_id", "is_active",
]


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Consecutive days, both ends included."""
    days = (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days + 1
    return spark.range(0, max(days, 0), 1, 1).select(F.date_add(as_date(start), F.col("id").cast("int")).alias("full_date"))


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    d = F.col("full_date")
    year, week = F.year(d).cast("string"), F.weekofyear(d).cast("string")
    return date_spine(spark, start, end).select(
        date_key(d).alias("date_sk"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.monthname(d).alias("month_name"),
        F.left(F.monthname(d), F.lit(3)).alias("month_abbr"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofyear(d).alias("day_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        day_of_week(d).alias("day_of_week"),
        F.dayname(d).alias("day_name"),
        F.left(F.dayname(d), F.lit(3)).alias("day_abbr"),
        F.year(d).alias("fiscal_year"),
        F.quarter(d).alias("fiscal_quarter"),
        F.month(d).alias("fiscal_month"),
        is_weekend(d).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        (~is_weekend(d)).alias("is_business_day"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.concat(year, F.lit("-Q"), F.quarter(d).cast("string")).alias("year_quarter"),
        F.concat(year, F.lit("-W"), F.lpad(week, 2, "0")).alias("year_week"),
        F.add_months(d, -12).alias("same_day_last_year"),
        F.add_months(d, -1).alias("same_day_last_month"),
    )


def _version_columns(as_of: dt.date | str | None) -> list[Column]:
    if as_of is None:
        return []
    return [
        as_date(as_of).alias("effective_date"),
        F.lit(OPEN_END).alias("expiration_date"),
        F.lit(True).alias("is_current"),
    ]


def _current(df: DataFrame) -> DataFrame:
    return df.where("is_current") if "is_current" in df.columns else df


def dim_customer(customers: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Rows to merge into the customer dimension; with ``as_of`` also the version columns."""
    current = F.col("is_current") if "is_current" in customers.columns else F.lit(True)
    key = ["customer_sk"] if "customer_sk" in customers.columns else []
    return _current(customers).select(
        *key,
        "customer_id",
        F.col("customer_id").alias("customer_bk"),
        "full_name", "email", "email_domain",
        F.col("phone_formatted").alias("phone"),
        "city", "state", "state_code", "country", "country_code",
        region(F.col("state")).alias("region"),
        "customer_segment", "customer_tier", "registration_date",
        F.col("days_since_registration").alias("customer_tenure_days"),
        tenure_band(F.col("days_since_registration")).alias("tenure_band"),
        current.alias("is_active"),
        "is_email_valid",
        *_version_columns(as_of),
    )


def dim_product(products: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Rows to merge into the product dimension; with ``as_of`` also the version columns."""
    key = ["product_sk"] if "product_sk" in products.columns else []
    return _current(products).select(
        *key,
        "product_id",
        F.col("product_id").alias("product_bk"),
        "product_name", "category", "subcategory", "category_path", "brand",
        "unit_price", "unit_cost", "profit_margin", "margin_percent",
        price_band(F.col("unit_price")).alias("price_band"),
        "weight_kg", "supplier_id", "is_active",
        *_version_columns(as_of),
    )


def geography_attributes(orders: DataFrame) -> DataFrame:
    """Distinct shipping places of the orders, with codes and region by the customer rules."""
    places = orders.select(
        F.col("shipping_city").alias("city"), F.col("shipping_state").alias("state"),
        F.col("shipping_country").alias("country"),
    ).distinct()
    state, country = trim_upper(F.col("state")), trim_upper(F.col("country"))
    return places.select(
        "city", "state", F.left(state, F.lit(2)).alias("state_code"),
        "country", country_code(country).alias("country_code"),
        region(state).alias("region"),
        F.lit(None).cast("string").alias("subregion"),
        F.lit(None).cast("decimal(10,6)").alias("latitude"),
        F.lit(None).cast("decimal(10,6)").alias("longitude"),
    )


def dim_geography(orders: DataFrame) -> DataFrame:
    return with_surrogate_key(geography_attributes(orders), "geography_sk", ["city", "state", "country"])
