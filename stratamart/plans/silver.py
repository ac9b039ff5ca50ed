"""Bronze to silver: cleansing, typing and scoring. Every table is one narrow projection."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import as_date, day_of_week, is_weekend, try_date, try_wall_clock
from ..functions.numeric import MONEY, PERCENT, percent_of, try_decimal, zero_percent
from ..functions.quality import dq_score
from ..functions.text import EMAIL_LIKE, TRUE_WORDS, country_code, customer_tier, digits_only, looks_like_email, trim_upper
from ..operators.changes import anti_new
from ..operators.flatten import QUANTITY, counted_items, flatten_items, item_aggregates
from ..operators.merge import latest_by_key, repeated_hashes, settle_repeated

# The score given to every order, and pounds per kilogram.
ORDER_DQ_SCORE = "0.95"
POUNDS_PER_KG = "2.20462"

# Order columns that a re-sent order may change.
ORDER_UPDATE_COLUMNS = ["order_status", "ship_date", "total_amount"]

AUDIT_COLUMNS = {"record_id": "source_record_id", "filename": "source_filename", "load_timestamp": "bronze_load_ts"}


def _audit(raw: DataFrame, names: tuple[str, ...] = tuple(AUDIT_COLUMNS)) -> list[Column]:
    """Lineage columns, where the raw frame carries them."""
    return [F.col(c).alias(AUDIT_COLUMNS[c]) for c in names if c in raw.columns]


def silver_customers(raw: DataFrame, as_of: dt.date | str) -> DataFrame:
    registered = try_date(F.col("registration_date"))
    country = trim_upper(F.col("country"))
    state = trim_upper(F.col("state"))
    segment = trim_upper(F.col("customer_segment"))
    email = F.lower(F.trim("email"))
    digits = digits_only(F.col("phone"))
    score = dq_score([
        (F.col("customer_id").isNotNull(), "0.20"),
        (F.col("first_name").isNotNull(), "0.15"),
        (F.col("last_name").isNotNull(), "0.15"),
        (F.col("email").like(EMAIL_LIKE), "0.20"),
        (F.col("phone").isNotNull(), "0.15"),
        (F.col("city").isNotNull(), "0.15"),
    ])
    return raw.select(
        "customer_id",
        F.trim("first_name").alias("first_name"),
        F.trim("last_name").alias("last_name"),
        F.concat(F.trim("first_name"), F.lit(" "), F.trim("last_name")).alias("full_name"),
        email.alias("email"),
        F.split_part(email, F.lit("@"), F.lit(2)).alias("email_domain"),
        F.trim("phone").alias("phone"),
        digits.alias("phone_formatted"),
        F.trim("address").alias("address"),
        trim_upper(F.col("city")).alias("city"),
        state.alias("state"),
        F.left(state, F.lit(2)).alias("state_code"),
        F.trim("zip_code").alias("zip_code"),
        country.alias("country"),
        country_code(country).alias("country_code"),
        registered.alias("registration_date"),
        segment.alias("customer_segment"),
        customer_tier(segment).alias("customer_tier"),
        F.datediff(as_date(as_of), registered).cast("long").alias("days_since_registration"),
        looks_like_email(F.col("email")).alias("is_email_valid"),
        F.coalesce(F.length(digits) >= 10, F.lit(False)).alias("is_phone_valid"),
        score.alias("dq_score"),
        *_audit(raw),
    )


def silver_products(raw: DataFrame, as_of: dt.date | str) -> DataFrame:
    name = F.trim("product_name")
    category, subcategory = trim_upper(F.col("category")), trim_upper(F.col("subcategory"))
    typed = raw.select(
        "*",
        try_decimal(F.col("unit_price")).alias("_price"),
        try_decimal(F.col("unit_cost")).alias("_cost"),
        try_decimal(F.col("weight_kg"), 12, 4).alias("_kg"),
        try_date(F.col("created_date")).alias("_created"),
    )
    price, cost, kg = F.col("_price"), F.col("_cost"), F.col("_kg")
    score = dq_score([
        (F.col("product_id").isNotNull(), "0.20"),
        (F.col("product_name").isNotNull(), "0.20"),
        (F.col("category").isNotNull(), "0.15"),
        (price > 0, "0.20"),
        (cost > 0, "0.15"),
        (F.col("brand").isNotNull(), "0.10"),
    ])
    return typed.select(
        "product_id",
        name.alias("product_name"),
        F.regexp_replace(F.upper(name), "[^A-Z0-9 ]", "").alias("product_name_clean"),
        category.alias("category"),
        subcategory.alias("subcategory"),
        F.concat(category, F.lit(" > "), subcategory).alias("category_path"),
        trim_upper(F.col("brand")).alias("brand"),
        price.alias("unit_price"),
        cost.alias("unit_cost"),
        (price - cost).try_cast(MONEY).alias("profit_margin"),
        F.when(price > 0, percent_of(price - cost, price)).otherwise(zero_percent()).try_cast(PERCENT).alias("margin_percent"),
        kg.alias("weight_kg"),
        F.round(kg * F.lit(Decimal(POUNDS_PER_KG)), 4).cast("decimal(12,4)").alias("weight_lbs"),
        "supplier_id",
        trim_upper(F.col("is_active")).isin(*TRUE_WORDS).alias("is_active"),
        F.col("_created").alias("created_date"),
        try_date(F.col("updated_date")).alias("updated_date"),
        F.datediff(as_date(as_of), F.col("_created")).cast("long").alias("days_since_created"),
        score.alias("dq_score"),
        *_audit(raw),
    )


def _text(path: str) -> Column:
    return F.try_variant_get("raw_data", path, "string")


def _money(path: str) -> Column:
    return F.try_variant_get("raw_data", path, MONEY)


def order_discount_percent(subtotal: Column, discount: Column) -> Column:
    """Discount share; 0 unless the subtotal is positive."""
    return F.when(subtotal > 0, percent_of(discount, subtotal)).otherwise(zero_percent()).try_cast(PERCENT)


# The order document's header, typed in one read; a field that does not convert is NULL on its own.
ORDER_HEADER = f"""struct<
  order_id: string, customer_id: string, order_date: string, order_timestamp: string, order_status: string,
  priority: string, ship_date: string, ship_mode: string,
  shipping: struct<address: string, city: string, state: string, zip: string, country: string>,
  totals: struct<subtotal: {MONEY}, discount: {MONEY}, tax: {MONEY}, shipping: {MONEY}, total: {MONEY}>
>"""


def silver_orders(raw: DataFrame, exact: bool = False) -> DataFrame:
    """Order headers from documents.

    The discount percentage divides amounts first rounded to whole units, as the reference does;
    ``exact`` divides the amounts as they are. A bad number gives NULL instead of failing the batch.
    """
    whole = MONEY if exact else QUANTITY
    header = F.col("_h")
    # The extracted id is the document's; who needs the ids alone then reads no document.
    known = ["order_id"] if "order_id" in raw.columns else []
    parsed = raw.select(
        *(c for c in raw.columns if c in AUDIT_COLUMNS), *known,
        F.try_variant_get("raw_data", "$", ORDER_HEADER).alias("_h"),
        F.try_variant_get("raw_data", "$.totals.subtotal", whole).alias("_subtotal"),
        F.try_variant_get("raw_data", "$.totals.discount", whole).alias("_discount"),
        counted_items(F.col("raw_data")).alias("_items"),
    ).withColumn("_date", try_date(header["order_date"]))
    date = F.col("_date")
    shipping, totals = header["shipping"], header["totals"]
    return parsed.select(
        (F.col("order_id") if known else header["order_id"]).alias("order_id"),
        header["customer_id"].alias("customer_id"),
        date.alias("order_date"),
        try_wall_clock(header["order_timestamp"]).alias("order_timestamp"),
        F.upper(header["order_status"]).alias("order_status"),
        F.upper(header["priority"]).alias("order_priority"),
        try_date(header["ship_date"]).alias("ship_date"),
        header["ship_mode"].alias("ship_mode"),
        shipping["address"].alias("shipping_address"),
        shipping["city"].alias("shipping_city"),
        shipping["state"].alias("shipping_state"),
        shipping["zip"].alias("shipping_zip"),
        shipping["country"].alias("shipping_country"),
        totals["subtotal"].alias("subtotal"),
        totals["discount"].alias("discount_amount"),
        order_discount_percent(F.col("_subtotal"), F.col("_discount")).alias("discount_percent"),
        totals["tax"].alias("tax_amount"),
        totals["shipping"].alias("shipping_cost"),
        totals["total"].alias("total_amount"),
        *(c.alias(name) for name, c in item_aggregates("_items").items()),
        F.year(date).alias("order_year"),
        F.month(date).alias("order_month"),
        F.quarter(date).alias("order_quarter"),
        F.weekofyear(date).alias("order_week"),
        day_of_week(date).alias("order_day_of_week"),
        is_weekend(date).alias("is_weekend"),
        F.lit(Decimal(ORDER_DQ_SCORE)).cast("decimal(3,2)").alias("dq_score"),
        *_audit(raw),
    )


def bad_order_values(raw: DataFrame) -> DataFrame:
    """Documents whose amounts are present but are not numbers: what a strict cast would stop at."""
    paths = ["$.totals.subtotal", "$.totals.discount", "$.totals.tax", "$.totals.shipping", "$.totals.total"]
    bad = F.lit(False)
    for path in paths:
        bad = bad | (_money(path).isNull() & _text(path).isNotNull())
    return raw.where(bad)


def line_amounts(quantity: Column, price: Column, discount: Column) -> dict[str, Column]:
    """Gross, discount and net of an order line from exact decimals, rounded half up to 4 places.

    The percentage is applied as an exact factor, so no division scale gets into the result.
    """
    gross = quantity.try_cast("decimal(14,0)") * price
    share = (discount * F.lit(Decimal("0.01"))).cast("decimal(10,6)")
    return {
        "line_total": gross.try_cast(MONEY),
        "line_discount": F.round(gross.try_cast(MONEY) * share, 4).try_cast(MONEY),
        "line_net_amount": F.round(gross.try_cast(MONEY) * (F.lit(Decimal("1.000000")) - share), 4).try_cast(MONEY),
    }


def silver_order_items(raw: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per order item; only (order, line) pairs not in ``existing``. Items are never updated.

    When the raw frame has lineage, a document sent twice in the batch counts once (the latest); the order ids are then
    counted at once, so the frame must not be a stream.
    """
    element = f"struct<product_id:string,quantity:{QUANTITY},unit_price:{MONEY},discount_percent:{PERCENT}>"
    items = flatten_items(raw, element=element)
    keys = ["order_id", "line_number"]
    lines = items.select(
        _order_id(items).alias("order_id"),
        F.col("value.product_id").alias("product_id"),
        (F.col("index") + 1).cast("long").alias("line_number"),
        F.col("value.quantity").alias("quantity"),
        F.col("value.unit_price").alias("unit_price"),
        F.coalesce(F.col("value.discount_percent"), F.lit(0).cast(PERCENT)).alias("discount_percent"),
        *_audit(items, ("record_id",)),
    )
    amounts = line_amounts(F.col("quantity"), F.col("unit_price"), F.col("discount_percent"))
    lines = lines.withColumns(amounts)
    if "source_record_id" in lines.columns:
        # Lines repeat only if their order does, which its extracted id tells without reading the document.
        lines = settle_repeated(lines, ["order_id"], repeated_hashes(raw, ["order_id"]),
                                lambda again: latest_by_key(again, keys, ["source_record_id"]))
    return anti_new(lines, existing, keys) if existing is not None else lines


def _order_id(items: DataFrame) -> Column:
    if "order_id" not in items.columns:
        raise ValueError("the raw frame needs the extracted order_id column")
    return F.col("order_id")


def typed_events(raw: DataFrame) -> DataFrame:
    """Events as sent, typed. Business hours are Monday to Friday, 09:00 to 16:59."""
    typed = raw.select(
        "*",
        try_wall_clock(_text("$.event_timestamp")).alias("_ts"),
    )
    ts = F.col("_ts")
    date = ts.cast("date")
    weekday = ~is_weekend(date)
    return typed.select(
        _text("$.event_id").alias("event_id"),
        _text("$.event_type").alias("event_type"),
        _text("$.category").alias("event_category"),
        _text("$.action").alias("event_action"),
        ts.alias("event_timestamp"),
        date.alias("event_date"),
        _text("$.user_id").alias("user_id"),
        _text("$.session_id").alias("session_id"),
        _text("$.device_type").alias("device_type"),
        _text("$.browser").alias("browser"),
        _text("$.os").alias("os"),
        _text("$.page_url").alias("page_url"),
        _text("$.page_title").alias("page_title"),
        _text("$.referrer_url").alias("referrer_url"),
        _text("$.product_id").alias("product_id"),
        _money("$.event_value").alias("event_value"),
        F.try_variant_get("raw_data", "$.properties", "variant").alias("properties"),
        F.hour(ts).alias("event_hour"),
        day_of_week(date).alias("event_day_of_week"),
        (weekday & (F.hour(ts) >= 9) & (F.hour(ts) < 17)).alias("is_business_hours"),
        *_audit(raw, ("record_id", "load_timestamp")),
    )


def silver_events(raw: DataFrame) -> DataFrame:
    """Typed events. When the raw frame has lineage, an event sent twice in the batch counts once (the latest).
    Events without an id stay rows of their own; the stored merge sets them aside.
    """
    events = typed_events(raw)
    if "source_record_id" in events.columns:
        unknown = F.when(F.col("event_id").isNull(), F.col("source_record_id"))
        events = latest_by_key(events.withColumn("_own", unknown), ["event_id", "_own"], ["source_record_id"]).drop("_own")
    return events
