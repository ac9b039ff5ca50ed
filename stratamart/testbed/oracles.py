"""The same results as plain SQL over the benchmark tables, written independently of the operators.

Shared parts are named common table expressions; ``build`` adds the ones a statement uses.
"""

from __future__ import annotations

import re

# Fixed values, written down again here so that a slip in the code under test shows.
STATES = "CA,OR,WA,NV,AZ,TX,OK,NM,AR,LA,NY,NJ,PA,MA,CT,IL,FL,GA,CO,OH,MI,MN,WI,IA,UT"
COUNTRIES = "United States, canada,United Kingdom,australia ,Germany"
SHIP_MODES = "Express,Standard,Overnight"
COUNTRY_CODES = {
    "UNITED STATES": "US",
    "USA": "US",
    "CANADA": "CA",
    "UNITED KINGDOM": "UK",
    "AUSTRALIA": "AU",
}

AS_OF = "DATE '2002-01-01'"
MONEY = "DECIMAL(18,4)"


def exact(x: str) -> str:
    """A decimal of at most four places as a whole number of ten-thousandths."""
    return f"(({x})::DECIMAL(28,4) * 10000)::HUGEINT"


def quo(a: str, b: str, digits: int = 2, factor: int = 1) -> str:
    """factor * a / b, half of the last place rounded away from zero, in whole numbers."""
    x, y = exact(a), exact(b)
    return (f"(sign({x})::DOUBLE * sign({y})::DOUBLE * ((abs({x}) * {2 * factor * 10**digits} + abs({y})) "
            f"// nullif(2 * abs({y}), 0))::DOUBLE / {10**digits}.0::DOUBLE + 0.0::DOUBLE)")


def ratio(a: str, b: str) -> str:
    return f"(({a})::DOUBLE / nullif(({b})::DOUBLE, 0))"


def pct(a: str, b: str) -> str:
    return quo(a, b, 2, 100)


def growth(cur: str, prev: str) -> str:
    return f"CASE WHEN {prev} > 0 THEN {pct(f'({cur}) - ({prev})', prev)} ELSE 0.0::DOUBLE END"


def avg(x: str) -> str:
    return ratio(f"sum({x})", f"count({x})")


def dbl(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c.split('.')[-1]}" for c in columns)


def big(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS BIGINT) AS {c.split('.')[-1]}" for c in columns)


_country_case = " ".join(f"WHEN '{name}' THEN '{code}'" for name, code in COUNTRY_CODES.items())

REGION = """CASE WHEN {s} IN ('CA','OR','WA','NV','AZ') THEN 'West'
     WHEN {s} IN ('TX','OK','NM','AR','LA') THEN 'South'
     WHEN {s} IN ('NY','NJ','PA','MA','CT') THEN 'Northeast' ELSE 'Midwest' END"""

CTES: dict[str, str] = {
    "places": f"""
SELECT n_nationkey, r_name, split_part('{STATES}', ',', n_nationkey + 1) AS state,
       split_part('{COUNTRIES}', ',', n_regionkey + 1) AS country
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "people": """
SELECT 'CUST-' || c_custkey AS customer_id, c_custkey AS k, c_custkey * 2 AS sk, c_name AS name, c_nationkey AS n,
       c_mktsegment AS market FROM customer
UNION ALL
SELECT 'CUST-S' || s_suppkey, s_suppkey, s_suppkey * 2 + 1, s_name, s_nationkey, 'BUILDING' FROM supplier""",
    "raw_customers": """
SELECT customer_id, k, sk, r_name,
       '  ' || left(name, 8) AS first_name,
       CASE WHEN k % 17 <> 0 THEN substr(name, 10) || ' ' END AS last_name,
       CASE WHEN k % 13 = 0 THEN NULL WHEN k % 10 = 0 THEN 'bad-email'
            ELSE ' User' || k || '@Mail' || n || '.Example.COM ' END AS email,
       CASE WHEN k % 19 = 0 THEN NULL WHEN k % 11 = 0 THEN '555-01'
            ELSE '+1-' || (n + 200) || '-555-' || lpad((k % 10000)::VARCHAR, 4, '0') END AS phone,
       k || ' Main Street ' AS address,
       ' City ' || (k % 40) AS city,
       CASE WHEN k % 23 <> 0 THEN lower(state) END AS state,
       lpad((k % 100000)::VARCHAR, 5, '0') AS zip_code,
       country,
       CASE WHEN k % 29 <> 0 THEN DATE '2001-12-31' - (k % 1000)::INTEGER END AS registered,
       CASE WHEN k % 29 = 0 THEN 'unknown'
            WHEN k % 3 = 0 THEN strftime(DATE '2001-12-31' - (k % 1000)::INTEGER, '%Y-%m-%d')
            WHEN k % 3 = 1 THEN strftime(DATE '2001-12-31' - (k % 1000)::INTEGER, '%m/%d/%Y')
            ELSE strftime(DATE '2001-12-31' - (k % 1000)::INTEGER, '%d-%b-%Y') END AS registration_date,
       CASE market WHEN 'MACHINERY' THEN 'Premium' WHEN 'BUILDING' THEN ' vip' WHEN 'AUTOMOBILE' THEN 'Regular '
            WHEN 'FURNITURE' THEN 'Basic' END AS customer_segment
FROM people JOIN places ON n = n_nationkey""",
    "trimmed_customers": """
SELECT customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name, trim(email) AS email, phone,
       trim(address) AS address, trim(city) AS city, state, zip_code, trim(country) AS country, registration_date,
       trim(customer_segment) AS customer_segment
FROM raw_customers""",
    # The cleansing of any customer rows with the raw columns.
    "silver_customers": "{clean_customers:raw_customers}",
    "dim_customer": f"""
SELECT sk AS customer_sk, customer_id, customer_id AS customer_bk, full_name, email, email_domain,
       phone_formatted AS phone, city, state, state_code, country, country_code,
       {REGION.format(s='state')} AS region, customer_segment, customer_tier, registration_date,
       days_since_registration AS customer_tenure_days,
       CASE WHEN days_since_registration <= 30 THEN 'New (0-30 days)'
            WHEN days_since_registration <= 90 THEN 'Recent (31-90 days)'
            WHEN days_since_registration <= 365 THEN 'Established (91-365 days)'
            ELSE 'Loyal (365+ days)' END AS tenure_band,
       TRUE AS is_active, is_email_valid, TRUE AS is_current, r_name
FROM silver_customers""",
    "raw_products": f"""
SELECT 'PROD-' || p_partkey AS product_id, p_partkey AS k,
       ' ' || p_name || '-' || p_size || '" (new) ' AS product_name,
       lower(p_type) AS category, split_part(p_name, ' ', 2) AS subcategory, ' ' || p_brand AS brand,
       CASE WHEN p_partkey % 97 <> 0 THEN price END AS price,
       CASE WHEN p_partkey % 101 <> 0 THEN (price * 0.6)::{MONEY} END AS cost,
       (p_size || '.25')::DECIMAL(12,4) AS kg,
       'SUP-' || (p_partkey % 10) AS supplier_id,
       CASE p_partkey % 5 WHEN 0 THEN 'TRUE' WHEN 1 THEN ' yes' WHEN 2 THEN '0' WHEN 3 THEN 'Y' END AS active,
       DATE '2001-06-30' - (p_partkey % 700)::INTEGER AS created,
       CASE WHEN p_partkey % 31 <> 0 THEN DATE '2001-06-30' - (p_partkey % 700)::INTEGER + 90 END AS updated
FROM (SELECT *, (p_retailprice::DECIMAL(18,2) * p_size * 0.02)::{MONEY} AS price FROM part)""",
    "silver_products": "{clean_products:raw_products}",
    "dim_product": """
SELECT k AS product_sk, product_id, product_id AS product_bk, product_name, category, subcategory, category_path,
       brand, unit_price, unit_cost, profit_margin, margin_percent,
       CASE WHEN unit_price < 25 THEN 'Budget' WHEN unit_price < 100 THEN 'Mid-Range'
            WHEN unit_price < 500 THEN 'Premium' ELSE 'Luxury' END AS price_band,
       weight_kg, supplier_id, is_active, TRUE AS is_current
FROM silver_products""",
    "documents_totals": f"""
SELECT l_orderkey, l_suppkey, count(*) AS total_items, sum(l_quantity::DECIMAL(18,0)) AS total_quantity,
       count(DISTINCT l_partkey) AS unique_products, min(l_shipdate)::DATE AS ship_date,
       sum(l_extendedprice::DECIMAL(18,2))::{MONEY} AS subtotal,
       sum((l_extendedprice::DECIMAL(18,2) * l_discount::DECIMAL(4,2))::{MONEY})::{MONEY} AS discount,
       sum((l_extendedprice::DECIMAL(18,2) * l_tax::DECIMAL(4,2))::{MONEY})::{MONEY} AS tax
FROM lineitem GROUP BY l_orderkey, l_suppkey""",
    "headers": f"""
SELECT 'ORD-' || o_orderkey || coalesce('-' || l_suppkey, '') AS order_id,
       o_orderkey, 'CUST-' || o_custkey AS customer_id, o_custkey, o_orderdate::DATE AS order_date,
       upper(o_orderstatus) AS order_status, upper(o_orderpriority) AS order_priority, ship_date,
       split_part('{SHIP_MODES}', ',', (o_orderkey % 3 + 1)::INTEGER) AS ship_mode, state, trim(country) AS country,
       coalesce(subtotal, 0)::{MONEY} AS subtotal, coalesce(discount, 0)::{MONEY} AS discount_amount,
       coalesce(tax, 0)::{MONEY} AS tax_amount,
       (CASE WHEN o_orderkey % 3 = 0 THEN 15.0 ELSE 4.99 END)::{MONEY} AS shipping_cost,
       coalesce(total_items, CASE WHEN o_orderkey % 2 = 0 THEN 0 END) AS total_items, total_quantity,
       coalesce(unique_products, 0) AS unique_products
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN places ON c_nationkey = n_nationkey
LEFT JOIN documents_totals ON o_orderkey = l_orderkey""",
    "silver_orders": f"""
SELECT *, (subtotal - discount_amount + tax_amount + shipping_cost)::{MONEY} AS total_amount,
       CASE WHEN round(subtotal, 0) > 0 THEN {pct('round(discount_amount, 0)', 'round(subtotal, 0)')}
            ELSE 0.0::DOUBLE END AS discount_percent,
       o_custkey || ' Main Street' AS shipping_address, 'City ' || (o_custkey % 40) AS shipping_city,
       state AS shipping_state, lpad((o_custkey % 100000)::VARCHAR, 5, '0') AS shipping_zip,
       country AS shipping_country
FROM headers""",
    "silver_items": f"""
SELECT 'ORD-' || l_orderkey || '-' || l_suppkey AS order_id, l_orderkey,
       'PROD-' || l_partkey AS product_id, l_partkey,
       row_number() OVER (PARTITION BY l_orderkey, l_suppkey
                          ORDER BY l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount) AS line_number,
       l_quantity::DECIMAL(14,0) AS quantity, (l_extendedprice::DECIMAL(18,2) * 0.01)::{MONEY} AS unit_price,
       (l_discount::DECIMAL(8,2) * 100)::DECIMAL(8,4) AS discount_percent
FROM lineitem""",
    "item_amounts": f"""
SELECT *, (quantity * unit_price)::{MONEY} AS line_total,
       round((quantity * unit_price)::{MONEY} * (discount_percent * 0.01)::DECIMAL(10,6), 4)::{MONEY} AS line_discount,
       round((quantity * unit_price)::{MONEY} * (1.000000 - (discount_percent * 0.01)::DECIMAL(10,6)), 4)::{MONEY}
         AS line_net_amount
FROM silver_items""",
    "fact_sales": f"""
SELECT order_id, strftime(order_date, '%Y%m%d')::BIGINT AS date_sk, o_custkey * 2 AS customer_sk, order_date,
       customer_id, order_status, order_priority, ship_mode, total_items, total_quantity, unique_products, subtotal,
       discount_amount, discount_percent, tax_amount, shipping_cost, total_amount,
       (subtotal * 0.30)::{MONEY} AS profit_amount, date_diff('day', order_date, ship_date) AS days_to_ship
FROM silver_orders""",
    "fact_items": f"""
SELECT strftime(o_orderdate, '%Y%m%d')::BIGINT AS date_sk, o_custkey * 2 AS customer_sk, p.product_sk, i.order_id,
       i.line_number, o_orderdate::DATE AS order_date, 'CUST-' || o_custkey AS customer_id, i.product_id, i.quantity,
       i.unit_price, p.unit_cost, i.discount_percent, i.line_total, i.line_discount, i.line_net_amount,
       (i.quantity * p.unit_cost)::{MONEY} AS line_cost,
       (i.line_net_amount - (i.quantity * p.unit_cost)::{MONEY})::{MONEY} AS line_profit, p.category
FROM item_amounts i LEFT JOIN orders ON i.l_orderkey = o_orderkey
LEFT JOIN dim_product p ON i.l_partkey = p.product_sk""",
    "daily": "{daily_of:silver_orders}",
    "calendar": "{calendar_of:spine}",
    "spine": """
SELECT unnest(generate_series(date_trunc('year', min(o_orderdate))::DATE,
       (date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY)::DATE, INTERVAL 1 DAY))::DATE AS full_date
FROM orders""",
    "events_text": """
SELECT 'EVT-' || event_id AS event_id, event_type, ts, user_id, value::DECIMAL(18,2) AS event_value,
       json_extract(props, '$.k')::BIGINT AS k FROM events""",
    "run_log": """
SELECT 'JOB_' || (user_id % 20) AS task_name, 'RETAIL' AS database_name, upper(event_type) AS schema_name,
       CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS state, ts AS scheduled_time,
       ts AS query_start_time, ts + to_microseconds((value::DECIMAL(18,2) * 1000000)::BIGINT) AS completed_time,
       CASE WHEN event_type = 'error' THEN '100' END AS error_code,
       CASE WHEN event_type = 'error' THEN 'failed run' END AS error_message,
       CASE WHEN event_type <> 'error' THEN 'ok' END AS return_value
FROM events""",
    # Second deliveries.
    "resent_customers": """
SELECT * REPLACE (' Renamed' AS first_name, 'vip' AS customer_segment) FROM raw_customers
WHERE r_name IN ('EUROPE', 'ASIA')""",
    "merged_raw_customers": """
SELECT *, 1 AS batch FROM raw_customers WHERE r_name NOT IN ('ASIA', 'EUROPE')
UNION ALL SELECT *, 2 FROM resent_customers""",
    "merged_customers": "{clean_customers:merged_raw_customers}",
    "merged_raw_products": """
SELECT * REPLACE (CASE WHEN category IN ('promo', 'large') THEN 120.0::DECIMAL(18,4) ELSE price END AS price,
                  CASE WHEN category = 'large' THEN DATE '2001-12-01' ELSE created END AS created),
       CASE WHEN category IN ('promo', 'large') THEN DATE '2001-12-01' ELSE created END AS latest_created,
       CASE WHEN category = 'large' THEN 3 ELSE 1 END AS batch
FROM raw_products""",
    "merged_products": "{clean_products:merged_raw_products}",
}


def _clean_customers(source: str) -> str:
    return f"""
SELECT customer_id, k, sk, r_name, trim(first_name) AS first_name, trim(last_name) AS last_name,
       trim(first_name) || ' ' || trim(last_name) AS full_name, lower(trim(email)) AS email,
       split_part(lower(trim(email)), '@', 2) AS email_domain, trim(phone) AS phone,
       regexp_replace(phone, '[^0-9]', '', 'g') AS phone_formatted, trim(address) AS address,
       upper(trim(city)) AS city, upper(trim(state)) AS state, left(upper(trim(state)), 2) AS state_code,
       trim(zip_code) AS zip_code, upper(trim(country)) AS country,
       CASE upper(trim(country)) {_country_case} ELSE left(upper(trim(country)), 2) END AS country_code,
       registered AS registration_date, upper(trim(customer_segment)) AS customer_segment,
       CASE WHEN upper(trim(customer_segment)) IN ('PREMIUM', 'VIP') THEN 'TIER_1'
            WHEN upper(trim(customer_segment)) = 'REGULAR' THEN 'TIER_2' ELSE 'TIER_3' END AS customer_tier,
       date_diff('day', registered, {AS_OF}) AS days_since_registration,
       coalesce(email LIKE '%@%.%', FALSE) AS is_email_valid,
       coalesce(length(regexp_replace(phone, '[^0-9]', '', 'g')) >= 10, FALSE) AS is_phone_valid,
       (CASE WHEN customer_id IS NOT NULL THEN 0.20 ELSE 0 END + CASE WHEN first_name IS NOT NULL THEN 0.15 ELSE 0 END
        + CASE WHEN last_name IS NOT NULL THEN 0.15 ELSE 0 END + CASE WHEN email LIKE '%@%.%' THEN 0.20 ELSE 0 END
        + CASE WHEN phone IS NOT NULL THEN 0.15 ELSE 0 END + CASE WHEN city IS NOT NULL THEN 0.15 ELSE 0 END)
         ::DECIMAL(3,2) AS dq_score
FROM {source}"""


CUSTOMER_OUT = f"""customer_id, first_name, last_name, full_name, email, email_domain, phone, phone_formatted, address, city,
state, state_code, zip_code, country, country_code, registration_date, customer_segment, customer_tier,
{big('days_since_registration')}, is_email_valid, is_phone_valid, {dbl('dq_score')}"""


def _clean_products(source: str) -> str:
    return f"""
SELECT *, trim(product_name) AS name, regexp_replace(upper(trim(product_name)), '[^A-Z0-9 ]', '', 'g') AS name_clean,
       price AS unit_price, cost AS unit_cost, (price - cost)::{MONEY} AS profit_margin,
       CASE WHEN price > 0 THEN {pct('price - cost', 'price')} ELSE 0.0::DOUBLE END AS margin_percent,
       kg AS weight_kg, round(kg * 2.20462, 4)::DECIMAL(12,4) AS weight_lbs,
       upper(trim(active)) IN ('TRUE', 'YES', '1', 'Y') AS is_active, created AS created_date,
       updated AS updated_date,
       (0.20 + 0.20 + 0.15 + CASE WHEN price > 0 THEN 0.20 ELSE 0 END + CASE WHEN cost > 0 THEN 0.15 ELSE 0 END + 0.10)
         ::DECIMAL(3,2) AS dq_score,
       upper(category) || ' > ' || upper(subcategory) AS category_path
FROM (SELECT * FROM {source})"""


def _products(source: str) -> str:
    return f"""SELECT * REPLACE (name AS product_name, upper(category) AS category, upper(subcategory) AS subcategory,
       upper(trim(brand)) AS brand) FROM ({_clean_products(source)})"""


PRODUCT_OUT = f"""product_id, product_name, name_clean AS product_name_clean, category, subcategory, category_path, brand,
{dbl('unit_price', 'unit_cost', 'profit_margin', 'margin_percent', 'weight_kg', 'weight_lbs')}, supplier_id, is_active,
created_date, updated_date, {dbl('dq_score')}"""


def _daily_of(source: str) -> str:
    return f"""
SELECT strftime(order_date, '%Y%m%d')::BIGINT AS date_sk, order_date AS snapshot_date,
       count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS total_customers,
       0::BIGINT AS new_customers, sum(total_items) AS total_items_sold, sum(total_quantity) AS total_quantity,
       sum(subtotal) AS gross_revenue, sum(discount_amount) AS total_discounts, sum(total_amount) AS net_revenue,
       sum(tax_amount) AS total_tax, sum(shipping_cost) AS total_shipping,
       {quo('sum(total_amount)', 'count(total_amount)', 4)} AS avg_order_value, {quo('sum(total_items)', 'count(total_items)', 2)} AS avg_items_per_order,
       {quo('sum(discount_percent::DECIMAL(8,4))', 'count(discount_percent::DECIMAL(8,4))', 4)} AS avg_discount_percent,
       sum(unique_products) AS unique_products_sold
FROM {source} GROUP BY order_date"""


DAILY_OUT = f"""{big('date_sk')}, snapshot_date, {big('total_orders', 'total_customers', 'new_customers', 'total_items_sold')},
{dbl('total_quantity', 'gross_revenue', 'total_discounts', 'net_revenue', 'total_tax', 'total_shipping')},
avg_order_value, avg_items_per_order, avg_discount_percent, {big('unique_products_sold')}"""


def _calendar_of(source: str) -> str:
    return f"""
SELECT strftime(full_date, '%Y%m%d')::BIGINT AS date_sk, full_date, year(full_date) AS year,
       quarter(full_date) AS quarter, month(full_date) AS month, left(monthname(full_date), 3) AS month_name,
       left(monthname(full_date), 3) AS month_abbr, weekofyear(full_date) AS week_of_year,
       dayofyear(full_date) AS day_of_year, day(full_date) AS day_of_month, dayofweek(full_date) AS day_of_week,
       left(dayname(full_date), 3) AS day_name, left(dayname(full_date), 3) AS day_abbr,
       year(full_date) AS fiscal_year, quarter(full_date) AS fiscal_quarter, month(full_date) AS fiscal_month,
       dayofweek(full_date) IN (0, 6) AS is_weekend, FALSE AS is_holiday,
       dayofweek(full_date) NOT IN (0, 6) AS is_business_day, strftime(full_date, '%Y-%m') AS year_month,
       year(full_date) || '-Q' || quarter(full_date) AS year_quarter,
       year(full_date) || '-W' || lpad(weekofyear(full_date)::VARCHAR, 2, '0') AS year_week,
       (full_date - INTERVAL 1 YEAR)::DATE AS same_day_last_year,
       (full_date - INTERVAL 1 MONTH)::DATE AS same_day_last_month
FROM {source}"""


CALENDAR_OUT = f"""date_sk, full_date, {big('year', 'quarter', 'month')}, month_name, month_abbr,
{big('week_of_year', 'day_of_year', 'day_of_month', 'day_of_week')}, day_name, day_abbr,
{big('fiscal_year', 'fiscal_quarter', 'fiscal_month')}, is_weekend, is_holiday, is_business_day, year_month, year_quarter,
year_week, same_day_last_year, same_day_last_month"""

_TEMPLATES = {"clean_customers": _clean_customers, "clean_products": _products, "daily_of": _daily_of,
              "calendar_of": _calendar_of}


def _body(name: str) -> str:
    text = CTES[name].strip()
    template = re.fullmatch(r"\{(\w+):(\w+)\}", text)
    return _TEMPLATES[template[1]](template[2]) if template else text


def build(final: str, local: dict[str, str] | None = None) -> str:
    """``final`` with the shared and local table expressions it needs, in order."""
    local = local or {}
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in [*CTES, *local]:
            if name not in ordered and re.search(rf"\b(FROM|JOIN)\s+\(?\s*{name}\b", sql):
                body = local.get(name) or _body(name)
                visit(body)
                if name not in ordered:
                    ordered.append(name)

    visit(final)
    bodies = ",\n".join(f"{n} AS ({(local.get(n) or _body(n)).strip()})" for n in ordered)
    return f"WITH {bodies}\n{final.strip()}" if ordered else final.strip()


FACT_SALES_OUT = f"""order_id, date_sk, order_date, customer_id, order_status, order_priority, ship_mode,
{big('total_items')}, {dbl('total_quantity')}, {big('unique_products')},
{dbl('subtotal', 'discount_amount', 'discount_percent', 'tax_amount', 'shipping_cost', 'total_amount', 'profit_amount')},
{big('days_to_ship')}"""

PER_CUSTOMER = """
SELECT c.*, f.order_id, f.total_amount, f.total_quantity, f.shipping_cost, f.order_date
FROM dim_customer c LEFT JOIN fact_sales f ON c.customer_sk = f.customer_sk"""

ITEMS_BY_PRODUCT = """
SELECT p.*, fi.order_id, fi.quantity, fi.line_net_amount, fi.line_profit, fi.discount_percent AS given,
       fi.unit_price AS sold_at
FROM dim_product p LEFT JOIN fact_items fi ON p.product_sk = fi.product_sk"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    # Scans and loads.
    q["scan_json_array"] = """
SELECT 'ORD-' || o_orderkey AS order_id, o_orderstatus AS order_status,
       strftime(o_orderdate, '%Y-%m-%d') AS order_date,
       row_number() OVER (PARTITION BY o_orderkey // 5000 ORDER BY o_orderkey) AS file_row_number
FROM orders"""
    q["scan_json_object"] = build(f"SELECT event_id, k, {dbl('event_value')} FROM events_text")
    customers_text = build("SELECT * FROM trimmed_customers")
    q["scan_csv"] = customers_text
    q["load_raw_customers"] = customers_text
    q["scan_csv_noheader"] = build("""
SELECT product_id, trim(product_name) AS product_name, category, coalesce(price::VARCHAR, 'n/a') AS unit_price,
       cost::VARCHAR AS unit_cost, trim(active) AS is_active FROM raw_products""")
    q["load_raw_products"] = build("""
SELECT product_id, trim(product_name) AS product_name, category, subcategory, trim(brand) AS brand,
       coalesce(price::VARCHAR, 'n/a') AS unit_price, cost::VARCHAR AS unit_cost,
       kg::DECIMAL(12,2)::VARCHAR AS weight_kg, supplier_id, trim(active) AS is_active,
       strftime(created, '%Y-%m-%d') AS created_date,
       CASE WHEN k % 31 = 0 THEN '2001-02-30' ELSE strftime(updated, '%Y-%m-%d') END AS updated_date
FROM raw_products""")
    q["scan_pipe"] = """
SELECT s_suppkey::VARCHAR AS supplier_id, s_name AS supplier_name, s_nationkey::VARCHAR AS nation,
       NULL::VARCHAR AS comment FROM supplier"""
    q["scan_file_metadata"] = """
SELECT c_custkey::VARCHAR AS customer_key, c_custkey // 100 AS lot, TRUE AS named_csv,
       row_number() OVER (PARTITION BY c_custkey // 100 ORDER BY c_custkey) AS file_row_number
FROM customer"""
    q["scan_file_pattern"] = build("SELECT event_id, event_type FROM events_text")
    q["scan_rejects"] = """
SELECT c_custkey::VARCHAR AS id, CASE WHEN c_acctbal BETWEEN 0 AND 9000 THEN c_mktsegment END AS segment,
       CASE WHEN c_acctbal BETWEEN 0 AND 9000 THEN 'loaded' ELSE 'rejected' END AS outcome
FROM customer"""
    q["load_raw_orders"] = build("""
SELECT order_id, order_date, total_amount::DOUBLE AS total, total_items::BIGINT AS items FROM silver_orders""")
    q["load_raw_events"] = build("SELECT event_id, event_type, ts AS event_timestamp FROM events_text")
    q["load_once"] = build("""
SELECT customer_id, 1::BIGINT AS copies, 1::BIGINT AS record_ids, 0::BIGINT AS loaded_by_rerun FROM people""")
    q["load_batch_log"] = build("""
SELECT 1::BIGINT AS batch_id, 'RAW_CUSTOMERS' AS table_name, count(*) AS records_loaded, 0::BIGINT AS records_rejected,
       'SUCCESS' AS load_status, FALSE AS has_error, TRUE AS times_ordered FROM people
UNION ALL
SELECT 2, 'RAW_CONTACTS', count(*) FILTER (c_acctbal BETWEEN 0 AND 9000),
       count(*) FILTER (c_acctbal NOT BETWEEN 0 AND 9000), 'SUCCESS', FALSE, TRUE FROM customer
UNION ALL SELECT 3, 'RAW_PRODUCTS', 0, 0, 'FAILED', TRUE, TRUE""")
    q["raw_extracted_keys"] = build("""
SELECT order_id AS record_key, 'order' AS record_type, order_date AS record_date, NULL::TIMESTAMP AS record_time
FROM silver_orders
UNION ALL SELECT event_id, event_type, ts::DATE, ts FROM events_text""")

    # Silver.
    q["silver_customers"] = build(f"SELECT {CUSTOMER_OUT} FROM silver_customers")
    q["silver_products"] = build(f"""SELECT {PRODUCT_OUT},
       date_diff('day', created_date, {AS_OF}) AS days_since_created FROM silver_products""")
    q["silver_orders"] = build(f"""
SELECT order_id, customer_id, order_date, order_date + INTERVAL 630 MINUTE AS order_timestamp, order_status,
       order_priority, ship_date, ship_mode, shipping_address, shipping_city, shipping_state, shipping_zip,
       shipping_country, {dbl('subtotal', 'discount_amount', 'discount_percent', 'tax_amount', 'shipping_cost',
                              'total_amount')}, {big('total_items')}, {dbl('total_quantity')},
       {big('unique_products')}, year(order_date) AS order_year, month(order_date) AS order_month,
       quarter(order_date) AS order_quarter, weekofyear(order_date) AS order_week,
       dayofweek(order_date) AS order_day_of_week, dayofweek(order_date) IN (0, 6) AS is_weekend,
       0.95::DOUBLE AS dq_score
FROM silver_orders""")
    q["silver_order_items"] = build(f"""
SELECT order_id, product_id, line_number, {dbl('quantity', 'unit_price', 'discount_percent', 'line_total',
                                               'line_discount', 'line_net_amount')} FROM item_amounts""")
    q["silver_events"] = build("""
SELECT event_id, event_type, 'cat-' || event_type AS event_category, upper(event_type) AS event_action,
       ts AS event_timestamp, ts::DATE AS event_date, user_id::VARCHAR AS user_id, 's' || (user_id // 7) AS session_id,
       CASE WHEN user_id % 2 = 0 THEN 'mobile' ELSE 'desktop' END AS device_type, NULL::VARCHAR AS browser,
       NULL::VARCHAR AS os, NULL::VARCHAR AS page_url, NULL::VARCHAR AS page_title, NULL::VARCHAR AS referrer_url,
       NULL::VARCHAR AS product_id, event_value::DOUBLE AS event_value, k AS properties, hour(ts) AS event_hour,
       dayofweek(ts) AS event_day_of_week,
       dayofweek(ts) BETWEEN 1 AND 5 AND hour(ts) BETWEEN 9 AND 16 AS is_business_hours
FROM events_text""")
    q["clustered_events"] = build("""
SELECT 'event_timestamp' AS key, count(*) AS row_count, TRUE AS under_a_fifth FROM events_text
WHERE ts BETWEEN TIMESTAMP '2024-01-17 10:00:00' AND TIMESTAMP '2024-01-17 11:00:00'
UNION ALL SELECT 'user_id', count(*), TRUE FROM events_text WHERE user_id = 7""")
    q["dq_score"] = build("""
SELECT entity, dq_score::DOUBLE AS dq_score, count(*) AS row_count FROM (
  SELECT 'customers' AS entity, dq_score FROM silver_customers
  UNION ALL SELECT 'products', dq_score FROM silver_products
  UNION ALL SELECT 'orders', 0.95 FROM silver_orders) GROUP BY ALL""")
    q["flatten_items"] = build(f"""
SELECT order_id, line_number - 1 AS index, product_id, {dbl('quantity')},
       CASE WHEN discount_percent > 0 THEN discount_percent::DOUBLE END AS discount_percent FROM silver_items""")
    q["item_array_aggregates"] = build(f"""
SELECT order_id, {big('total_items')}, {dbl('total_quantity')}, {big('unique_products')} FROM silver_orders""")
    q["insert_only_new_items"] = build(f"""
SELECT i.order_id, i.line_number, i.product_id, i.quantity::DOUBLE AS quantity
FROM silver_items i JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate >= DATE '2000-01-01'""")

    # Merges.
    q["merge_upsert"] = build("""
SELECT c_custkey,
       CASE WHEN r_name = 'ASIA' THEN 'ignored' ELSE c_name END AS c_name,
       (c_acctbal::DECIMAL(18,2) + CASE WHEN r_name IN ('ASIA', 'EUROPE') THEN 100 ELSE 0 END)::DOUBLE AS balance,
       CASE r_name WHEN 'ASIA' THEN 'inserted' WHEN 'EUROPE' THEN 'updated' ELSE 'kept' END AS merge_action
FROM customer JOIN places ON c_nationkey = n_nationkey""")
    q["merge_customers"] = build(f"""
SELECT {CUSTOMER_OUT}, k * 10 + CASE WHEN r_name = 'ASIA' THEN 2 ELSE 1 END AS source_record_id,
       CASE WHEN r_name = 'ASIA' THEN 'batch-2' ELSE 'batch-1' END AS source_filename, TRUE AS is_current
FROM merged_customers""")
    q["merge_products"] = build(f"""
SELECT {PRODUCT_OUT}, date_diff('day', latest_created, {AS_OF}) AS days_since_created, k * 10 + batch AS source_record_id,
       'batch-' || batch AS source_filename, TRUE AS is_current FROM merged_products""")
    q["merge_orders"] = build(f"""
SELECT order_id, customer_id, order_date,
       CASE WHEN order_date >= DATE '1999-07-01' THEN 'SHIPPED' ELSE order_status END AS order_status,
       CASE WHEN order_date >= DATE '1999-07-01' THEN order_date + 3 ELSE ship_date END AS ship_date,
       CASE WHEN order_date >= DATE '2000-01-01' THEN 'Resent' ELSE ship_mode END AS ship_mode,
       {dbl('subtotal')},
       (total_amount + CASE WHEN order_date >= DATE '1999-07-01' THEN 1.5 ELSE 0 END)::DOUBLE AS total_amount,
       {big('total_items')}
FROM silver_orders""")
    q["merge_dim_customer"] = build(f"""
SELECT customer_sk, customer_id, full_name, region,
       CASE WHEN r_name IN ('ASIA', 'EUROPE') THEN 'TIER_9' ELSE customer_tier END AS customer_tier,
       CASE WHEN r_name = 'ASIA' THEN {AS_OF} ELSE registration_date END AS registration_date, tenure_band, is_current
FROM dim_customer""")
    q["merge_dim_product"] = build(f"""
SELECT product_sk, product_id, CASE WHEN category = 'LARGE' THEN 'changed' ELSE product_id END AS product_bk,
       CASE WHEN category IN ('LARGE', 'PROMO') THEN 'Resent' ELSE price_band END AS price_band, {dbl('unit_price')},
       is_current FROM dim_product""")
    q["merge_fact_sales"] = build(f"""
SELECT order_id, date_sk, customer_sk,
       CASE WHEN order_date >= DATE '1999-07-01' THEN 'SHIPPED' ELSE order_status END AS order_status,
       CASE WHEN order_date >= DATE '2000-01-01' THEN 'Resent' ELSE ship_mode END AS ship_mode,
       (total_amount + CASE WHEN order_date >= DATE '1999-07-01' THEN 1.5 ELSE 0 END)::DOUBLE AS total_amount,
       {dbl('profit_amount')},
       CASE WHEN order_date >= DATE '1999-07-01' THEN 3 ELSE days_to_ship END AS days_to_ship
FROM fact_sales""")
    q["merge_daily_sales"] = build(f"""
SELECT date_sk, snapshot_date, CASE WHEN snapshot_date < DATE '2000-01-01' THEN 7 ELSE 0 END::BIGINT AS new_customers,
       {big('total_orders')}, {dbl('net_revenue')}, avg_order_value
FROM grown""", {"grown": _daily_of("grown_orders"), "grown_orders": f"""
SELECT * REPLACE ((total_amount + CASE WHEN order_date >= DATE '1999-07-01' THEN 10 ELSE 0 END)::{MONEY} AS total_amount)
FROM silver_orders"""})
    q["surrogate_keys"] = build("""
SELECT 1000 + row_number() OVER (ORDER BY customer_id) AS customer_sk, customer_id FROM people""")
    q["scd2_dimension"] = build(f"""
SELECT customer_id, full_name, customer_tier, region, DATE '2001-01-01' AS effective_date,
       CASE WHEN r_name = 'EUROPE' AND customer_tier <> 'TIER_1' THEN DATE '2001-12-31' ELSE DATE '9999-12-31' END
         AS expiration_date,
       NOT (r_name = 'EUROPE' AND customer_tier <> 'TIER_1') AS is_current
FROM dim_customer WHERE r_name <> 'ASIA'
UNION ALL
SELECT customer_id, full_name, 'TIER_1', region, {AS_OF}, DATE '9999-12-31', TRUE FROM dim_customer
WHERE r_name = 'ASIA' OR (r_name = 'EUROPE' AND customer_tier <> 'TIER_1')""")

    # Global order.
    q["global_rank"] = """
SELECT o_orderkey, o_orderpriority, o_orderdate::DATE AS order_date,
       rank() OVER (ORDER BY o_orderdate DESC) AS overall_rank,
       rank() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC) AS priority_rank
FROM orders"""
    q["global_ntile"] = """
SELECT o_orderkey, o_orderdate::DATE AS order_date, ntile(5) OVER (ORDER BY o_orderdate DESC, o_orderkey) AS tile
FROM orders"""
    q["pct_of_total"] = f"""
SELECT l_returnflag, l_linestatus, l_linenumber::BIGINT AS l_linenumber, revenue::DOUBLE AS revenue,
       {pct('revenue', 'sum(revenue) OVER ()')} AS share
FROM (SELECT l_returnflag, l_linestatus, l_linenumber, sum(l_extendedprice::DECIMAL(18,2)) AS revenue FROM lineitem
      GROUP BY ALL)"""

    # Change capture.
    q["cdc_changes"] = build("""
SELECT customer_id, first_name, customer_segment, 'DELETE' AS change_type, r_name = 'EUROPE' AS is_update
FROM raw_customers WHERE r_name IN ('EUROPE', 'AFRICA')
UNION ALL
SELECT customer_id, first_name, customer_segment, 'INSERT', r_name = 'EUROPE' FROM resent_customers""")
    orders = """orders_typed AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice::DECIMAL(18,2) AS amount,
                          o_orderdate::DATE AS order_date FROM orders)"""
    q["cdc_checksum_tree"] = f"""
WITH {orders}, marked AS (SELECT *, o_orderkey > (SELECT max(o_orderkey) - max(o_orderkey) // 100 FROM orders) AS late FROM orders_typed)
SELECT o_orderkey, o_custkey, o_orderstatus, amount::DOUBLE AS amount, 'DELETE' AS change_type, o_orderkey % 5000 <> 17 AS is_update
FROM marked WHERE o_orderkey % 5000 = 17 OR (late AND o_orderstatus <> 'X')
UNION ALL
SELECT o_orderkey, o_custkey, 'X', amount::DOUBLE, 'INSERT', TRUE FROM marked WHERE o_orderkey % 5000 <> 17 AND late AND o_orderstatus <> 'X'
UNION ALL
SELECT -o_orderkey, o_custkey, o_orderstatus, amount::DOUBLE, 'INSERT', FALSE FROM orders_typed WHERE o_orderkey % 5000 = 18"""
    q["incremental_daily_sales"] = f"""
WITH {orders}, now AS (
    SELECT CASE WHEN o_orderkey % 14 = 0 THEN order_date + 1 ELSE order_date END AS order_date,
           CASE WHEN o_orderkey % 7 = 0 THEN o_custkey + 1 ELSE o_custkey END AS customer,
           CASE WHEN o_orderkey % 7 = 0 THEN amount + 1.5 ELSE amount END AS amount
    FROM orders_typed WHERE o_orderkey % 11 <> 0)
SELECT order_date, count(*) AS orders, count(DISTINCT customer) AS customers, sum(amount)::DOUBLE AS revenue,
       sum(amount)::DOUBLE / count(amount) AS avg_order_value
FROM now GROUP BY 1"""
    q["distinct_customers_by_bitmap"] = f"""
WITH {orders} SELECT strftime(order_date, '%Y-%m') AS period, count(DISTINCT o_custkey) AS customers FROM orders_typed GROUP BY 1
UNION ALL SELECT strftime(order_date, '%Y'), count(DISTINCT o_custkey) FROM orders_typed GROUP BY 1"""
    tiers = f"""{orders}, versions AS (
    SELECT o_custkey, o_orderdate::DATE AS valid_from, o_orderpriority AS tier FROM orders WHERE o_orderkey % 3 = 0
    QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate::DATE ORDER BY o_orderkey DESC) = 1)"""
    q["validity_intervals"] = f"""
WITH {tiers}, opening AS (
    SELECT * FROM versions QUALIFY lag(tier) OVER (PARTITION BY o_custkey ORDER BY valid_from) IS DISTINCT FROM tier)
SELECT o_custkey, tier, valid_from,
       coalesce(lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from), DATE '9999-12-31') AS valid_to FROM opening"""
    q["fact_as_of_version"] = f"""
WITH {tiers} SELECT o.o_orderkey, o.o_custkey, o.order_date, v.tier, v.valid_from
FROM (SELECT * FROM orders_typed WHERE o_orderkey % 3 <> 0) o
ASOF LEFT JOIN versions v ON o.o_custkey = v.o_custkey AND o.order_date >= v.valid_from"""
    q["cdc_append_only"] = build(f"""
SELECT event_id, event_type, ts AS event_timestamp, {dbl('event_value')},
       CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 0 ELSE 1 END::BIGINT AS batch FROM events_text""")
    q["events_by_state"] = build(f"""
SELECT event_id, event_type, ts AS event_timestamp, {dbl('event_value')},
       CASE WHEN ts < TIMESTAMP '2024-01-11' AND substr(event_id, 5)::BIGINT % 20 <> 3 THEN TIMESTAMP '2024-01-11'
            WHEN ts < TIMESTAMP '2024-01-21' THEN TIMESTAMP '2024-01-21' ELSE TIMESTAMP '2024-01-31' END AS first_delivered
FROM events_text""")
    q["incremental_silver"] = build(f"""
SELECT customer_id, first_name, customer_segment, customer_tier, {dbl('dq_score')}, 0::BIGINT AS idle_batches
FROM merged_customers""")
    q["stream_status"] = """
SELECT * FROM (VALUES ('STREAM_RAW_EVENTS', (SELECT count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-15') > 0),
  ('STREAM_RAW_CUSTOMERS', FALSE), ('STREAM_RAW_PRODUCTS', (SELECT count(*) FROM part) > 0),
  ('STREAM_RAW_ORDERS', FALSE)) t(stream_name, has_data)"""

    # Gold.
    q["date_spine"] = """
SELECT d::DATE AS full_date, count(o_orderkey) AS order_count
FROM (SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY)) AS d FROM orders)
LEFT JOIN orders ON o_orderdate::DATE = d::DATE GROUP BY 1"""
    q["dim_date"] = build(f"SELECT {CALENDAR_OUT} FROM shipped_calendar", {
        "shipped_calendar": _calendar_of("shipped_spine"),
        "shipped_spine": """SELECT unnest(generate_series(min(l_shipdate)::DATE, max(l_shipdate)::DATE,
                                    INTERVAL 1 DAY))::DATE AS full_date FROM lineitem"""})
    q["dim_customer"] = build(f"""
SELECT * EXCLUDE (r_name) REPLACE (customer_tenure_days::BIGINT AS customer_tenure_days) FROM dim_customer""")
    q["dim_product"] = build(f"""
SELECT product_sk, product_id, product_bk, product_name, category, subcategory, category_path, brand,
       {dbl('unit_price', 'unit_cost', 'profit_margin', 'margin_percent')}, price_band, {dbl('weight_kg')}, supplier_id,
       is_active, is_current FROM dim_product""")
    q["dim_geography"] = build(f"""
SELECT row_number() OVER (ORDER BY city, state, country) AS geography_sk, city, state, left(upper(state), 2) AS state_code,
       country, CASE upper(country) {_country_case} ELSE left(upper(country), 2) END AS country_code,
       {REGION.format(s='upper(state)')} AS region, NULL::VARCHAR AS subregion, NULL::DOUBLE AS latitude,
       NULL::DOUBLE AS longitude
FROM (SELECT DISTINCT shipping_city AS city, shipping_state AS state, shipping_country AS country FROM silver_orders)""")
    q["fact_sales"] = build(f"SELECT {FACT_SALES_OUT}, customer_sk, TRUE AS has_geography FROM fact_sales")
    q["fact_sales_items"] = build(f"""
SELECT date_sk, customer_sk, product_sk, order_id, line_number, order_date, customer_id, product_id,
       {dbl('quantity', 'unit_price', 'unit_cost', 'discount_percent', 'line_total', 'line_discount', 'line_net_amount',
            'line_cost', 'line_profit')},
       CASE WHEN line_net_amount > 0 THEN {pct('line_profit', 'line_net_amount')} ELSE 0.0::DOUBLE END
         AS line_margin_percent FROM fact_items""")
    q["fact_daily_sales"] = build(f"SELECT {DAILY_OUT} FROM daily")
    q["full_layer_run"] = q["fact_daily_sales"]
    q["run_pipeline"] = build("""
SELECT 'dim_customer' AS table_name, count(*) AS n_rows, count(DISTINCT customer_id) AS n_keys,
       sum(customer_tenure_days)::DOUBLE AS measure FROM dim_customer
UNION ALL SELECT 'dim_product', count(*), count(DISTINCT product_id), sum(unit_price)::DOUBLE FROM dim_product
UNION ALL SELECT 'dim_geography', count(*), count(*), count(*)::DOUBLE FROM (
  SELECT DISTINCT shipping_city, shipping_state, shipping_country FROM silver_orders
  WHERE shipping_city IS NOT NULL AND shipping_state IS NOT NULL AND shipping_country IS NOT NULL)
UNION ALL SELECT 'fact_sales', count(*), count(DISTINCT order_id), sum(total_amount)::DOUBLE FROM fact_sales
UNION ALL SELECT 'fact_sales_items', count(*), count(DISTINCT (order_id, line_number)), sum(line_net_amount)::DOUBLE
FROM fact_items
UNION ALL SELECT 'fact_daily_sales', count(*), count(DISTINCT date_sk), sum(net_revenue)::DOUBLE FROM daily""")
    q["daily_sales_trends"] = build(f"""
SELECT date_sk, snapshot_date, {big('total_orders')}, {dbl('net_revenue')},
       (sum(total_orders) OVER ytd)::BIGINT AS ytd_orders, (sum(net_revenue) OVER ytd)::DOUBLE AS ytd_revenue,
       (sum(coalesce(fresh, 0)) OVER ytd)::BIGINT AS ytd_customers,
       (net_revenue - max(net_revenue) OVER (ORDER BY snapshot_date RANGE BETWEEN INTERVAL 1 DAY PRECEDING
                                             AND INTERVAL 1 DAY PRECEDING))::DOUBLE AS revenue_vs_prev_day,
       (net_revenue - max(net_revenue) OVER (ORDER BY snapshot_date RANGE BETWEEN INTERVAL 7 DAY PRECEDING
                                             AND INTERVAL 7 DAY PRECEDING))::DOUBLE AS revenue_vs_prev_week,
       (total_orders - max(total_orders) OVER (ORDER BY snapshot_date RANGE BETWEEN INTERVAL 1 DAY PRECEDING
                                               AND INTERVAL 1 DAY PRECEDING))::BIGINT AS orders_vs_prev_day
FROM daily LEFT JOIN first_days USING (snapshot_date)
WINDOW ytd AS (PARTITION BY year(snapshot_date) ORDER BY snapshot_date)""", {"first_days": """
SELECT snapshot_date, count(*) AS fresh FROM (
  SELECT customer_id, min(order_date) AS snapshot_date FROM silver_orders GROUP BY customer_id, year(order_date))
GROUP BY snapshot_date"""})
    q["fact_customer_activity"] = build(f"""
SELECT strftime(activity_date, '%Y%m%d')::BIGINT AS date_sk, customer_sk, customer_id, activity_date, orders_placed,
       {dbl('items_purchased', 'total_spend')}, to_date::BIGINT AS lifetime_orders, {dbl('lifetime_spend', 'lifetime_items')},
       days_since_first_order, days_since_last_order,
       {quo('lifetime_spend', 'to_date', 4)} AS avg_order_value,
       {quo('days_since_first_order', 'to_date - 1', 2)} AS avg_days_between_orders,
       r AS rfm_recency_score, f AS rfm_frequency_score, m AS rfm_monetary_score,
       CASE WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'Champions' WHEN f >= 4 THEN 'Loyal' WHEN r >= 4 THEN 'Recent'
            WHEN r <= 2 AND f >= 3 THEN 'At Risk' WHEN r <= 2 THEN 'Lapsed' ELSE 'Regular' END AS rfm_segment
FROM activity_history JOIN activity_scores USING (customer_id)""", {
        "activity_days": """
SELECT customer_id, customer_sk, order_date AS activity_date, count(*) AS orders_placed,
       sum(total_quantity) AS items_purchased, sum(total_amount) AS total_spend
FROM fact_sales GROUP BY ALL""",
        "activity_history": """
SELECT *, sum(orders_placed) OVER w AS to_date, sum(total_spend) OVER w AS lifetime_spend,
       sum(items_purchased) OVER w AS lifetime_items,
       date_diff('day', min(activity_date) OVER w, activity_date) AS days_since_first_order,
       date_diff('day', lag(activity_date) OVER (PARTITION BY customer_id ORDER BY activity_date), activity_date)
         AS days_since_last_order
FROM activity_days WINDOW w AS (PARTITION BY customer_id ORDER BY activity_date)""",
        "activity_scores": f"""
SELECT customer_id, ntile(5) OVER (ORDER BY date_diff('day', max(order_date), {AS_OF}) DESC, customer_id) AS r,
       ntile(5) OVER (ORDER BY count(*), customer_id) AS f, ntile(5) OVER (ORDER BY sum(total_amount), customer_id) AS m
FROM fact_sales GROUP BY customer_id"""})
    q["fact_product_performance"] = build(f"""
SELECT strftime(performance_date, '%Y%m%d')::BIGINT AS date_sk, product_id, product_sk, performance_date, times_ordered,
       {dbl('quantity_sold', 'gross_revenue', 'total_discounts', 'net_revenue', 'total_cost', 'total_profit')},
       CASE WHEN net_revenue > 0 THEN {pct('total_profit', 'net_revenue')} ELSE 0.0::DOUBLE END AS profit_margin,
       (sum(quantity_sold) OVER m)::DOUBLE AS mtd_quantity, (sum(net_revenue) OVER m)::DOUBLE AS mtd_revenue,
       (sum(quantity_sold) OVER y)::DOUBLE AS ytd_quantity, (sum(net_revenue) OVER y)::DOUBLE AS ytd_revenue,
       rank() OVER (PARTITION BY performance_date ORDER BY net_revenue DESC NULLS FIRST) AS daily_revenue_rank,
       rank() OVER (PARTITION BY performance_date, category ORDER BY net_revenue DESC NULLS FIRST)
         AS category_revenue_rank
FROM product_days
WINDOW m AS (PARTITION BY product_id, year(performance_date), month(performance_date) ORDER BY performance_date),
       y AS (PARTITION BY product_id, year(performance_date) ORDER BY performance_date)""", {"product_days": """
SELECT product_id, product_sk, category, order_date AS performance_date, count(DISTINCT order_id) AS times_ordered,
       sum(quantity) AS quantity_sold, sum(line_total) AS gross_revenue, sum(line_discount) AS total_discounts,
       sum(line_net_amount) AS net_revenue, sum(line_cost) AS total_cost, sum(line_profit) AS total_profit
FROM fact_items GROUP BY ALL"""})

    # Views.
    q["v_sales_overview"] = build(f"""
SELECT full_date, {big('year', 'quarter', 'month')}, month_name, {big('week_of_year')}, day_name, is_weekend,
       {big('total_orders', 'total_customers')},
       {dbl('total_quantity', 'gross_revenue', 'total_discounts', 'net_revenue')}, avg_order_value,
       {ratio('sum(net_revenue) OVER w', 'count(net_revenue) OVER w')} AS revenue_7day_avg,
       {ratio('sum(total_orders) OVER w', 'count(total_orders) OVER w')} AS orders_7day_avg,
       (lag(net_revenue, 365) OVER (ORDER BY full_date))::DOUBLE AS revenue_same_day_last_year,
       {growth('net_revenue', 'lag(net_revenue, 1) OVER (ORDER BY full_date)')} AS revenue_dod_growth_pct
FROM daily JOIN calendar USING (date_sk)
WINDOW w AS (ORDER BY full_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
    per_customer = {"with_sales": PER_CUSTOMER}
    q["v_customer_segments"] = build(f"""
SELECT customer_segment, customer_tier, tenure_band, region, count(DISTINCT customer_id) AS customer_count,
       count(DISTINCT order_id) AS total_orders, sum(total_amount)::DOUBLE AS total_revenue,
       {avg('total_amount')} AS avg_order_value, sum(total_quantity)::DOUBLE AS total_items_purchased,
       {quo('sum(total_amount)', 'count(DISTINCT customer_id)')} AS revenue_per_customer,
       {quo('count(DISTINCT order_id)', 'count(DISTINCT customer_id)')} AS orders_per_customer
FROM with_sales GROUP BY 1, 2, 3, 4""", per_customer)
    q["v_product_performance"] = build(f"""
SELECT product_id, product_name, category, subcategory, brand, price_band,
       {dbl('unit_price', 'unit_cost', 'margin_percent')}, count(DISTINCT order_id) AS times_ordered,
       sum(quantity)::DOUBLE AS total_quantity_sold, sum(line_net_amount)::DOUBLE AS total_revenue,
       sum(line_profit)::DOUBLE AS total_profit, {quo('sum(given)', 'count(given)')} AS avg_discount_given,
       rank() OVER (PARTITION BY category ORDER BY sum(line_net_amount) DESC NULLS FIRST) AS category_revenue_rank,
       rank() OVER (ORDER BY sum(line_net_amount) DESC NULLS FIRST) AS overall_revenue_rank
FROM by_product
GROUP BY product_id, product_name, category, subcategory, brand, price_band, by_product.unit_price,
         by_product.unit_cost, by_product.margin_percent""", {"by_product": ITEMS_BY_PRODUCT})
    months = f"""
SELECT year, month, month_name, year_month, count(DISTINCT order_id) AS total_orders,
       count(DISTINCT customer_id) AS unique_customers, sum(total_amount) AS total_revenue,
       sum(discount_amount) AS total_discounts, sum(profit_amount) AS total_profit,
       {avg('total_amount')} AS avg_order_value, sum(total_quantity) AS total_items
FROM fact_sales JOIN calendar USING (date_sk) GROUP BY 1, 2, 3, 4"""
    q["v_monthly_trends"] = build(f"""
SELECT {big('year', 'month')}, month_name, year_month, total_orders, unique_customers,
       {dbl('total_revenue', 'total_discounts', 'total_profit')}, avg_order_value, {dbl('total_items')},
       (lag(total_revenue, 1) OVER w)::DOUBLE AS prev_month_revenue,
       {growth('total_revenue', 'lag(total_revenue, 1) OVER w')} AS mom_growth_pct,
       (lag(total_revenue, 12) OVER w)::DOUBLE AS same_month_last_year,
       {growth('total_revenue', 'lag(total_revenue, 12) OVER w')} AS yoy_growth_pct
FROM months WINDOW w AS (ORDER BY year, month)""", {"months": months})
    q["v_category_performance"] = build(f"""
SELECT category, subcategory, count(DISTINCT product_id) AS product_count, count(DISTINCT order_id) AS total_orders,
       sum(quantity)::DOUBLE AS total_units_sold, sum(line_net_amount)::DOUBLE AS total_revenue,
       sum(line_profit)::DOUBLE AS total_profit, {pct('sum(line_profit)', 'sum(line_net_amount)')} AS profit_margin_pct,
       {avg('sold_at')} AS avg_unit_price, {quo('sum(given)', 'count(given)')} AS avg_discount_pct,
       {pct('sum(line_net_amount)', 'sum(sum(line_net_amount)) OVER ()')} AS revenue_contribution_pct
FROM by_product GROUP BY 1, 2""", {"by_product": ITEMS_BY_PRODUCT})
    q["v_geographic_sales"] = build(f"""
SELECT region, state, city, count(DISTINCT customer_id) AS customer_count, count(DISTINCT order_id) AS total_orders,
       sum(total_amount)::DOUBLE AS total_revenue, {avg('total_amount')} AS avg_order_value,
       sum(shipping_cost)::DOUBLE AS total_shipping,
       {quo('sum(total_amount)', 'count(DISTINCT customer_id)')} AS revenue_per_customer,
       {pct('sum(total_amount)', 'sum(sum(total_amount)) OVER ()')} AS revenue_pct_of_total
FROM with_sales GROUP BY 1, 2, 3""", per_customer)
    since = f"date_diff('day', max(order_date), {AS_OF})"
    q["v_top_customers"] = build(f"""
SELECT customer_id, full_name, email, customer_segment, customer_tier, region, registration_date,
       {big('customer_tenure_days')}, count(DISTINCT order_id) AS lifetime_orders,
       sum(total_amount)::DOUBLE AS lifetime_value, {avg('total_amount')} AS avg_order_value,
       max(order_date) AS last_order_date, {since} AS days_since_last_order,
       ntile(5) OVER (ORDER BY {since} DESC NULLS FIRST, customer_id) AS recency_score,
       ntile(5) OVER (ORDER BY count(DISTINCT order_id), customer_id) AS frequency_score,
       ntile(5) OVER (ORDER BY sum(total_amount) NULLS LAST, customer_id) AS monetary_score
FROM with_sales
GROUP BY customer_id, full_name, email, customer_segment, customer_tier, region, registration_date,
         with_sales.customer_tenure_days""", per_customer)
    q["v_order_status_summary"] = build(f"""
SELECT order_status, order_priority, ship_mode, count(*) AS order_count, sum(total_amount)::DOUBLE AS total_revenue,
       {avg('total_amount')} AS avg_order_value, {avg('days_to_ship')} AS avg_days_to_ship,
       count(*) FILTER (days_to_ship <= 3) AS orders_shipped_within_3_days,
       {pct('count(*) FILTER (days_to_ship <= 3)', 'count(*)')} AS pct_shipped_within_3_days
FROM fact_sales GROUP BY 1, 2, 3""")

    # Run log and audits.
    seconds = "date_diff('second', query_start_time, completed_time)"
    q["run_summary"] = build(f"""
SELECT task_name, count(*) AS total_runs, count(*) FILTER (state = 'SUCCEEDED') AS success_count,
       count(*) FILTER (state = 'FAILED') AS failure_count, {avg(seconds)} AS avg_duration_seconds,
       max({seconds}) AS max_duration_seconds, min(scheduled_time) AS first_run, max(scheduled_time) AS last_run
FROM run_log WHERE scheduled_time >= TIMESTAMP '2024-01-31' - INTERVAL 24 DAY GROUP BY 1""")
    q["run_history"] = build(f"""
SELECT *, {seconds} AS duration_seconds FROM run_log
WHERE scheduled_time >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY""")

    def rule(table: str, kind: str, columns: str, count: str) -> str:
        return (f"SELECT '{table}' AS table_name, '{kind}' AS rule, '{columns}' AS columns, "
                f"({count})::BIGINT AS violations")

    def surplus(table: str, *keys: str) -> str:
        names = ", ".join(keys)
        return f"SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM {table} GROUP BY {names})"

    def nulls(column: str) -> str:
        return f"SELECT count(*) FILTER ({column} IS NULL) FROM silver_customers"

    q["constraint_audit"] = build("\nUNION ALL ".join([
        rule("lineitem", "unique", "l_orderkey, l_linenumber", surplus("lineitem", "l_orderkey", "l_linenumber")),
        rule("orders", "unique", "l_orderkey", surplus("orders", "o_orderkey")),
        rule("silver_customers", "unique", "customer_id", surplus("silver_customers", "customer_id")),
        *(rule("silver_customers", "not_null", c, nulls(c)) for c in ("customer_id", "email", "registration_date")),
        rule("lineitem", "not_null", "l_orderkey", "SELECT count(*) FROM lineitem WHERE l_orderkey IS NULL"),
        rule("lineitem", "foreign_key", "l_orderkey",
             "SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"),
        rule("orders", "foreign_key", "o_custkey",
             "SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)"),
        rule("orders", "foreign_key", "l_orderkey",
             "SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"),
    ]))
    q["layer_counts"] = build("""
SELECT 'bronze.raw_customers' AS table_name, count(*) AS row_count FROM people
UNION ALL SELECT 'silver.customers', count(*) FROM people
UNION ALL SELECT 'gold.dim_customer', count(*) FROM people
UNION ALL SELECT 'bronze.raw_orders', count(*) FROM silver_orders
UNION ALL SELECT 'silver.orders', count(*) FROM silver_orders
UNION ALL SELECT 'silver.order_items', count(*) FROM lineitem
UNION ALL SELECT 'gold.fact_daily_sales', count(*) FROM daily""")
    return q
