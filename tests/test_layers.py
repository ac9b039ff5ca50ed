import datetime as dt
import json
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratamart.operators import audit
from stratamart.plans import dims, facts, full_run, silver, views
from stratamart.schemas import CUSTOMER_COLUMNS, PRODUCT_COLUMNS
from stratamart.sources import load

AS_OF = dt.date(2025, 4, 1)


def order(i, date="2025-03-15", items=None, customer="C1", subtotal=100.0, discount=0.0, total=None, **extra):
    return {
        "order_id": f"O{i}", "customer_id": customer, "order_date": date, "order_timestamp": f"{date}T10:30:00Z",
        "order_status": "completed", "priority": "High", "ship_date": None, "ship_mode": "Express",
        "shipping": {"address": "1 Road", "city": "Austin", "state": "TX", "zip": "1", "country": "USA"},
        "items": [] if items is None else items,
        "totals": {"subtotal": subtotal, "discount": discount, "tax": 1.5, "shipping": 5,
                   "total": total if total is not None else subtotal - discount}, **extra}


def item(p, q, price, discount=None):
    out = {"product_id": p, "quantity": q, "unit_price": price}
    return out if discount is None else {**out, "discount_percent": discount}


def raw_orders(spark, *documents):
    data = [(d.get("order_id") if isinstance(d, dict) else None, json.dumps(d)) for d in documents]
    return spark.createDataFrame(data, "order_id string, j string").select(
        "order_id", F.parse_json("j").alias("raw_data"))


def customer(**cells):
    base = dict(customer_id="C1", first_name=" Ann ", last_name="Lee", email=" Ann@Mail.COM", phone="+1-415-555-0101",
                address="1 Road", city="austin", state=" tx", zip_code="78701", country="united states",
                registration_date="2025-03-02", customer_segment="vip")
    return tuple({**base, **cells}[c] for c in CUSTOMER_COLUMNS)


def product(**cells):
    base = dict(product_id="P1", product_name="USB-C Cable (6ft)", category="electronics", subcategory="cables",
                brand="acme", unit_price="299.99", unit_cost="150.00", weight_kg="0.35", supplier_id="S1",
                is_active="yes", created_date="2025-03-01", updated_date="n/a")
    return tuple({**base, **cells}[c] for c in PRODUCT_COLUMNS)


def text_frame(spark, columns, *data):
    return spark.createDataFrame(list(data), ", ".join(f"{c} string" for c in columns))


# --- silver ------------------------------------------------------------------------------------


def test_clean_customer(spark):
    row = silver.silver_customers(text_frame(spark, CUSTOMER_COLUMNS, customer()), AS_OF).first()
    assert (row.full_name, row.email, row.email_domain, row.phone_formatted) == (
        "Ann Lee", "ann@mail.com", "mail.com", "14155550101")
    assert (row.city, row.state, row.state_code, row.country_code, row.customer_tier) == (
        "AUSTIN", "TX", "TX", "US", "TIER_1")
    assert (row.days_since_registration, row.is_email_valid, row.is_phone_valid) == (30, True, True)
    assert row.dq_score == Decimal("1.00")


def test_customer_of_nulls(spark):
    empty = customer(**{c: None for c in CUSTOMER_COLUMNS})
    row = silver.silver_customers(text_frame(spark, CUSTOMER_COLUMNS, empty), AS_OF).first()
    assert (row.full_name, row.customer_tier, row.is_email_valid, row.is_phone_valid) == (None, "TIER_3", False, False)
    assert row.dq_score == Decimal("0.00")
    dim = dims.dim_customer(silver.silver_customers(text_frame(spark, CUSTOMER_COLUMNS, empty), AS_OF)).first()
    assert (dim.region, dim.tenure_band) == ("Midwest", "Loyal (365+ days)")


def test_clean_product(spark):
    row = silver.silver_products(text_frame(spark, PRODUCT_COLUMNS, product()), AS_OF).first()
    assert (row.product_name_clean, row.category_path) == ("USBC CABLE 6FT", "ELECTRONICS > CABLES")
    assert (row.profit_margin, row.margin_percent, row.weight_lbs) == (
        Decimal("149.9900"), Decimal("50.0000"), Decimal("0.7716"))
    assert (row.is_active, row.updated_date, row.days_since_created) == (True, None, 31)


def test_product_without_price(spark):
    bad = product(unit_price="abc", is_active=None)
    rows = silver.silver_products(text_frame(spark, PRODUCT_COLUMNS, bad), AS_OF)
    row, dim = rows.first(), dims.dim_product(rows).first()
    assert (row.unit_price, row.margin_percent, row.is_active) == (None, Decimal("0.0000"), None)
    assert dim.price_band == "Luxury"


@pytest.mark.parametrize("subtotal, discount, expected, exact", [
    (649.97, 60.00, "9.2300", "9.2300"), (449.97, 22.50, "5.1100", "5.0000"), (1299.99, 0, "0.0000", "0.0000"),
    (0.40, 0.10, "0.0000", "25.0000"), (0, 0, "0.0000", "0.0000")])
def test_discount_percent_divides_whole_units(spark, subtotal, discount, expected, exact):
    raw = raw_orders(spark, order(1, subtotal=subtotal, discount=discount))
    assert silver.silver_orders(raw).first().discount_percent == Decimal(expected)
    assert silver.silver_orders(raw, exact=True).first().discount_percent == Decimal(exact)


def test_order_header(spark):
    doc = order(1, items=[item("P1", 2, 299.99, 10), item("P3", 1.5, 49.99), item("P1", 1, 5)], ship_date="2025-03-17")
    row = silver.silver_orders(raw_orders(spark, doc)).first()
    assert (row.order_status, row.order_priority, row.ship_mode) == ("COMPLETED", "HIGH", "Express")
    assert (row.total_items, row.total_quantity, row.unique_products) == (3, 5, 2)
    assert (row.order_week, row.order_day_of_week, row.is_weekend) == (11, 6, True)
    assert row.order_timestamp == dt.datetime(2025, 3, 15, 10, 30)
    assert row.dq_score == Decimal("0.95")


def test_orders_with_no_items_or_bad_values(spark, rows):
    missing = order(2)
    del missing["items"]
    broken = order(3, date="bad")
    broken["totals"]["tax"] = "a lot"
    raw = raw_orders(spark, order(1), missing, broken)
    got = silver.silver_orders(raw)
    assert rows(got, "order_id", "total_items", "total_quantity", "unique_products") == [
        ("O1", 0, None, 0), ("O2", None, None, 0), ("O3", 0, None, 0)]
    assert rows(got.where("order_id = 'O3'"), "order_date", "order_year", "tax_amount", "total_amount") == [
        (None, None, None, Decimal("100.0000"))]
    assert rows(silver.bad_order_values(raw), "order_id") == [("O3",)]
    assert silver.silver_order_items(raw).count() == 0


def test_item_amounts(spark, rows):
    doc = order(1, items=[item("P2", 3, 149.99, 5), item("P4", 1, 599.99, 15), item("P5", 2, 29.99)])
    items = silver.silver_order_items(raw_orders(spark, doc))
    assert [tuple(str(v) for v in r) for r in
            rows(items, "line_number", "line_total", "line_discount", "line_net_amount")] == [
        ("1", "449.9700", "22.4985", "427.4715"), ("2", "599.9900", "89.9985", "509.9915"),
        ("3", "59.9800", "0.0000", "59.9800")]
    assert silver.silver_order_items(raw_orders(spark, doc), existing=items.where("line_number < 3")).count() == 1


def test_event_business_hours(spark, rows):
    def event(i, ts):
        return {"event_id": f"E{i}", "event_type": "view", "event_timestamp": ts, "event_value": 1.25,
                "properties": {"k": 1}}

    raw = raw_orders(spark, event(1, "2025-03-14T09:00:00"), event(2, "2025-03-14T17:00:00"),
                     event(3, "2025-03-15T10:00:00"), event(4, "noon"))
    got = silver.silver_events(raw)
    assert rows(got, "event_id", "event_hour", "is_business_hours") == [
        ("E1", 9, True), ("E2", 17, False), ("E3", 10, False), ("E4", None, None)]
    assert json.loads(got.select(F.to_json("properties")).first()[0]) == {"k": 1}


def test_events_without_id_are_set_aside_and_replays_add_nothing(spark, tmp_path, rows):
    raw = raw_orders(spark, {"event_id": "E1", "event_type": "view", "event_timestamp": "2025-03-14T09:00:00"},
                     {"event_type": "view"}, {"event_type": "click"}, {"event_id": "E1", "event_type": "again"})
    raw = raw.withColumns({"record_id": F.monotonically_increasing_id(), "load_timestamp": F.lit(AS_OF).cast("timestamp_ntz")})
    house = full_run.Warehouse(str(tmp_path / "house"))
    first = full_run.merge_events(house, raw, AS_OF, dt.datetime(2025, 3, 15))
    assert (first.inserted, first.unkeyed) == (1, 2)
    again = full_run.merge_events(house, raw, AS_OF, dt.datetime(2025, 3, 16))
    assert again.inserted == 0
    stored = house.read(spark, "silver", "events")
    assert rows(stored, "event_id", "silver_load_ts") == [("E1", dt.datetime(2025, 3, 15))]
    assert "event_sk" in stored.columns


# --- dimensions --------------------------------------------------------------------------------


def test_calendar(spark):
    days = dims.dim_date(spark)
    assert days.count() == 2192
    leap = days.where("full_date = '2024-02-29'").first()
    assert (leap.same_day_last_year, leap.same_day_last_month) == (dt.date(2023, 2, 28), dt.date(2024, 1, 29))
    last = days.where("full_date = '2024-12-30'").first()
    assert (last.date_sk, last.year_week, last.day_name, last.month_name) == (20241230, "2024-W01", "Mon", "Dec")
    assert (last.year_quarter, last.is_business_day, last.is_holiday) == ("2024-Q4", True, False)
    long = (dt.date(3000, 12, 31) - dt.date(1600, 1, 1)).days + 1
    assert dims.date_spine(spark, "1600-01-01", "3000-12-31").count() == long
    assert dims.date_spine(spark, "2024-01-02", "2024-01-01").count() == 0


def test_geography_is_joined_on_all_three_names(spark):
    here = order(1)
    there = order(2)
    there["shipping"] = {**there["shipping"], "country": "Canada"}
    orders = silver.silver_orders(raw_orders(spark, here, there))
    places = dims.dim_geography(orders)
    assert places.count() == 2
    buyers = spark.createDataFrame([("C1", 7)], "customer_id string, customer_sk long")
    sales = facts.fact_sales(orders, buyers, places)
    assert sales.count() == 2
    assert sales.select("geography_sk").distinct().count() == 2
    assert sales.first().profit_amount == Decimal("30.0000")


# --- facts and views ---------------------------------------------------------------------------


@pytest.fixture
def shop(spark):
    orders = silver.silver_orders(raw_orders(
        spark,
        order(1, items=[item("P1", 2, 10.0)], subtotal=20, customer="C1"),
        order(2, items=[item("P1", 1, 10.0), item("P2", 1, 30.0)], subtotal=40, customer="C2"),
        order(3, date="2025-03-16", subtotal=50, customer="C1"),
        order(4, date="2025-03-23", subtotal=10, customer="C2", ship_date="2025-03-24")))
    buyers = dims.dim_customer(silver.silver_customers(text_frame(
        spark, CUSTOMER_COLUMNS, customer(), customer(customer_id="C2", state="ny"),
        customer(customer_id="C3")), AS_OF)).withColumn("customer_sk", F.substring("customer_id", 2, 1).cast("long"))
    products = dims.dim_product(silver.silver_products(text_frame(
        spark, PRODUCT_COLUMNS, product(unit_cost="4"), product(product_id="P2", unit_cost="10"),
        product(product_id="P3")), AS_OF)).withColumn("product_sk", F.substring("product_id", 2, 1).cast("long"))
    sales = facts.fact_sales(orders, buyers, dims.geography_attributes(orders).withColumn("geography_sk", F.lit(1)))
    raw = raw_orders(spark, order(1, items=[item("P1", 2, 10.0)]),
                     order(2, items=[item("P1", 1, 10.0), item("P2", 1, 30.0)]))
    lines = facts.fact_sales_items(silver.silver_order_items(raw), sales, products)
    return orders, buyers, products, sales, lines


def test_daily_snapshot_and_trends(shop, rows):
    orders = shop[0]
    daily = facts.fact_daily_sales(orders)
    assert [(str(r[0]), *r[1:]) for r in rows(
        daily, "snapshot_date", "total_orders", "total_customers", "total_items_sold", "avg_order_value",
        "avg_items_per_order")] == [
        ("2025-03-15", 2, 2, 3, 30.0, 1.5), ("2025-03-16", 1, 1, 0, 50.0, 0.0), ("2025-03-23", 1, 1, 0, 10.0, 0.0)]
    one_day = facts.fact_daily_sales(orders, dt.date(2025, 3, 16), dt.date(2025, 3, 16))
    assert one_day.count() == 1
    trends = facts.daily_sales_trends(daily, orders)
    assert [tuple(None if v is None else float(v) for v in r) for r in rows(
        trends, "ytd_orders", "ytd_revenue", "ytd_customers", "revenue_vs_prev_day", "revenue_vs_prev_week")] == [
        (2, 60, 2, None, None), (3, 110, 2, -10, None), (4, 120, 2, None, -40)]


def test_sales_overview_counts_rows(spark, shop):
    days = views.v_sales_overview(facts.fact_daily_sales(shop[0]), dims.dim_date(spark)).collect()
    assert [d.full_date.day for d in days] == [23, 16, 15]
    assert [d.revenue_7day_avg for d in days] == [40.0, 55.0, 60.0]
    assert [d.revenue_dod_growth_pct for d in days] == [Decimal("-80.00"), Decimal("-16.67"), Decimal("0.00")]


def test_customer_without_orders_scores(shop):
    _, buyers, _, sales, _ = shop
    top = {r.customer_id: r for r in views.v_top_customers(buyers, sales, AS_OF).collect()}
    assert (top["C3"].lifetime_orders, top["C3"].lifetime_value) == (0, None)
    assert (top["C3"].recency_score, top["C3"].frequency_score, top["C3"].monetary_score) == (1, 1, 3)
    assert (top["C2"].recency_score, top["C1"].days_since_last_order) == (3, 16)


def test_product_without_sales_ranks_first(shop):
    _, _, products, _, lines = shop
    got = {r.product_id: r for r in views.v_product_performance(products, lines).collect()}
    assert (got["P3"].category_revenue_rank, got["P3"].overall_revenue_rank, got["P3"].times_ordered) == (1, 1, 0)
    assert (got["P1"].times_ordered, float(got["P1"].total_profit)) == (2, 18.0)
    assert {got["P1"].overall_revenue_rank, got["P2"].overall_revenue_rank} == {2}


def test_product_performance_ranks(shop):
    _, _, products, _, lines = shop
    got = {r.product_id: r for r in facts.fact_product_performance(lines, products).collect()}
    assert (float(got["P1"].net_revenue), got["P1"].times_ordered, got["P1"].daily_revenue_rank) == (30.0, 2, 1)
    assert float(got["P2"].profit_margin) == 66.67


def test_customer_activity(shop):
    rows = facts.fact_customer_activity(shop[3], AS_OF).orderBy("customer_id", "activity_date").collect()
    assert [(r.customer_id, r.lifetime_orders, r.days_since_first_order, r.days_since_last_order) for r in rows] == [
        ("C1", 1, 0, None), ("C1", 2, 1, 1), ("C2", 1, 0, None), ("C2", 2, 8, 8)]
    assert {r.rfm_recency_score for r in rows if r.customer_id == "C1"} == {1}


def test_other_views(spark, shop):
    _, buyers, products, sales, lines = shop
    segments = views.v_customer_segments(buyers, sales).collect()
    assert sum(r.customer_count for r in segments) == 3 and sum(r.total_orders for r in segments) == 4
    category = views.v_category_performance(products, lines).collect()
    assert [(r.product_count, r.total_orders, r.revenue_contribution_pct) for r in category] == [(3, 2, 100.0)]
    status = views.v_order_status_summary(sales).first()
    assert (status.order_count, status.orders_shipped_within_3_days, status.pct_shipped_within_3_days) == (4, 1, 25.0)
    months = views.v_monthly_trends(sales, dims.dim_date(spark)).collect()
    assert [(r.year_month, r.total_orders, r.mom_growth_pct, r.prev_month_revenue) for r in months] == [
        ("2025-03", 4, 0.0, None)]
    geo = views.v_geographic_sales(buyers, sales).collect()
    assert sum(r.revenue_pct_of_total or 0 for r in geo) == 100.0


# --- audits ------------------------------------------------------------------------------------


def test_constraint_audit(spark, rows):
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    child = spark.createDataFrame([(1, "a"), (3, None), (3, "b"), (None, "c")], "pid int, v string")
    got = audit.constraint_audit(
        {"parent": parent, "child": child}, unique=[("parent", ["id"])], not_null=[("child", ["pid", "v"])],
        foreign=[("child", "pid", "parent", "id")])
    assert rows(got) == [("child", "foreign_key", "pid", 2), ("child", "not_null", "pid", 1),
                         ("child", "not_null", "v", 1), ("parent", "unique", "id", 1)]


# --- whole run ---------------------------------------------------------------------------------


def write_landing(root, name, text):
    (root / name.split("/")[0]).mkdir(parents=True, exist_ok=True)
    (root / name).write_text(text)


def test_run_layers_twice_and_with_a_resent_order(spark, tmp_path, rows):
    landing = tmp_path / "landing"
    first = [order(1, items=[item("P1", 2, 10.0), item("P2", 1, 5.0)]), order(2, items=[item("P1", 1, 10.0)])]
    write_landing(landing, "orders/a.json", json.dumps(first, indent=1))
    write_landing(landing, "customers/c.csv", ",".join(CUSTOMER_COLUMNS) + "\n" + ",".join(customer()) + "\n")
    write_landing(landing, "products/p.csv", ",".join(PRODUCT_COLUMNS) + "\n" + ",".join(product()) + "\n")
    root, day = str(tmp_path / "house"), dt.date(2025, 3, 15)

    def run(since=None):
        return full_run.run_layers(spark, str(landing), root, AS_OF, day, day, since=since)

    done = run()
    assert done["silver"] == {"customers": 1, "products": 1, "orders": 1, "order_items": 1}
    assert done["gold"]["fact_sales_items"].inserted == 3
    house = full_run.Warehouse(root)

    def state():
        return {
            t: rows(house.read(spark, layer, t).drop("etl_load_ts", "updated_ts"))
            for layer, t in (("silver", "orders"), ("silver", "order_items"), ("gold", "fact_sales"),
                             ("gold", "fact_daily_sales"), ("gold", "dim_customer"))
        }

    before = state()
    idle = run()
    assert set(idle["silver"].values()) == {0}
    assert state() == before

    changed = order(1, items=[item("P9", 9, 9.0)], total=77.0, order_status="shipped", ship_mode="Slow",
                    ship_date="2025-03-18")
    changed["order_status"] = "shipped"
    write_landing(landing, "orders/b.json", json.dumps([changed]))
    time.sleep(1.1)
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    merged = run(since=started)["gold"]["fact_sales"]
    assert (merged.inserted, merged.updated) == (0, 1)
    resent = house.read(spark, "silver", "orders").where("order_id = 'O1'").first()
    assert (resent.order_status, resent.ship_mode, resent.total_amount) == ("SHIPPED", "Express", Decimal("77.0000"))
    assert resent.ship_date == dt.date(2025, 3, 18)
    assert house.read(spark, "silver", "order_items").count() == 3
    fact = house.read(spark, "gold", "fact_sales").where("order_id = 'O1'").first()
    assert (fact.order_status, fact.days_to_ship, fact.total_amount) == ("SHIPPED", 3, Decimal("77.0000"))
    log = spark.read.parquet(f"{root}/run_log")
    assert log.where("state = 'SUCCEEDED'").count() == 9
    assert load.read_batch_log(spark, house.bronze).count() == 9
