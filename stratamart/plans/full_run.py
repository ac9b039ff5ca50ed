"""The jobs: bronze to silver to gold over stored tables, in the fixed order."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.layout import along_curve
from ..operators.merge import MergeCounts, merge_into_path, read_table, rewrite_table, table_exists
from ..operators.scd2 import OPEN_END
from ..schemas import LINEAGE_COLUMNS, RUN_LOG
from ..sources.load import (
    RAW_CUSTOMERS, RAW_EVENTS, RAW_ORDERS, RAW_PRODUCTS, RawTable, load_all_raw, load_raw, read_raw,
)
from ..sources.scan import FileFormat
from ..streaming import event_state
from ..streaming.incremental import drain_files, read_growing
from . import dims, facts, silver


@dataclass(frozen=True)
class Warehouse:
    """Paths of the layers below one root."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    def table(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def read(self, spark: SparkSession, layer: str, name: str) -> DataFrame:
        return read_table(spark, self.table(layer, name))


def _clock() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)


def _stamp(now: dt.datetime):
    return F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")


def _silver_merge(house: Warehouse, name: str, source: DataFrame, key: str, surrogate: str,
                  update_cols: list[str], now: dt.datetime, versioned: bool, cluster_by: list[str]) -> MergeCounts:
    stamp = _stamp(now)
    defaults = {"silver_load_ts": stamp, "silver_update_ts": stamp}
    if versioned:
        defaults["is_current"] = F.lit(True)
    return merge_into_path(
        house.table("silver", name), source, [key], update_cols,
        on_update={"silver_update_ts": stamp}, on_insert=defaults,
        order_by=["bronze_load_ts", "source_record_id"], surrogate=surrogate, cluster_by=cluster_by,
    )


def merge_customers(house: Warehouse, raw: DataFrame, as_of: dt.date, now: dt.datetime) -> MergeCounts:
    rows = silver.silver_customers(raw, as_of)
    update = [c for c in rows.columns if c not in ("customer_id", *silver.AUDIT_COLUMNS.values())]
    return _silver_merge(house, "customers", rows, "customer_id", "customer_sk", update, now, True,
                         ["customer_segment", "state"])


def merge_products(house: Warehouse, raw: DataFrame, as_of: dt.date, now: dt.datetime) -> MergeCounts:
    rows = silver.silver_products(raw, as_of)
    fixed = ("product_id", "created_date", *silver.AUDIT_COLUMNS.values())
    update = [c for c in rows.columns if c not in fixed]
    return _silver_merge(house, "products", rows, "product_id", "product_sk", update, now, True,
                         ["category", "is_active"])


def merge_orders(house: Warehouse, raw: DataFrame, as_of: dt.date, now: dt.datetime) -> MergeCounts:
    rows = silver.silver_orders(raw)
    return _silver_merge(house, "orders", rows, "order_id", "order_sk", silver.ORDER_UPDATE_COLUMNS, now, False,
                         ["order_date"])


def append_order_items(house: Warehouse, raw: DataFrame, as_of: dt.date, now: dt.datetime) -> MergeCounts:
    """Insert-only: a merge that updates nothing adds the (order, line) pairs not present yet."""
    rows = silver.silver_order_items(raw)
    stamp = _stamp(now)
    return merge_into_path(
        house.table("silver", "order_items"), rows, ["order_id", "line_number"], [],
        on_insert={"silver_load_ts": stamp, "silver_update_ts": stamp}, surrogate="order_item_sk",
        cluster_by=["order_id"],
    )


Consumer = Callable[[Warehouse, DataFrame, dt.date, dt.datetime], MergeCounts]


def consume(spark: SparkSession, house: Warehouse, table: RawTable, consumer: str, merge: Consumer,
            as_of: dt.date, files_per_batch: int | None = None) -> int:
    """Feed the unread good records of a raw table to a merge, at most ``files_per_batch`` files at a time; the
    number of batches that ran."""
    path = f"{house.bronze}/{table.name}"
    if not table_exists(spark, path):
        return 0
    stored = spark.read.parquet(path).schema

    def run(batch: DataFrame, batch_id: int) -> None:
        good = batch.where(F.col("rejected") == 0).select(*LINEAGE_COLUMNS, *table.data_columns())
        merge(house, good, as_of, _clock())

    return drain_files(spark, path, stored, f"{house.root}/checkpoints/{consumer}", run, files_per_batch)


def transform_all(spark: SparkSession, house: Warehouse, as_of: dt.date, files_per_batch: int | None = None) -> dict[str, int]:
    """Silver: customers, products, orders, order items."""
    return {
        name: consume(spark, house, table, f"silver_{name}", merge, as_of, files_per_batch)
        for name, table, merge in (
            ("customers", RAW_CUSTOMERS, merge_customers),
            ("products", RAW_PRODUCTS, merge_products),
            ("orders", RAW_ORDERS, merge_orders),
            ("order_items", RAW_ORDERS, append_order_items),
        )
    }


def merge_events(house: Warehouse, raw: DataFrame, as_of: dt.date, now: dt.datetime) -> MergeCounts:
    """Insert-only: an event sent again, also in a later batch or under another file name, is not added."""
    return merge_into_path(
        house.table("silver", "events"), silver.silver_events(raw), ["event_id"], [],
        on_insert={"silver_load_ts": _stamp(now)}, surrogate="event_sk",
        cluster_by=["event_date", "event_type"],
    )


def transform_events(spark: SparkSession, house: Warehouse, files_per_batch: int | None = None) -> int:
    """Unread events into silver; the number of batches that ran."""
    return consume(spark, house, RAW_EVENTS, "silver_events", merge_events, _clock().date(), files_per_batch)


EVENT_KEY, EVENT_TIME = "event_id", "event_timestamp"


def stream_events(spark: SparkSession, house: Warehouse, horizon: str = "7 days") -> event_state.StateReport | None:
    """Unread events into silver, each once as first delivered, by keyed state: only events that come late are compared
    with stored ones. Another way than ``transform_events``, with a table of its own (``event_state.read_events``)."""
    path = f"{house.bronze}/{RAW_EVENTS.name}"
    if not table_exists(spark, path):
        return None
    raw = read_growing(spark, path, spark.read.parquet(path).schema).where(F.col("rejected") == 0)
    return event_state.first_deliveries(
        silver.typed_events(raw), house.table("silver", "event_stream"), f"{house.root}/checkpoints/event_stream",
        EVENT_KEY, EVENT_TIME, arrived="bronze_load_ts", horizon=horizon)


# Keys that filters use, of tables that grow by appended runs.
RAW_LAYOUT = {RAW_ORDERS.name: ["order_date", "order_id"], RAW_EVENTS.name: ["event_timestamp", "event_type"]}
EVENT_LAYOUT = ["event_timestamp", "user_id"]


def lay_out_events(spark: SparkSession, house: Warehouse, files: int) -> None:
    """Stored events of all runs as ``files`` files along a curve of both keys; the rows stay the same."""
    rewrite_table(spark, house.table("silver", "events"), lambda df: along_curve(df, EVENT_LAYOUT, files))


def lay_out_raw(spark: SparkSession, house: Warehouse, table: RawTable, files: int) -> str:
    """A copy of a raw table's good records for filters on its keys; the path. The loaded files stay as they are, since
    streams follow them."""
    path = f"{house.bronze}/by_key/{table.name}"
    along_curve(read_raw(spark, table, house.bronze), RAW_LAYOUT[table.name], files).write.mode("overwrite").parquet(path)
    return path


def load_events(spark: SparkSession, house: Warehouse, landing: str):
    return load_raw(spark, RAW_EVENTS, landing, house.bronze)


def _dim_defaults(as_of: dt.date, now: dt.datetime) -> dict:
    stamp = _stamp(now)
    return {
        "effective_date": F.lit(as_of), "expiration_date": F.lit(OPEN_END), "is_current": F.lit(True),
        "created_ts": stamp, "updated_ts": stamp,
    }


def _changed(df: DataFrame, column: str, since: dt.datetime | None) -> DataFrame:
    """Only rows written since a moment: what an incremental gold run has to look at."""
    return df if since is None else df.where(F.col(column) >= _stamp(since))


def populate_dim_customer(spark: SparkSession, house: Warehouse, as_of: dt.date,
                          since: dt.datetime | None = None) -> MergeCounts:
    now = _clock()
    changed = _changed(house.read(spark, "silver", "customers"), "silver_update_ts", since)
    return merge_into_path(
        house.table("gold", "dim_customer"), dims.dim_customer(changed),
        ["customer_id"], dims.CUSTOMER_UPDATE_COLUMNS, on_update={"updated_ts": _stamp(now)},
        on_insert=_dim_defaults(as_of, now),
    )


def populate_dim_product(spark: SparkSession, house: Warehouse, as_of: dt.date,
                         since: dt.datetime | None = None) -> MergeCounts:
    now = _clock()
    changed = _changed(house.read(spark, "silver", "products"), "silver_update_ts", since)
    return merge_into_path(
        house.table("gold", "dim_product"), dims.dim_product(changed),
        ["product_id"], dims.PRODUCT_UPDATE_COLUMNS, on_update={"updated_ts": _stamp(now)},
        on_insert=_dim_defaults(as_of, now),
    )


def populate_dim_geography(spark: SparkSession, house: Warehouse, since: dt.datetime | None = None) -> MergeCounts:
    changed = _changed(house.read(spark, "silver", "orders"), "silver_update_ts", since)
    places = dims.geography_attributes(changed)
    return merge_into_path(
        house.table("gold", "dim_geography"), places, ["city", "state", "country"], [],
        surrogate="geography_sk",
    )


def populate_dim_date(spark: SparkSession, house: Warehouse, start: str, end: str) -> None:
    dims.dim_date(spark, start, end).coalesce(1).write.mode("overwrite").parquet(house.table("gold", "dim_date"))


def populate_fact_sales(spark: SparkSession, house: Warehouse, since: dt.datetime | None = None) -> MergeCounts:
    now = _clock()
    rows = facts.fact_sales(
        _changed(house.read(spark, "silver", "orders"), "silver_update_ts", since), house.read(spark, "gold", "dim_customer"),
        house.read(spark, "gold", "dim_geography"),
    )
    return merge_into_path(
        house.table("gold", "fact_sales"), rows, ["order_id"], facts.SALES_UPDATE_COLUMNS,
        on_update={"etl_load_ts": _stamp(now)}, on_insert={"etl_load_ts": _stamp(now)},
        surrogate="sales_sk", cluster_by=["date_sk"],
    )


def populate_fact_sales_items(spark: SparkSession, house: Warehouse,
                              since: dt.datetime | None = None) -> MergeCounts:
    now = _clock()
    items = _changed(house.read(spark, "silver", "order_items"), "silver_load_ts", since).drop("order_item_sk", "silver_load_ts", "silver_update_ts")
    rows = facts.fact_sales_items(
        items, house.read(spark, "gold", "fact_sales"), house.read(spark, "gold", "dim_product"))
    return merge_into_path(
        house.table("gold", "fact_sales_items"), rows, ["order_id", "line_number"], [],
        on_insert={"etl_load_ts": _stamp(now)}, surrogate="sales_item_sk",
        cluster_by=["date_sk", "product_sk"],
    )


def populate_daily_sales(spark: SparkSession, house: Warehouse, as_of: dt.date, start: dt.date | None = None,
                         end: dt.date | None = None) -> MergeCounts:
    """Snapshot of the day before ``as_of``, or of a range of days for a backfill."""
    now = _clock()
    first = start or facts.previous_day(as_of)
    rows = facts.fact_daily_sales(house.read(spark, "silver", "orders"), first, end or facts.previous_day(as_of))
    return merge_into_path(
        house.table("gold", "fact_daily_sales"), rows, ["date_sk"], facts.DAILY_UPDATE_COLUMNS,
        on_update={"etl_load_ts": _stamp(now)}, on_insert={"etl_load_ts": _stamp(now)},
    )


def populate_all(spark: SparkSession, house: Warehouse, as_of: dt.date, start: dt.date | None = None,
                 end: dt.date | None = None, since: dt.datetime | None = None) -> dict[str, MergeCounts]:
    """Gold: dimensions, then the facts that use them. With ``since`` only silver rows written from
    then on are merged; without it every row is, as in a nightly full run."""
    return {
        "dim_customer": populate_dim_customer(spark, house, as_of, since),
        "dim_product": populate_dim_product(spark, house, as_of, since),
        "dim_geography": populate_dim_geography(spark, house, since),
        "fact_sales": populate_fact_sales(spark, house, since),
        "fact_sales_items": populate_fact_sales_items(spark, house, since),
        "fact_daily_sales": populate_daily_sales(spark, house, as_of, start, end),
    }


def _logged(spark: SparkSession, house: Warehouse, layer: str, name: str, step: Callable[[], object]):
    """Run a step and append its outcome to the run log."""
    begun = _clock()
    state, error, value = "SUCCEEDED", None, None
    try:
        value = step()
        return value
    except Exception as failure:
        state, error = "FAILED", str(failure)
        raise
    finally:
        row = (name, house.root.rstrip("/").rsplit("/", 1)[-1], layer, state, begun, begun, _clock(),
               None, error, None if value is None else str(value))
        spark.createDataFrame([row], RUN_LOG).coalesce(1).write.mode("append").parquet(f"{house.root}/run_log")


def run_layers(spark: SparkSession, landing: str, root: str, as_of: dt.date, start: dt.date | None = None,
               end: dt.date | None = None, order_format: FileFormat = RAW_ORDERS.fmt,
               since: dt.datetime | None = None, files_per_batch: int | None = None) -> dict[str, dict]:
    """Bronze, silver, gold. A second run with no new files changes nothing.

    ``since`` (the start of the last run) limits gold to silver rows written from then on. ``files_per_batch``
    bounds what one load or merge takes, whatever the backlog.
    """
    house = Warehouse(root)
    return {
        "bronze": _logged(spark, house, "bronze", "load_all_raw",
                          lambda: load_all_raw(spark, landing, house.bronze, order_format, files_per_batch)),
        "silver": _logged(spark, house, "silver", "transform_all", lambda: transform_all(spark, house, as_of, files_per_batch)),
        "gold": _logged(spark, house, "gold", "populate_all",
                        lambda: populate_all(spark, house, as_of, start, end, since)),
    }
