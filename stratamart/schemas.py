"""Column lists of the raw tables and of the load log."""

from __future__ import annotations

from pyspark.sql import types as T

CUSTOMER_COLUMNS = [
    "customer_id", "first_name", "last_name", "email", "phone", "address",
    "city", "state", "zip_code", "country", "registration_date", "customer_segment",
]

PRODUCT_COLUMNS = [
    "product_id", "product_name", "category", "subcategory", "brand", "unit_price",
    "unit_cost", "weight_kg", "supplier_id", "is_active", "created_date", "updated_date",
]

# Lineage columns that every raw table carries besides its data.
LINEAGE_COLUMNS = ["record_id", "filename", "file_row_number", "load_timestamp"]

BATCH_LOG = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("records_loaded", T.LongType()),
    T.StructField("records_rejected", T.LongType()),
    T.StructField("load_start_time", T.TimestampNTZType()),
    T.StructField("load_end_time", T.TimestampNTZType()),
    T.StructField("load_status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("loaded_by", T.StringType()),
])

RUN_LOG = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("database_name", T.StringType()),
    T.StructField("schema_name", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("scheduled_time", T.TimestampNTZType()),
    T.StructField("query_start_time", T.TimestampNTZType()),
    T.StructField("completed_time", T.TimestampNTZType()),
    T.StructField("error_code", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("return_value", T.StringType()),
])


def text_schema(columns: list[str], *extra: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in [*columns, *extra]])
