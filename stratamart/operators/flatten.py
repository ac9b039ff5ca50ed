"""Nested order items: lateral flatten and per-document aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

QUANTITY = "decimal(38,0)"


def variant_array(doc: Column, path: str) -> Column:
    """The elements at a path, NULL when it is missing or not an array."""
    return F.try_variant_get(doc, path, "array<variant>")


def flatten_items(raw: DataFrame, path: str = "$.items", doc: str = "raw_data",
                  element: str = "variant") -> DataFrame:
    """One row per array element with its 0-based ``index`` and ``value``; empty and missing arrays drop out.

    ``element`` types the value while the document is read once (a field that does not convert is NULL);
    the default keeps it a variant.
    """
    others = [c for c in raw.columns if c != doc]
    elements = F.try_variant_get(F.col(doc), path, f"array<{element}>")
    return raw.select(*others, F.posexplode(elements).alias("index", "value"))


def counted_items(doc: Column, path: str = "$.items") -> Column:
    """The item fields that the aggregates need, typed in one read of the document."""
    return F.try_variant_get(doc, path, f"array<struct<product_id:string,quantity:{QUANTITY}>>")


def item_aggregates(items: str) -> dict[str, Column]:
    """Item count, total quantity and distinct products of an item array column, with no shuffle.

    Quantities are whole numbers (a fraction rounds); the sum over no items is NULL, as in SQL.
    """
    array = F.col(items)
    quantities = F.array_compact(array["quantity"])
    total = F.aggregate(quantities, F.lit(0).cast(QUANTITY), lambda acc, q: (acc + q).cast(QUANTITY))
    products = F.array_distinct(F.array_compact(array["product_id"]))
    return {
        "total_items": F.when(array.isNotNull(), F.size(array)).cast("long"),
        "total_quantity": F.when(F.size(quantities) > 0, total),
        "unique_products": F.coalesce(F.when(array.isNotNull(), F.size(products)), F.lit(0)).cast("long"),
    }
