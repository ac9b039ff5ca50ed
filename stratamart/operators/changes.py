"""Change capture between two snapshots of a table, and new-row selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import VariantType

CHANGE_TYPE = "_change_type"
IS_UPDATE = "_is_update"


def comparable(c: Column, data_type) -> Column:
    return F.to_json(c) if isinstance(data_type, VariantType) else c


def any_differs(left: str, right: str, schema, columns: list[str]) -> Column:
    """Null-safe: TRUE when any column differs between two structs."""
    differs = F.lit(False)
    for name in columns:
        kind = schema[name].dataType
        same = comparable(F.col(f"{left}.{name}"), kind).eqNullSafe(comparable(F.col(f"{right}.{name}"), kind))
        differs = differs | ~same
    return differs


def table_changes(prev: DataFrame, curr: DataFrame, keys: list[str]) -> DataFrame:
    """Changes that turn ``prev`` into ``curr``: an update is a DELETE of the old and an INSERT of the new image.

    Rows carry the table's columns plus the change type and the update flag. Both sides hold one row
    per key (the record key of a table), so the join has no hot key.
    """
    columns = curr.columns
    rest = [c for c in columns if c not in keys]
    old = prev.select(*(F.col(k).alias(f"_p_{k}") for k in keys), F.struct(*columns).alias("_old"))
    new = curr.select(*(F.col(k).alias(f"_c_{k}") for k in keys), F.struct(*columns).alias("_new"))
    match = F.lit(True)
    for k in keys:
        match = match & (F.col(f"_p_{k}") == F.col(f"_c_{k}"))
    both = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    changed = ~both | any_differs("_old", "_new", curr.schema, rest)

    def image(name: str, kind: str) -> Column:
        return F.when(
            F.col(name).isNotNull(),
            F.struct(F.lit(kind).alias(CHANGE_TYPE), both.alias(IS_UPDATE), F.col(name).alias("_image")),
        )

    images = F.array_compact(F.array(image("_old", "DELETE"), image("_new", "INSERT")))
    return (
        old.join(new, match, "full_outer")
        .where(changed)
        .select(F.explode(images).alias("_c"))
        .select(f"_c.{CHANGE_TYPE}", f"_c.{IS_UPDATE}", "_c._image.*")
    )


def inserted_rows(changes: DataFrame) -> DataFrame:
    """What a consumer of the change stream keeps: new rows and the new image of updated rows."""
    return changes.where(F.col(CHANGE_TYPE) == "INSERT").drop(CHANGE_TYPE, IS_UPDATE)


def anti_new(source: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key is not in the existing table yet."""
    return source.join(existing.select(*keys), keys, "left_anti")
