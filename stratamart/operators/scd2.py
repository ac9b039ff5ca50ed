"""Type 2 history for a dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import as_date
from .changes import any_differs

OPEN_END = dt.date(9999, 12, 31)


def scd2(dim: DataFrame, source: DataFrame, key: str, tracked: list[str], as_of: dt.date | str) -> DataFrame:
    """Dimension after applying one row per key from ``source`` on day ``as_of``.

    A changed tracked column closes the current version the day before and opens a new one; a second
    change on the same day replaces the version opened that day. Keys absent from the source stay.
    """
    columns = dim.columns
    today = as_date(as_of)
    kept_history = dim.where(~F.col("is_current"))
    current = dim.where(F.col("is_current")).select(F.col(key).alias("_k"), F.struct(*columns).alias("_old"))
    incoming = source.select(F.col(key).alias("_n"), F.struct(*source.columns).alias("_new"))
    pairs = current.join(incoming, F.col("_k") == F.col("_n"), "full_outer")

    arrived, known = F.col("_new").isNotNull(), F.col("_old").isNotNull()
    changed = arrived & known & any_differs("_old", "_new", source.schema, tracked)
    same_day = F.col("_old.effective_date") == today

    def version(fields: dict[str, Column], base: str) -> Column:
        return F.struct(*(
            fields.get(c, F.col(f"{base}.{c}") if base == "_old" or c in source.columns else F.lit(None))
            .cast(dim.schema[c].dataType).alias(c)
            for c in columns
        ))

    opened = version(
        {"effective_date": today, "expiration_date": F.lit(OPEN_END), "is_current": F.lit(True)}, "_new"
    )
    closed = version({"expiration_date": F.date_sub(today, 1), "is_current": F.lit(False)}, "_old")
    versions = (
        F.when(~known | (changed & same_day), F.array(opened))
        .when(changed, F.array(closed, opened))
        .otherwise(F.array(F.col("_old")))
    )
    return pairs.select(F.explode(versions).alias("_v")).select("_v.*").unionByName(kept_history)
