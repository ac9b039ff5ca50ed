"""Validity intervals of a dimension whose versions arrive late or several at a time, and facts joined as of their day.

Versions are kept as they came, one per key and day (the last to arrive); intervals follow from them, so a version
that arrives late splits the interval it falls into. Both the intervals and the join look at one key and *slice* of time
(a month by default) at a time and hand only the first and last version of a slice on, so a key with a third of
the rows is dealt out by time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from .merge import latest_by_key

FROM, TO = "valid_from", "valid_to"
OPEN_END = dt.date(9999, 12, 31)
_SLICE, _VERSION = "_slice", "_version"


def by_month(day: Column) -> Column:
    return F.trunc(day, "month")


def merge_versions(stored: DataFrame | None, delivery: DataFrame, key: str, arrival: str) -> DataFrame:
    """Versions after a delivery in any order: per key and day that with the greatest ``arrival``. Rows without a key or
    a day are left out."""
    known = delivery.where(F.col(key).isNotNull() & F.col(FROM).isNotNull())
    every = known if stored is None else stored.unionByName(known)
    return latest_by_key(every, [key, FROM], [arrival])


def _at_edges(versions: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """Per key and slice: what the version before it held, and the day of the first version after it."""
    last = F.max(F.struct(FROM, *attributes))
    slices = versions.groupBy(key, _SLICE).agg(F.min(FROM).alias("_first"), last.alias("_last"))
    in_time = Window.partitionBy(key).orderBy(_SLICE)  # a row a slice
    return slices.select(F.col(key).alias("_k"), F.col(_SLICE).alias("_s"), F.lag("_last").over(in_time).alias("_before"),
                         F.lead("_first").over(in_time).alias("_after"))


def intervals(versions: DataFrame, key: str, attributes: list[str], slice_of=by_month) -> DataFrame:
    """``key``, ``attributes``, ``valid_from`` and ``valid_to`` (exclusive). Versions that change nothing open no interval."""
    placed = versions.select(key, FROM, *attributes, slice_of(F.col(FROM)).alias(_SLICE))
    inside = Window.partitionBy(key, _SLICE).orderBy(FROM)

    def with_edges(rows: DataFrame) -> DataFrame:
        edges = _at_edges(rows, key, attributes)
        return rows.join(edges, (F.col(key) == F.col("_k")) & (F.col(_SLICE) == F.col("_s"))).drop("_k", "_s")

    now = F.struct(*attributes)
    before = F.coalesce(F.lag(now).over(inside), F.when(F.col("_before").isNotNull(), F.struct(*(F.col(f"_before.{a}") for a in attributes))))
    opening = with_edges(placed).withColumn(_VERSION, before).where(F.col(_VERSION).isNull() | ~now.eqNullSafe(F.col(_VERSION)))
    opening = opening.select(*placed.columns)
    until = F.coalesce(F.lead(FROM).over(inside), F.col("_after"), F.lit(OPEN_END))
    return with_edges(opening).select(key, *attributes, FROM, until.alias(TO))


def refresh_intervals(stored: DataFrame, versions: DataFrame, touched: DataFrame, key: str, attributes: list[str],
                      slice_of=by_month) -> DataFrame:
    """Stored intervals, computed again for the keys of ``touched`` only."""
    keys = touched.select(key).distinct()
    return stored.join(keys, key, "left_anti").unionByName(intervals(versions.join(keys, key, "left_semi"), key, attributes, slice_of))


def as_of_join(facts: DataFrame, versions: DataFrame, key: str, day: str, attributes: list[str], slice_of=by_month) -> DataFrame:
    """Facts with ``attributes`` and ``valid_from`` of the version valid on their day (NULL before the first).

    Versions and facts of a key and slice are sorted together and the last version is carried forward; a slice starts
    with the last version of the slices before it. ``versions`` has a row per key and ``valid_from``; attributes must not
    be columns of ``facts``. Facts without key or day get NULLs.
    """
    columns = facts.columns
    version = F.struct(FROM, *attributes)
    known = facts.where(F.col(key).isNotNull() & F.col(day).isNotNull())
    asked = known.select(F.col(key).alias("_k"), F.col(day).alias("_t"), slice_of(F.col(day)).alias(_SLICE),
                         F.lit(1).alias("_fact"), F.struct(*columns).alias("_row"))
    given = versions.select(F.col(key).alias("_k"), F.col(FROM).alias("_t"), slice_of(F.col(FROM)).alias(_SLICE),
                            version.alias(_VERSION))
    # A row a key and slice: the last version in it, and whether it holds facts.
    ends = given.groupBy("_k", _SLICE).agg(F.max(_VERSION).alias("_last")).withColumn("_asked", F.lit(False))
    wanted = asked.select("_k", _SLICE).distinct().select("_k", _SLICE, F.lit(None).cast(given.schema[_VERSION].dataType).alias("_last"),
                                                          F.lit(True).alias("_asked"))
    slices = ends.unionByName(wanted).groupBy("_k", _SLICE).agg(F.max("_last").alias("_last"), F.max("_asked").alias("_asked"))
    earlier = Window.partitionBy("_k").orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    opening = slices.withColumn(_VERSION, F.last("_last", ignorenulls=True).over(earlier)).where(f"_asked and {_VERSION} is not null")
    lead_in = opening.select("_k", F.col(f"{_VERSION}.{FROM}").alias("_t"), _SLICE, _VERSION)
    rows = asked.unionByName(given.unionByName(lead_in).withColumn("_fact", F.lit(0)), allowMissingColumns=True)
    up_to = Window.partitionBy("_k", _SLICE).orderBy("_t", "_fact").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = rows.withColumn("_met", F.last(_VERSION, ignorenulls=True).over(up_to)).where("_fact = 1")
    found = met.select("_row.*", *(F.col(f"_met.{a}").alias(a) for a in (*attributes, FROM)))
    rest = facts.where(F.col(key).isNull() | F.col(day).isNull())
    return found.unionByName(rest, allowMissingColumns=True)
