"""Grouped results kept up to date from changes instead of being computed again.

A view holds counts and sums per group; both follow a change by adding signed values, so a batch of changes is grouped
on its own and added. A distinct count does not add up: for it the view keeps its members, the number of rows per group
and item, and counts the items whose number leaves or reaches zero. Groups without rows disappear.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .changes import CHANGE_TYPE

ROWS = "row_count"
_SIGN = "_sign"


def signed(changes: DataFrame) -> DataFrame:
    """Change rows with +1 for a new and -1 for an old image."""
    return changes.withColumn(_SIGN, F.when(F.col(CHANGE_TYPE) == "INSERT", 1).otherwise(-1).cast("long"))


@dataclass(frozen=True)
class MaintainedView:
    """``by`` group columns; ``sums``: output name and column; ``distinct``: output name and column."""

    by: tuple[str, ...]
    sums: dict[str, str]
    distinct: dict[str, str]

    def _same(self, left: DataFrame, right: DataFrame, columns: tuple[str, ...], how: str) -> DataFrame:
        """``right`` has its columns behind ``_r_``; NULL groups are groups."""
        match = F.lit(True)
        for c in columns:
            match = match & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        return left.join(right.withColumnsRenamed({c: f"_r_{c}" for c in right.columns}), match, how)

    def _grouped(self, rows: DataFrame) -> DataFrame:
        """Signed counts and sums; a sum keeps the number of its values, since a sum of none is NULL."""
        values = []
        for name, column in self.sums.items():
            values += [F.sum(F.col(column) * F.col(_SIGN)).alias(name),
                       F.sum(F.when(F.col(column).isNotNull(), F.col(_SIGN)).otherwise(F.lit(0))).alias(f"{name}_values")]
        return rows.groupBy(*self.by).agg(F.sum(_SIGN).alias(ROWS), *values)

    def _items(self, rows: DataFrame, name: str) -> DataFrame:
        column = self.distinct[name]
        return (rows.where(F.col(column).isNotNull()).groupBy(*self.by, F.col(column).alias("item"))
                .agg(F.sum(_SIGN).alias("n")).where("n <> 0"))

    def build(self, rows: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
        """View and members of whole rows."""
        return self.apply(None, {}, rows.withColumn(_SIGN, F.lit(1).cast("long")))

    def apply(self, view: DataFrame | None, members: dict[str, DataFrame], rows: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
        """View and members after the ``signed`` rows. Members that no row touches are passed on as they are."""
        delta, kept = self._grouped(rows), {}
        for name in self.distinct:
            moved, old = self._items(rows, name), members.get(name)
            key = (*self.by, "item")
            if old is None:
                kept[name], counted = moved, moved.select(*self.by, F.lit(1).cast("long").alias(name))
            else:
                both = self._same(old, moved, key, "full_outer")
                n = F.coalesce("n", F.lit(0)) + F.coalesce("_r_n", F.lit(0))
                named = [F.when(F.col("n").isNull(), F.col(f"_r_{c}")).otherwise(F.col(c)).alias(c) for c in key]
                kept[name] = both.select(*named, n.alias("n")).where("n <> 0")
                # Only items of the batch can appear or vanish.
                touched = self._same(moved.alias("m"), old, key, "left").select(
                    *self.by, F.coalesce("_r_n", F.lit(0)).alias("before"), (F.coalesce("_r_n", F.lit(0)) + F.col("n")).alias("after"))
                counted = touched.select(*self.by, ((F.col("after") > 0).cast("long") - (F.col("before") > 0).cast("long")).alias(name))
            counted = counted.groupBy(*self.by).agg(F.sum(name).alias(name))
            delta = self._same(delta, counted, self.by, "left").select(*delta.columns, F.coalesce(f"_r_{name}", F.lit(0)).alias(name))
        if view is None:
            return delta.where(F.col(ROWS) != 0), kept
        return self._added(view, delta).where(F.col(ROWS) != 0), kept

    def _added(self, view: DataFrame, delta: DataFrame) -> DataFrame:
        both = self._same(view, delta, self.by, "full_outer")
        known = F.col(ROWS).isNotNull()

        def total(name: str) -> Column:
            left, right = F.col(name), F.col(f"_r_{name}")
            kind = view.schema[name].dataType
            if name in self.sums:
                values = F.coalesce(f"{name}_values", F.lit(0)) + F.coalesce(f"_r_{name}_values", F.lit(0))
                zero = F.lit(0).cast(kind)
                return F.when(values > 0, F.coalesce(left, zero) + F.coalesce(right, zero)).cast(kind).alias(name)
            return (F.coalesce(left, F.lit(0)) + F.coalesce(right, F.lit(0))).cast(kind).alias(name)

        groups = [F.when(known, F.col(c)).otherwise(F.col(f"_r_{c}")).alias(c) for c in self.by]
        return both.select(*groups, *(total(c) for c in view.columns if c not in self.by))
