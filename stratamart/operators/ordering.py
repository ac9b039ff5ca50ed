"""Sort keys with the reference null order: ascending puts NULLs last, descending puts them first."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class SortKey:
    name: str
    descending: bool = False

    def column(self) -> Column:
        c = F.col(self.name)
        return c.desc_nulls_first() if self.descending else c.asc_nulls_last()

    def _null_side(self, is_null: Column) -> Column:
        # Position of NULLs as a number that compares like the sort order.
        null_at, value_at = (0, 1) if self.descending else (1, 0)
        return F.when(is_null, F.lit(null_at)).otherwise(F.lit(value_at))

    def sorts_after(self, value: Any) -> Column:
        """TRUE where this row's key sorts strictly after a known key value."""
        c = F.col(self.name)
        here = self._null_side(c.isNull())
        if value is None:
            return here > (0 if self.descending else 1)
        beyond = c < F.lit(value) if self.descending else c > F.lit(value)
        return F.coalesce(beyond, F.lit(not self.descending))

    def ties(self, value: Any) -> Column:
        c = F.col(self.name)
        return c.isNull() if value is None else F.coalesce(c == F.lit(value), F.lit(False))


def asc(name: str) -> SortKey:
    return SortKey(name)


def desc(name: str) -> SortKey:
    return SortKey(name, True)


def sorts_at_or_after(keys: list[SortKey], row: tuple) -> Column:
    """TRUE where the row's key tuple sorts at or after ``row`` (lexicographic)."""
    result = F.lit(True)
    for key, value in reversed(list(zip(keys, row))):
        result = key.sorts_after(value) | (key.ties(value) & result)
    return result
