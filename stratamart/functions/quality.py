"""Weighted completeness score."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F


def dq_score(rules: list[tuple[Column, str]]) -> Column:
    """Sum of the weights whose predicate holds (NULL counts as not holding), two decimals."""
    parts = [F.when(test, F.lit(Decimal(weight))).otherwise(F.lit(Decimal("0.00"))) for test, weight in rules]
    return F.round(reduce(add, parts), 2).cast("decimal(3,2)")
