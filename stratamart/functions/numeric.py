"""Decimal parsing and the single rounding policy for ratios.

A rounded ratio is computed in whole numbers, so that ties are ties: half of the last place goes away from zero.
Ratios that are not rounded are one division in double.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,4)"
PERCENT = "decimal(8,4)"


def try_decimal(text: Column, precision: int = 18, scale: int = 4) -> Column:
    """NULL instead of an error when the text is not a number."""
    return text.try_cast(f"decimal({precision},{scale})")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, NULL when the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def quotient(numerator: Column, denominator: Column, digits: int, factor: int = 1) -> Column:
    """``factor * numerator / denominator`` rounded to ``digits`` places, as a decimal; NULL by zero.

    Both sides are exact decimals of at most four places (or whole numbers).
    """
    above, below = numerator.cast("decimal(28,4)"), F.nullif(denominator.cast("decimal(28,4)"), F.lit(Decimal("0.0000")))
    twice = F.abs(above) * F.lit(Decimal(2 * factor * 10**digits)) + F.abs(below)
    whole = F.call_function("div", twice, F.abs(below) * F.lit(Decimal(2)))
    signed = F.when((above < 0) != (below < 0), -whole).otherwise(whole)
    return signed.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-digits))


def percent_of(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    return quotient(numerator, denominator, digits, 100)


def average(column: Column) -> Column:
    """Exact sum over non-null count; Spark's own avg would fix an intermediate decimal scale."""
    return ratio(F.sum(column), F.count(column))


def rounded_average(column: Column, digits: int) -> Column:
    return quotient(F.sum(column), F.count(column), digits)


def zero_percent() -> Column:
    return F.lit(Decimal("0.00"))


def growth_percent(current: Column, previous: Column) -> Column:
    """Percentage change, 0 unless the previous value is positive."""
    return F.when(previous > 0, percent_of(current - previous, previous)).otherwise(zero_percent())
