"""Exact distinct counts that add up: bitmaps per group, joined by OR for any coarser group.

Items are whole numbers, best dense ones such as surrogate keys: a group has one bitmap of 4 KB per 32,768 numbers that
it touches. Bitmaps are built before the shuffle, so a group that holds a third of the rows moves as a bitmap a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BUCKET, BITS = "bucket", "bits"


def distinct_bitmaps(rows: DataFrame, by: list[str], number: str) -> DataFrame:
    """A bitmap per group and bucket of numbers. Rows without a number are left out."""
    known = rows.where(F.col(number).isNotNull())
    return known.groupBy(*by, F.bitmap_bucket_number(number).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITS))


def roll_up(bitmaps: DataFrame, *by: str | Column) -> DataFrame:
    """Bitmaps of coarser groups, from stored ones alone."""
    return bitmaps.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_counts(bitmaps: DataFrame, by: list[str], out: str) -> DataFrame:
    """Items of each group that has any."""
    return bitmaps.groupBy(*by).agg(F.sum(F.bitmap_count(BITS)).alias(out))
