"""Changes between two snapshots by a tree of checksums over key ranges.

Each level splits the ranges that still differ into ``FANOUT`` narrower ones and compares one order-free checksum a range
and side: rows, the exclusive or of one row hash and the sum of another. Checksums are combined before the shuffle, so
a level moves a few numbers a task; ranges that agree are not read again. Only the rows of the last differing ranges are
joined.

A single numeric, date or timestamp key is split by value, so changes that lie together stay in few ranges and both
scans get bounds on the key to push down; other keys are split by hash.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..session import stage
from .changes import comparable, table_changes

FANOUT, LEAF_ROWS = 64, 64
# Differing ranges are broadcast up to this number; with more, a join of all rows costs no more.
MOST_RANGES = 1 << 16
_HASH_BITS = 40
_PLACE, _RANGE = "_place", "_range"


@dataclass
class Narrowed:
    """Rows of both snapshots in the ranges that differ, and per level the ranges compared and found to differ."""

    prev: DataFrame
    curr: DataFrame
    levels: list[tuple[int, int]] = field(default_factory=list)


def _by_value(df: DataFrame, keys: list[str]) -> Column | None:
    """The single key as a whole number in its own order, if it has one."""
    kind = df.schema[keys[0]].dataType
    key = F.col(keys[0])
    if len(keys) > 1:
        return None
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return key.cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(key).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(key)
    return None


def row_hash(df: DataFrame, columns: list[str], seed: int) -> Column:
    """A hash of the whole row that tells NULL from absent."""
    values = [comparable(F.col(c), df.schema[c].dataType) for c in columns]
    return F.xxhash64(F.lit(seed), *values, *(v.isNull() for v in values))


def _checksums(df: DataFrame, columns: list[str], width: int, side: str) -> DataFrame:
    return df.groupBy(F.floor(F.col(_PLACE) / F.lit(width)).alias(_RANGE) if width > 1 else F.col(_PLACE).alias(_RANGE)).agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.bit_xor(row_hash(df, columns, 1)).alias("x"),
                 F.sum(F.shiftrightunsigned(row_hash(df, columns, 2), 32)).alias("s")).alias(side))


def _inside(df: DataFrame, ranges: DataFrame, width: int) -> DataFrame:
    """Rows in the given ranges, of which there are at most ``MOST_RANGES``."""
    number = F.floor(F.col(_PLACE) / F.lit(width)) if width > 1 else F.col(_PLACE)
    return df.withColumn(_RANGE, number).join(F.broadcast(ranges), _RANGE, "left_semi").drop(_RANGE)


def differing_rows(prev: DataFrame, curr: DataFrame, keys: list[str], fanout: int = FANOUT, leaf_rows: int = LEAF_ROWS) -> Narrowed:
    """Both snapshots without the key ranges in which they agree.

    Ranges are narrowed until a differing one holds ``leaf_rows`` rows on average, or one key value. Rows with a NULL
    key belong to no range; they stay on both sides.
    """
    columns = curr.columns
    value = _by_value(curr, keys)
    sides = [prev.select(*columns), curr]
    bounds = [0, 1 << _HASH_BITS]
    if value is not None:
        found = sides[0].select(value.alias("v")).union(sides[1].select(value.alias("v"))).agg(F.min("v"), F.max("v")).first()
        if found[0] is None:
            return Narrowed(*sides)
        bounds = [found[0], found[1] - found[0] + 1]
    if value is None or bounds[1] > 1 << 50:  # a quotient of doubles is exact below
        value, bounds = F.shiftrightunsigned(F.xxhash64(*keys), 64 - _HASH_BITS), [0, 1 << _HASH_BITS]
        by_value = False
    else:
        by_value = True
    low, width = bounds
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    unkeyed = [s.where(missing) for s in sides]
    live = [s.where(~missing).withColumn(_PLACE, value - F.lit(low)) for s in sides]
    levels: list[tuple[int, int]] = []
    while True:
        width = -(-width // fanout)
        old, new = (_checksums(df, columns, width, side) for df, side in zip(live, ("old", "new")))
        pairs = stage(old.join(new, _RANGE, "full_outer"), "checksums")
        differing = pairs.where(~F.col("old").eqNullSafe(F.col("new")))
        compared = pairs.count()
        count, rows, first, last = differing.agg(
            F.count(F.lit(1)), F.sum(F.greatest(F.coalesce("old.n", F.lit(0)), F.coalesce("new.n", F.lit(0)))),
            F.min(_RANGE), F.max(_RANGE)).first()
        levels.append((compared, count))
        if count > MOST_RANGES:
            break
        if not count:
            live = [df.where(F.lit(False)) for df in live]
            break
        if by_value:  # bounds that reach the scan
            edges = [low + first * width, low + (last + 1) * width]
            live = [df.where((value >= F.lit(edges[0])) & (value < F.lit(edges[1]))) for df in live]
        live = [_inside(df, differing.select(_RANGE), width) for df in live]
        if width == 1 or rows <= leaf_rows * count:
            break
    narrowed = [df.drop(_PLACE).unionByName(rest) for df, rest in zip(live, unkeyed)]
    return Narrowed(*narrowed, levels)


def changes_by_checksum(prev: DataFrame, curr: DataFrame, keys: list[str], fanout: int = FANOUT,
                        leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """As ``table_changes``; only rows of differing ranges are shuffled. For snapshots of which little differs."""
    found = differing_rows(prev, curr, keys, fanout, leaf_rows)
    return table_changes(found.prev, found.curr, keys)
