"""Tables laid out along a space-filling curve, so that filters on any one of several keys skip most files.

Each key's value becomes its place among quantile cuts (a few bits); the bits of all keys are interleaved and rows are
range-partitioned on the result. A file then spans a small stretch of every key, and Parquet's own minima and maxima
let a reader skip the others. With two keys and n files a filter on one value of a key meets about one to two times sqrt(n) of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

BITS = 6
_PREFIX_BYTES = 7  # of a text, behind what all texts share: fits a positive long


def _shared_length(low: str | None, high: str | None) -> int:
    """Bytes that the smallest and the greatest text, hence all texts between, start with."""
    a, b = (low or "").encode(), (high or "").encode()
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def _text_number(name: str, skip: int) -> Column:
    """A number that grows with the text's bytes behind the shared ones."""
    part = F.hex(F.substring(F.encode(F.col(name), "UTF-8"), skip + 1, _PREFIX_BYTES))
    return F.conv(F.rpad(part, 2 * _PREFIX_BYTES, "0"), 16, 10).cast("long")


def _numbers(df: DataFrame, keys: list[str]) -> dict[str, Column]:
    """Per key something quantiles can be taken of: the value, or a number for a text."""
    texts = [k for k in keys if isinstance(df.schema[k].dataType, T.StringType)]
    skip = {}
    if texts:
        ends = df.agg(*(f(k).alias(f"{side}{i}") for i, k in enumerate(texts) for side, f in (("low", F.min), ("high", F.max)))).first()
        skip = {k: _shared_length(ends[f"low{i}"], ends[f"high{i}"]) for i, k in enumerate(texts)}
    return {k: _text_number(k, skip[k]) if k in skip else F.col(k) for k in keys}


def _place(value: Column, cuts: list, low: int = 0, high: int | None = None) -> Column:
    """How many cuts are not above the value, by halving."""
    high = len(cuts) if high is None else high
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(value < F.lit(cuts[middle]), _place(value, cuts, low, middle)).otherwise(_place(value, cuts, middle + 1, high))


def with_curve_place(df: DataFrame, keys: list[str], out: str, bits: int = BITS) -> DataFrame:
    """``out``: a row's place on the curve. One aggregation finds the quantile cuts, at most ``2**bits - 1`` a key; texts
    need one more for their shared beginning. NULL is filed with the smallest values."""
    numbers = _numbers(df, keys)
    shares = [i / 2**bits for i in range(1, 2**bits)]
    found = df.agg(*(F.percentile_approx(c, shares).alias(f"c{i}") for i, c in enumerate(numbers.values()))).first()
    # In steps, so that numbers and ranks are computed once a row.
    steps = [f"{out}_{i}" for i in range(len(keys))]
    placed = df.withColumns(dict(zip(steps, numbers.values())))
    ranks = {
        # A value held by many rows fills several cuts; equal cuts are one.
        step: F.when(F.col(step).isNull(), F.lit(0)).otherwise(_place(F.col(step), sorted(set(found[f"c{i}"] or []))))
        for i, step in enumerate(steps)
    }
    place = F.lit(0).cast("long")
    for i, step in enumerate(steps):
        for bit in range(bits):
            one = F.shiftright(step, bit).bitwiseAND(F.lit(1)).cast("long")
            place = place.bitwiseOR(F.shiftleft(one, bit * len(keys) + i))
    return placed.withColumns(ranks).withColumn(out, place).drop(*steps)


def along_curve(df: DataFrame, keys: list[str], files: int, bits: int = BITS) -> DataFrame:
    """``df`` in ``files`` partitions along the curve. Rows alike in all keys are spread by a hash of the row, so that a
    pair of hot values fills several files; only whole copies of a row stay together. Column names that begin with
    ``_curve`` must be free."""
    if len(keys) * bits > 62:
        raise ValueError("too many keys for this number of bits")
    if any(c.startswith("_curve") for c in df.columns):
        raise ValueError("column names that begin with _curve are used here")
    spread = [f.name for f in df.schema if isinstance(f.dataType, (T.NumericType, T.StringType, T.DatetimeType, T.BooleanType))]
    placed = with_curve_place(df, keys, "_curve", bits)
    spread_out = F.xxhash64(*(F.col(f"`{c}`") for c in spread))
    return placed.repartitionByRange(files, "_curve", spread_out).sortWithinPartitions(*keys).drop("_curve")


def file_spans(stored: DataFrame, keys: list[str]) -> DataFrame:
    """Smallest and greatest value of each key per file, as a reader's file statistics have them."""
    ends = [f(k).alias(f"{side}_{k}") for k in keys for side, f in (("low", F.min), ("high", F.max))]
    return stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(*ends)


def files_met(spans: DataFrame, key: str, low: Column, high: Column) -> DataFrame:
    """One row: all files, and those that a filter ``key between low and high`` cannot skip."""
    met = (F.col(f"low_{key}") <= high) & (F.col(f"high_{key}") >= low)
    return spans.agg(F.count(F.lit(1)).alias("files"), F.count_if(met).alias("files_met"))
