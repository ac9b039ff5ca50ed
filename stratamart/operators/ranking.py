"""Global order without a single-task window: row index, rank, ntile and share of total.

An unpartitioned window sorts the whole input in one task. Here the input is range-partitioned on the
sort keys, each slice numbers its own rows, and slice offsets (one number per slice) make the numbering
global. The numbered slices are written before any second pass, so every pass sees one numbering.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from ..session import stage
from .ordering import SortKey, asc, sorts_at_or_after

_POSITION_BITS = 33  # monotonically_increasing_id keeps the row position in its low 33 bits


def ordered_slices(df: DataFrame, keys: list[SortKey], slices: int | None = None) -> DataFrame:
    """``df`` written in range slices of the sort order, with ``_slice`` and 0-based ``_pos`` in it."""
    spark = df.sparkSession
    count = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [k.column() for k in keys]
    numbered = (
        df.repartitionByRange(count, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    return _split_id(stage(numbered, "slices"))


def _split_id(numbered: DataFrame) -> DataFrame:
    return (
        numbered.withColumn("_slice", F.shiftright("_id", _POSITION_BITS))
        .withColumn("_pos", F.col("_id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
        .drop("_id")
    )


def slice_offsets(sliced: DataFrame, weight: Column | None = None) -> DataFrame:
    """Total weight (default: rows) of all earlier slices; one row per slice."""
    totals = sliced.groupBy("_slice").agg(
        (F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("_total")
    )
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("_slice", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))


def with_row_index(df: DataFrame, keys: list[SortKey], out: str, start: int = 0,
                   slices: int | None = None) -> DataFrame:
    """Dense numbering ``start + 1 ..`` in sort order. The keys must identify a row."""
    return dense_number(ordered_slices(df, keys, slices), start).withColumnRenamed("_number", out)


def dense_number(numbered: DataFrame, start: int = 0) -> DataFrame:
    """``_number``: ``start + 1 ..`` over the slices of a numbered table."""
    # One row per written slice, so the offsets are a safe broadcast.
    return (
        numbered.join(F.broadcast(slice_offsets(numbered)), "_slice")
        .withColumn("_number", F.col("_offset") + F.col("_pos") + F.lit(start + 1))
        .drop("_slice", "_pos", "_offset")
    )


def with_surrogate_key(df: DataFrame, name: str, order_by: list[str], start: int = 0) -> DataFrame:
    """Autoincrement-style key for new rows, in business-key order after ``start``."""
    keyed = with_row_index(df, [asc(c) for c in order_by], name, start)
    return keyed.select(name, *df.columns)


def global_ranks(df: DataFrame, order: list[SortKey], ranks: dict[str, tuple[str, ...]], staged: bool = False) -> DataFrame:
    """RANK in the given order, for each new column inside the groups it names (none: over the whole input),
    whatever the group sizes.

    Rows are first reduced to counts per distinct key, so a value shared by a third of the rows is one
    row of the running count; all ranks are put side by side on these and joined back by value, so that the whole rows
    are shuffled once however many ranks there are.
    """
    rows = df if staged else stage(df, "rank")
    names = [k.name for k in order]
    every = list(dict.fromkeys([*(g for within in ranks.values() for g in within), *names]))
    counts = rows.groupBy(*every).agg(F.count(F.lit(1)).alias("_n"))
    if len(ranks) > 1:
        counts = stage(counts, "rank-counts")
    values = None
    # The finest rank first: it has every key already.
    for name, within in sorted(ranks.items(), key=lambda item: -len({*item[1], *names})):
        found = _rank_values(counts, order, name, list(within))
        if values is None:
            values = found if {*within, *names} == set(every) else _join_null_safe(counts.drop("_n"), found, [*within, *names])
        else:
            values = _join_null_safe(values, found, [*within, *names])
    return _join_null_safe(rows, values, every).select(*rows.columns, *ranks)


def global_rank(df: DataFrame, order: list[SortKey], out: str, within: tuple[str, ...] = (), staged: bool = False) -> DataFrame:
    return global_ranks(df, order, {out: within}, staged)


def _rank_values(counts: DataFrame, order: list[SortKey], out: str, group: list[str]) -> DataFrame:
    """A row per group and distinct key, with its rank, from the row counts ``_n`` of keys at least as fine.

    Each slice of the sort order counts, in one pass, the rows before each key in its group there. Only the first group of
    a slice can have begun in earlier ones: their rows of it are added, one number per slice.
    """
    spark = counts.sparkSession
    keys = list(dict.fromkeys([*group, *(k.name for k in order)]))
    distinct = counts.groupBy(*keys).agg(F.sum("_n").alias("_n"))
    by = [*(asc(g).column() for g in group), *(k.column() for k in order)]
    dealt = distinct.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *by).sortWithinPartitions(*by)
    schema = T.StructType([*dealt.schema.fields, T.StructField("_slice", T.IntegerType()), T.StructField("_place", T.LongType()),
                           T.StructField("_before", T.LongType()), T.StructField("_first", T.BooleanType())])
    numbered = stage(dealt.mapInArrow(_counted_in_slice(group), schema), "rank-slices")

    same = F.struct(*group) if group else F.struct(F.lit(0))
    # One row per written slice, at most spark.sql.shuffle.partitions.
    slices = stage(numbered.groupBy("_slice").agg(
        F.min_by(same, "_place").alias("_from"),
        F.max_by(F.struct(same.alias("g"), (F.col("_before") + F.col("_n")).alias("n")), "_place").alias("_end")), "rank-ends")
    earlier = slices.select(F.col("_slice").alias("_earlier"), F.col("_end.g").alias("_open"), F.col("_end.n").alias("_rows"))
    carried = slices.join(earlier, (F.col("_earlier") < F.col("_slice")) & F.col("_open").eqNullSafe(F.col("_from")), "left")
    carried = carried.groupBy("_slice").agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("_carried"))
    before = F.col("_before") + F.when(F.col("_first"), F.col("_carried")).otherwise(0)
    return numbered.join(F.broadcast(carried), "_slice").select(*keys, (before + 1).alias(out))


def _counted_in_slice(group: list[str]):
    """For ``mapInArrow`` over sorted rows with counts ``_n``: slice, place in it, rows before in the slice's part of the
    group, and whether that is the slice's first group."""
    def run(batches):
        part, place, before, first, last = TaskContext.get().partitionId(), 0, 0, True, None
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            changed = np.zeros(size, bool)
            for name in group:
                column = batch.column(name)
                if last is None:
                    changed[1:] |= _changes(column)
                else:
                    changed |= _changes(pa.concat_arrays([last.column(name), column]))
            n = batch.column("_n").to_numpy()
            so_far = before + np.cumsum(n) - n
            counted = so_far - np.maximum.accumulate(np.where(changed, so_far, 0))
            of_first = ~np.logical_or.accumulate(changed) & first
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(size, part, np.int32)), pa.array(np.arange(place, place + size)),
                 pa.array(counted), pa.array(of_first)],
                names=[*batch.schema.names, "_slice", "_place", "_before", "_first"])
            place, before, first, last = place + size, int(counted[-1] + n[-1]), bool(of_first[-1]), batch.slice(size - 1, 1)

    return run


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before it, as Spark groups: nulls are alike, NaN too."""
    if pa.types.is_nested(column.type):
        values = column.to_pylist()
        return np.array([a != b for a, b in zip(values, values[1:])], bool)
    old, new = column.slice(0, len(column) - 1), column.slice(1)
    differs = pc.or_(pc.fill_null(pc.not_equal(old, new), False), pc.xor(pc.is_null(old), pc.is_null(new)))
    if pa.types.is_floating(column.type):
        nan = pc.and_(pc.fill_null(pc.is_nan(old), False), pc.fill_null(pc.is_nan(new), False))
        differs = pc.and_not(differs, nan)
    return differs.to_numpy(zero_copy_only=False)


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(right, match, "left").drop(*(f"_r_{k}" for k in keys))


def ntile_starts(rows: int, k: int) -> list[int]:
    """0-based positions where tiles 2..k begin; the first ``rows % k`` tiles hold one row more."""
    base, extra = divmod(rows, k)
    starts = [tile * base + min(tile, extra) for tile in range(1, k)]
    return [s for s in starts if s < rows]


def ntile_cuts(df: DataFrame, k: int, keys: list[SortKey], accuracy: int = 10_000) -> list[tuple]:
    """Exact sort-key tuples of the first row of tiles 2..k. The keys must identify a row.

    A quantile sketch of the first key gives a bracket round each cut, counts show how many rows lie before and in it, and
    only rows of brackets are sorted: a few of ``accuracy`` shares a cut, and whole runs of a tied value. All rows are
    sorted where the first key has no quantiles (text) or a bracket misses its cut.
    What reaches the driver: counts, two values a cut, and at most ``k - 1`` rows.
    """
    rows = df.select(*(key.name for key in keys))
    sizes = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(keys[0].name).isNull()).alias("nulls")).first()
    starts = ntile_starts(sizes["rows"], k)
    if not starts:
        return []
    if isinstance(rows.schema[keys[0].name].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        spans = _cut_spans(rows, keys[0], starts, sizes["rows"] - sizes["nulls"], sizes["nulls"], accuracy)
        inside, places = _in_spans(rows, keys[0], starts, spans)
        if inside is not None:
            return _rows_at(inside, keys, places)
    return _rows_at(rows, keys, starts)


Span = tuple[object, object]


def _cut_spans(rows: DataFrame, key: SortKey, starts: list[int], valued: int, nulls: int, accuracy: int) -> list[Span]:
    """For each position the first and last key value, in sort order, between which its row should lie."""
    slack = 2 * valued // accuracy + 1
    shares: list[tuple[float, float] | None] = []
    for start in starts:
        place = start - nulls if key.descending else start
        if not 0 <= place < valued:
            shares.append(None)
            continue
        rising = valued - 1 - place if key.descending else place
        shares.append((max(0, rising - slack) / valued, min(valued, rising + 1 + slack) / valued))
    wanted = [share for pair in shares if pair for share in pair]
    if not wanted:
        return [(None, None)] * len(starts)
    found = iter(rows.agg(F.percentile_approx(key.name, wanted, accuracy)).first()[0])
    spans: list[Span] = []
    for pair in shares:
        low, high = (next(found), next(found)) if pair else (None, None)
        spans.append((high, low) if key.descending else (low, high))
    return spans


def _in_spans(rows: DataFrame, key: SortKey, starts: list[int], spans: list[Span]) -> tuple[DataFrame | None, list[int]]:
    """The rows inside the spans, and where the positions lie among them; no rows if a span misses its position
    or ends at NaN, which does not compare."""
    if any(value != value for span in spans for value in span):
        return None, starts
    merged: list[Span] = []
    for low, high in spans:
        touches = merged and ((low is None) == (merged[-1][1] is None)) and (
            low is None or (low >= merged[-1][1] if key.descending else low <= merged[-1][1]))
        if touches:
            merged[-1] = (merged[-1][0], high)
        else:
            merged.append((low, high))
    inside = [(key.sorts_after(low) | key.ties(low)) & ~key.sorts_after(high) for low, high in merged]
    counts = rows.agg(
        *(F.count_if(~(key.sorts_after(low) | key.ties(low))).alias(f"before{i}") for i, (low, _) in enumerate(merged)),
        *(F.count_if(c).alias(f"inside{i}") for i, c in enumerate(inside)),
    ).first()
    places, kept = [], 0
    for i in range(len(merged)):
        before, size = counts[f"before{i}"], counts[f"inside{i}"]
        places += [start - before + kept for start in starts if before <= start < before + size]
        kept += size
    if len(places) != len(starts):
        return None, starts
    return rows.where(reduce(Column.__or__, inside)), places


def _rows_at(rows: DataFrame, keys: list[SortKey], positions: list[int]) -> list[tuple]:
    """Key tuples of the rows at 0-based positions of the sort order, which rise."""
    names = [key.name for key in keys]
    sliced = ordered_slices(rows, keys)
    sizes = sorted((r["_slice"], r["count"]) for r in sliced.groupBy("_slice").count().collect())
    wanted = []
    offset = 0
    for slice_id, n in sizes:
        wanted += [(slice_id, p - offset) for p in positions if offset <= p < offset + n]
        offset += n
    hit = F.lit(False)
    for slice_id, pos in wanted:
        hit = hit | ((F.col("_slice") == slice_id) & (F.col("_pos") == pos))
    found = {(r["_slice"], r["_pos"]): tuple(r[n] for n in names) for r in sliced.where(hit).collect()}
    return [found[w] for w in wanted]


def ntile_by_cuts(cuts: list[tuple], keys: list[SortKey]) -> Column:
    """Tile number of a row from the cut rows: a narrow projection, no shuffle and no join."""
    tile = F.lit(1)
    for cut in cuts:
        tile = tile + F.when(sorts_at_or_after(keys, cut), 1).otherwise(0)
    return tile.cast("long")


def global_ntile(df: DataFrame, k: int, keys: list[SortKey], out: str, staged: bool = False) -> DataFrame:
    """NTILE(k) over the whole input; end the keys with a unique column so that ties are settled."""
    rows = df if staged else stage(df, "ntile")
    return rows.withColumn(out, ntile_by_cuts(ntile_cuts(rows, k, keys), keys))


def pct_of_total(df: DataFrame, value: str, out: str, staged: bool = False) -> DataFrame:
    """Share of the grand total in percent, two decimals.

    ``df`` is a grouped result: it is written once, the total is a scalar subquery over it.
    """
    from ..functions.numeric import percent_of

    rows = df if staged else stage(df, "share")
    total = rows.agg(F.sum(value)).scalar()
    return rows.withColumn(out, percent_of(F.col(value), total))
