"""Helpers shared by the text operators: Arrow batches in and out, bounded label samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

# Bytes of text that one vectorised step handles; one longer document is a step of its own.
GROUP_BYTES = 1 << 18


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def groups(offsets: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text, at least one row each."""
    rows, first = len(offsets) - 1, 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def texts(column: pa.Array) -> list[str]:
    return ["" if t is None else t for t in column.to_pylist()]


def unused(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_rows(docs: DataFrame, columns: list[str], schema: str,
             fn: Callable[[pa.RecordBatch], dict[str, object]]) -> DataFrame:
    """Run ``fn`` on Arrow batches of the named columns only, so other columns cannot clash.

    ``fn`` returns a value per output column of ``schema``.
    """
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v, pa.Array) else pa.array(v) for v in out.values()], names=list(out))

    return docs.select(*columns).mapInArrow(run, schema)


def filter_rows(docs: DataFrame, text: str, keep: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """Whole rows for which ``keep`` (a mask over the text column) holds; no shuffle, any other columns."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(keep(batch.column(text)), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def crc_mod(key: str | Column, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor``."""
    column = F.col(key) if isinstance(key, str) else key
    return F.crc32(column.cast("string").cast("binary")) % F.lit(divisor)


def bounded_ids(rows: DataFrame, key: str, bound: int) -> DataFrame:
    """At most ``bound`` different ids as ``_key``, chosen by a hash of the id; a repeated id counts once."""
    return bounded_labels(rows.select(F.col(key).alias("_key")), "_key", bound, once=True)


def bounded_labels(labels: DataFrame, key: str, bound: int, once: bool = False) -> DataFrame:
    """At most ``bound`` rows of ``labels``, chosen by a hash of the key, alike at every size.

    The threshold leaves about 1.2 times the bound, so that the sort sees a bounded input; the limit makes the
    bound hard. Rows with a null key are left out; repeated keys count as often as they occur, or ``once`` after the threshold.
    """
    spread = 1 << 30
    labels = labels.filter(F.col(key).isNotNull())
    total = labels.count()
    place = F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(spread))
    share = 1.0 if total == 0 else min(1.0, 1.2 * bound / total + 100.0 / total)
    chosen = labels.withColumn("_place", place).filter(F.col("_place") < F.lit(int(share * spread)))
    return (chosen.dropDuplicates([key]) if once else chosen).orderBy("_place", key).limit(bound).drop("_place")


def one_label(labels: DataFrame, key: str, *values: str) -> DataFrame:
    """One row per key: the largest of repeated labels; rows without a key or a label are left out."""
    rows = labels.select(key, *values).dropna()
    return rows.groupBy(key).agg(*[F.max(v).alias(v) for v in values])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))
