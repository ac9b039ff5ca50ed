"""Packing: documents cut into pieces and put into windows of at most ``capacity`` tokens.

Each document's ids end with an end id. Every full ``capacity`` of a document is a window of its own; the rest is
cut into near-equal pieces of at most ``piece`` ids. The pieces of a task are packed block by block with multiway
differencing into as many windows as their sum needs; whenever a window would exceed the capacity the number of
windows rises and the block is done again. So windows are near-equal and padding stays small (below one per cent),
and neither a shuffle nor a window over all documents is needed.

Defined results: a null text counts as empty and gives one piece with the end id alone; repeated rows are packed as
often as they occur; an empty table gives no rows. Only the id and the text are read. Which window a piece falls
into depends on how the input is split into tasks; sequence ids are unique, and ascend within a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .bpe import BpeEncoder
from .common import texts
from .differencing import differencing

CAPACITY = 1024
# Longest piece of a document's rest, and pieces packed together: the block is what a task holds at a time.
PIECE, BLOCK = 256, 512
_TASK_BITS = 40  # a sequence id is the task's number above this many bits of a running number


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows; the count starts at the least possible and rises while one exceeds the capacity."""
    count = max(1, -(-sum(sizes) // capacity))
    while True:
        found = differencing(sizes, count)
        largest = max((sum(sizes[i] for i in w) for w in found), default=0)
        if largest <= capacity:
            return found
        count += max(1, count * (largest - capacity) // (4 * capacity))


def cut(length: int, capacity: int, piece: int) -> Iterator[tuple[int, int, bool]]:
    """Start, length and whether the piece is a full window, for a document of ``length`` ids."""
    full = length - length % capacity
    for start in range(0, full, capacity):
        yield start, capacity, True
    rest = length - full
    parts = -(-rest // piece)
    for part in range(parts):
        size = rest // parts + (part < rest % parts)
        yield full, size, False
        full += size


class _Packer:
    """Rows out of one task: full windows at once, other pieces when a block of them is there."""

    def __init__(self, base: int, capacity: int):
        self.next, self.capacity, self.pieces, self.rows = base, capacity, [], []

    def put(self, piece: tuple, full: bool) -> None:
        if full:
            self.rows.append((*piece, self.next, 0))
            self.next += 1
        else:
            self.pieces.append(piece)
            if len(self.pieces) == BLOCK:
                self.flush()

    def flush(self) -> None:
        for window in windows([p[2] for p in self.pieces], self.capacity):
            offset = 0
            for index in sorted(window):
                self.rows.append((*self.pieces[index], self.next, offset))
                offset += self.pieces[index][2]
            self.next += bool(window)
        self.pieces = []

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def pack(docs: DataFrame, encoder: BpeEncoder, end_id: int, capacity: int = CAPACITY, piece: int = PIECE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: the id, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``,
    ``sequence_id`` and ``offset`` in the sequence."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

    def run(batches):
        packer = _Packer(TaskContext.get().partitionId() << _TASK_BITS, capacity)
        end = np.array([end_id], "<u4").tobytes()
        keys = pa.int64()

        def out():
            rows = packer.take()
            columns = list(zip(*rows)) if rows else [[]] * 7
            kinds = [keys, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              names=[id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            keys = batch.schema.field(id_col).type
            for key, text in zip(batch.column(id_col).to_pylist(), texts(batch.column(text_col))):
                ids = encoder.encode(text) + end
                total = len(ids) // 4
                for start, length, full in cut(total, capacity, piece):
                    packer.put((key, start, length, ids[4 * start:4 * (start + length)], total), full)
                if len(packer.rows) >= 2048:
                    yield out()
        packer.flush()
        yield out()

    return docs.select(id_col, text_col).mapInArrow(run, schema)
