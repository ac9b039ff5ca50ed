"""Token-id files: flat unsigned integers and 64-bit document offsets, read back through a memory map.

The documents are range-partitioned by id, so the shards in order hold all documents in ascending order (equal
ids by text). A shard is three flat little-endian files: ``.bin`` with ids (16-bit if the vocabulary fits, else
32-bit), ``.idx`` with n + 1 offsets counted in ids (64-bit) and ``.key`` with the documents' keys (64-bit). A
task writes under a name of its own; only names in the manifest, which Spark commits, belong to the result, so a
repeated or lost task leaves nothing behind that is read. A shard's base is the sum of all ids in earlier shards.

Defined results: a null text counts as empty and has the end id alone; a null key sorts first; repeated rows are
written as often as they occur; an empty table gives no rows and an empty manifest.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..session import scratch_path, stage
from .bpe import BpeEncoder
from .common import texts

NULL_KEY = -(1 << 63)
MANIFEST = "shard int, stem string, width int, documents long, tokens long"


def _store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def write(docs: DataFrame, encoder: BpeEncoder, end_id: int, folder: str | None = None, id_col: str = "doc_id",
          text_col: str = "text", shards: int | None = None) -> DataFrame:
    """Write all documents below ``folder`` (default: the shared folder); the manifest, one row a shard with ``base``."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    wide = "<u2" if max(encoder.vocabulary(), end_id + 1) <= 1 << 16 else "<u4"

    def run(batches):
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        shard = TaskContext.get().partitionId()
        stem = f"shard-{shard:06d}-{uuid.uuid4().hex}"
        tail = np.array([end_id], "<u4").tobytes()
        offsets, total = [0], 0
        with store.open_output_stream(f"{base}/{stem}.bin") as ids, store.open_output_stream(f"{base}/{stem}.key") as keys:
            for batch in batches:
                key = batch.column(id_col).cast(pa.int64()).fill_null(NULL_KEY)
                keys.write(np.asarray(key).astype("<i8").tobytes())
                for text in texts(batch.column(text_col)):
                    found = np.frombuffer(encoder.encode(text) + tail, "<u4")
                    ids.write(found.astype(wide).tobytes())
                    total += len(found)
                    offsets.append(total)
        with store.open_output_stream(f"{base}/{stem}.idx") as index:
            index.write(np.array(offsets, "<u8").tobytes())
        if total:
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "stem": [f"{folder.rstrip('/')}/{stem}"],
                "width": pa.array([int(wide[-1])], pa.int32()), "documents": [len(offsets) - 1], "tokens": [total]})

    written = (docs.select(id_col, text_col).repartitionByRange(shards, id_col)
               .sortWithinPartitions(id_col, text_col).mapInArrow(run, MANIFEST))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    return stage(written, "manifest").withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


class Shard:
    """One shard's files, mapped where the store is a local or mounted folder, else read whole files' parts."""

    def __init__(self, stem: str, width: int):
        store, base = _store(stem)
        self.keys = np.frombuffer(self._whole(store, base + ".key"), "<i8")
        self.offsets = np.frombuffer(self._whole(store, base + ".idx"), "<u8").astype(np.int64)
        self.kind, self.mapped, self.file = np.dtype(f"<u{width}"), None, None
        if store.type_name == "local":
            self.mapped = np.memmap(base + ".bin", self.kind, "r")
        else:
            self.file = store.open_input_file(base + ".bin")

    @staticmethod
    def _whole(store, path: str) -> bytes:
        with store.open_input_file(path) as file:
            return file.read()

    def ids(self, row: int) -> np.ndarray:
        first, last = int(self.offsets[row]), int(self.offsets[row + 1])
        if self.mapped is not None:
            return self.mapped[first:last]
        self.file.seek(first * self.kind.itemsize)
        return np.frombuffer(self.file.read((last - first) * self.kind.itemsize), self.kind)


def read(manifest: DataFrame, finish, schema: str, rows: int = 4096) -> DataFrame:
    """Read every document back, shard by shard. ``finish`` turns (key or None, start, ids) into an output row."""
    def run(batches):
        for batch in batches:
            for entry in batch.to_pylist():
                shard = Shard(entry["stem"], entry["width"])
                for first in range(0, len(shard.keys), rows):
                    out = []
                    for row in range(first, min(first + rows, len(shard.keys))):
                        key = int(shard.keys[row])
                        out.append(finish(None if key == NULL_KEY else key,
                                          entry["base"] + int(shard.offsets[row]), shard.ids(row)))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)

    names = [part.split()[0] for part in schema.split(",")]
    spread = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(spread, "shard").mapInArrow(run, schema)
