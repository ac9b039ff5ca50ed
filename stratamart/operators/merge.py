"""Keyed upsert: update matched rows, insert the others.

A stored table is a folder with one Parquet folder per run: ``full-<n>`` holds the whole table after an updating merge,
``add-<n>`` only the new rows of an insert-only one. A folder counts once Spark has put its ``_SUCCESS`` file there, so
a merge that fails leaves the table as it was and is simply run again. One writer at a time is assumed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from ..session import matching_paths, path_exists, remove_path, shuffles_freed, stage

ACTION = "_merge_action"


def latest_by_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key: the one greatest in ``order_by``.

    Asking for the first row only lets Spark keep one row per key and task before the shuffle, so a key
    that holds a large share of the rows does not gather in one task.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*(F.col(c).desc_nulls_last() for c in order_by))
    return df.withColumn("_n", F.row_number().over(newest_first)).where("_n = 1").drop("_n")


def repeated_hashes(df: DataFrame, keys: list[str], extra: Column | None = None) -> DataFrame:
    """Hashes (``_hash``) and rows (``_n``) of keys that occur more than once, written; with ``extra`` also those of rows where
    it holds, told by ``_extra``. Only hashes are shuffled. Two keys of one hash are both listed, so whoever uses them
    must look at the keys themselves."""
    held = F.lit(False) if extra is None else extra
    counted = df.groupBy(F.xxhash64(*keys).alias("_hash"), held.alias("_extra")).agg(F.count(F.lit(1)).alias("_n"))
    return stage(counted.where("_n > 1 or _extra"), "repeated")


def settle_repeated(df: DataFrame, keys: list[str], repeated: DataFrame, settle: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``df`` with ``settle`` applied to the rows whose key hash is listed; the others pass without a shuffle while the list is
    small enough to be broadcast (it is written, so Spark knows), and are not even looked up when it is empty."""
    if repeated.isEmpty():
        return df
    listed = repeated.select(F.col("_hash").alias("_listed"))
    same = F.xxhash64(*keys) == F.col("_listed")
    return df.join(listed, same, "left_anti").unionByName(settle(df.join(listed, same, "left_semi")))


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str],
                 insert_cols: list[str] | None = None, on_update: dict[str, Column] | None = None,
                 on_insert: dict[str, Column] | None = None, order_by: list[str] | None = None,
                 with_action: bool = False) -> DataFrame:
    """Target after the merge, in the target's columns.

    Matched rows take ``update_cols`` from the source, unmatched source rows are inserted with
    ``insert_cols`` (default: every source column); ``on_update`` / ``on_insert`` set further columns.
    Duplicate source keys are settled by ``order_by`` (latest wins). Rows without a key are not merged.
    Both sides hold one row per key at the join, so no key can be hot there.
    """
    insert_cols = insert_cols or [c for c in source.columns if c in target.columns]
    on_update, on_insert = on_update or {}, on_insert or {}
    for k in keys:
        source = source.where(F.col(k).isNotNull())
    if order_by:
        source = latest_by_key(source, keys, order_by)

    needed = list(dict.fromkeys(keys + update_cols + insert_cols))
    src = source.select(*(F.col(c).alias(f"_s_{c}") for c in needed), F.lit(True).alias("_in_source"))
    tgt = target.withColumn("_in_target", F.lit(True))
    match = F.lit(True)
    for k in keys:
        match = match & (F.col(k) == F.col(f"_s_{k}"))
    joined = tgt.join(src, match, "full_outer")
    in_source = F.coalesce(F.col("_in_source"), F.lit(False))
    in_target = F.coalesce(F.col("_in_target"), F.lit(False))

    def value(name: str) -> Column:
        kind = target.schema[name].dataType
        kept, new = F.col(name), F.col(f"_s_{name}")
        inserted = new if name in insert_cols or name in keys else F.lit(None)
        inserted = on_insert.get(name, inserted)
        updated = new if name in update_cols else kept
        updated = on_update.get(name, updated)
        return (
            F.when(~in_target, inserted.cast(kind)).when(in_source, updated.cast(kind)).otherwise(kept).alias(name)
        )

    columns = [value(c) for c in target.columns]
    if with_action:
        action = F.when(~in_target, "inserted").when(in_source, "updated").otherwise("kept")
        columns.append(action.alias(ACTION))
    return joined.select(*columns)


@dataclass(frozen=True)
class MergeCounts:
    inserted: int
    updated: int
    #: rows without a whole key of the table's types, kept in the run's folder below ``unkeyed``
    unkeyed: int = 0

    def message(self, what: str) -> str:
        return f"Processed {self.inserted + self.updated} {what} records"


def table_exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path)


def _finished_runs(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and name of every run folder that was written to its end, oldest first."""
    names = [p.rsplit("/", 2)[1] for p in matching_paths(spark, f"{path}/*-*/_SUCCESS")]
    return sorted((int(name.split("-")[1]), name) for name in names)


def _current(runs: list[tuple[int, str]]) -> list[str]:
    """The newest whole table and what was added to it since."""
    start = max((i for i, (_, name) in enumerate(runs) if name.startswith("full-")), default=0)
    return [name for _, name in runs[start:]]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table after its last finished merge; a Parquet folder without runs is read as it is."""
    names = _current(_finished_runs(spark, path))
    return spark.read.parquet(*(f"{path}/{name}" for name in names)) if names else spark.read.parquet(path)


def _remove_superseded(spark: SparkSession, path: str, runs: list[tuple[int, str]]) -> None:
    """Delete folders older than the state that was read."""
    for _, name in runs:
        if name not in _current(runs):
            remove_path(spark, f"{path}/{name}")


def _write_run(df: DataFrame, path: str, name: str, cluster_by: list[str] | None) -> None:
    """Rows are sorted by the cluster columns inside each file, so filters on them skip row groups."""
    ordered = df.sortWithinPartitions(*cluster_by) if cluster_by else df
    with shuffles_freed(df.sparkSession):
        ordered.write.mode("overwrite").parquet(f"{path}/{name}", compression="zstd")


def rewrite_table(spark: SparkSession, path: str, arrange: Callable[[DataFrame], DataFrame]) -> None:
    """The same rows as one run in another layout, in place of the runs so far; they go with the next rewrite.

    A reader that began before goes on with the older folders. A rewrite that fails leaves the table as it was.
    """
    runs = _finished_runs(spark, path)
    if not runs:
        raise ValueError(f"{path} has no finished runs")
    _write_run(arrange(read_table(spark, path)), path, f"full-{runs[-1][0] + 1:08d}", None)
    _remove_superseded(spark, path, runs)


def _set_aside(source: DataFrame, whole_key: Column, keys: list[str], path: str, repeated: DataFrame | None) -> int:
    """Write the rows without a whole key below the run's number, so that a run that is repeated writes them over its own; how
    many. Where the counted keys show none, the source is not read for them."""
    odd = source.where(~whole_key).select(
        *(F.col(c).cast("string").alias(c) if c in keys else F.col(c) for c in source.columns))
    if repeated is not None and repeated.where("_extra").isEmpty():
        odd.limit(0).write.mode("overwrite").parquet(path)
        return 0
    seen = Observation()
    odd.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def merge_into_path(path: str, source: DataFrame, keys: list[str], update_cols: list[str],
                    insert_cols: list[str] | None = None, on_update: dict[str, Column] | None = None,
                    on_insert: dict[str, Column] | None = None, order_by: list[str] | None = None,
                    surrogate: str | None = None, cluster_by: list[str] | None = None) -> MergeCounts:
    """Merge into a stored table; the first merge makes it.

    Source keys are cast to the stored types. Rows without a whole key (or with one that cannot be cast) are kept
    below ``unkeyed`` and counted. An updating merge is one join and one write of the whole table; folders older than
    the state it read are deleted. With nothing to update, only stored keys are read and only new rows are written.
    The surrogate key grows from run to run with gaps: it is given in the task that writes the row, as the task's own
    range plus the place there.
    """
    spark = source.sparkSession
    runs = _finished_runs(spark, path)
    target = read_table(spark, path) if runs else None
    if target is not None:
        if absent := [k for k in keys if k not in target.columns]:
            raise ValueError(f"{path} has no key columns {absent}")
        kinds = {k: target.schema[k].dataType for k in keys}
        source = source.withColumns({k: F.col(k).try_cast(kind) for k, kind in kinds.items()
                                     if source.schema[k].dataType != kind})
    number = runs[-1][0] + 1 if runs else 1
    columns, on_update, on_insert = source.columns, on_update or {}, on_insert or {}
    insert_cols = insert_cols or columns
    whole_key = F.lit(True)
    for k in keys:
        whole_key = whole_key & F.col(k).isNotNull()

    # Most keys come once: with them counted by hash, only rows of repeated keys are shuffled whole.
    repeated = repeated_hashes(source, keys, ~whole_key) if order_by else None
    unkeyed = _set_aside(source, whole_key, keys, f"{path}/unkeyed/run={number}", repeated)
    source = source.where(whole_key)
    if order_by:
        source = settle_repeated(source, keys, repeated.where("not _extra"), lambda rows: latest_by_key(rows, keys, order_by))
    written = Observation()
    if surrogate:
        top = target.agg(F.max(surrogate)).scalar() if target is not None else F.lit(0)
        on_insert = {surrogate: F.coalesce(top, F.lit(0)) + F.monotonically_increasing_id() + 1, **on_insert}

    if target is not None and (update_cols or on_update):
        merged = merge_upsert(target, source, keys, update_cols, [c for c in insert_cols if c in target.columns],
                              on_update, on_insert, with_action=True)
        merged = merged.observe(written, F.count_if(F.col(ACTION) == "inserted").alias("inserted"),
                                F.count_if(F.col(ACTION) == "updated").alias("updated"))
        _write_run(merged.drop(ACTION), path, f"full-{number:08d}", cluster_by)
        _remove_superseded(spark, path, runs)
        return MergeCounts(written.get["inserted"], written.get["updated"], unkeyed)

    fresh = source if target is None else source.join(target.select(*keys), keys, "left_anti")
    lead = [surrogate] if surrogate else []
    fresh = fresh.select(*insert_cols).withColumns(on_insert).select(
        *lead, *insert_cols, *(c for c in on_insert if c not in (*lead, *insert_cols)))
    if target is not None:
        fresh = fresh.select(*target.columns)
    kind = "full" if target is None else "add"
    _write_run(fresh.observe(written, F.count(F.lit(1)).alias("inserted")), path, f"{kind}-{number:08d}", cluster_by)
    return MergeCounts(written.get["inserted"], 0, unkeyed)
