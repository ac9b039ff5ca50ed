"""First deliveries of events by keyed state with a watermark, without a join with the stored table.

An event is its id and event time; a copy carries both. The watermark runs on the arrival time, not on the event time, so
that a late event is never dropped by it. Three kinds of arrival are told apart by event time ``e`` and arrival ``a``:

* on time (``a - horizon < e <= a``): any earlier copy came within the horizon, so the state still knows it. State rows
  are evicted by the watermark's timers, so the state holds the events of at most two horizons, whatever the table's size;
* late (older, or without event time) and early (``e > a``, a sender's clock ahead): few rows, compared with the stored
  events of their own span of event times only;
* without id: set aside as they come.

Nothing is dropped: a row that arrives with an arrival time before the newest stored one takes the late way.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.merge import table_exists
from .incremental import incremental

ON_TIME, LATE, EARLY, UNKEYED = "on_time", "late", "early", "unkeyed"
_KEPT = (ON_TIME, LATE, EARLY)
ARRIVED = "_arrived_at"
_NOTES = ("_batch", "_stored_kind")


@dataclass(frozen=True)
class StateReport:
    #: events the state holds after the run
    state_rows: int
    #: repeats that the state caught
    repeats: int


def _read(spark: SparkSession, target: str, kinds: tuple[str, ...]) -> DataFrame | None:
    parts = [
        spark.read.parquet(f"{target}/{kind}").withColumn("_stored_kind", F.lit(kind))
        for kind in kinds if table_exists(spark, f"{target}/{kind}")
    ]
    return reduce(DataFrame.unionByName, parts) if parts else None


def read_events(spark: SparkSession, target: str) -> DataFrame:
    """The events stored so far, each once, with their arrival time."""
    return _read(spark, target, _KEPT).drop(*_NOTES)


def read_unkeyed(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/{UNKEYED}").drop("_batch")


def _write(df: DataFrame, target: str, kind: str, batch_id: int, time: str) -> None:
    # Files sorted by event time: a later look-up of a span of time skips the others by their statistics.
    df.sortWithinPartitions(time).write.mode("overwrite").parquet(f"{target}/{kind}/_batch={batch_id}")


def _unknown(new: DataFrame, known: DataFrame, key: str, time: str) -> DataFrame:
    same = (F.col(f"n.{key}") == F.col(f"o.{key}")) & F.col(f"n.{time}").eqNullSafe(F.col(f"o.{time}"))
    return new.alias("n").join(known.select(key, time).alias("o"), same, "left_anti")


def _one_copy(df: DataFrame, key: str, time: str) -> DataFrame:
    """The first arrival of each event; max_by style aggregation, so a hot event is one row per task before the shuffle."""
    row = F.struct(ARRIVED, *(c for c in df.columns if c != ARRIVED))
    first = df.groupBy(F.col(key).alias("_known_key"), F.col(time).alias("_known_time")).agg(F.min_by(row, ARRIVED).alias("_event_row"))
    return first.select(*(F.col("_event_row").getField(c).alias(c) for c in df.columns))


def first_deliveries(stream: DataFrame, target: str, checkpoint: str, key: str, time: str,
                     arrived: str | None = None, horizon: str = "7 days") -> StateReport:
    """Process everything unread of a file stream; each event is stored below ``target`` once, as first delivered.

    ``arrived`` names the column with the arrival time (default: the clock of the micro-batch, which never goes
    back). Of copies in one micro-batch any one is kept on time, the first arrival otherwise. A replayed batch overwrites
    its own folder. Rows of an event that repeats without end pass one task one by one, with one row of state. An
    empty stream stores nothing; the names ``_arrived_at``, ``_batch`` and ``_stored_kind`` must be free. The files of the finished run are in the ledger of ``checkpoint``.
    """
    spark = stream.sparkSession
    if taken := {ARRIVED, *_NOTES} & set(stream.columns):
        raise ValueError(f"column names {sorted(taken)} are used here")
    arrival = F.col(arrived).cast("timestamp") if arrived else F.current_timestamp()
    rows = stream.withColumn(ARRIVED, arrival)
    span = F.expr(f"interval {horizon}")
    e, a = F.col(time).cast("timestamp"), F.col(ARRIVED)
    stored = _read(spark, target, _KEPT)
    newest = stored.agg(F.max(ARRIVED).cast("string")).first()[0] if stored is not None else None
    on_time = F.col(key).isNotNull() & (e > a - span) & (e <= a)
    if newest is not None:
        on_time = on_time & (a >= F.lit(newest).cast("timestamp"))
    on_time = F.coalesce(on_time, F.lit(False))

    report = _run_on_time(rows.where(on_time), target, f"{checkpoint}-state", key, time, horizon)
    incremental(rows.where(~on_time), checkpoint, _keep_rest(target, key, time, e > a), staged=True).awaitTermination()
    return report


def _run_on_time(rows: DataFrame, target: str, checkpoint: str, key: str, time: str, horizon: str) -> StateReport:
    def keep(batch: DataFrame, batch_id: int) -> None:
        # What came early is not in the state when a copy comes on time.
        early = _read(batch.sparkSession, target, (EARLY,))
        _write(batch if early is None else _unknown(batch, early, key, time), target, ON_TIME, batch_id, time)

    firsts = rows.withWatermark(ARRIVED, horizon).dropDuplicatesWithinWatermark([key, time])
    query = (firsts.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    operators = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    if lost := sum(o["numRowsDroppedByWatermark"] for o in operators):
        raise RuntimeError(f"{lost} rows arrived over {horizon} out of order between files of one run")
    return StateReport(
        operators[-1]["numRowsTotal"] if operators else 0,
        sum(o["customMetrics"].get("numDroppedDuplicateRows", 0) for o in operators),
    )


def _keep_rest(target: str, key: str, time: str, is_early: Column):
    def keep(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _write(batch.where(F.col(key).isNull()), target, UNKEYED, batch_id, time)
        new = _one_copy(batch.where(F.col(key).isNotNull()), key, time)
        low, high = batch.agg(F.min(time).cast("string"), F.max(time).cast("string")).first()
        known = _read(spark, target, _KEPT)
        if known is not None:
            kind = batch.schema[time].dataType
            in_span = F.col(time).between(F.lit(low).cast(kind), F.lit(high).cast(kind)) if low else F.lit(False)
            own = F.col("_stored_kind").isin(LATE, EARLY) & (F.col("_batch") == batch_id)
            new = _unknown(new, known.where((in_span | F.col(time).isNull()) & ~own), key, time)
        early = F.coalesce(is_early, F.lit(False))
        _write(new.where(~early), target, LATE, batch_id, time)
        _write(new.where(early), target, EARLY, batch_id, time)

    return keep
