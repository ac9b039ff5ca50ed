"""Bronze loads: landing files into raw tables, each file once, with lineage, rejects and a load log."""

from __future__ import annotations

import datetime as dt
import getpass
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions.dates import try_date, try_wall_clock
from ..operators.merge import table_exists
from ..schemas import BATCH_LOG, CUSTOMER_COLUMNS, LINEAGE_COLUMNS, PRODUCT_COLUMNS
from .scan import CSV, JSON_ARRAY, FileFormat, read_files, shape_records


def _variant_text(path: str) -> Column:
    return F.try_variant_get("raw_data", path, "string")


@dataclass(frozen=True)
class RawTable:
    name: str
    fmt: FileFormat
    columns: tuple[str, ...] = ()
    #: columns extracted from the document when it is written
    extracted: tuple[tuple[str, str, str], ...] = ()

    def data_columns(self) -> list[str]:
        return list(self.columns) if self.columns else ["raw_data", *(name for name, _, _ in self.extracted)]

    def with_extracted(self, df: DataFrame) -> DataFrame:
        convert = {"string": lambda c: c, "date": try_date, "timestamp": try_wall_clock}
        for name, path, kind in self.extracted:
            df = df.withColumn(name, convert[kind](_variant_text(path)))
        return df


RAW_ORDERS = RawTable("raw_orders", JSON_ARRAY, extracted=(
    ("order_id", "$.order_id", "string"), ("order_date", "$.order_date", "date")))
RAW_CUSTOMERS = RawTable("raw_customers", CSV, tuple(CUSTOMER_COLUMNS))
RAW_PRODUCTS = RawTable("raw_products", CSV, tuple(PRODUCT_COLUMNS))
RAW_EVENTS = RawTable("raw_events", JSON_ARRAY, extracted=(
    ("event_id", "$.event_id", "string"), ("event_type", "$.event_type", "string"),
    ("event_timestamp", "$.event_timestamp", "timestamp")))


@dataclass(frozen=True)
class BatchResult:
    batch_id: int
    table: str
    loaded: int
    rejected: int
    status: str
    error: str | None = None

    def message(self) -> str:
        return f"Loaded {self.loaded} records into {self.table.upper()} (Batch ID: {self.batch_id})"


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def next_batch_id(spark: SparkSession, log_path: str) -> int:
    if not table_exists(spark, log_path):
        return 1
    return (spark.read.schema(BATCH_LOG).parquet(log_path).agg(F.max("batch_id")).first()[0] or 0) + 1


def append_batch_log(spark: SparkSession, log_path: str, result: BatchResult, filename: str,
                     start: dt.datetime, end: dt.datetime) -> None:
    row = (result.batch_id, result.table.upper(), filename, result.loaded, result.rejected, start, end,
           result.status, result.error, getpass.getuser())
    spark.createDataFrame([row], BATCH_LOG).coalesce(1).write.mode("append").parquet(log_path)


def read_batch_log(spark: SparkSession, bronze: str) -> DataFrame:
    return spark.read.schema(BATCH_LOG).parquet(f"{bronze}/load_batch_log")


def _epoch_rows_before(spark: SparkSession, ledger: str, epoch: int) -> int:
    """Records of the table's earlier loads: where the numbering of this one starts."""
    if epoch == 0 or not table_exists(spark, ledger):
        return 0
    return spark.read.parquet(ledger).where(F.col("epoch") < epoch).agg(F.sum("records")).first()[0] or 0


# A text is under 2**31 bytes and every element of an array takes two at least, so no document reaches this number.
_ELEMENTS_PER_DOCUMENT = 1 << 30


def record_id(first: int) -> Column:
    """Increasing id, unique over the loads of a table and the same when a load is replayed.

    A decimal, as the number of a text (64 bits) and the place in it (30 bits) do not fit a long.
    """
    text = (F.lit(first).cast("long") + F.col("_batch_row")).cast("decimal(19,0)")
    element = F.col("_element").cast("decimal(10,0)")
    return (text * F.lit(_ELEMENTS_PER_DOCUMENT).cast("decimal(10,0)") + element).cast("decimal(28,0)")


def load_raw(spark: SparkSession, table: RawTable, landing: str, bronze: str, glob: str | None = None,
             fmt: FileFormat | None = None, files_per_batch: int | None = None) -> BatchResult:
    """Load the landing files that were not loaded before and log the call.

    The file stream's checkpoint remembers the loaded files, so a rerun loads nothing. Every micro-batch
    overwrites its own ``epoch`` partition, so a batch replayed after a failure is not doubled; bad
    records go to the ``rejected=1`` partition in the same pass. ``files_per_batch`` bounds a micro-batch, whatever
    the backlog. On failure a FAILED row is logged
    and the error raised again.
    """
    fmt = fmt or table.fmt
    log_path = f"{bronze}/load_batch_log"
    target, ledger = f"{bronze}/{table.name}", f"{bronze}/load_epochs/{table.name}"
    shown = glob or fmt.glob
    batch_id, start = next_batch_id(spark, log_path), _now()
    totals = {"loaded": 0, "rejected": 0}

    def write_epoch(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        # Good and bad records are two folders: two open files a task, instead of sorting its records by folder.
        session.conf.set("spark.sql.maxConcurrentOutputFileWriters", "2")
        first = _epoch_rows_before(session, ledger, epoch)
        scanned = shape_records(batch, fmt, list(table.columns))
        rows = (
            table.with_extracted(scanned)
            .withColumn("record_id", record_id(first))
            .withColumn("load_timestamp", F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz"))
            .select(*LINEAGE_COLUMNS, *table.data_columns(), "_batch_row", "_raw",
                    F.lit(epoch).alias("epoch"), F.col("_rejected").cast("int").alias("rejected"))
        )
        seen = Observation()
        (
            rows.observe(seen, F.count_if(F.col("rejected") == 0).alias("loaded"),
                         F.count_if(F.col("rejected") == 1).alias("rejected"),
                         F.max("_batch_row").alias("records"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("epoch", "rejected").parquet(target, compression="zstd")
        )
        counts = seen.get
        totals["loaded"] += counts["loaded"]
        totals["rejected"] += counts["rejected"]
        size = session.createDataFrame([(counts["records"] or 0, epoch)], "records long, epoch int")
        (
            size.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("epoch").parquet(ledger)
        )

    try:
        stream = read_files(spark, landing, fmt, list(table.columns), stream=True, glob=shown, files_per_batch=files_per_batch)
        writer = stream.writeStream.foreachBatch(write_epoch).option(
            "checkpointLocation", f"{bronze}/checkpoints/load_{table.name}"
        )
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
    except Exception as error:
        # Micro-batches that were committed before the failure stay loaded.
        failed = BatchResult(batch_id, table.name, totals["loaded"], totals["rejected"], "FAILED", str(error)[:5000])
        append_batch_log(spark, log_path, failed, shown, start, _now())
        raise
    result = BatchResult(batch_id, table.name, totals["loaded"], totals["rejected"], "SUCCESS")
    append_batch_log(spark, log_path, result, shown, start, _now())
    return result


def read_raw(spark: SparkSession, table: RawTable, bronze: str) -> DataFrame:
    """The good records of a raw table."""
    return spark.read.parquet(f"{bronze}/{table.name}").where(F.col("rejected") == 0).select(
        *LINEAGE_COLUMNS, *table.data_columns()
    )


def read_quarantine(spark: SparkSession, table: RawTable, bronze: str) -> DataFrame:
    return spark.read.parquet(f"{bronze}/{table.name}").where(F.col("rejected") == 1).select(
        "filename", "file_row_number", F.col("_raw").alias("raw_record")
    )


def load_all_raw(spark: SparkSession, landing: str, bronze: str, order_format: FileFormat = RAW_ORDERS.fmt,
                 files_per_batch: int | None = None) -> dict[str, BatchResult]:
    """Orders, customers, products: the fixed load order. Large order drops come as JSON Lines."""
    return {
        table.name: load_raw(spark, table, f"{landing}/{area}", bronze, fmt=fmt, files_per_batch=files_per_batch)
        for table, area, fmt in (
            (RAW_ORDERS, "orders", order_format),
            (RAW_CUSTOMERS, "customers", None),
            (RAW_PRODUCTS, "products", None),
        )
    }
