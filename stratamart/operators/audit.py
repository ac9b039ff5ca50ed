"""Data audits: declared constraints, row counts along the flow, run history."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import second_boundaries
from ..functions.numeric import average


def _line(df: DataFrame, table: str, rule: str, columns: list[str], violations: Column) -> DataFrame:
    return df.agg(violations.cast("long").alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"),
        F.lit(", ".join(columns)).alias("columns"), "violations",
    )


def constraint_audit(tables: dict[str, DataFrame], unique: list[tuple[str, list[str]]] = (),
                     not_null: list[tuple[str, list[str]]] = (),
                     foreign: list[tuple[str, str, str, str]] = ()) -> DataFrame:
    """Violations per declared constraint.

    unique: surplus rows beyond one per key; not_null: NULLs in the column; foreign
    ``(table, column, parent, parent_column)``: rows whose value has no parent row. Keys are counted
    before they are joined or compared, so a hot key is one row after the map side.
    """
    lines = []
    for table, keys in unique:
        present = reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))
        counts = tables[table].where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        lines.append(_line(counts.where("n > 1"), table, "unique", keys,
                           F.coalesce(F.sum(F.col("n") - 1), F.lit(0))))
    by_table: dict[str, list[str]] = {}
    for table, columns in not_null:
        by_table.setdefault(table, []).extend(columns)
    for table, columns in by_table.items():
        # One pass per table counts all its NOT NULL columns; the one result row becomes a line each.
        nulls = tables[table].agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
        pairs = F.array(*(F.struct(F.lit(c).alias("columns"), F.col(c).alias("violations")) for c in columns))
        lines.append(nulls.select(F.explode(pairs).alias("_p")).select(
            F.lit(table).alias("table_name"), F.lit("not_null").alias("rule"), "_p.columns", "_p.violations",
        ))
    for table, column, parent, parent_column in foreign:
        counts = (
            tables[table].where(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("_v")).agg(F.count(F.lit(1)).alias("n"))
        )
        orphans = counts.join(tables[parent].select(F.col(parent_column).alias("_v")), "_v", "left_anti")
        lines.append(_line(orphans, table, "foreign_key", [column], F.coalesce(F.sum("n"), F.lit(0))))
    return reduce(DataFrame.unionByName, lines)


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table along the flow."""
    lines = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, lines)


def _window_start(as_of: dt.datetime, hours: int) -> Column:
    return F.lit((as_of - dt.timedelta(hours=hours)).isoformat(sep=" ")).cast("timestamp_ntz")


def run_history(run_log: DataFrame, as_of: dt.datetime, days: int = 7, limit: int | None = None) -> DataFrame:
    """Runs scheduled in the trailing window with their duration in seconds, latest first.

    ``limit`` caps the report (a top-k, not a global sort).
    """
    history = run_log.where(F.col("scheduled_time") >= _window_start(as_of, days * 24)).select(
        F.col("name").alias("task_name"), "database_name", "schema_name", "state", "scheduled_time",
        "query_start_time", "completed_time",
        second_boundaries(F.col("query_start_time"), F.col("completed_time")).alias("duration_seconds"),
        "error_code", "error_message", "return_value",
    ).orderBy(F.col("scheduled_time").desc_nulls_first())
    return history.limit(limit) if limit is not None else history


def run_summary(run_log: DataFrame, as_of: dt.datetime, hours: int = 24) -> DataFrame:
    """Per job over the trailing window: runs, outcomes, durations, first and last run."""
    history = run_log.where(F.col("scheduled_time") >= _window_start(as_of, hours)).withColumn(
        "_seconds", second_boundaries(F.col("query_start_time"), F.col("completed_time"))
    )
    return history.groupBy(F.col("name").alias("task_name")).agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(F.col("state") == "SUCCEEDED").alias("success_count"),
        F.count_if(F.col("state") == "FAILED").alias("failure_count"),
        average(F.col("_seconds")).alias("avg_duration_seconds"),
        F.max("_seconds").alias("max_duration_seconds"),
        F.min("scheduled_time").alias("first_run"),
        F.max("scheduled_time").alias("last_run"),
    ).orderBy(F.col("total_runs").desc_nulls_first())
