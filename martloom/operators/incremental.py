"""Date-ranged rebuilds, the run log and missing intervals."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.names import epoch_ms_to_utc, materialised_label, quoted_parts
from martloom.schemas import RUN_LOG


def in_range(df: DataFrame, start: date | Column, end: date | Column, on: str = "event_date") -> DataFrame:
    """Rows dated from ``start`` to ``end``, both included; prunes partitions on that column."""
    return df.filter(F.col(on).between(start, end))


def orders_per_item(incremental: DataFrame) -> DataFrame:
    """Distinct ids per item."""
    return incremental.groupBy("item_id").agg(F.count_distinct("id").alias("num_orders"))


# Stored with the table, so that an overwrite never depends on a session setting: only the days
# present in the written rows are replaced.
DYNAMIC = {"partitionOverwriteMode": "dynamic"}


def _by_day(rows: DataFrame, on: str) -> DataFrame:
    """The day last, and rebalanced on it: few files per day, and AQE splits a day too large for
    one task."""
    return rows.select(*[c for c in rows.columns if c != on], on).hint("rebalance", on)


def create_day_table(
    rows: DataFrame, table: str, on: str = "event_date", path: str | None = None
) -> None:
    """Store rows as a day-partitioned table whose overwrites replace single days."""
    writer = _by_day(rows, on).write.options(**DYNAMIC).partitionBy(on)
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def _write_days(rows: DataFrame, table: str, on: str) -> None:
    spark = rows.sparkSession
    if not spark.catalog.tableExists(table):
        create_day_table(rows, table, on)
        return
    properties = ", ".join(f"'{k}' = '{v}'" for k, v in DYNAMIC.items())
    spark.sql(f"ALTER TABLE {table} SET SERDEPROPERTIES ({properties})")
    _by_day(rows, on).write.insertInto(table, overwrite=True)


def _stored_days(spark: SparkSession, table: str, on: str) -> list[date]:
    """Days of the table's partitions; rows without a day are in none of them."""
    parts = spark.sql("SHOW PARTITIONS IDENTIFIER(:t)", args={"t": table})
    day = F.regexp_extract("partition", f"{on}=(.*)", 1).try_cast("date")
    return [r.day for r in parts.select(day.alias("day")).filter("day is not null").collect()]


def _drop_days(spark: SparkSession, table: str, on: str, days: set[date]) -> None:
    for day in sorted(days):
        spark.sql(
            f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({on} = DATE '{day.isoformat()}')"
        )


def rebuild_range(
    source: DataFrame, table: str, start: date, end: date, on: str = "event_date"
) -> None:
    """Replace the days from ``start`` to ``end`` of a day-partitioned table by the source's rows.

    Other days stay. A day that lost all its rows is dropped, which a dynamic overwrite alone
    would leave behind. Running the same range again gives the same table. ``source`` must not
    read ``table``.
    """
    spark = source.sparkSession
    rows = in_range(source, F.lit(start), F.lit(end), on)
    _write_days(rows, table, on)
    stored = [d for d in _stored_days(spark, table, on) if start <= d <= end]
    # One row per calendar day of the range, so the driver holds days, never data.
    filled = {r[0] for r in rows.select(on).distinct().collect()}
    _drop_days(spark, table, on, set(stored) - filled)


def rebuild_days(source: DataFrame, days: DataFrame, table: str, on: str = "event_date") -> None:
    """Replace exactly the days listed in ``days`` (one column named ``on``); a listed day without
    rows in the source is dropped."""
    spark = source.sparkSession
    # One row per calendar day.
    listed = {r[0] for r in days.select(on).distinct().collect()} - {None}
    if not listed:
        return
    # As literals, the days prune the source's partitions or row groups.
    rows = source.filter(F.col(on).isin(sorted(listed)))
    _write_days(rows, table, on)
    emptied = listed.intersection(_stored_days(spark, table, on))
    if emptied:
        emptied -= {r[0] for r in rows.select(on).distinct().collect()}
    _drop_days(spark, table, on, emptied)


def expected_days(models: DataFrame) -> DataFrame:
    """One row per model and day from its ``start_day`` to its ``end_day``; none for a model that
    starts after its end."""
    days = F.sequence("start_day", "end_day", F.make_dt_interval(days=F.lit(1)))
    due = models.filter(F.col("start_day") <= F.col("end_day"))
    return due.select("model", F.explode(days).alias("day"))


def covered_days(log: DataFrame) -> DataFrame:
    """Days covered by logged intervals, ends exclusive."""
    last = F.date_sub("interval_end", 1)
    days = F.sequence("interval_start", last, F.make_dt_interval(days=F.lit(1)))
    return (
        log.filter(F.col("interval_start") <= last)
        .select("model", "interval_start", "interval_end")
        .distinct()
        .select("model", F.explode(days).alias("day"))
        .distinct()
    )


def missing_intervals(models: DataFrame, log: DataFrame) -> DataFrame:
    """Daily intervals of each model that no logged run covers."""
    return expected_days(models).join(covered_days(log), ["model", "day"], "left_anti")


def log_runs(spark: SparkSession, log_table: str, rows: list[tuple]) -> None:
    """Append finished runs (model, interval start, interval end, finished at) to the run log."""
    spark.createDataFrame(rows, RUN_LOG.schema).coalesce(1).write.mode("append").saveAsTable(log_table)


def catch_up(
    source: DataFrame,
    table: str,
    model: str,
    log_table: str,
    start: date,
    end: date,
    finished_at: datetime,
    on: str = "event_date",
) -> list[date]:
    """Build the daily intervals from ``start`` to ``end`` that the log lacks, then log them.

    Returns the days built. A run that dies before the log entry is simply built again.
    """
    spark = source.sparkSession
    models = spark.createDataFrame(
        [(model, start, end)], "model STRING, start_day DATE, end_day DATE"
    )
    if spark.catalog.tableExists(log_table):
        missing = missing_intervals(models, spark.table(log_table))
    else:
        missing = expected_days(models)
    # One row per calendar day.
    days = sorted(r.day for r in missing.collect())
    if days:
        wanted = spark.createDataFrame([(d,) for d in days], f"{on} DATE")
        rebuild_days(source, wanted, table, on)
        log_runs(spark, log_table, [(model, d, d + timedelta(days=1), finished_at) for d in days])
    return days


def last_materialised(models: DataFrame, log: DataFrame) -> DataFrame:
    """Latest interval end per model (epoch ms in ``end_ms``); NULL for a model that never ran."""
    last = log.groupBy("model").agg(F.max("end_ms").alias("last_end_ms"))
    end = F.col("last_end_ms")
    return models.join(last, "model", "left").select(
        "model",
        F.array_join(quoted_parts(F.col("model")), "/").alias("model_path"),
        "last_end_ms",
        epoch_ms_to_utc(end).alias("last_end_at"),
        materialised_label(end).alias("label"),
    )
