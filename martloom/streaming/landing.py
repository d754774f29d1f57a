"""Drain new landing files into the day-partitioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martloom.operators.incremental import rebuild_days
from martloom.schemas import SEED_EVENTS, TableSpec


def drain_landing(
    spark: SparkSession,
    folder: str,
    table: str,
    checkpoint: str,
    spec: TableSpec = SEED_EVENTS,
    on: str = "event_date",
) -> None:
    """Process every file not seen before, then stop.

    Each batch only tells which days changed; those days are rebuilt from the landing folder, so
    late files and a replayed batch give the same table. The changed days reach the scan as
    literals: partitions or row groups without them are not read.
    """

    def rebuild(batch: DataFrame, _epoch: int) -> None:
        landed = batch.sparkSession.read.schema(spec.schema).parquet(folder)
        rebuild_days(landed, batch.select(on).distinct(), table, on)

    query = (
        spark.readStream.schema(spec.schema)
        .parquet(folder)
        .writeStream.foreachBatch(rebuild)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # Batches run in a session of their own; drop what this one remembers of the table's files.
    if spark.catalog.tableExists(table):
        spark.catalog.refreshTable(table)
