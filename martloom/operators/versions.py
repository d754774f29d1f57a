"""Day tables whose days are replaced all at once; buckets or any other parts go the same way.

The rows of a table lie in ``<table>__data``, partitioned by version and day. Each replacement adds a
version of its own and never touches another. ``<table>__manifest`` holds lists, each under a name of
its own, of the version that each day has; and the table itself is a view of one such list. A replacement writes its rows,
then a new list of days, and in the end replaces the view, which is one change in the catalogue. Until
then every reader sees the old days, emptied days included, and whoever planned a query before goes on
with them; a replacement that dies before leaves nothing but rows that no list names.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.incremental import in_range

VERSION = "version"


def _data(table: str) -> str:
    return f"{table}__data"


def _manifests(table: str) -> str:
    return f"{table}__manifest"


def _shown(spark: SparkSession, table: str) -> str:
    """The list that the table shows."""
    return spark.sql(f"SHOW TBLPROPERTIES {table} ('manifest')").first().value


def manifest(spark: SparkSession, table: str) -> DataFrame:
    """The day and version of each day the table has."""
    return spark.table(_manifests(table)).filter(F.col("manifest") == _shown(spark, table)).drop("manifest")


def note(spark: SparkSession, table: str) -> str:
    """What the last replacement has noted."""
    return spark.sql(f"SHOW TBLPROPERTIES {table} ('note')").first().value


def _switch(spark: SparkSession, table: str, on: str, name: str, columns: list[str], noted: str) -> None:
    """Show another list, with a note: one change in the catalogue."""
    if "'" in noted or "\\" in noted:
        raise ValueError(f"note {noted!r}")
    listed = ", ".join(f"d.`{c}`" for c in columns)
    # The days are few, so they prune the partitions that are read.
    spark.sql(
        f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('manifest' = '{name}', 'note' = '{noted}') AS "
        f"SELECT {listed} FROM {_data(table)} d LEFT SEMI JOIN "
        f"(SELECT `{on}`, {VERSION} FROM {_manifests(table)} WHERE manifest = '{name}') m "
        f"ON d.`{on}` = m.`{on}` AND d.{VERSION} = m.{VERSION}"
    )


def _add(rows: DataFrame, table: str, on: str) -> DataFrame:
    """Store rows as a version of their own; returns its days, as manifest rows."""
    version = uuid.uuid4().hex
    plain = [c for c in rows.columns if c != on]
    stored = rows.select(*plain, F.lit(version).alias(VERSION), on).hint("rebalance", on)
    stored.write.mode("append").partitionBy(VERSION, on).saveAsTable(_data(table))
    added = rows.sparkSession.table(_data(table)).filter(F.col(VERSION) == version)
    return added.select(on, VERSION).distinct()


def _publish(days: DataFrame, table: str, on: str, columns: list[str], noted: str = "") -> None:
    # Not a number: a replacement that died may have left a list behind.
    name = uuid.uuid4().hex
    listed = days.select(on, VERSION, F.lit(name).alias("manifest")).coalesce(1)
    listed.write.mode("append").partitionBy("manifest").saveAsTable(_manifests(table))
    _switch(days.sparkSession, table, on, name, columns, noted)


def create(rows: DataFrame, table: str, on: str = "event_date") -> None:
    """Store rows as a table whose days can be replaced. Rows without a day are an error."""
    if VERSION in rows.columns:
        raise ValueError(f"{table}: column {VERSION} is taken")
    added = _add(rows, table, on)
    # Asked of the stored rows, as the rows themselves would be made twice.
    if not added.filter(F.col(on).isNull()).isEmpty():
        raise ValueError(f"{table}: rows without {on}")
    _publish(added, table, on, rows.columns)


def _replace(rows: DataFrame, table: str, replaced: Column, on: str, noted: str = "") -> None:
    spark = rows.sparkSession
    columns = spark.table(table).columns
    kept = manifest(spark, table).filter(~replaced).select(on, VERSION)
    added = _add(rows.select(*columns), table, on)
    _publish(kept.unionByName(added), table, on, columns, noted)


def replace_range(source: DataFrame, table: str, start: date, end: date, on: str = "event_date") -> None:
    """Replace the days from ``start`` to ``end`` by the source's rows, all at once.

    A day without rows in the source is gone afterwards. ``source`` may read ``table``: it sees the old
    days. One writer at a time.
    """
    _replace(in_range(source, F.lit(start), F.lit(end), on), table, F.col(on).between(start, end), on)


def replace_days(
    source: DataFrame, table: str, days: list[date] | list[int], on: str = "event_date", noted: str = ""
) -> None:
    """Replace exactly the days listed, all at once; a listed day without rows is gone. ``noted``
    becomes the table's note in the same change."""
    if days:
        listed = F.col(on).isin(sorted(set(days)))
        _replace(source.filter(listed), table, listed, on, noted)


def vacuum(spark: SparkSession, table: str, on: str = "event_date") -> int:
    """Drop stored days and lists that the table does not show; returns the number of days dropped.

    Not while a query that was planned before the last replacement still runs.
    """
    data, name = _data(table), _shown(spark, table)
    stored = spark.table(data).select(on, VERSION).distinct()
    # One row per calendar day and replacement.
    dead = stored.join(manifest(spark, table), [on, VERSION], "left_anti").collect()
    for r in dead:
        part = f"DATE '{r[on].isoformat()}'" if isinstance(r[on], date) else str(r[on])
        spark.sql(f"ALTER TABLE {data} DROP IF EXISTS PARTITION ({VERSION} = '{r[VERSION]}', `{on}` = {part})")
    lists = spark.table(_manifests(table)).filter(F.col("manifest") != name).select("manifest").distinct()
    for r in lists.collect():
        spark.sql(f"ALTER TABLE {_manifests(table)} DROP IF EXISTS PARTITION (manifest = '{r.manifest}')")
    return len(dead)
