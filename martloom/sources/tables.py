"""Warehouse tables: read, replace, truncate-and-load, materialise, list, flush."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.schemas import TableSpec
from martloom.sources.files import csv_scan, keyed

DEFAULT_SCHEMA = "main"


def qualify(name: str, custom: str | None = None, default: str = DEFAULT_SCHEMA) -> str:
    """``schema.name``; a custom schema wins over the default."""
    schema = default if custom is None else custom.strip()
    return f"{schema}.{name}"


def ensure_schema(
    spark: SparkSession, schema: str = DEFAULT_SCHEMA, location: str | None = None
) -> None:
    """Create a schema unless it exists; its tables go below ``location`` when one is given."""
    where = "" if location is None else f" LOCATION '{location}'"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:schema){where}", args={"schema": schema})


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def write_replace(df: DataFrame, name: str) -> None:
    """Drop and recreate the table with the frame's schema."""
    df.write.mode("overwrite").option("overwriteSchema", True).saveAsTable(name)


def write_truncate_load(df: DataFrame, name: str) -> None:
    """Replace the rows and keep the table's definition; the first load creates the table.

    Columns go by name. A frame that reads its own target must be written elsewhere first.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        df.write.saveAsTable(name)
        return
    # An overwrite replaces all partitions or single ones, as table and session say; a truncate
    # leaves none.
    spark.sql("TRUNCATE TABLE IDENTIFIER(:t)", args={"t": name})
    df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)


def keyed_load(
    spark: SparkSession, spec: TableSpec, path_glob: str, name: str, multi_line: bool = False
) -> None:
    """Full refresh of a table from the CSV files of a glob, after its key is proven."""
    rows = csv_scan(spark, spec, path_glob, multi_line=multi_line)
    write_truncate_load(keyed(rows, spec), name)


def materialise(df: DataFrame, name: str, kind: str, schema: str | None = None) -> DataFrame:
    """Publish a model: ``view`` stays lazy and session-local, ``table`` is stored."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind == "table":
        target = qualify(name, schema)
        ensure_schema(spark, target.split(".")[0])
        write_replace(df, target)
        return spark.table(target)
    raise ValueError(f"kind must be 'view' or 'table', not {kind!r}")


def base_tables(spark: SparkSession, schema: str) -> list[str]:
    """Stored tables of a schema, without views."""
    return sorted(
        t.name
        for t in spark.catalog.listTables(schema)
        if not t.isTemporary and t.tableType != "VIEW"
    )


def flush_schema(spark: SparkSession, schema: str = DEFAULT_SCHEMA) -> list[str]:
    """Empty every stored table of a schema, keeping definitions; returns their names."""
    names = base_tables(spark, schema)
    for name in names:
        spark.sql("TRUNCATE TABLE IDENTIFIER(:t)", args={"t": f"{schema}.{name}"})
    return names


def list_schemas(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW SCHEMAS")


def list_tables(spark: SparkSession, schema: str = DEFAULT_SCHEMA) -> DataFrame:
    return spark.sql("SHOW TABLES IN IDENTIFIER(:schema)", args={"schema": schema}).filter(
        ~F.col("isTemporary")
    )


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql("DESCRIBE TABLE IDENTIFIER(:t)", args={"t": name})
