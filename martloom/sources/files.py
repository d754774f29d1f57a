"""File scans and exports. Every typed read declares its schema, so no file is read to infer one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.quality import Rule, evaluate, gate
from martloom.schemas import TableSpec


# Header CSV as most tools write it: a quote inside a quoted field is doubled, spaces are kept.
CSV_FORMAT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def csv_scan(
    spark: SparkSession,
    spec: TableSpec,
    path: str,
    mode: str = "FAILFAST",
    multi_line: bool = False,
) -> DataFrame:
    """Header CSV under the declared schema, checked against the header.

    ``multi_line`` allows line breaks inside quoted fields; such files cannot be split, so each
    is read by one task.
    """
    return (
        spark.read.options(**CSV_FORMAT)
        .option("mode", mode)
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .schema(spec.schema)
        .csv(path)
    )


def csv_all_text(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Header CSV with every column as text.

    Without types, a record cut at a quoted line break cannot be told from a short one, so quoted
    line breaks are read as text unless the caller rules them out.
    """
    return spark.read.options(**CSV_FORMAT).option("multiLine", multi_line).csv(path)


def parquet_scan(spark: SparkSession, path: str, spec: TableSpec | None = None) -> DataFrame:
    reader = spark.read if spec is None else spark.read.schema(spec.schema)
    return reader.parquet(path)


def typed_tweets(all_text: DataFrame) -> DataFrame:
    """All-text tweets cast to the contract types."""
    return all_text.select(
        F.col("id").cast("string").alias("id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("tweeted_at").cast("timestamp_ntz").alias("tweeted_at"),
        F.col("content").cast("string").alias("content"),
    )


def key_rules(table: str, key: tuple[str, ...]) -> list[Rule]:
    return [Rule.not_null(table, column) for column in key] + [Rule.unique(table, *key)]


def keyed(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Return ``df`` once its declared key is proven unique and complete; raise otherwise."""
    gate(evaluate({spec.name: df}, key_rules(spec.name, spec.key)))
    return df


def seed(spark: SparkSession, spec: TableSpec, path: str, multi_line: bool = False) -> DataFrame:
    """Strict CSV load of a seed with its key proven."""
    return keyed(csv_scan(spark, spec, path, multi_line=multi_line), spec)


# Text exports keep microseconds, which the writers' default format cuts to milliseconds.
EXACT_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def export_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_FORMAT, **EXACT_TIMES).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    """One JSON object per line; NULL fields are written so that readers see every column."""
    df.write.mode("overwrite").option("ignoreNullFields", False).options(**EXACT_TIMES).json(path)
