"""Dollar marts from tables that lie in buckets of their join keys.

A table is stored in buckets by the hash of a key. Tables of the same key and number of buckets are
joined and summed bucket by bucket, without an exchange. One task reads a bucket, so this pays only
while no bucket is far larger than the others. Each table notes its largest bucket when it is stored;
a table with a hot bucket is read as plain files instead, where sums combine before their exchange and
adaptive execution splits skewed joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.plans import marts_v1

# A bucket should fit a task; at 100 TB that takes some thousands.
BUCKETS = 64
# Rows of a bucket, about: tables that have more get more buckets than asked for.
BUCKET_ROWS = 1_000_000
# Tasks that write one bucket, so that a hot key is not written by one.
SPLIT = 4
# A bucket is hot with more rows than this, if it also has so many times the mean.
HOT_ROWS = 10_000_000
HOT_TIMES = 4.0

ORDER_COLUMNS = ("order_id", "customer_id", "store_id", "order_date", "status")


def _bucket(key: str, buckets: int) -> Column:
    """The bucket that ``bucketBy`` puts a key into."""
    return F.pmod(F.hash(key), F.lit(buckets))


def store(df: DataFrame, table: str, key: str, buckets: int = BUCKETS, split: int = SPLIT) -> None:
    """Replace a table, in buckets of ``key``, and note the rows of the largest one and of all.

    Columns must be hashable (no maps).
    """
    spark = df.sparkSession
    part = F.pmod(F.xxhash64(*df.columns), F.lit(split))
    dealt = df.repartition(buckets * split, _bucket(key, buckets), part)
    dealt.write.mode("overwrite").bucketBy(buckets, key).saveAsTable(table)
    sizes = spark.table(table).groupBy(_bucket(key, buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    most, total = sizes.agg(F.max("n"), F.sum("n")).first()
    spark.sql(
        f"ALTER TABLE {table} SET TBLPROPERTIES "
        f"('buckets' = '{buckets}', 'largest_bucket' = '{most or 0}', 'bucketed_rows' = '{total or 0}')"
    )


def stored(
    spark: SparkSession, table: str, hot_rows: int = HOT_ROWS, hot_times: float = HOT_TIMES
) -> DataFrame:
    """A table that ``store`` made: by its buckets, or as plain files if one of them is hot."""
    noted = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    buckets, most, total = (int(noted[k]) for k in ("buckets", "largest_bucket", "bucketed_rows"))
    df = spark.table(table)
    if most <= hot_rows or most * buckets <= hot_times * total:
        return df
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return spark.read.schema(df.schema).parquet(described.first().data_type)


def orders(stg_orders: DataFrame, items: DataFrame) -> DataFrame:
    """``marts_v1.orders`` of two tables in the same buckets of ``order_id``."""
    return marts_v1.orders(stg_orders.hint("merge"), items)


def customers(stg_customers: DataFrame, orders_mart: DataFrame) -> DataFrame:
    """``marts_v1.customers`` of two tables in the same buckets of ``customer_id``."""
    return marts_v1.customers(stg_customers.hint("merge"), orders_mart)


def enough_buckets(rows: int, buckets: int) -> int:
    """``buckets``, doubled until a bucket has no more than ``BUCKET_ROWS`` of the rows, on average."""
    while rows > buckets * BUCKET_ROWS:
        buckets *= 2
    return buckets


def build(
    stg_customers: DataFrame,
    stg_orders: DataFrame,
    items: DataFrame,
    schema: str,
    buckets: int = BUCKETS,
    counted: Sequence[DataFrame] = (),
) -> dict[str, DataFrame]:
    """Store the inputs and the orders mart in buckets; returns the marts of orders and customers.

    ``buckets`` is the least number; the tables get more as they grow, so that what a task holds does
    not. ``counted`` names cheaper frames with as many rows as the three inputs.

    ``items`` is ``marts_v1.item_dollars`` of priced items. Tables of ``schema``: ``order_items`` and
    ``placed_orders`` in buckets of ``order_id``, ``orders`` and ``known_customers`` of ``customer_id``.
    """
    spark = items.sparkSession
    name = lambda table: f"{schema}.{table}"
    buckets = enough_buckets(max(df.count() for df in counted or (stg_customers, stg_orders, items)), buckets)
    store(items, name("order_items"), "order_id", buckets)
    store(stg_orders.select(*ORDER_COLUMNS), name("placed_orders"), "order_id", buckets)
    placed, bought = stored(spark, name("placed_orders")), stored(spark, name("order_items"))
    store(orders(placed, bought), name("orders"), "customer_id", buckets)
    store(stg_customers, name("known_customers"), "customer_id", buckets)
    mart = stored(spark, name("orders"))
    return {"orders": mart, "customers": customers(stored(spark, name("known_customers")), mart)}
