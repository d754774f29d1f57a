"""Dollar marts of orders and customers kept up by changed items alone.

The state of an order holds its counts and cent sums, and for each sum how many items have a value, so
that items can be taken out again as exactly as they are put in. Orders lie in buckets by their
customer, the customers in the same ones. A set of changed items is summed per order with its signs,
and only the buckets of their customers are merged and replaced; the items that did not change are
never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.money import cents_to_dollars
from martloom.operators import versions
from martloom.operators.lookup import bounded
from martloom.plans import marts_v1
from martloom.session import written

BUCKETS = 64
ORDER_COLUMNS = ("order_id", "customer_id", "store_id", "order_date", "status")
COUNTS = tuple(f"{kind}_items_count" for kind in marts_v1.KINDS)
MEASURES = tuple(f"{kind}_{measure}" for measure in ("revenue", "cost", "profit") for kind in marts_v1.KINDS)


def _known(measure: str) -> str:
    return f"{measure}_known"


STATE = (*COUNTS, *MEASURES, *map(_known, MEASURES))


def _bucket(customer: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(customer), F.lit(buckets)).cast("int")


def signed_summary(items: DataFrame) -> DataFrame:
    """The sums of ``marts_v1.order_summary`` of items that have a ``sign``: 1 for an item put in, -1
    for one taken out."""
    sign = F.col("sign").cast("bigint")
    zero = F.lit(0).cast("bigint")
    flags = {k: F.col(f"is_{k}_item") if k != "total" else F.lit(True) for k in marts_v1.KINDS}
    sums = [F.sum(F.when(flag, sign).otherwise(zero)).alias(f"{k}_items_count") for k, flag in flags.items()]
    for name, part in marts_v1.order_measures().items():
        sums.append(F.sum(F.coalesce(part, zero) * sign).alias(name))
        sums.append(F.sum(F.when(part.isNotNull(), sign).otherwise(zero)).alias(_known(name)))
    return items.groupBy("order_id").agg(*sums)


def _placed(stg_orders: DataFrame, summary: DataFrame, buckets: int) -> DataFrame:
    rows = stg_orders.select(*ORDER_COLUMNS).join(summary, "order_id")
    return rows.select(*ORDER_COLUMNS, *STATE, _bucket("customer_id", buckets).alias("bucket"))


def orders_mart(state: DataFrame) -> DataFrame:
    """The orders mart of ``marts_v1`` from the states of its orders."""
    dollars = lambda m: cents_to_dollars(F.when(F.col(_known(m)) > 0, F.col(m))).alias(m)
    return state.select(*ORDER_COLUMNS, *COUNTS, *map(dollars, MEASURES))


def _customers(stg_customers: DataFrame, state: DataFrame, buckets: int) -> DataFrame:
    mart = marts_v1.customers(stg_customers, orders_mart(state))
    return mart.withColumn("bucket", _bucket("customer_id", buckets))


def create(
    stg_customers: DataFrame,
    stg_orders: DataFrame,
    items: DataFrame,
    orders_table: str,
    customers_table: str,
    buckets: int = BUCKETS,
) -> None:
    """Store the states of all orders that have ``items`` (as ``marts_v1.item_dollars`` gives them), and
    the customers mart."""
    summary = signed_summary(items.withColumn("sign", F.lit(1)))
    versions.create(_placed(stg_orders, summary, buckets), orders_table, "bucket")
    state = items.sparkSession.table(orders_table)
    versions.create(_customers(stg_customers, state, buckets), customers_table, "bucket")


def touched_buckets(placed: DataFrame) -> list[int]:
    """Numbers below the number of buckets."""
    return sorted(r.bucket for r in placed.select("bucket").distinct().collect())


def apply(
    stg_customers: DataFrame,
    stg_orders: DataFrame,
    changes: DataFrame,
    change: str,
    orders_table: str,
    customers_table: str,
    buckets: int = BUCKETS,
) -> list[int]:
    """Bring both tables up to the changed items; returns the buckets that were replaced.

    ``changes`` are items as ``create`` takes them, with a ``sign``. An item that changes is taken out as
    it was and put in as it is. ``change`` names them: the orders table notes it in the same step that
    shows the new states, so that a call that died is simply made again, and counts nothing twice.
    Orders without items leave the table. Only items change, not the orders or customers themselves.
    """
    spark: SparkSession = changes.sparkSession
    # A row for each order that the changes touch.
    summary = written(signed_summary(changes), "order_changes")
    placed = written(_placed(stg_orders, bounded(summary), buckets), "placed_changes")
    touched = touched_buckets(placed)
    if not touched:
        return []
    inside = F.col("bucket").isin(touched)
    if versions.note(spark, orders_table) != change:
        old = spark.table(orders_table).filter(inside)
        merged = old.unionByName(placed).groupBy(*ORDER_COLUMNS, "bucket").agg(*[F.sum(c).alias(c) for c in STATE])
        merged = merged.filter("total_items_count > 0")
        versions.replace_days(merged, orders_table, touched, "bucket", change)
    own = stg_customers.filter(_bucket("customer_id", buckets).isin(touched))
    marts = _customers(own, spark.table(orders_table).filter(inside), buckets)
    versions.replace_days(marts, customers_table, touched, "bucket", change)
    return touched
