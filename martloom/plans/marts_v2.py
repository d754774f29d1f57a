"""Marts in cents without profit; orders without items are kept and numbered per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.lookup import bounded
from martloom.operators.ranking import HOT_ROWS, row_numbers
from martloom.plans.products import priced_items, product_economics

ITEM_COLUMNS = (
    "product_name",
    "product_price",
    "is_food_item",
    "is_drink_item",
    "supply_cost",
)


def order_items(
    stg_order_items: DataFrame,
    stg_orders: DataFrame,
    stg_products: DataFrame,
    stg_supplies: DataFrame,
) -> DataFrame:
    economics = bounded(product_economics(stg_products, stg_supplies))
    priced = priced_items(stg_order_items, economics)
    dates = stg_orders.select("order_id", F.col("order_date").alias("ordered_at"))
    return priced.join(dates, "order_id", "left").select(
        "order_item_id", "order_id", "product_id", "ordered_at", *ITEM_COLUMNS
    )


def order_summary(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.sum("supply_cost").alias("order_cost"),
        F.sum("product_price").alias("order_items_subtotal"),
        F.count_if("is_food_item").alias("count_food_items"),
        F.count_if("is_drink_item").alias("count_drink_items"),
        F.count("order_item_id").alias("count_order_items"),
    )


def orders(stg_orders: DataFrame, items: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All orders with item totals and their sequence number per customer.

    Orders of one customer at the same time are numbered by ``order_id``. ``items`` is the
    order_items mart or plain priced items.
    """
    totals = stg_orders.join(order_summary(items), "order_id", "left").select(
        *stg_orders.columns,
        "order_cost",
        "order_items_subtotal",
        "count_food_items",
        "count_drink_items",
        "count_order_items",
        (F.col("count_food_items") > 0).alias("is_food_order"),
        (F.col("count_drink_items") > 0).alias("is_drink_order"),
    )
    return row_numbers(
        totals,
        key="customer_id",
        order=("order_date", "order_id"),
        keys_from=stg_orders,
        hot_rows=hot_rows,
        name="customer_order_number",
    )


def customers(stg_customers: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """All customers with lifetime totals; a customer without orders counts as new."""
    summary = stg_orders.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("count_lifetime_orders"),
        F.min("order_date").alias("first_ordered_at"),
        F.max("order_date").alias("last_ordered_at"),
        F.sum(F.col("subtotal").cast("bigint")).alias("lifetime_spend_pretax"),
        F.sum(F.col("tax_paid").cast("bigint")).alias("lifetime_tax_paid"),
        F.sum(F.col("order_total").cast("bigint")).alias("lifetime_spend"),
    )
    is_repeat_buyer = F.col("count_lifetime_orders") > 1
    return stg_customers.join(summary, "customer_id", "left").select(
        *stg_customers.columns,
        "count_lifetime_orders",
        "first_ordered_at",
        "last_ordered_at",
        F.lit(True).alias("is_true"),
        "lifetime_spend_pretax",
        "lifetime_tax_paid",
        "lifetime_spend",
        F.when(is_repeat_buyer, "returning").otherwise("new").alias("customer_type"),
    )
