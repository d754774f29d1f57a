"""Ranked and grouped reports over the dollar marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.money import cents_to_dollars, dollars_to_cents


def top_customers(customers: DataFrame, n: int = 10) -> DataFrame:
    """Customers by revenue; ties by id, customers without revenue last."""
    return (
        customers.orderBy(F.col("total_revenue").desc_nulls_last(), "customer_id")
        .limit(n)
        .select("customer_name", "total_revenue", "number_of_orders", "avg_order_value")
    )


def sales_by_type_month(
    stg_order_items: DataFrame, stg_orders: DataFrame, economics: DataFrame
) -> DataFrame:
    """Items, revenue and profit per month and product type.

    Items are counted per month and product first; only those counts meet the products, so a
    best-seller is one row per month by then.
    """
    month = F.trunc(F.col("order_date").cast("date"), "month").alias("month")
    counts = (
        stg_order_items.join(stg_orders.select("order_id", "order_date"), "order_id", "left")
        .groupBy(month, "product_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    n = F.col("n")
    return (
        counts.join(economics, "product_id", "left")
        .groupBy("month", "product_type")
        .agg(
            F.sum(n).alias("number_of_items"),
            cents_to_dollars(F.sum(n * F.col("product_price"))).alias("total_revenue"),
            cents_to_dollars(F.sum(n * F.col("gross_profit"))).alias("total_profit"),
        )
        .orderBy("month", "product_type")
    )


def store_performance(orders: DataFrame, stg_stores: DataFrame) -> DataFrame:
    """Orders, revenue, profit and mean items per order by store, best revenue first."""
    named = orders.join(stg_stores.select("store_id", "store_name"), "store_id", "inner")
    return (
        named.groupBy("store_name")
        .agg(
            F.count_distinct("order_id").alias("number_of_orders"),
            cents_to_dollars(F.sum(dollars_to_cents("total_revenue"))).alias("total_revenue"),
            cents_to_dollars(F.sum(dollars_to_cents("total_profit"))).alias("total_profit"),
            F.round(F.avg("total_items_count"), 6).alias("avg_items_per_order"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_last(), "store_name")
    )


def profitable_products(
    stg_order_items: DataFrame, economics: DataFrame, n: int = 10
) -> DataFrame:
    """Products by total profit. Items collapse to one count per product before the join."""
    counts = stg_order_items.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    profit = F.sum(F.col("n") * F.col("gross_profit"))
    with_profit = F.sum(F.when(F.col("gross_profit").isNotNull(), F.col("n")))
    return (
        counts.join(economics, "product_id", "left")
        .groupBy("product_name", "product_type")
        .agg(
            F.sum("n").alias("times_ordered"),
            F.round(profit.cast("double") / with_profit / 100, 6).alias("avg_profit_per_item"),
            cents_to_dollars(profit).alias("total_profit"),
        )
        .orderBy(F.col("total_profit").desc_nulls_last(), "product_name", "product_type")
        .limit(n)
    )
