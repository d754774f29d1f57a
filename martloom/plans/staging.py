"""Landing tables to cleaned staging frames. Narrow projections only: nothing here shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("id").alias("customer_id"), F.col("name").alias("customer_name"))


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("order_id"),
        F.col("customer").alias("customer_id"),
        F.col("ordered_at").alias("order_date"),
        "store_id",
        "subtotal",
        "tax_paid",
        "order_total",
        F.lit("completed").alias("status"),
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("order_item_id"), "order_id", F.col("sku").alias("product_id")
    )


def _in_types(types: Sequence[str]) -> Column:
    return F.col("type").isin(list(types))


def stg_products(
    raw: DataFrame,
    food_types: Sequence[str] = ("food",),
    drink_types: Sequence[str] = ("drink",),
    trim_names: bool = False,
) -> DataFrame:
    """A NULL type leaves both flags NULL."""
    name = F.trim("name") if trim_names else F.col("name")
    return raw.select(
        F.col("sku").alias("product_id"),
        name.alias("product_name"),
        F.col("type").alias("product_type"),
        "description",
        F.col("price").alias("product_price"),
        _in_types(food_types).alias("is_food_item"),
        _in_types(drink_types).alias("is_drink_item"),
    )


def stg_stores(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("store_id"), F.col("name").alias("store_name"), "opened_at", "tax_rate"
    )


def stg_supplies(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("supply_id"),
        F.col("sku").alias("product_id"),
        F.col("name").alias("supply_name"),
        F.col("cost").alias("supply_cost"),
        "perishable",
    )


def stg_tweets(raw: DataFrame, on_bad_time: str = "raise") -> DataFrame:
    """``on_bad_time``: ``raise`` fails on an unreadable time, ``null`` lets it through as NULL."""
    at = F.col("tweeted_at")
    at = at.cast("timestamp_ntz") if on_bad_time == "raise" else at.try_cast("timestamp_ntz")
    return raw.select("id", "user_id", at.alias("tweeted_at"), "content")


def bad_tweets(raw: DataFrame) -> DataFrame:
    """Rows whose time text is present but unreadable."""
    return raw.filter(
        F.col("tweeted_at").isNotNull() & F.col("tweeted_at").try_cast("timestamp_ntz").isNull()
    )
