"""Product-grain economics, shared by both mart families."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def supply_cost_by_product(stg_supplies: DataFrame) -> DataFrame:
    return stg_supplies.groupBy("product_id").agg(
        F.sum(F.col("supply_cost").cast("bigint")).alias("supply_cost")
    )


def product_economics(
    stg_products: DataFrame, stg_supplies: DataFrame, literal_macro: bool = False
) -> DataFrame:
    """One row per product known to either side: price, cost and unit profit in cents.

    Both dimensions are folded here, at product grain, so that the item table meets one lookup
    instead of two and is exchanged on ``product_id`` once at most. The join is a full outer one
    because an item may name a product that only the supplies know.

    ``literal_macro`` reproduces the unparenthesised form ``1.0*price - cost/100``.
    """
    joined = stg_products.join(supply_cost_by_product(stg_supplies), "product_id", "full")
    price = F.col("product_price").cast("bigint")
    cost = F.coalesce(F.col("supply_cost"), F.lit(0))
    profit = price * 100 - cost if literal_macro else price - cost
    return joined.select(
        "product_id",
        "product_name",
        "product_type",
        price.alias("product_price"),
        "is_food_item",
        "is_drink_item",
        "supply_cost",
        profit.alias("gross_profit"),
    )


def priced_items(stg_order_items: DataFrame, economics: DataFrame) -> DataFrame:
    """Items with their product's economics in cents; unknown products keep NULLs."""
    return stg_order_items.join(economics, "product_id", "left")
