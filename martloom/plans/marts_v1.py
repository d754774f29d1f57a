"""Marts in dollars with profit; orders need at least one item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.money import cents_to_dollars, dollars_to_cents, mean_dollars
from martloom.operators.lookup import bounded
from martloom.plans.products import priced_items, product_economics

KINDS = ("food", "drink", "total")


def item_dollars(priced: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Dollar columns of priced items, with ``extra`` columns kept in place after the ids."""
    return priced.select(
        "order_item_id",
        "order_id",
        "product_id",
        *extra,
        "product_name",
        cents_to_dollars("product_price").alias("product_price"),
        "is_food_item",
        "is_drink_item",
        cents_to_dollars("supply_cost").alias("supply_cost"),
        cents_to_dollars("gross_profit").alias("gross_profit_per_item"),
    )


def order_items(
    stg_order_items: DataFrame,
    stg_orders: DataFrame,
    stg_products: DataFrame,
    stg_supplies: DataFrame,
    literal_macro: bool = False,
) -> DataFrame:
    economics = bounded(product_economics(stg_products, stg_supplies, literal_macro))
    priced = priced_items(stg_order_items, economics).join(
        stg_orders.select("order_id", "order_date", "store_id"), "order_id", "left"
    )
    return item_dollars(priced, ("order_date", "store_id"))


def _kind_flag(kind: str) -> Column | None:
    return None if kind == "total" else F.col(f"is_{kind}_item")


def order_measures() -> dict[str, Column]:
    """Cents that each item adds to a sum of its order."""
    measures = {}
    for measure, column in (
        ("revenue", "product_price"),
        ("cost", "supply_cost"),
        ("profit", "gross_profit_per_item"),
    ):
        cents = dollars_to_cents(column)
        for kind in KINDS:
            flag = _kind_flag(kind)
            part = cents if flag is None else F.when(flag, cents).otherwise(F.lit(0))
            measures[f"{kind}_{measure}"] = part
    return measures


def order_summary(items: DataFrame) -> DataFrame:
    """Counts and cent sums per order. ``items`` needs only the item columns, not the order's."""
    counts = []
    for kind in KINDS:
        flag = _kind_flag(kind)
        n = F.count(F.lit(1)) if flag is None else F.count_if(flag)
        counts.append(n.alias(f"{kind}_items_count"))
    sums = [F.sum(part).alias(name) for name, part in order_measures().items()]
    return items.groupBy("order_id").agg(*counts, *sums)


def orders(stg_orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders having items. ``items`` is the order_items mart or ``item_dollars`` of priced items.

    Items are summarised to ``order_id`` before the join, so the join reuses that exchange and
    both sides carry one row per order.
    """
    joined = stg_orders.join(order_summary(items), "order_id", "inner")
    return joined.select(
        "order_id",
        "customer_id",
        "store_id",
        "order_date",
        "status",
        *[f"{kind}_items_count" for kind in KINDS],
        *[
            cents_to_dollars(f"{kind}_{measure}").alias(f"{kind}_{measure}")
            for measure in ("revenue", "cost", "profit")
            for kind in KINDS
        ],
    )


def customers(stg_customers: DataFrame, orders_mart: DataFrame) -> DataFrame:
    """All customers; those without orders keep NULL measures."""
    sums = [
        F.sum(f"{kind}_items_count").alias("total_items" if kind == "total" else f"total_{kind}_items")
        for kind in KINDS
    ]
    money = []
    for measure in ("revenue", "cost", "profit"):
        for kind in KINDS:
            name = f"total_{measure}" if kind == "total" else f"total_{kind}_{measure}"
            sums.append(F.sum(dollars_to_cents(f"{kind}_{measure}")).alias(name))
            money.append(name)
    summary = orders_mart.groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_at"),
        F.max("order_date").alias("most_recent_order_at"),
        F.count(F.lit(1)).alias("number_of_orders"),
        *sums,
    )
    n = F.col("number_of_orders")
    return stg_customers.join(summary, "customer_id", "left").select(
        "customer_id",
        "customer_name",
        "first_order_at",
        "most_recent_order_at",
        "number_of_orders",
        "total_food_items",
        "total_drink_items",
        "total_items",
        *[cents_to_dollars(name).alias(name) for name in money],
        mean_dollars(F.col("total_revenue"), n).alias("avg_order_value"),
        mean_dollars(F.col("total_profit"), n).alias("avg_order_profit"),
    )


def products(stg_products: DataFrame) -> DataFrame:
    return stg_products.select("*")


def supplies(stg_supplies: DataFrame) -> DataFrame:
    return stg_supplies.select("*")


def tweets(stg_tweets: DataFrame) -> DataFrame:
    return stg_tweets.select("*")
