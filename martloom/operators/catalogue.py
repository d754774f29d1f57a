"""The rules every table carries."""

from __future__ import annotations

from collections.abc import Sequence

from martloom.functions.text import BIN_LABELS
from martloom.operators.quality import Rule
from martloom.schemas import LANDING


def _not_null(table: str, *columns: str) -> list[Rule]:
    return [Rule.not_null(table, c) for c in columns]


def _key(table: str, column: str) -> list[Rule]:
    return [Rule.unique(table, column), Rule.not_null(table, column)]


def _at_least(table: str, low: float, *columns: str) -> list[Rule]:
    return [Rule.accepted_range(table, c, low) for c in columns]


def source_rules() -> list[Rule]:
    """Declared source keys; supplies have no single-column key."""
    rules = []
    for spec in LANDING.values():
        if spec.name == "raw_supplies":
            rules += _not_null(spec.name, "id")
        else:
            rules += _key(spec.name, spec.key[0])
    return rules


def _tweet_rules(table: str) -> list[Rule]:
    return _key(table, "id") + _not_null(table, "user_id", "tweeted_at", "content")


def _product_rules(table: str, product_types: Sequence[str]) -> list[Rule]:
    return [
        *_key(table, "product_id"),
        *_not_null(
            table,
            "product_name",
            "product_type",
            "product_price",
            "is_food_item",
            "is_drink_item",
        ),
        Rule.accepted_values(table, "product_type", product_types),
        *_at_least(table, 0, "product_price"),
    ]


def _supply_rules(table: str) -> list[Rule]:
    return [
        *_not_null(table, "supply_id", "product_id", "supply_name", "supply_cost", "perishable"),
        *_at_least(table, 0, "supply_cost"),
    ]


def staging_rules(product_types: Sequence[str]) -> list[Rule]:
    return [
        *_key("stg_customers", "customer_id"),
        *_not_null("stg_customers", "customer_name"),
        *_key("stg_orders", "order_id"),
        *_key("stg_order_items", "order_item_id"),
        *_not_null("stg_order_items", "order_id", "product_id"),
        Rule.relationships("stg_order_items", "order_id", "stg_orders", "order_id"),
        Rule.relationships("stg_order_items", "product_id", "stg_products", "product_id"),
        *_product_rules("stg_products", product_types),
        *_key("stg_stores", "store_id"),
        *_not_null("stg_stores", "store_name", "opened_at", "tax_rate"),
        Rule.accepted_range("stg_stores", "tax_rate", 0, 1),
        *_supply_rules("stg_supplies"),
        Rule.relationships("stg_supplies", "product_id", "stg_products", "product_id"),
        *_tweet_rules("stg_tweets"),
    ]


def mart_rules(product_types: Sequence[str]) -> list[Rule]:
    return [
        *_product_rules("products", product_types),
        *_supply_rules("supplies"),
        Rule.unique("supplies", "supply_id", "product_id"),
        *_tweet_rules("tweets"),
        *_key("order_items", "order_item_id"),
        *_not_null(
            "order_items",
            "order_id",
            "order_date",
            "store_id",
            "product_id",
            "product_name",
            "product_price",
            "gross_profit_per_item",
            "is_food_item",
            "is_drink_item",
        ),
        Rule.relationships("order_items", "store_id", "stg_stores", "store_id"),
        Rule.relationships("order_items", "product_id", "stg_products", "product_id"),
        *_at_least("order_items", 0, "product_price", "supply_cost"),
        *_key("orders", "order_id"),
        *_not_null(
            "orders",
            "customer_id",
            "store_id",
            "order_date",
            "status",
            "total_items_count",
            "total_revenue",
            "total_profit",
        ),
        Rule.relationships("orders", "customer_id", "customers", "customer_id"),
        Rule.relationships("orders", "store_id", "stg_stores", "store_id"),
        Rule.accepted_values("orders", "status", ("completed",)),
        *_at_least("orders", 1, "total_items_count"),
        *_at_least("orders", 0, "total_revenue", "total_cost"),
        *_key("customers", "customer_id"),
        *_not_null("customers", "customer_name"),
        *_at_least(
            "customers",
            0,
            "number_of_orders",
            "total_food_items",
            "total_drink_items",
            "total_items",
            "total_food_revenue",
            "total_drink_revenue",
            "total_revenue",
            "total_food_cost",
            "total_drink_cost",
            "total_cost",
            "avg_order_value",
        ),
    ]


# Columns each landing suite requires; every one is also checked for NULLs, unless named below.
LANDING_REQUIRED = {
    "raw_items": ("id", "sku", "order_id"),
    "raw_orders": ("id", "customer", "ordered_at"),
    "raw_supplies": ("id", "name", "cost", "perishable", "sku"),
    "raw_stores": ("id", "name", "opened_at", "tax_rate"),
    "raw_products": ("sku", "name", "type", "price"),
    "raw_customers": ("id", "name"),
    "raw_tweets": ("id", "user_id", "tweeted_at", "content"),
}
NULLS_ALLOWED = {("raw_supplies", "perishable")}


def landing_rules() -> list[Rule]:
    """Blocking suites on the landing tables; here repeated NULL keys count as duplicates and NaN
    as missing."""
    rules = []
    for table, columns in LANDING_REQUIRED.items():
        rules += [Rule.required_columns(table, *columns), Rule.row_count(table)]
        checked = [c for c in columns if (table, c) not in NULLS_ALLOWED]
        rules += [Rule.not_null(table, c, nan_is_null=True) for c in checked]
        if table != "raw_supplies":
            rules.append(Rule.unique(table, LANDING[table].key[0], nulls_fail=True))
    return rules


def sentiment_rules(strict_null: bool = False, table: str = "product_sentiment") -> list[Rule]:
    """Blocking suite on the sentiment mart.

    A product mentioned once has no sample deviation; ``strict_null`` makes that a failure.
    """
    return [
        Rule.row_count(table),
        Rule.required_columns(
            table, "product_name", "avg_sentiment", "mention_count", "sentiment_category"
        ),
        Rule.not_null(table, "product_name"),
        Rule.unique(table, "product_name", nulls_fail=True),
        Rule.accepted_range(table, "avg_sentiment", -1, 1, nulls_fail=True, nan_is_null=True),
        Rule.accepted_range(table, "mention_count", 1, nulls_fail=True),
        Rule.accepted_range(table, "sentiment_std", 0, nulls_fail=strict_null, nan_is_null=True),
        Rule.accepted_values(table, "sentiment_category", BIN_LABELS, nulls_fail=True),
    ]
