"""The whole build in call order: landing checks, staging, marts, sentiment, checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.catalogue import landing_rules, mart_rules, sentiment_rules, staging_rules
from martloom.operators.freshness import POLICY_DDL, freshness, mart_policies
from martloom.operators.contract import enforce_contract
from martloom.operators.incremental import create_day_table, log_runs, orders_per_item, rebuild_days
from martloom.operators.lookup import bounded
from martloom.operators.quality import QualityError, Rule, audit, audit_passes, evaluate, gate
from martloom.operators.sentiment import product_sentiment
from martloom.plans import marts_v1, marts_v2, staging
from martloom.plans.products import priced_items, product_economics
from martloom.schemas import LANDING
from martloom.sources.tables import ensure_schema, materialise, qualify


def staged(
    landing: Mapping[str, DataFrame], food_types: Sequence[str], drink_types: Sequence[str]
) -> dict[str, DataFrame]:
    return {
        "stg_customers": staging.stg_customers(landing["raw_customers"]),
        "stg_orders": staging.stg_orders(landing["raw_orders"]),
        "stg_order_items": staging.stg_order_items(landing["raw_items"]),
        "stg_products": staging.stg_products(landing["raw_products"], food_types, drink_types),
        "stg_stores": staging.stg_stores(landing["raw_stores"]),
        "stg_supplies": staging.stg_supplies(landing["raw_supplies"]),
        "stg_tweets": staging.stg_tweets(landing["raw_tweets"]),
    }


def build_marts(
    landing: Mapping[str, DataFrame],
    lexicon: DataFrame,
    product_types: Sequence[str],
    food_types: Sequence[str] = ("food",),
    drink_types: Sequence[str] = ("drink",),
    schema: str = "main",
    finished_at: datetime | None = None,
) -> dict[str, DataFrame]:
    """Check the landing tables, then store every dollar mart and the sentiment mart.

    The marts' updates go to ``schema.run_log`` under ``finished_at`` (default: now, UTC). Raises
    QualityError before anything is written when a landing check fails, ContractError when the
    tweets break their contract, and QualityError before the next layer when a staging or mart
    rule does.
    """
    gate(evaluate(landing, landing_rules()))
    enforce_contract(landing["raw_tweets"], LANDING["raw_tweets"])
    stg = staged(landing, food_types, drink_types)
    for name, df in stg.items():
        materialise(df, name, "view")
    gate(evaluate(stg, staging_rules(product_types)))

    def store(name: str, df: DataFrame) -> DataFrame:
        return materialise(df, name, "table", schema)

    economics = store(
        "product_economics", product_economics(stg["stg_products"], stg["stg_supplies"])
    )
    dated = priced_items(stg["stg_order_items"], bounded(economics)).join(
        stg["stg_orders"].select("order_id", "order_date", "store_id"), "order_id", "left"
    )
    marts = {"order_items": store("order_items", marts_v1.item_dollars(dated, ("order_date", "store_id")))}
    marts["orders"] = store("orders", marts_v1.orders(stg["stg_orders"], marts["order_items"]))
    marts["customers"] = store("customers", marts_v1.customers(stg["stg_customers"], marts["orders"]))
    marts["products"] = store("products", marts_v1.products(stg["stg_products"]))
    marts["supplies"] = store("supplies", marts_v1.supplies(stg["stg_supplies"]))
    marts["tweets"] = store("tweets", marts_v1.tweets(stg["stg_tweets"]))
    gate(evaluate({**stg, **marts}, mart_rules(product_types)))
    sentiment = product_sentiment(marts["tweets"], marts["products"], lexicon)
    marts["product_sentiment"] = store("product_sentiment", sentiment)
    gate(evaluate(marts, sentiment_rules()))
    done = finished_at or datetime.now(timezone.utc).replace(tzinfo=None)
    log_runs(
        sentiment.sparkSession,
        qualify("run_log", schema),
        [(name, done.date(), done.date() + timedelta(days=1), done) for name in marts],
    )
    return marts


def build_cent_marts(
    stg: Mapping[str, DataFrame], seed: DataFrame, schema: str = "main", finished_at: datetime | None = None
) -> dict[str, DataFrame]:
    """Store the marts in cents, the day-partitioned seed and the orders per item, checked.

    ``stg`` holds the staging frames, ``seed`` the dated rows (id, item_id, event_date). Raises
    QualityError before anything is stored when a staged key is broken, and when an item id of the
    seed is negative. The updates go to ``schema.run_log``.
    """
    spark = seed.sparkSession
    keys = {"stg_orders": "order_id", "stg_order_items": "order_item_id", "stg_customers": "customer_id"}
    rules = [r for t, c in keys.items() for r in (Rule.unique(t, c), Rule.not_null(t, c))]
    gate(evaluate(stg, rules))
    if not audit_passes(seed, F.col("item_id") < 0):
        raise QualityError(audit("positive_item_ids", seed, F.col("item_id") < 0).select(
            F.lit("full_model").alias("table_name"), F.lit("item_id").alias("column_name"),
            F.col("audit").alias("rule"), "n_failed",
        ).collect())
    ensure_schema(spark, schema)
    economics = materialise(
        product_economics(stg["stg_products"], stg["stg_supplies"]), "cent_economics", "table", schema
    )
    priced = priced_items(stg["stg_order_items"], bounded(economics))
    dates = stg["stg_orders"].select("order_id", F.col("order_date").alias("ordered_at"))
    items = priced.join(dates, "order_id", "left").select(
        "order_item_id", "order_id", "product_id", "ordered_at", *marts_v2.ITEM_COLUMNS
    )
    marts = {"cent_order_items": materialise(items, "cent_order_items", "table", schema)}
    orders = marts_v2.orders(stg["stg_orders"], marts["cent_order_items"])
    marts["cent_orders"] = materialise(orders, "cent_orders", "table", schema)
    customers = marts_v2.customers(stg["stg_customers"], stg["stg_orders"])
    marts["cent_customers"] = materialise(customers, "cent_customers", "table", schema)
    name = qualify("incremental_model", schema)
    if not spark.catalog.tableExists(name):
        create_day_table(seed, name)
    else:
        rebuild_days(seed, seed.select("event_date"), name)
    marts["incremental_model"] = spark.table(name)
    full = orders_per_item(marts["incremental_model"])
    marts["full_model"] = materialise(full, "full_model", "table", schema)
    done = finished_at or datetime.now(timezone.utc).replace(tzinfo=None)
    log_runs(
        spark,
        qualify("run_log", schema),
        [(name, done.date(), done.date() + timedelta(days=1), done) for name in marts],
    )
    return marts


def mart_freshness(spark: SparkSession, as_of: datetime, schema: str = "main") -> DataFrame:
    """How stale each stored mart is at ``as_of``, judged from the run log."""
    log = spark.table(qualify("run_log", schema)).select(F.col("model").alias("dataset"), "finished_at")
    policies = spark.createDataFrame(mart_policies(), POLICY_DDL)
    return freshness(log, policies, F.lit(as_of.isoformat()).cast("timestamp_ntz"))
