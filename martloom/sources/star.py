"""Shape the star-schema parquet tables into the landing tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.lookup import spread

# Which part types of this data count as food or drink.
FOOD_TYPES = ("ECONOMY", "STANDARD", "MEDIUM")
DRINK_TYPES = ("SMALL", "PROMO")


class Star:
    """The parquet tables of one folder, read lazily, and the landing shapes derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """Opened once: a query naming a table twice lists and reads its footers once."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def documents(self) -> DataFrame:
        """Texts, spread over the cores before any work on them."""
        return spread(self.table("documents").select("doc_id", "text"))

    def raw_customers(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("name")
        )

    def raw_stores(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.table("nation").select(
            key.alias("id"),
            F.col("n_name").alias("name"),
            F.date_add(F.lit("2018-01-01").cast("date"), key * 30).alias("opened_at"),
            ((key % 9).cast("double") / 100).alias("tax_rate"),
        )

    def raw_orders(self) -> DataFrame:
        total = F.rint(F.col("o_totalprice") * 100).cast("bigint")
        tax = F.floor(F.col("order_total") * (F.col("store_id") % 9) / 100).cast("bigint")
        placed = (
            self.table("orders")
            .select("o_orderkey", "o_custkey", "o_orderdate", total.alias("order_total"))
            .join(
                self.table("customer").select(
                    F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("store_id")
                ),
                "o_custkey",
            )
        )
        return placed.select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("customer"),
            F.col("o_orderdate").alias("ordered_at"),
            "store_id",
            (F.col("order_total") - tax).alias("subtotal"),
            tax.alias("tax_paid"),
            "order_total",
        )

    def raw_items(self) -> DataFrame:
        parts = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        return self.table("lineitem").select(
            F.concat_ws("-", *[F.col(c).cast("string") for c in parts]).alias("id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("sku"),
        )

    def raw_products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("sku"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("type"),
            F.rint(F.col("p_retailprice") * 100).cast("bigint").alias("price"),
            F.col("p_brand").alias("description"),
        )

    def raw_supplies(self) -> DataFrame:
        """One row per supplier and part seen together on a line; the cost is made from both keys."""
        pairs = self.table("lineitem").select("l_suppkey", "l_partkey").distinct()
        names = self.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
        return pairs.join(names, "l_suppkey").select(
            F.col("l_suppkey").alias("id"),
            F.col("s_name").alias("name"),
            (10 + (F.col("l_suppkey") * 7 + F.col("l_partkey") * 3) % 200).alias("cost"),
            (F.col("l_suppkey") % 2 == 0).alias("perishable"),
            F.col("l_partkey").alias("sku"),
        )

    def raw_tweets(self) -> DataFrame:
        authors = self.table("events").select(F.col("event_id").alias("doc_id"), "user_id", "ts")
        return (
            self.documents()
            .join(authors, "doc_id")
            .select(
                F.col("doc_id").alias("id"),
                "user_id",
                F.col("ts").alias("tweeted_at"),
                F.col("text").alias("content"),
            )
        )

    def seed_events(self, where: Column | None = None) -> DataFrame:
        events = self.table("events")
        return (events if where is None else events.filter(where)).select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("item_id"),
            F.col("ts").cast("date").alias("event_date"),
        )
