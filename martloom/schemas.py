"""Declared schemas and keys of every landing table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """A flat table: name, fixed column types and the columns that identify a row."""

    name: str
    ddl: str
    key: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


# Money columns are integer cents.
LANDING = {
    spec.name: spec
    for spec in (
        TableSpec("raw_customers", "id STRING, name STRING", ("id",)),
        TableSpec(
            "raw_orders",
            "id STRING, customer STRING, ordered_at TIMESTAMP_NTZ, store_id STRING, "
            "subtotal INT, tax_paid INT, order_total INT",
            ("id",),
        ),
        TableSpec("raw_items", "id STRING, order_id STRING, sku STRING", ("id",)),
        TableSpec(
            "raw_products",
            "sku STRING, name STRING, type STRING, price INT, description STRING",
            ("sku",),
        ),
        TableSpec(
            "raw_stores",
            "id STRING, name STRING, opened_at TIMESTAMP_NTZ, tax_rate DOUBLE",
            ("id",),
        ),
        TableSpec(
            "raw_supplies",
            "id STRING, name STRING, cost INT, perishable BOOLEAN, sku STRING",
            ("id", "sku"),
        ),
        TableSpec(
            "raw_tweets",
            "id STRING, user_id STRING, tweeted_at TIMESTAMP_NTZ, content STRING",
            ("id",),
        ),
    )
}

SEED_EVENTS = TableSpec(
    "seed_events", "id INT, item_id INT, event_date DATE", ("id", "event_date")
)

RUN_LOG = TableSpec(
    "run_log",
    "model STRING, interval_start DATE, interval_end DATE, finished_at TIMESTAMP_NTZ",
    ("model", "interval_start", "finished_at"),
)
