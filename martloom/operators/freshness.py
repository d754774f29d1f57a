"""Freshness of datasets and models from the run log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Last-update bound of the marts, in seconds.
MART_BOUND_SECONDS = 180
MARTS = ("tweets", "products", "orders", "order_items", "customers", "supplies")

# Per-dataset policies (dataset, seconds, severity, seconds between deadlines).
DATASET_POLICIES = (
    ("customers", 3600, "error", None),
    ("orders", 3600, "error", None),
    ("stg_orders", 7200, "error", None),
    ("stg_stores", 7200, "error", None),
    ("stg_products", 7200, "error", None),
    ("stg_supplies", 7200, "error", None),
    ("tweets", 60, "warn", 300),
)

POLICY_DDL = "dataset STRING, max_lag_seconds INT, severity STRING, deadline_seconds INT"
EPOCH = "1970-01-01 00:00:00"


def mart_policies() -> list[tuple]:
    return [(name, MART_BOUND_SECONDS, "error", None) for name in MARTS]


def _last_deadline(as_of: Column, every: Column) -> Column:
    """The latest whole multiple of ``every`` seconds at or before ``as_of``."""
    epoch = F.lit(EPOCH).cast("timestamp_ntz")
    since = F.timestamp_diff("SECOND", epoch, as_of)
    return epoch + F.make_dt_interval(secs=since - since % every)


def freshness(log: DataFrame, policies: DataFrame, as_of: Column) -> DataFrame:
    """Lag of each dataset against its bound at ``as_of``; a dataset never updated is stale.

    A policy with deadlines is judged at its last deadline instead; an update after it makes the
    lag negative. ``log`` has (dataset, finished_at) and is reduced to one row per dataset before
    the join.
    """
    last = log.groupBy("dataset").agg(F.max("finished_at").alias("last_update"))
    moment = F.coalesce(_last_deadline(as_of, F.col("deadline_seconds")), as_of)
    lag = F.timestamp_diff("SECOND", F.col("last_update"), moment)
    return policies.join(last, "dataset", "left").select(
        "dataset",
        "last_update",
        lag.alias("lag_seconds"),
        "max_lag_seconds",
        "severity",
        F.coalesce(lag <= F.col("max_lag_seconds"), F.lit(False)).alias("passed"),
    )
