import datetime as dt

import pytest

from martloom.schemas import LANDING
from martloom.session import local_session

# (price, supply cost) in cents and the unit profit in dollars, as meant and as the literal macro
# expansion gives it.
GOLDEN_PRODUCTS = {
    "B-1": (600, 82, 5.18, 599.18),
    "B-2": (500, 175, 3.25, 498.25),
    "B-3": (600, 154, 4.46, 598.46),
    "B-4": (700, 82, 6.18, 699.18),
    "B-5": (400, 63, 3.37, 399.37),
    "T-1": (1100, 121, 9.79, 1098.79),
    "T-2": (1100, 251, 8.49, 1097.49),
    "T-3": (1200, 366, 8.34, 1196.34),
    "T-4": (1400, 343, 10.57, 1396.57),
    "T-5": (1200, 239, 9.61, 1197.61),
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "4",
        4,
        **{
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(day: int, hour: int = 0) -> dt.datetime:
    return dt.datetime(2024, 1, day, hour)


ROWS = {
    "raw_customers": [("c1", "Ann"), ("c2", "Bo"), ("c3", "No Orders")],
    "raw_orders": [
        ("o1", "c1", at(1, 9), "s1", 1700, 100, 1800),
        ("o2", "c1", at(2, 9), "s1", 1100, 60, 1160),
        # Same time as o2, and no items.
        ("o3", "c1", at(2, 9), "s2", 0, 0, 0),
        ("o4", "c2", at(3, 9), "s2", 900, 50, 950),
    ],
    "raw_items": [
        ("i1", "o1", "T-1"),
        ("i2", "o1", "B-1"),
        ("i3", "o2", "T-1"),
        # No supplies; no type; unknown product.
        ("i4", "o4", "P-bare"),
        ("i5", "o4", "P-untyped"),
        ("i6", "o4", "P-unknown"),
    ],
    "raw_products": [
        *[
            (sku, f"name {sku}", "drink" if sku[0] == "B" else "food", price, "text")
            for sku, (price, *_) in GOLDEN_PRODUCTS.items()
        ],
        ("P-bare", "plain", "food", 300, None),
        ("P-untyped", "mystery", None, 600, None),
    ],
    "raw_stores": [("s1", "North", at(1), 0.06), ("s2", "South", at(1), 0.04)],
    "raw_supplies": [
        *[
            (f"{sku}-{i}", f"part {i}", part, i == 1, sku)
            for sku, (_, cost, *_) in GOLDEN_PRODUCTS.items()
            for i, part in enumerate((cost - 20, 20))
        ],
        ("u-1", "part", 50, False, "P-untyped"),
    ],
    "raw_tweets": [
        ("t1", "u1", at(5), "I love the NAME T-1, good stuff"),
        ("t2", "u2", at(6), "name t-1 and name B-1 together: bad, bad"),
        ("t3", "u1", at(7), "nothing to see"),
    ],
}


@pytest.fixture(scope="session")
def landing(spark):
    return {name: spark.createDataFrame(rows, LANDING[name].schema) for name, rows in ROWS.items()}


@pytest.fixture(scope="session")
def stg(landing):
    from martloom.plans.daily import staged

    return staged(landing, ("food",), ("drink",))


@pytest.fixture(scope="session")
def lexicon(spark):
    rows = [("love", 3.2), ("good", 1.9), ("bad", -2.5)]
    return spark.createDataFrame(rows, "token STRING, valence DOUBLE")


def by_key(df, *key):
    """Rows of a frame as dictionaries, keyed by one column or a tuple of columns."""
    rows = [r.asDict() for r in df.collect()]
    return {(r[key[0]] if len(key) == 1 else tuple(r[k] for k in key)): r for r in rows}
