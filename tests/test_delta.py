import random

import pytest
from pyspark.sql import functions as F

from martloom.operators import versions
from martloom.plans import delta, marts_v1
from martloom.plans.products import priced_items, product_economics
from martloom.session import scratch_path
from martloom.sources import tables

ITEMS = "order_item_id STRING, order_id STRING, product_id STRING"


def priced(spark, stg, rows, sign=None):
    items = spark.createDataFrame(rows, ITEMS)
    economics = product_economics(stg["stg_products"], stg["stg_supplies"])
    out = priced_items(items, economics)
    if sign is not None:
        return marts_v1.item_dollars(out.withColumn("sign", F.lit(sign)), ("sign",))
    return marts_v1.item_dollars(out)


def rows_of(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.fixture
def names(spark):
    path = scratch_path(spark, "schema")
    schema = "delta_" + path.rsplit("-", 1)[1]
    tables.ensure_schema(spark, schema, path)
    return f"{schema}.orders", f"{schema}.customers"


def holds(spark, stg, names, rows):
    """The stored marts against marts built from all items."""
    orders = marts_v1.orders(stg["stg_orders"], priced(spark, stg, rows))
    customers = marts_v1.customers(stg["stg_customers"], orders)
    got = delta.orders_mart(spark.table(names[0]))
    assert rows_of(got, orders.columns) == rows_of(orders, orders.columns)
    assert rows_of(spark.table(names[1]), customers.columns) == rows_of(customers, customers.columns)


def test_like_a_rebuild(spark, stg, names):
    rnd = random.Random(5)
    products = ["T-1", "T-2", "B-1", "B-3", "P-bare", "P-untyped", "P-unknown"]
    rows = [(f"i{k}", f"o{rnd.randrange(1, 5)}", rnd.choice(products)) for k in range(12)]
    sides = stg["stg_customers"], stg["stg_orders"]
    delta.create(*sides, priced(spark, stg, rows), *names, 5)
    holds(spark, stg, names, rows)
    for n in range(3):
        # An item goes, one changes its product, one comes, one comes for an order that is not there.
        gone, changed, *kept = rnd.sample(rows, len(rows))
        put = [(changed[0], changed[1], rnd.choice(products)), (f"n{n}", f"o{rnd.randrange(1, 5)}", "P-unknown")]
        rows = kept + put
        out = priced(spark, stg, [gone, changed], -1)
        changes = out.unionByName(priced(spark, stg, [*put, (f"x{n}", "none such", "T-1")], 1))
        for _ in range(2):  # the second call changes nothing
            touched = delta.apply(*sides, changes, f"change {n}", *names, 5)
            assert touched and set(touched) <= set(range(5))
            holds(spark, stg, names, rows)
    # Orders that lose all their items leave, those of unknown products alone keep NULL sums.
    out = priced(spark, stg, [r for r in rows if r[1] != "o4"], -1)
    delta.apply(*sides, out, "all but one", *names, 5)
    holds(spark, stg, names, [r for r in rows if r[1] == "o4"])
    assert delta.apply(*sides, out.limit(0), "nothing", *names, 5) == []


def test_a_call_that_died_is_made_again(spark, stg, names, monkeypatch):
    rows = [("i1", "o1", "T-1"), ("i2", "o2", "B-1"), ("i3", "o4", "T-1")]
    sides = stg["stg_customers"], stg["stg_orders"]
    delta.create(*sides, priced(spark, stg, rows), *names, 3)
    changes = priced(spark, stg, [("i4", "o4", "T-2")], 1)
    switch = versions._switch

    def dies(spark_, table, *rest):
        if table == names[1]:
            raise RuntimeError("lost")
        switch(spark_, table, *rest)

    monkeypatch.setattr(versions, "_switch", dies)
    with pytest.raises(RuntimeError):
        delta.apply(*sides, changes, "one more", *names, 3)
    monkeypatch.setattr(versions, "_switch", switch)
    delta.apply(*sides, changes, "one more", *names, 3)
    holds(spark, stg, names, [*rows, ("i4", "o4", "T-2")])


def test_only_touched_buckets_are_read_and_replaced(spark, stg, names):
    rows = [(f"i{k}", f"o{k}", "T-1") for k in (1, 2, 3, 4)]
    sides = stg["stg_customers"], stg["stg_orders"]
    delta.create(*sides, priced(spark, stg, rows), *names, 16)
    before = {r.bucket: r.version for r in versions.manifest(spark, names[0]).collect()}
    touched = delta.apply(*sides, priced(spark, stg, [("i9", "o4", "B-1")], 1), "c2 only", *names, 16)
    after = {r.bucket: r.version for r in versions.manifest(spark, names[0]).collect()}
    assert len(touched) == 1 and {b for b in after if after[b] != before[b]} == set(touched)
    plan = spark.table(names[0]).filter(F.col("bucket").isin(touched))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [(bucket" in plan
