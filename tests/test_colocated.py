import pytest
from pyspark.sql import functions as F

from martloom.plans import colocated, marts_v1
from martloom.plans.products import priced_items, product_economics
from martloom.session import scratch_path
from martloom.sources import tables


def plan(df, capsys) -> str:
    df.explain()
    return capsys.readouterr().out


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def schema(spark):
    path = scratch_path(spark, "schema")
    name = "colocated_" + path.rsplit("-", 1)[1]
    tables.ensure_schema(spark, name, path)
    return name


@pytest.fixture
def items(stg):
    economics = product_economics(stg["stg_products"], stg["stg_supplies"])
    return marts_v1.item_dollars(priced_items(stg["stg_order_items"], economics))


def test_marts_equal_the_plain_ones_without_exchange(spark, stg, items, schema, capsys):
    marts = colocated.build(stg["stg_customers"], stg["stg_orders"], items, schema, buckets=4)
    plain = marts_v1.orders(stg["stg_orders"], items)
    assert rows(marts["orders"]) == rows(plain)
    assert rows(marts["customers"]) == rows(marts_v1.customers(stg["stg_customers"], plain))
    placed, bought = (colocated.stored(spark, f"{schema}.{t}") for t in ("placed_orders", "order_items"))
    for df in (colocated.orders(placed, bought), marts["customers"]):
        shown = plan(df, capsys)
        assert "SortMergeJoin" in shown and "Bucketed: true" in shown and "Exchange" not in shown


def test_a_hot_bucket_is_read_as_plain_files(spark, schema, capsys):
    name = f"{schema}.facts"
    key = F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("k")
    df = spark.range(3000).select(key, F.col("id").alias("v"))
    colocated.store(df, name, "k", buckets=8, split=4)
    total = lambda t: t.groupBy("k").agg(F.sum("v").alias("v"))
    even = colocated.stored(spark, name)
    hot = colocated.stored(spark, name, hot_rows=1000)
    assert "Exchange" not in plan(total(even), capsys)
    shown = plan(total(hot), capsys)
    assert "Exchange" in shown and "partial_sum" in shown
    assert rows(total(even)) == rows(total(hot)) == rows(total(df))
    # The rows of the hot key were written by several tasks.
    assert hot.filter("k = 7").select(F.input_file_name()).distinct().count() == 4
    # A bucket of many rows that is no larger than the others is not hot.
    assert "Exchange" not in plan(total(colocated.stored(spark, name, 1000, 100.0)), capsys)


def test_empty_and_null_keys(spark, schema):
    df = spark.createDataFrame([(None, 1), (None, 2), (3, 4)], "k INT, v INT")
    colocated.store(df, f"{schema}.nulls", "k", buckets=4)
    assert rows(colocated.stored(spark, f"{schema}.nulls")) == rows(df)
    colocated.store(df.limit(0), f"{schema}.nulls", "k", buckets=4)
    assert rows(colocated.stored(spark, f"{schema}.nulls")) == []


def test_buckets_grow_with_the_tables(spark, stg, items, schema, monkeypatch):
    monkeypatch.setattr(colocated, "BUCKET_ROWS", 1)
    counted = [spark.range(3), spark.range(4), spark.range(7)]
    marts = colocated.build(stg["stg_customers"], stg["stg_orders"], items, schema, 2, counted)
    for table in ("order_items", "placed_orders", "orders", "known_customers"):
        noted = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {schema}.{table}").collect()}
        assert noted["buckets"] == "8"
    assert rows(marts["orders"]) == rows(marts_v1.orders(stg["stg_orders"], items))
    monkeypatch.setattr(colocated, "BUCKET_ROWS", 1_000_000)
    assert [colocated.enough_buckets(n, 8) for n in (0, 8_000_000, 8_000_001, 216_000_000)] == [8, 8, 16, 256]
