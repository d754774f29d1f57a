"""Behaviour that only shows at size: lookups beyond their bound, hot keys, shared folders."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from martloom.operators.lookup import bounded, spread
from martloom.plans import marts_v1
from martloom.plans.products import priced_items
from martloom.session import scratch_root, written


def plan(df, capsys) -> str:
    df.explain()
    return capsys.readouterr().out


def test_bounded_names_the_join(spark, capsys):
    big = spark.range(1000)
    small = spark.createDataFrame([(1, "a"), (2, "b")], "id BIGINT, s STRING")
    assert "BroadcastHashJoin" in plan(big.join(bounded(small), "id"), capsys)
    for beyond in (bounded(small, max_rows=1), bounded(small, max_text=1)):
        joined = big.join(beyond, "id")
        assert "SortMergeJoin" in plan(joined, capsys)
        assert joined.count() == 2


def test_spread_only_when_short_of_splits(spark, tmp_path):
    path = str(tmp_path / "one")
    spark.range(10).coalesce(1).write.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.read.parquet(path)).rdd.getNumPartitions() == cores
    wide = spark.range(10, numPartitions=cores + 1)
    assert spread(wide) is wide


def test_written_cuts_lineage(spark, capsys):
    df = spark.range(5).withColumn("r", F.col("id") * 2)
    stored = written(df, "ids")
    assert stored.dtypes == df.dtypes
    assert "Range" not in plan(stored, capsys) and stored.count() == 5


def test_no_local_folder_on_a_cluster():
    def session(master, folder=None):
        context = SimpleNamespace(
            master=master,
            getConf=lambda: SimpleNamespace(get=lambda key: folder),
            getCheckpointDir=lambda: None,
        )
        conf = SimpleNamespace(get=lambda key, default=None: default)
        return SimpleNamespace(sparkContext=context, conf=conf)

    assert scratch_root(session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(session("yarn"))


def test_a_third_of_all_items_in_one_order_and_product(spark):
    n = 30_000
    hot = F.col("id") % 3 == 0
    items = spark.range(n).select(
        F.col("id").alias("order_item_id"),
        F.when(hot, 0).otherwise(F.col("id")).alias("order_id"),
        F.when(hot, 0).otherwise(F.col("id") % 100).alias("product_id"),
    )
    economics = spark.range(100).select(
        F.col("id").alias("product_id"),
        F.lit("p").alias("product_name"),
        F.lit(250).cast("bigint").alias("product_price"),
        (F.col("id") == 0).alias("is_food_item"),
        F.lit(False).alias("is_drink_item"),
        F.lit(100).cast("bigint").alias("supply_cost"),
        F.lit(150).cast("bigint").alias("gross_profit"),
    )
    priced = priced_items(items, economics.hint("merge"))
    summary = marts_v1.order_summary(marts_v1.item_dollars(priced))
    row = summary.filter("order_id = 0").first()
    assert row.total_items_count == row.food_items_count == n // 3
    assert row.total_profit == 150 * (n // 3)
    assert summary.count() == 1 + n - n // 3


def test_items_are_not_exchanged_for_their_product(spark, capsys):
    """Economics within the bound: the item table meets them without an exchange on the product."""
    from martloom.workloads import QUERIES

    for name in ("v1_orders", "v2_orders", "v1_order_items"):
        text = plan(QUERIES[name](spark, "/root/testdata/sf0.001"), capsys)
        merged = [line for line in text.splitlines() if "SortMergeJoin [product_id" in line]
        # Products and supply costs meet so; items are the left side of an outer join.
        assert all(line.rstrip().endswith("FullOuter") for line in merged)
        assert "BroadcastHashJoin [product_id" in text


def test_partitions_are_never_lowered(spark):
    from martloom.session import configure

    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    configure(spark)
    found = spark.conf.get(initial, None)
    assert found is None or int(found) >= int(spark.conf.get("spark.sql.shuffle.partitions"))
