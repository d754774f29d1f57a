import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martloom.session import configure


def test_small_keys_are_dealt_to_more_tasks_than_cores(spark):
    """Merged to a partition a core, a task holds a share of the keys that grows with the table."""
    assert configure(spark).conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "8m"
    spark.conf.set("spark.sql.shuffle.partitions", "48")
    try:
        # Some 80 MB of random keys.
        keys = spark.range(8_000_000).selectExpr("xxhash64(id) AS k").groupBy("k").count()
        dealt = keys.selectExpr("spark_partition_id() AS p").distinct().count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert dealt > spark.sparkContext.defaultParallelism


def test_long_texts_go_to_python_in_small_batches(spark):
    """Batches of 10,000 texts would be held by executor and worker, however long the texts."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "b": [batch.nbytes]})

    texts = configure(spark).range(0, 3_000, 1, 1).select(F.repeat(F.lit("word "), 1_000).alias("text"))
    rows, largest = texts.mapInArrow(sizes, "n BIGINT, b BIGINT").agg(F.sum("n"), F.max("b")).first()
    assert rows == 3_000 and largest < 3_000_000


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_run_by_themselves_have_the_scale_settings(spark, name, stage):
    other = spark.newSession()
    folder = "/root/testdata/sf0.001"
    stage(other, other.read.parquet(f"{folder}/documents.parquet").limit(20), folder)
    assert other.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "2m"
    assert other.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "8m"
