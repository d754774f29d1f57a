import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martloom.operators.ranking import row_numbers


@pytest.mark.parametrize("hot_rows", [3, 50, 10**6])
def test_same_numbers_whatever_is_hot(spark, hot_rows):
    rnd = random.Random(7)
    rows = []
    for i in range(600):
        key = rnd.choice(["big"] * 6 + ["a", "b", None, None])
        at = rnd.choice([None, dt.datetime(2024, 1, rnd.randint(1, 5), rnd.randint(0, 1))])
        rows.append((key, at, i))
    df = spark.createDataFrame(rows, "k STRING, t TIMESTAMP_NTZ, id INT")
    out = row_numbers(df, "k", ("t", "id"), hot_rows=hot_rows, range_rows=50)
    expected = {}
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        mine.sort(key=lambda r: (r[1] is None, r[1] or dt.datetime.min, r[2]))
        expected.update({r[2]: n for n, r in enumerate(mine, 1)})
    assert {r.id: r.row_number for r in out.collect()} == expected
    assert out.columns == ["k", "t", "id", "row_number"]


def test_one_hot_day_is_spread(spark):
    """All rows of a key on one day are numbered in several partitions."""
    df = spark.range(20_000).select(
        F.lit("big").alias("k"), F.lit(dt.datetime(2024, 1, 1)).alias("t"), F.col("id").alias("id")
    )
    out = row_numbers(df, "k", ("t", "id"), hot_rows=2_000, range_rows=2_000)
    assert out.filter("row_number <> id + 1").isEmpty() and out.count() == 20_000
    stored = [f for f in out.inputFiles() if "ranges" in f]
    assert len(stored) >= 5


def test_rows_are_made_once_when_a_key_is_hot(spark):
    """For both parts, and for the sampling of the ranges."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def noted(n):
        made.add(1)
        return -n

    ids = spark.range(60).select(F.when(F.col("id") < 40, 0).otherwise(F.col("id")).alias("k"), "id")
    df = ids.select("k", "id", noted("id").alias("at"))
    got = row_numbers(df, "k", ("at",), keys_from=ids, hot_rows=5, range_rows=7).collect()
    assert sorted((r.k, r.id, r.row_number) for r in got) == sorted(
        (0, i, 40 - i) if i < 40 else (i, i, 1) for i in range(60)
    )
    assert made.value == 60
