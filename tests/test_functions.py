from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martloom.functions.money import cents_to_dollars, mean_dollars
from martloom.functions.names import epoch_ms_to_utc, materialised_label, quoted_parts
from martloom.functions.text import bin_rank, score_bin


def test_score_bins(spark):
    expected = {
        -1.0: None,
        -0.5: "Very Negative",
        -0.1: "Negative",
        0.1: "Neutral",
        0.5: "Positive",
        1.0: "Very Positive",
        None: None,
        -1.5: None,
        1.5: None,
    }
    df = spark.createDataFrame([(k,) for k in expected], "s DOUBLE")
    label = score_bin(F.col("s"))
    rows = df.select("s", label.alias("b"), bin_rank(label).alias("r")).collect()
    assert {r.s: r.b for r in rows} == expected
    assert {r.b: r.r for r in rows if r.b} == {
        "Very Negative": 1,
        "Negative": 2,
        "Neutral": 3,
        "Positive": 4,
        "Very Positive": 5,
    }


def _half_up(value: Decimal, places: int) -> float:
    return float(value.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-(10**12), 10**12), st.integers(0, 10**6)), min_size=50))
def test_rounding_half_away(spark, pairs):
    df = spark.createDataFrame(pairs, "c BIGINT, n BIGINT")
    rows = df.select(
        "c",
        "n",
        *[cents_to_dollars("c", p).alias(f"p{p}") for p in (0, 1, 2)],
        mean_dollars(F.col("c"), F.col("n")).alias("mean"),
    ).collect()
    for r in rows:
        dollars = Decimal(r.c) / 100
        for p in (0, 1, 2):
            assert r[f"p{p}"] == _half_up(dollars, p)
        assert r.mean == (None if r.n == 0 else _half_up(dollars / r.n, 2))


def test_names(spark):
    df = spark.createDataFrame(
        [('"db"."main"."orders"', 1704067200123), ("bare", None)], "name STRING, ms BIGINT"
    )
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        rows = df.select(
            quoted_parts(F.col("name")).alias("parts"),
            epoch_ms_to_utc(F.col("ms")).cast("string").alias("at"),
            materialised_label(F.col("ms")).alias("label"),
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert rows[0].parts == ["db", "main", "orders"]
    assert rows[0].at == "2024-01-01 00:00:00.123"
    assert rows[0].label == "2024-01-01 00:00:00 (UTC)"
    assert rows[1].parts == [] and rows[1].label == "never materialized"
