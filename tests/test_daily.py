import datetime as dt

import pytest

from martloom.operators.quality import QualityError
from martloom.plans.daily import build_marts, mart_freshness


def clean(landing):
    """The fixture without its deliberate defects."""
    return {
        **landing,
        "raw_items": landing["raw_items"].filter("sku <> 'P-unknown' AND sku <> 'P-untyped'"),
        "raw_products": landing["raw_products"].filter("type IS NOT NULL"),
        "raw_supplies": landing["raw_supplies"].filter("sku <> 'P-untyped'"),
    }


def test_build(spark, landing, lexicon):
    done = dt.datetime(2024, 1, 10, 12)
    marts = build_marts(
        clean(landing), lexicon, ("food", "drink"), schema="built", finished_at=done
    )
    assert spark.table("built.orders").count() == 3
    assert spark.table("built.customers").filter("number_of_orders IS NULL").count() == 1
    assert marts["product_sentiment"].count() == 2
    assert {t.name for t in spark.catalog.listTables("built")} >= set(marts)
    for late, fresh in ((180, True), (181, False)):
        rows = mart_freshness(spark, done + dt.timedelta(seconds=late), "built").collect()
        assert [r.passed for r in rows] == [fresh] * 6


def test_blocked_before_anything_is_written(spark, landing, lexicon):
    doubled = landing["raw_items"].union(landing["raw_items"])
    with pytest.raises(QualityError, match="raw_items.id unique"):
        build_marts({**clean(landing), "raw_items": doubled}, lexicon, ("food",), schema="blocked")
    assert not spark.catalog.databaseExists("blocked")


def test_blocked_by_landing_rules(landing, lexicon):
    with pytest.raises(QualityError, match="raw_products.type not_null: 1"):
        build_marts(landing, lexicon, ("food", "drink"), schema="blocked")


def test_blocked_by_staging_rules(spark, landing, lexicon):
    with pytest.raises(QualityError, match="stg_products.product_type accepted_values"):
        build_marts(clean(landing), lexicon, ("food",), schema="blocked")
    assert not spark.catalog.databaseExists("blocked")


def test_cent_marts(spark, stg):
    from martloom.plans.daily import build_cent_marts

    rows = [(1, 2, dt.date(2024, 1, 1)), (2, 2, dt.date(2024, 1, 2)), (3, 5, dt.date(2024, 1, 2))]
    seed = spark.createDataFrame(rows, "id INT, item_id INT, event_date DATE")
    for _ in range(2):
        marts = build_cent_marts(stg, seed, "cents")
    assert marts["cent_orders"].count() == 4 and marts["cent_customers"].count() == 3
    assert {r.item_id: r.num_orders for r in spark.table("cents.full_model").collect()} == {2: 2, 5: 1}
    assert spark.table("cents.run_log").count() == 10
    bad = seed.selectExpr("id", "-item_id AS item_id", "event_date")
    with pytest.raises(QualityError, match="positive_item_ids"):
        build_cent_marts(stg, bad, "cents_bad")
    assert not spark.catalog.databaseExists("cents_bad")
