import pytest

from martloom.plans import marts_v1, marts_v2, reports
from martloom.plans.products import priced_items, product_economics

from .conftest import GOLDEN_PRODUCTS, by_key


def v1_items(stg, literal_macro=False):
    return marts_v1.order_items(
        stg["stg_order_items"],
        stg["stg_orders"],
        stg["stg_products"],
        stg["stg_supplies"],
        literal_macro,
    )


def v1_orders(stg):
    return marts_v1.orders(stg["stg_orders"], v1_items(stg))


@pytest.mark.parametrize("literal", [False, True])
def test_unit_profit_golden(spark, stg, literal):
    economics = product_economics(stg["stg_products"], stg["stg_supplies"], literal)
    items = spark.createDataFrame(
        [(sku, "o", sku) for sku in GOLDEN_PRODUCTS],
        "order_item_id STRING, order_id STRING, product_id STRING",
    )
    found = by_key(marts_v1.item_dollars(priced_items(items, economics)), "product_id")
    for sku, (price, cost, meant, literally) in GOLDEN_PRODUCTS.items():
        row = found[sku]
        assert row["product_price"] == price / 100
        assert row["supply_cost"] == cost / 100
        assert row["gross_profit_per_item"] == (literally if literal else meant)


def test_v1_order_items_edges(stg):
    items = by_key(v1_items(stg), "order_item_id")
    assert len(items) == 6
    bare = items["i4"]
    assert bare["supply_cost"] is None and bare["gross_profit_per_item"] == 3.0
    untyped = items["i5"]
    assert untyped["is_food_item"] is None and untyped["gross_profit_per_item"] == 5.5
    unknown = items["i6"]
    assert unknown["product_name"] is None and unknown["gross_profit_per_item"] is None
    assert unknown["store_id"] == "s2"


def test_product_known_to_supplies_only(spark, stg):
    extra = spark.createDataFrame(
        [("x", "P-unknown", "part", 70, False)], stg["stg_supplies"].schema
    )
    items = marts_v1.order_items(
        stg["stg_order_items"],
        stg["stg_orders"],
        stg["stg_products"],
        stg["stg_supplies"].unionByName(extra),
    )
    row = by_key(items, "order_item_id")["i6"]
    assert row["supply_cost"] == 0.7
    assert row["product_price"] is None and row["gross_profit_per_item"] is None


def test_v1_orders_need_items(stg):
    orders = by_key(v1_orders(stg), "order_id")
    assert set(orders) == {"o1", "o2", "o4"}
    o1 = orders["o1"]
    assert (o1["food_items_count"], o1["drink_items_count"], o1["total_items_count"]) == (1, 1, 2)
    assert (o1["food_revenue"], o1["drink_revenue"], o1["total_revenue"]) == (11.0, 6.0, 17.0)
    assert (o1["food_profit"], o1["drink_profit"], o1["total_profit"]) == (9.79, 5.18, 14.97)
    o4 = orders["o4"]
    assert o4["total_items_count"] == 3 and o4["food_items_count"] == 1
    # The only food item has no supply cost, so the food cost sums a NULL and zeros.
    assert o4["food_cost"] == 0.0 and o4["total_cost"] == 0.5
    assert o4["total_revenue"] == 9.0


def test_v1_customers_keep_orderless(stg):
    customers = by_key(marts_v1.customers(stg["stg_customers"], v1_orders(stg)), "customer_id")
    assert customers["c3"]["number_of_orders"] is None
    assert customers["c3"]["avg_order_value"] is None
    c1 = customers["c1"]
    assert c1["number_of_orders"] == 2
    assert c1["total_revenue"] == 28.0 and c1["avg_order_value"] == 14.0
    assert c1["total_profit"] == 24.76 and c1["avg_order_profit"] == 12.38
    assert len(c1) == 19


def test_same_orders_from_priced_items(stg):
    economics = product_economics(stg["stg_products"], stg["stg_supplies"])
    light = marts_v1.item_dollars(priced_items(stg["stg_order_items"], economics))
    left = by_key(marts_v1.orders(stg["stg_orders"], light), "order_id")
    assert left == by_key(v1_orders(stg), "order_id")


def v2_items(stg):
    return marts_v2.order_items(
        stg["stg_order_items"], stg["stg_orders"], stg["stg_products"], stg["stg_supplies"]
    )


def test_v2_orders(stg):
    orders = by_key(marts_v2.orders(stg["stg_orders"], v2_items(stg)), "order_id")
    assert len(orders) == 4
    o3 = orders["o3"]
    assert o3["count_order_items"] is None and o3["is_food_order"] is None
    numbers = {k: v["customer_order_number"] for k, v in orders.items()}
    assert numbers == {"o1": 1, "o2": 2, "o3": 3, "o4": 1}
    assert orders["o1"]["order_cost"] == 203 and orders["o1"]["is_drink_order"]
    assert not orders["o2"]["is_drink_order"]


def test_v2_customers(stg):
    customers = by_key(marts_v2.customers(stg["stg_customers"], stg["stg_orders"]), "customer_id")
    assert customers["c1"]["customer_type"] == "returning"
    assert customers["c2"]["customer_type"] == "new"
    assert customers["c3"]["customer_type"] == "new"
    assert customers["c3"]["count_lifetime_orders"] is None
    assert customers["c1"]["lifetime_spend"] == 2960
    assert "is_repeat_buyer" not in customers["c1"]


def test_reports(stg):
    orders = v1_orders(stg)
    customers = marts_v1.customers(stg["stg_customers"], orders)
    top = reports.top_customers(customers).collect()
    assert [r.customer_name for r in top] == ["Ann", "Bo", "No Orders"]
    economics = product_economics(stg["stg_products"], stg["stg_supplies"])
    sales = by_key(
        reports.sales_by_type_month(stg["stg_order_items"], stg["stg_orders"], economics),
        "product_type",
    )
    assert sales["food"]["number_of_items"] == 3 and sales["food"]["total_revenue"] == 25.0
    # The untyped and the unknown product share the NULL type.
    assert sales[None]["number_of_items"] == 2 and sales[None]["total_profit"] == 5.5
    stores = reports.store_performance(orders, stg["stg_stores"]).collect()
    assert [(r.store_name, r.number_of_orders) for r in stores] == [("North", 2), ("South", 1)]
    best = reports.profitable_products(stg["stg_order_items"], economics, 2).collect()
    assert [r.product_name for r in best] == ["name T-1", "mystery"]
    assert best[0].times_ordered == 2 and best[0].total_profit == 19.58
