from __future__ import annotations

import datetime as dt

import pytest
from rows import expense, product, purchase, raw, returned, sale, staged

from tillworks.operators import joins, ordering
from tillworks.plans import dashboards, marts, quality
from tillworks.plans.rebuild import rebuild
from tillworks.sources.layers import Layers
from tillworks.values import RAW_DB

AS_OF = dt.date(2025, 7, 20)


def test_single_checks(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, "b", "x"), (None, None, "x")], "i int, s string, t string")
    assert [tuple(r) for r in quality.unique(df, "i").collect()] == [(1, 2)]
    assert quality.not_null(df, "t").count() == 2
    assert [tuple(r) for r in quality.accepted_values(df, "s", ["a"]).collect()] == [("b", 1)]
    assert [tuple(r) for r in quality.unique_combination(df, ["i", "t"]).collect()] == [(1, None, 2)]
    parent = spark.createDataFrame([("a",)], "s string")
    assert [tuple(r) for r in quality.relationships(df, parent, "s").collect()] == [("b", 1)]
    assert {tuple(r) for r in quality.null_counts(df, ["i", "t"]).collect()} == {("i", 1), ("t", 2)}
    odd = quality.odd_values(df, [("s", ["a"]), ("t", ["y"])])
    assert {tuple(r) for r in odd.collect()} == {("s", "b", 1), ("t", "x", 2)}


def test_business_rules(spark):
    sales = staged(spark, "stg_sales", sale(), sale("8/1/2025"), sale(Unit_Price_KES="199"))
    returns = staged(spark, "stg_returns", returned(), returned("8/1/2025", Original_Unit_Price_KES=None))
    purchases = staged(spark, "stg_inventory_purchases", purchase(), purchase("4/1/2025", Unit_Cost_KES="9999"))
    assert quality.no_future_sale_dates(sales, AS_OF).count() == 1
    assert quality.no_future_return_dates(returns, AS_OF).count() == 1
    assert quality.no_negative_return_value(returns).count() == 1
    assert [r.sale_price for r in quality.sale_price_above_cost(sales, purchases).collect()] == [199]
    products = staged(spark, "stg_products", product())
    inventory = marts.inventory_position(products, purchases, staged(spark, "stg_sales", sale(Units_Sold="41")), returns)
    assert [r.stock_on_hand for r in quality.stock_never_negative(inventory).collect()] == []
    inventory = marts.inventory_position(products, purchases, staged(spark, "stg_sales", sale(Units_Sold="50")), returns)
    assert [r.stock_on_hand for r in quality.stock_never_negative(inventory).collect()] == [-8]


@pytest.fixture
def layers(spark, tmp_path, request):
    made = Layers(spark, str(tmp_path), request.node.name.split("[")[0] + "_")
    rows = {"products_raw": [product()], "sales_raw": [sale(), sale("7/19/2025", Units_Sold="1")], "returns_raw": [returned()],
            "expenses_raw": [expense()], "inventory_purchases_raw": [purchase()]}
    for table, some in rows.items():
        made.replace(raw(spark, table, *some), RAW_DB, table)
    return made


def test_rebuild(layers, spark):
    with pytest.raises(Exception, match="business_units"):  # seeds only come with a full run
        rebuild(layers, "normal", AS_OF)
    summary = rebuild(layers, "full", AS_OF).collect()
    assert len(summary) == 78 and all(r.status == "pass" and r.failures == 0 for r in summary)
    for name in marts.BUILDERS:
        assert layers.mart(name).columns == marts.COLUMNS[name]
        ordering.sort_by(layers.mart(name), *marts.ORDER[name]).collect()
    assert layers.mart("unit_performance").count() == 12 * 2
    # A dirty load: nothing stops, the checks report it.
    dirty = [sale(), sale(), sale("12/31/2025", Business_Unit="Attic", Product="Ghost", Payment_Method="Shells")]
    layers.replace(raw(spark, "sales_raw", *dirty), RAW_DB, "sales_raw")
    rebuild(layers, "normal", AS_OF)
    summary = rebuild(layers, "test_only", AS_OF).filter("status = 'warn'").collect()
    failed = {(r.table_name, r.check_name, r.column_name): r.failures for r in summary}
    assert failed == {
        ("stg_sales", "unique", "sale_id"): 1, ("stg_sales", "accepted_values", "unit"): 1,
        ("stg_sales", "accepted_values", "payment_method"): 1, ("stg_sales", "relationships", "product_key"): 1,
        ("stg_sales", "no_future_sale_dates", "sale_date"): 1,
    }
    with pytest.raises(ValueError):
        rebuild(layers, "sometimes")
    # Dashboards read the stored marts.
    bars = dashboards.top10_products(layers.mart("product_performance"), dt.date(2025, 5, 31)).collect()
    assert [tuple(r) for r in bars] == [("Locks - Moment", 1100)]
    recent = dashboards.revenue_last_7_days(layers.mart("daily_sales_summary"), dt.date(2025, 5, 5)).collect()
    assert [r.sale_date.day for r in recent] == [4]
    assert dashboards.returns_table(layers.mart("returns_analysis"), reason="Defective").count() == 1
    assert dashboards.returns_table(layers.mart("returns_analysis"), product="Glue").count() == 0


def test_inventory_table_puts_out_of_stock_first(spark):
    columns = "product_name string, category string, stock_on_hand bigint, reorder_level bigint, stock_status string, " \
              "inventory_value_at_cost int, last_purchase_date date"
    rows = [(s[0], "c", 1, 1, s, 1, None) for s in ("In Stock", "Out of Stock", "Low Stock")]
    shown = dashboards.inventory_table(spark.createDataFrame(rows, columns)).collect()
    assert [r.stock_status for r in shown] == ["Out of Stock", "Low Stock", "In Stock"]


def test_null_safe_join(spark):
    left = spark.createDataFrame([(1, None, "a"), (1, "u", "b")], "d int, unit string, l string")
    right = spark.createDataFrame([(1, None, "x")], "d int, unit string, r string")
    joined = joins.left_null_safe(left, right, ["d", "unit"])
    assert {(r.l, r.r) for r in joined.collect()} == {("a", "x"), ("b", None)}
