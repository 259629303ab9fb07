from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import expense, product, purchase, returned, sale, staged

from tillworks.plans import dashboards, marts

AS_OF = dt.date(2025, 7, 20)
MAY, JULY = dt.date(2025, 5, 1), dt.date(2025, 7, 1)


@pytest.fixture
def tables(spark):
    """Empty staging tables that a test fills as it needs."""

    def make(**rows):
        names = {"products": "stg_products", "sales": "stg_sales", "returns": "stg_returns", "expenses": "stg_expenses",
                 "purchases": "stg_inventory_purchases"}
        return {short: staged(spark, table, *rows.get(short, [])) for short, table in names.items()}

    return make


def units(spark, *names):
    return spark.createDataFrame([(n, i) for i, n in enumerate(names)], "unit_name string, sort_order int")


def test_null_unit_is_one_group_across_sales_and_returns(tables):
    t = tables(sales=[sale(Business_Unit=None)], returns=[returned(Business_Unit=" ")])
    row, = marts.daily_sales_summary(t["sales"], t["returns"]).collect()
    assert (row.unit, row.transaction_count, row.return_transaction_count) == (None, 1, 1)
    assert (row.net_revenue, row.effective_revenue, row.mpesa_revenue, row.bank_revenue) == (550, 250, 550, 0)
    assert (row.day_of_week, row.day_of_month) == (1, 4)


def test_daily_keeps_days_with_returns_only(tables):
    t = tables(sales=[sale()], returns=[returned("5/6/2025")])
    rows = marts.daily_sales_summary(t["sales"], t["returns"]).orderBy("sale_date").collect()
    assert [(r.transaction_count, r.effective_revenue) for r in rows] == [(1, 550), (0, -300)]


def test_monthly_profit(tables):
    t = tables(products=[product()], sales=[sale(), sale(Product="Unknown", Business_Unit=None)], returns=[returned()],
               expenses=[expense(), expense("6/1/2025")])
    got = marts.monthly_profit(t["sales"], t["returns"], t["expenses"], t["products"])
    rows = {(r.month.month, r.unit): r for r in got.collect()}
    assert rows.keys() == {(5, "Hope"), (5, None), (6, "Hope")}
    may = rows[5, "Hope"]
    assert (may.gross_revenue, may.net_revenue, may.total_cogs, may.gross_profit, may.net_profit) == (550, 250, 400, -150, -250)
    assert (may.net_margin_pct, may.sale_count, may.expense_entries) == (Decimal("-100.0"), 1, 1)
    assert (rows[5, None].total_cogs, rows[5, None].net_margin_pct) == (0, 100)
    assert (rows[6, "Hope"].net_revenue, rows[6, "Hope"].net_margin_pct, rows[6, "Hope"].net_profit) == (0, 0, -100)


@pytest.mark.parametrize("sold, status, reorder", [(20, "Out of Stock", True), (10, "Low Stock", True), (9, "In Stock", False)])
def test_stock_status(tables, sold, status, reorder):
    t = tables(products=[product(), product("Off", Is_Active="No")], purchases=[purchase()], sales=[sale(Units_Sold=str(sold))])
    row, = marts.inventory_position(t["products"], t["purchases"], t["sales"], t["returns"]).collect()
    assert (row.stock_on_hand, row.stock_status, row.needs_reorder) == (20 - sold, status, reorder)


def test_latest_unit_cost_is_that_of_the_last_purchase(tables):
    t = tables(products=[product()], purchases=[purchase("5/9/2025", Unit_Cost_KES="210"), purchase("5/1/2025", Unit_Cost_KES="250"),
                                                purchase("5/9/2025", Unit_Cost_KES="205", Timestamp="5/1/2025 8:59:59")])
    row, = marts.inventory_position(t["products"], t["purchases"], t["sales"], t["returns"]).collect()
    assert (row.latest_unit_cost, row.last_purchase_date, row.total_purchase_cost) == (210, dt.date(2025, 5, 9), 13300)
    assert (row.inventory_value_at_cost, row.inventory_value_at_retail) == (12600, 18000)


def test_product_performance_is_dense_over_active_products_and_all_months(tables):
    t = tables(products=[product(), product("Glue"), product("Off", Is_Active="No")],
               sales=[sale(), sale(Unit_Price_KES="100"), sale("3/2/2025", Product="Off")], returns=[returned("4/1/2025")])
    got = marts.product_performance(t["products"], t["sales"], t["returns"], AS_OF)
    rows = {(r.product_key, r.month.month): r for r in got.collect()}
    assert rows.keys() == {(k, m) for k in ("locks_moment", "glue") for m in (3, 4, 5, 7)}
    may = rows["locks_moment", 5]
    # One sale at 300 earns 2 x 100; the one at 100 is below cost and its margin counts as 0.
    assert (may.total_transactions, may.total_units_sold, may.total_revenue, may.total_cogs) == (2, 4, 700, 800)
    assert (may.total_gross_profit, may.gross_margin_pct, may.avg_selling_price) == (200, Decimal("28.6"), 200)
    assert (may.first_sale_date, may.last_sale_date) == (dt.date(2025, 5, 4), dt.date(2025, 5, 4))
    april = rows["locks_moment", 4]
    assert (april.total_units_returned, april.total_gross_profit, april.gross_margin_pct) == (1, -300, None)
    empty = rows["glue", 7]
    assert (empty.total_revenue, empty.first_sale_date, empty.gross_margin_pct) == (0, None, None)


def test_unit_performance_lists_every_seeded_unit(spark, tables):
    t = tables(products=[product()], sales=[sale(), sale(Business_Unit="Elsewhere"), sale("6/2/2025", Business_Unit=None)],
               returns=[returned()], expenses=[expense("4/2/2025", Business_Unit="Elsewhere")])
    got = marts.unit_performance(units(spark, "Hope", "Tsavo"), t["sales"], t["returns"], t["expenses"], t["products"], AS_OF)
    rows = {(r.unit, r.month.month): r for r in got.collect()}
    assert rows.keys() == {(u, m) for u in ("Hope", "Tsavo") for m in (4, 5, 7)}  # June has no unit, so no month
    hope = rows["Hope", 5]
    assert (hope.total_revenue, hope.total_cogs, hope.gross_profit, hope.return_rate_pct) == (550, 400, -150, 50.0)
    assert (hope.net_margin_pct, hope.salespeople_count, hope.active_days) == (Decimal("-27.3"), 1, 1)
    tsavo = rows["Tsavo", 7]
    assert (tsavo.total_revenue, tsavo.first_sale_date, tsavo.net_margin_pct, tsavo.return_rate_pct) == (0, None, None, None)


def test_salesperson_without_name_keeps_a_row_without_measures(tables):
    t = tables(sales=[sale(Salesperson_Name=None), sale()], returns=[returned(Salesperson_Name="Bo")])
    rows = {r.salesperson_name: r for r in marts.salesperson_performance(t["sales"], t["returns"]).collect()}
    assert rows.keys() == {None, "ANN", "BO"}
    assert (rows[None].total_transactions, rows[None].total_revenue, rows[None].first_sale_date) == (0, 0, None)
    assert (rows["ANN"].total_revenue, rows["BO"].total_units_returned, rows["BO"].avg_transaction_value) == (550, 1, 0)


def test_returns_rate_counts_sales_of_unlisted_products(tables):
    t = tables(products=[product("Glue")], sales=[sale(Units_Sold="4")], returns=[returned(Customer_Phone_Number="0712345678"),
               returned(Product_Returned="Glue"), returned(Product_Returned="Nothing")])
    rows = {r.product_key: r for r in marts.returns_analysis(t["returns"], t["products"], t["sales"]).collect()}
    assert (rows["locks_moment"].product_return_rate_pct, rows["locks_moment"].product_name) == (25.0, None)
    assert (rows["glue"].product_return_rate_pct, rows["glue"].product_name) == (None, "Glue")
    assert rows["nothing"].customer_phone is None and rows["locks_moment"].customer_phone == "0712345678"
    masked = marts.returns_analysis(t["returns"], t["products"], t["sales"], mask_phones=True)
    assert masked.filter("customer_phone = '0712****78'").count() == 1


@pytest.mark.parametrize("spent, tier", [("10000", "VIP"), ("9999.99", "Regular"), ("3000", "Regular"), ("2999.99", "Occasional")])
def test_customer_tiers(tables, spent, tier):
    t = tables(sales=[sale(Units_Sold="1", Unit_Price_KES=spent, Discount_Amount_KES=None)])
    row, = marts.customer_insights(t["sales"], AS_OF).collect()
    assert (row.customer_tier, row.is_repeat_customer, row.days_since_last_purchase) == (tier, False, 77)


def test_customers_are_grouped_by_full_phone(tables):
    other = "0712999978"  # same mask
    t = tables(sales=[sale(), sale("5/5/2025"), sale(Customer_Phone_Number=other), sale(Customer_Phone_Number="none")])
    rows = marts.customer_insights(t["sales"], AS_OF).orderBy("total_transactions").collect()
    assert [(r.customer_phone_masked, r.total_transactions, r.is_repeat_customer) for r in rows] == [
        ("0712****78", 1, False), ("0712****78", 2, True),
    ]


def test_sums_agree_between_marts_and_staging(spark, tables):
    days = ["5/4/2025", "5/5/2025", "6/1/2025"]
    sales = [sale(d, Business_Unit=u, Units_Sold=str(n)) for d in days for u in ("Hope", None) for n in (1, 2)]
    t = tables(products=[product()], sales=sales, returns=[returned(d) for d in days], expenses=[expense()])
    staged_net = t["sales"].agg(F.sum("net_amount")).first()[0]
    daily = marts.daily_sales_summary(t["sales"], t["returns"])
    monthly = marts.monthly_profit(t["sales"], t["returns"], t["expenses"], t["products"])
    assert daily.agg(F.sum("net_revenue")).first()[0] == staged_net
    assert monthly.agg(F.sum("gross_revenue")).first()[0] == staged_net
    assert daily.count() == daily.select("sale_date", "unit").distinct().count() == 6


@pytest.mark.parametrize("mart", marts.BUILDERS)
def test_columns(spark, tables, mart):
    t = tables()
    builder, inputs, takes_as_of = marts.BUILDERS[mart]
    short = {"stg_products": "products", "stg_sales": "sales", "stg_returns": "returns", "stg_expenses": "expenses",
             "stg_inventory_purchases": "purchases"}
    frames = [units(spark, "Hope") if i == "business_units" else t[short[i]] for i in inputs]
    df = builder(*frames, **({"as_of": AS_OF} if takes_as_of else {}))
    assert df.columns == marts.COLUMNS[mart]
    assert df.count() == (1 if mart == "unit_performance" else 0)


def test_some_months_of_products_are_those_of_the_whole_mart(spark, tables):
    t = tables(
        products=[product(), product("Glue"), product("Rope", Is_Active="No")],
        sales=[sale(), sale("5/9/2025", Unit_Price_KES="310"), sale("6/1/2025", Product="Glue"), sale("4/2/2025", Product="Rope")],
        returns=[returned("6/3/2025"), returned("3/3/2025", Product_Returned="Nobody knows")],
    )
    inputs = t["products"], t["sales"], t["returns"]
    whole = marts.product_performance(*inputs, as_of=AS_OF)
    assert whole.count() == 2 * 5  # months 3 to 7
    for months in (MAY, AS_OF, dt.date(2024, 1, 1), (dt.date(2025, 4, 30), dt.date(2025, 6, 2))):
        def only(rows):
            return dashboards.this_month(rows, months)

        some = marts.product_performance(*inputs, as_of=AS_OF, only=only)
        assert some.schema == whole.schema
        assert sorted(some.collect(), key=str) == sorted(only(whole).collect(), key=str)


def test_a_month_that_a_product_lacks_has_no_margin(tables):
    t = tables(products=[product()], sales=[sale()])
    rows = {r.month: r for r in marts.product_performance(t["products"], t["sales"], t["returns"], AS_OF).collect()}
    assert (rows[MAY].total_gross_profit, rows[MAY].gross_margin_pct) == (200, Decimal("36.4"))
    july = rows[JULY]
    assert (july.total_gross_profit, july.gross_margin_pct, july.total_units_sold, july.first_sale_date) == (0, None, 0, None)
