from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from rows import expense, product, purchase, returned, sale, staged

from tillworks.plans import staging


@pytest.mark.parametrize("table", staging.BUILDERS)
def test_columns(spark, table):
    assert staged(spark, table).columns == staging.COLUMNS[table]


def test_sales_are_cleaned_and_unreadable_rows_dropped(spark):
    df = staged(
        spark, "stg_sales", sale(), sale(Date=None), sale(" "), sale("soon"), sale(Product=" "), sale(Units_Sold="0"),
        sale(Units_Sold="-1"), sale(Units_Sold="x"), sale(Unit_Price_KES=None, Customer_Phone_Number="712", Business_Unit=" "),
    )
    rows = sorted(df.collect(), key=lambda r: r.unit_price)
    assert len(rows) == 2
    assert (rows[1].gross_amount, rows[1].net_amount) == (Decimal("600.00"), Decimal("550.00"))
    assert (rows[1].salesperson_name, rows[1].product_key, rows[1].customer_type) == ("ANN", "locks_moment", "")
    assert (rows[0].unit_price, rows[0].net_amount, rows[0].customer_phone, rows[0].unit) == (0, Decimal("-50.00"), None, None)


def test_repeated_sales_are_kept(spark):
    rows = staged(spark, "stg_sales", sale(), sale(Units_Sold="3"), sale(Unit_Price_KES="1")).collect()
    assert len(rows) == 3 and len({r.sale_id for r in rows}) == 1


def test_net_is_taken_from_the_unrounded_product(spark):
    row = staged(spark, "stg_sales", sale(Units_Sold="3", Unit_Price_KES="0.335", Discount_Amount_KES="0.004")).first()
    assert (row.gross_amount, row.net_amount) == (Decimal("1.01"), Decimal("1.00"))


def test_products_keep_the_latest_row_and_inactive_ones(spark):
    df = staged(
        spark, "stg_products", product(Current_Selling_Price="1", Timestamp=None),
        product(Current_Selling_Price="2", Timestamp="1/5/2025 8:00:00"),
        product(Current_Selling_Price="3", Timestamp="2/1/2025 8:00:00", Cost_Price_KES="1"),
        product("Glue", Is_Active="No", Cost_Price_KES=None, Reorder_Level=""), product("Gone", Current_Selling_Price="0"),
    )
    rows = {r.product_key: r for r in df.collect()}
    assert rows.keys() == {"locks_moment", "glue"}
    assert (rows["locks_moment"].selling_price, rows["locks_moment"].unit_margin_kes) == (3, Decimal("2.00"))
    assert rows["locks_moment"].unit_margin_pct == Decimal("66.7")
    glue = rows["glue"]
    assert (glue.is_active, glue.reorder_level, glue.unit_margin_pct, glue.unit_margin_kes) == (False, 5, None, 300)


def test_expenses_purchases_returns(spark):
    spent = staged(spark, "stg_expenses", expense(), expense(Amount_KES="-5"), expense(Expense_Category=None),
                   expense(Expense_Category=" ")).collect()
    assert sorted(r.expense_category for r in spent) == ["", "Water"]
    bought = staged(spark, "stg_inventory_purchases", purchase(), purchase(Unit_Cost_KES="0"), purchase(Product_Purchased=None),
                    purchase(Product_Purchased=" ")).collect()
    assert sorted(r.product_key for r in bought) == ["", "locks_moment"] and bought[0].total_cost == Decimal("4000.00")
    back = staged(spark, "stg_returns", returned(), returned(Original_Unit_Price_KES=None), returned(Product_Returned=" ")).collect()
    assert sorted(r.return_value for r in back) == [0, 300]
    assert all(r.return_date == dt.date(2025, 5, 4) for r in back)
