"""Amounts beyond ordinary sizes, against Python's decimals."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rows import staged
from tillworks import functions as fn
from tillworks.functions.numeric import MONEY, NUMBER
from tillworks.plans import marts

CENT = Decimal("0.01")
NUMBERS = [
    "0", "1", "-1", "0.005", "-0.005", "0.014999999", "1234.567890123"[:-1], "999999999999999999.999999999", "1000000000000000000",
    "-1000000000000000000.000000005", "12345678901234567890123456789", "10000000000000000.5", "99999999999999999999999999999.999999999",
]
UNITS = [1, 3, 7, 9_999_999_999, 10_000_000_000, 10**12 + 1, -(10**10)]


def exact(units, price, less=Decimal(0)):
    with localcontext() as c:
        c.prec = 90
        return (Decimal(units) * price - less).quantize(CENT, ROUND_HALF_UP)


def test_line_amounts_are_exact_or_an_error(spark):
    cases, beyond = [], []
    for u in UNITS:
        for p in map(Decimal, NUMBERS):
            for less in (Decimal(0), Decimal("0.005"), Decimal("2000000000000000000.004999999")):
                (cases if abs(exact(u, p, less)) < 10**28 else beyond).append((u, p, less))
    df = spark.createDataFrame(cases, "u long, p decimal(38,9), l decimal(38,9)")
    got = df.withColumn("a", fn.line_amount(F.col("u"), F.col("p"), F.col("l"))).withColumn("t", fn.total_value(F.col("u"), F.col("p")))
    assert got.schema["a"].dataType == MONEY and got.schema["t"].dataType == NUMBER
    for r in got.collect():
        assert r.a == exact(r.u, r.p, r.l), r
    assert len(beyond) > 10
    for case in beyond[:3]:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            try:
                row = spark.createDataFrame([case], "u long, p decimal(38,9), l decimal(38,9)")
                if abs(exact(*case)) >= 10**29:
                    with pytest.raises(PySparkException):
                        row.select(fn.line_amount(F.col("u"), F.col("p"), F.col("l"))).collect()
            finally:
                spark.conf.unset("spark.sql.ansi.enabled")


def test_unknown_stays_unknown(spark):
    df = spark.createDataFrame([(None, Decimal(1)), (1, None)], "u long, p decimal(38,9)")
    u, p = F.col("u"), F.col("p")
    got = df.select(fn.line_amount(u, p).alias("a"), fn.total_value(u, p).alias("t"), fn.difference(p, p).alias("d")).collect()
    assert [(r.a, r.t) for r in got] == [(None, None)] * 2 and {r.d for r in got} == {None, 0}


def test_large_form_values_keep_their_rows(spark):
    price = "1000000000000000000"
    sale = {"Date": "1/2/2025", "Product": "Lock", "Timestamp": "1/2/2025 8:00:00", "Salesperson_Name": "a"}
    sales = staged(
        spark, "stg_sales", sale | {"Units_Sold": "1", "Unit_Price_KES": f"KES {price}"},
        sale | {"Units_Sold": "10,000,000,000", "Unit_Price_KES": "5"}, sale | {"Units_Sold": "2", "Unit_Price_KES": "1" + "0" * 16},
        sale | {"Units_Sold": "1", "Unit_Price_KES": "9" * 28}, sale | {"Units_Sold": "1", "Unit_Price_KES": "9" * 30},
    )
    frame, sales = sales, sales.collect()
    assert sorted(r.gross_amount for r in sales) == [0, 5 * 10**10, 2 * 10**16, 10**18, int("9" * 28)]
    spent = {"Date_of_Expense": "1/2/2025", "Expense_Category": "Water", "Amount_KES": price, "Timestamp": "1/2/2025 8:00:00"}
    expenses = staged(spark, "stg_expenses", spent)
    assert expenses.first().amount == Decimal(price)
    assert marts.expense_summary(expenses).first().total_amount == Decimal(price)
    product = {"Product_Name": "Lock", "Current_Selling_Price": price, "Cost_Price_KES": price, "Timestamp": "1/1/2025 8:00:00"}
    products = staged(spark, "stg_products", product)
    assert (products.first().selling_price, products.first().unit_margin_kes) == (Decimal(price), 0)
    bought = {"Date_of_Purchase": "1/1/2025", "Product_Purchased": "Lock", "Units_Purchased": "3", "Unit_Cost_KES": price}
    assert staged(spark, "stg_inventory_purchases", bought).first().total_cost == 3 * Decimal(price)
    back = {"Date_of_Return": "1/2/2025", "Product_Returned": "Lock", "Units_Returned": "4", "Original_Unit_Price_KES": price}
    assert staged(spark, "stg_returns", back).first().return_value == 4 * Decimal(price)
    total = marts.monthly_profit(frame, staged(spark, "stg_returns"), expenses, products).collect()
    with localcontext() as c:
        c.prec = 60
        assert {r.gross_revenue for r in total} == {sum(r.net_amount for r in sales)}
