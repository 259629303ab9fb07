"""The five raw tabs and the unit seed, derived from the given star-schema tables.

Every row of the source tables takes part. Dates, numbers and phones are written in the mixed formats a form export
has, chosen by key so that both engines produce the same text. ``testbed.oracle`` states the same derivation in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.values import CATEGORY_NAMES, EXPENSE_CATEGORIES, REFUND_METHODS, RETURN_REASONS, UNITS_OF_MEASURE

def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _pick(n: Column, values: tuple[str, ...]) -> Column:
    return F.get(F.array(*(F.lit(v) for v in values)), n.cast("int"))


def _us(c: Column) -> Column:
    return F.date_format(c, "M/d/yyyy")


def _stamp(c: Column) -> Column:
    return F.date_format(c, "M/d/yyyy H:mm:ss")


def _iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def _text(c: Column) -> Column:
    return c.cast("string")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts with their price and form name, written once per part and not once per line."""
    name = F.concat(F.initcap("p_name"), F.lit(" - "), F.col("p_brand"), F.lit(" "), _text(F.col("p_partkey")))
    return read(spark, sf_dir, "part").withColumns({"retail": F.col("p_retailprice").cast("decimal(18,2)"), "product": name})


def _retail() -> Column:
    return F.col("retail")


def _product() -> Column:
    return F.col("product")


def _pad(c: Column) -> Column:
    return F.concat(F.lit(" "), c, F.lit(" "))


def _salesperson() -> Column:
    return F.when(F.col("l_suppkey") % 50 != 0, _pad(F.col("s_name")))


def _lines(spark: SparkSession, sf_dir: str, with_orders: bool) -> DataFrame:
    """Order lines with their part, supplier and nation, and their order where the customer is needed."""
    lines = read(spark, sf_dir, "lineitem")
    part = _parts(spark, sf_dir)
    supplier, nation = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation")
    if with_orders:
        orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        lines = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return (
        lines.join(part, lines.l_partkey == part.p_partkey)
        .join(supplier, lines.l_suppkey == supplier.s_suppkey)
        .join(nation, supplier.s_nationkey == nation.n_nationkey)
    )


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _lines(spark, sf_dir, with_orders=True).filter("l_returnflag <> 'R'")
    order, line, part, customer = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "o_custkey"))
    day = F.col("l_shipdate")
    price = _retail() * F.when(order % 41 == 0, 1).otherwise(3)
    pretty = F.format_number(price, 2)
    return df.select(
        _stamp(day).alias("Timestamp"),
        F.when(order % 5 == 0, F.date_format(day, "MM/dd/yyyy"))
        .when(order % 5 == 1, F.date_format(day, "dd/MM/yyyy"))
        .when(order % 5 == 2, _iso(day))
        .when(order % 5 == 3, _stamp(day))
        .when(line == 7, "n/a")
        .otherwise(_pad(_us(day)))
        .alias("Date"),
        _salesperson().alias("Salesperson_Name"),
        F.when(part % 251 == 3, F.concat(F.lit("Ghost "), _text(part))).otherwise(_product()).alias("Product"),
        _text(F.col("l_quantity").cast("int")).alias("Units_Sold"),
        F.when(line % 3 == 0, F.concat(F.lit("KES "), pretty))
        .when(line % 3 == 1, pretty)
        .otherwise(_text(price))
        .alias("Unit_Price_KES"),
        _text(F.col("l_discount").cast("decimal(18,2)") * 100).alias("Discount_Amount_KES"),
        F.when(F.col("l_linestatus") == "O", "M-Pesa").otherwise("Bank").alias("Payment_Method"),
        F.when(customer % 7 == 0, None)
        .when(customer % 5 == 0, F.concat(F.lit("254"), F.lpad(_text(customer), 9, "0")))
        .otherwise(F.concat(F.lit("07"), F.lpad(_text(customer), 8, "0")))
        .alias("Customer_Phone_Number"),
        F.when(line % 2 == 0, "Retail").alias("Customer_Type"),
        F.when(F.col("n_nationkey") >= 20, "").otherwise(F.col("n_name")).alias("Business_Unit"),
        F.lit(None).cast("string").alias("Notes"),
    )


def returns_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _lines(spark, sf_dir, with_orders=True).filter("l_returnflag = 'R'")
    line, day = F.col("l_linenumber"), F.col("l_shipdate")
    return df.select(
        _stamp(day).alias("Timestamp"),
        F.when(line % 3 == 0, F.date_format(day, "dd/MM/yyyy")).otherwise(_iso(day)).alias("Date_of_Return"),
        _salesperson().alias("Salesperson_Name"),
        _product().alias("Product_Returned"),
        _text(1 + F.col("l_orderkey") % 3).alias("Units_Returned"),
        F.when(line != 7, _text(_retail() * 3)).alias("Original_Unit_Price_KES"),
        _pick(line % 4, RETURN_REASONS).alias("Reason_for_Return"),
        _pick(F.col("l_suppkey") % 4, REFUND_METHODS).alias("Requested_Refund_Method"),
        F.concat(F.lit("01"), F.lpad(_text(F.col("o_custkey")), 8, "0")).alias("Customer_Phone_Number"),
        F.lit(None).cast("string").alias("Notes"),
        F.when(F.col("n_nationkey") >= 20, "").otherwise(F.col("n_name")).alias("Business_Unit"),
    )


def expenses_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    customer, nation = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    df = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey
    )
    order, day, priority = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_orderpriority")
    total = _text(F.col("o_totalprice").cast("decimal(18,2)"))
    category = F.lit(EXPENSE_CATEGORIES[-1])
    for value, name in zip(("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"), EXPENSE_CATEGORIES):
        category = F.when(priority == value, name).otherwise(category)
    return df.select(
        _stamp(day).alias("Timestamp"),
        F.when(order % 3 == 0, _us(day))
        .when(order % 3 == 1, _iso(day))
        .otherwise(F.concat(F.lit(" "), _stamp(day)))
        .alias("Date_of_Expense"),
        category.alias("Expense_Category"),
        F.when(order % 97 == 0, "-5").otherwise(F.concat(F.lit("KES "), total)).alias("Amount_KES"),
        F.concat(F.lit("order "), _text(order)).alias("Description"),
        F.when(F.col("o_orderstatus") == "F", "Bank").otherwise("M-Pesa").alias("Paid_Via"),
        F.col("c_name").alias("Recorded_By"),
        F.when(F.col("n_nationkey") < 20, F.col("n_name")).alias("Business_Unit"),
    )


def inventory_purchases_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _lines(spark, sf_dir, with_orders=False)
    day = F.col("l_shipdate")
    return df.select(
        _stamp(day).alias("Timestamp"),
        _iso(day).alias("Date_of_Purchase"),
        _product().alias("Product_Purchased"),
        _text((F.col("l_quantity") * 3).cast("int")).alias("Units_Purchased"),
        _text(_retail() * 2 + F.col("l_linenumber") * 10).alias("Unit_Cost_KES"),
        F.col("s_name").alias("Supplier_Name"),
        F.when(F.col("l_linestatus") == "O", "M-Pesa").otherwise("Bank").alias("Payment_Method"),
        F.lit(None).cast("string").alias("Notes_Comments"),
        F.when(F.col("n_nationkey") < 20, F.col("n_name")).alias("Business_Unit"),
    )


def products_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part once; every tenth is submitted again a month later with another price."""
    part = F.col("p_partkey")
    versions = F.when(part % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    df = _parts(spark, sf_dir).withColumn("v", F.explode(versions))
    return df.select(
        F.when(F.col("v") == 1, "2/1/1995 8:00:00").otherwise("1/1/1995 8:00:00").alias("Timestamp"),
        _product().alias("Product_Name"),
        _pick(F.col("p_size") % 7, CATEGORY_NAMES).alias("Category"),
        _pick(F.col("p_size") % 5, UNITS_OF_MEASURE).alias("Unit_of_Measure"),
        _text(_retail() * 3 + F.col("v")).alias("Current_Selling_Price"),
        F.when(part % 4 != 0, _text(F.col("p_size") * 10)).alias("Reorder_Level"),
        F.when(part % 20 == 0, "No").when(part % 3 == 0, "TRUE").otherwise("Yes").alias("Is_Active"),
        F.when(part % 11 != 0, _text(_retail() * 2)).alias("Cost_Price_KES"),
    )


def business_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation").filter("n_nationkey < 12")
    return nation.select(F.col("n_name").alias("unit_name"), (F.col("n_nationkey") + 1).alias("sort_order"))


RAW = {
    "sales_raw": sales_raw,
    "expenses_raw": expenses_raw,
    "inventory_purchases_raw": inventory_purchases_raw,
    "returns_raw": returns_raw,
    "products_raw": products_raw,
    "business_units": business_units,
}
