"""Typed, cleaned staging tables, one function per table: raw DataFrame in, staging DataFrame out.

Each is one narrow pass over its raw table (filter, parse, filter), except for products, which also keeps the latest
row per product key. Rows that lack a required field, or whose date or quantity cannot be read, are dropped.

``whole`` says that the table is read or stored whole: its columns are then computed once, before rows are dropped. Without
it, a reader's filter can move down to the raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks import functions as fn
from tillworks import schemas
from tillworks.functions.parsing import default_if_unparsable
from tillworks.operators.filters import computed_once, date_parsed, positive, required_present
from tillworks.operators.windows import latest_per_key
from tillworks.values import DEFAULT_REORDER_LEVEL

COLUMNS: dict[str, list[str]] = {table: schemas.names(ddl) for table, ddl in schemas.STAGING.items()}


def _settled(parsed: DataFrame, whole: bool) -> DataFrame:
    return computed_once(parsed) if whole else parsed


def stg_products(products_raw: DataFrame, whole: bool = True) -> DataFrame:
    name = F.col("Product_Name")
    parsed = required_present(products_raw, ["Product_Name"]).select(
        fn.product_key_slug(name).alias("product_key"),
        fn.trim_ws(name).alias("product_name"),
        fn.product_family(name).alias("product_family"),
        fn.product_variant(name).alias("product_variant"),
        fn.trim_ws(F.col("Category")).alias("category"),
        fn.trim_ws(F.col("Unit_of_Measure")).alias("unit_of_measure"),
        fn.parse_form_number(F.col("Current_Selling_Price")).alias("selling_price"),
        fn.parse_form_number(F.col("Cost_Price_KES")).alias("cost_price"),
        default_if_unparsable(fn.parse_form_int(F.col("Reorder_Level")), DEFAULT_REORDER_LEVEL).alias("reorder_level"),
        fn.parse_bool_flag(F.col("Is_Active")).alias("is_active"),
        fn.parse_form_timestamp(F.col("Timestamp")).alias("submitted_at"),
    )
    # Only submitted_at decides; the other columns make equal or missing timestamps repeatable.
    newest_first = [F.col("submitted_at").desc_nulls_last()] + [
        F.col(c).desc_nulls_last()
        for c in ("product_name", "selling_price", "cost_price", "reorder_level", "is_active", "category",
                  "unit_of_measure")
    ]
    latest = latest_per_key(positive(_settled(parsed, whole), "selling_price"), ["product_key"], newest_first)
    selling, cost = F.col("selling_price"), F.col("cost_price")
    margin = F.round(fn.difference(selling, fn.zero_if_null(cost)), 2).cast(fn.MONEY)
    return latest.withColumns({
        "unit_margin_kes": margin,
        "unit_margin_pct": F.when(cost.isNotNull(), fn.ratio_pct(fn.difference(selling, cost), selling)),
    }).select(COLUMNS["stg_products"])


def stg_sales(sales_raw: DataFrame, whole: bool = True) -> DataFrame:
    date, person, product = F.col("Date"), F.col("Salesperson_Name"), F.col("Product")
    parsed = required_present(sales_raw, ["Date", "Product"]).select(
        fn.surrogate_key(fn.trim_ws(date), fn.trim_ws(person), fn.trim_ws(product), F.col("Timestamp")).alias("sale_id"),
        fn.parse_form_date(date).alias("sale_date"),
        fn.upper_name(person).alias("salesperson_name"),
        fn.product_key_slug(product).alias("product_key"),
        fn.parse_form_int(F.col("Units_Sold")).alias("units_sold"),
        default_if_unparsable(fn.parse_form_number(F.col("Unit_Price_KES")), 0).cast(fn.NUMBER).alias("unit_price"),
        default_if_unparsable(fn.parse_form_number(F.col("Discount_Amount_KES")), 0)
        .cast(fn.NUMBER).alias("discount_amount"),
        fn.trim_ws(F.col("Payment_Method")).alias("payment_method"),
        fn.validate_phone(F.col("Customer_Phone_Number")).alias("customer_phone"),
        fn.null_to_blank(F.col("Customer_Type")).alias("customer_type"),
        fn.blank_to_null(F.col("Business_Unit")).alias("unit"),
        fn.blank_to_null(F.col("Notes")).alias("notes"),
        fn.parse_form_timestamp(F.col("Timestamp")).alias("submitted_at"),
    )
    kept = date_parsed(positive(_settled(parsed, whole), "units_sold"), "sale_date")
    units, price, discount = F.col("units_sold"), F.col("unit_price"), F.col("discount_amount")
    return kept.withColumns({
        "gross_amount": fn.line_amount(units, price),
        "net_amount": fn.line_amount(units, price, less=discount),
    }).select(COLUMNS["stg_sales"])


def stg_expenses(expenses_raw: DataFrame, whole: bool = True) -> DataFrame:
    date, category, amount = F.col("Date_of_Expense"), F.col("Expense_Category"), F.col("Amount_KES")
    # A blank category counts as given, a missing one does not.
    parsed = required_present(expenses_raw, ["Date_of_Expense"], ["Expense_Category"]).select(
        fn.surrogate_key(fn.trim_ws(date), fn.trim_ws(category), fn.trim_ws(amount), F.col("Timestamp"))
        .alias("expense_id"),
        fn.parse_form_date(date).alias("expense_date"),
        fn.trim_ws(category).alias("expense_category"),
        fn.parse_form_number(amount).alias("amount"),
        fn.blank_to_null(F.col("Description")).alias("description"),
        fn.trim_ws(F.col("Paid_Via")).alias("paid_via"),
        fn.upper_name(F.col("Recorded_By")).alias("recorded_by"),
        fn.blank_to_null(F.col("Business_Unit")).alias("unit"),
        fn.parse_form_timestamp(F.col("Timestamp")).alias("submitted_at"),
    )
    return date_parsed(positive(_settled(parsed, whole), "amount"), "expense_date").select(COLUMNS["stg_expenses"])


def stg_inventory_purchases(inventory_purchases_raw: DataFrame, whole: bool = True) -> DataFrame:
    date, product, units = F.col("Date_of_Purchase"), F.col("Product_Purchased"), F.col("Units_Purchased")
    # A blank product counts as given, a missing one does not.
    parsed = required_present(inventory_purchases_raw, ["Date_of_Purchase"], ["Product_Purchased"]).select(
        fn.surrogate_key(fn.trim_ws(date), fn.trim_ws(product), fn.trim_ws(units), F.col("Timestamp"))
        .alias("purchase_id"),
        fn.parse_form_date(date).alias("purchase_date"),
        fn.product_key_slug(product).alias("product_key"),
        fn.parse_form_int(units).alias("units_purchased"),
        fn.parse_form_number(F.col("Unit_Cost_KES")).alias("unit_cost"),
        fn.blank_to_null(F.col("Supplier_Name")).alias("supplier_name"),
        fn.trim_ws(F.col("Payment_Method")).alias("payment_method"),
        fn.blank_to_null(F.col("Business_Unit")).alias("unit"),
        fn.blank_to_null(F.col("Notes_Comments")).alias("notes"),
        fn.parse_form_timestamp(F.col("Timestamp")).alias("submitted_at"),
    )
    kept = date_parsed(positive(_settled(parsed, whole), "units_purchased", "unit_cost"), "purchase_date")
    total = fn.line_amount(F.col("units_purchased"), F.col("unit_cost"))
    return kept.withColumn("total_cost", total).select(COLUMNS["stg_inventory_purchases"])


def stg_returns(returns_raw: DataFrame, whole: bool = True) -> DataFrame:
    date, person, product = F.col("Date_of_Return"), F.col("Salesperson_Name"), F.col("Product_Returned")
    units = F.col("Units_Returned")
    parsed = required_present(returns_raw, ["Date_of_Return", "Product_Returned"]).select(
        fn.surrogate_key(
            fn.trim_ws(date), fn.trim_ws(person), fn.trim_ws(product), fn.trim_ws(units), F.col("Timestamp")
        ).alias("return_id"),
        fn.parse_form_date(date).alias("return_date"),
        fn.upper_name(person).alias("salesperson_name"),
        fn.product_key_slug(product).alias("product_key"),
        fn.parse_form_int(units).alias("units_returned"),
        default_if_unparsable(fn.parse_form_number(F.col("Original_Unit_Price_KES")), 0)
        .cast(fn.NUMBER).alias("original_unit_price"),
        fn.trim_ws(F.col("Reason_for_Return")).alias("return_reason"),
        fn.trim_ws(F.col("Requested_Refund_Method")).alias("refund_method"),
        fn.validate_phone(F.col("Customer_Phone_Number")).alias("customer_phone"),
        fn.blank_to_null(F.col("Business_Unit")).alias("unit"),
        fn.blank_to_null(F.col("Notes")).alias("notes"),
        fn.parse_form_timestamp(F.col("Timestamp")).alias("submitted_at"),
    )
    kept = date_parsed(positive(_settled(parsed, whole), "units_returned"), "return_date")
    value = fn.line_amount(F.col("units_returned"), F.col("original_unit_price"))
    return kept.withColumn("return_value", value).select(COLUMNS["stg_returns"])


# staging table -> (builder, raw table it reads)
BUILDERS = {
    "stg_products": (stg_products, "products_raw"),
    "stg_sales": (stg_sales, "sales_raw"),
    "stg_expenses": (stg_expenses, "expenses_raw"),
    "stg_inventory_purchases": (stg_inventory_purchases, "inventory_purchases_raw"),
    "stg_returns": (stg_returns, "returns_raw"),
}
