"""The dashboard queries: small aggregates, top-N lists and tables over the marts.

``as_of`` is the reporting day (today when not given). Pages on "this month" filter the mart's ``month`` column, which
is the partition column of the large marts, so they read that month only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.functions import MONEY, as_of_date, money_sum, month_start, zero_if_null
from tillworks.operators.aggregates import combine
from tillworks.operators.ordering import sort_by, top_k

Day = dt.date | None
Months = Day | tuple[dt.date, dt.date]  # the month of a day, or all from that of one day to that of another


def this_month(mart: DataFrame, as_of: Months = None, column: str = "month") -> DataFrame:
    if isinstance(as_of, tuple):
        return mart.filter(F.col(column).between(*(month_start(F.lit(day)) for day in as_of)))
    return mart.filter(F.col(column) == month_start(as_of_date(as_of)))


def on_day(mart: DataFrame, column: str, as_of: Day = None) -> DataFrame:
    return mart.filter(F.col(column) == as_of_date(as_of))


def last_days(mart: DataFrame, days: int, as_of: Day = None, include_today: bool = False) -> DataFrame:
    """The last ``days`` days by sale_date, up to yesterday unless today is included."""
    today = as_of_date(as_of)
    until = today if include_today else F.date_sub(today, 1)
    return mart.filter(F.col("sale_date").between(F.date_sub(until, days - 1), until))


def total(mart: DataFrame, by: list[str], money: list[str] = [], units: list[str] = []) -> DataFrame:
    """Sums per group under the measures' own names."""
    sums: list[Column] = [money_sum(F.col(c)).alias(c) for c in money] + [F.sum(c).alias(c) for c in units]
    return mart.groupBy(*by).agg(*sums)


# --- 1: daily operations ------------------------------------------------------------------------------------------


def today_scorecards(daily: DataFrame, as_of: Day = None) -> DataFrame:
    money = ["effective_revenue", "mpesa_revenue", "bank_revenue"]
    return total(on_day(daily, "sale_date", as_of), [], money, ["transaction_count", "units_sold"])


def low_stock(inventory: DataFrame) -> DataFrame:
    columns = ("product_name", "category", "stock_on_hand", "reorder_level", "stock_status")
    return sort_by(inventory.filter("needs_reorder").select(*columns), "stock_on_hand", "product_name")


def revenue_last_7_days(daily: DataFrame, as_of: Day = None, include_today: bool = False) -> DataFrame:
    recent = last_days(daily, 7, as_of, include_today)
    return sort_by(total(recent, ["sale_date"], ["effective_revenue"]), "sale_date")


def today_returns(returns: DataFrame, as_of: Day = None) -> DataFrame:
    """The month is filtered too: the mart is stored by month."""
    today = this_month(on_day(returns, "return_date", as_of), as_of, "month_start")
    return total(today, [], ["return_value"])


# --- 2: sales trends ----------------------------------------------------------------------------------------------


def daily_revenue_30d(daily: DataFrame, as_of: Day = None, include_today: bool = False) -> DataFrame:
    recent = last_days(daily, 30, as_of, include_today)
    return sort_by(total(recent, ["sale_date"], ["effective_revenue"]), "sale_date")


def weekly_revenue_12w(daily: DataFrame, as_of: Day = None, include_today: bool = False) -> DataFrame:
    recent = last_days(daily, 12 * 7, as_of, include_today)
    return sort_by(total(recent, ["week_start"], ["effective_revenue"]), "week_start")


def monthly_revenue(daily: DataFrame) -> DataFrame:
    return sort_by(total(daily, ["month_start"], ["effective_revenue"]), "month_start")


def monthly_payment_split(daily: DataFrame) -> DataFrame:
    return sort_by(total(daily, ["month_start"], ["mpesa_revenue", "bank_revenue"]), "month_start")


def avg_by_day_of_month(daily: DataFrame) -> DataFrame:
    """Mean over the mart's (day, unit) rows."""
    mean = F.round(F.avg("effective_revenue"), 2).cast(MONEY)
    return sort_by(daily.groupBy("day_of_month").agg(mean.alias("avg_effective_revenue")), "day_of_month")


def returns_trend(daily: DataFrame) -> DataFrame:
    return sort_by(total(daily, ["sale_date"], ["returns_value"]), "sale_date")


# --- 3: products --------------------------------------------------------------------------------------------------


def top10_products(products: DataFrame, as_of: Months = None) -> DataFrame:
    revenue = total(this_month(products, as_of), ["product_name"], ["total_revenue"])
    return top_k(revenue, 10, "-total_revenue", "product_name")


def bottom10_products(products: DataFrame, as_of: Day = None) -> DataFrame:
    sold = this_month(products, as_of).filter("total_transactions > 0")
    return top_k(total(sold, ["product_name"], ["total_revenue"]), 10, "total_revenue", "product_name")


def top10_profit(products: DataFrame, as_of: Months = None) -> DataFrame:
    profit = total(this_month(products, as_of), ["product_name"], ["total_gross_profit"])
    return top_k(profit, 10, "-total_gross_profit", "product_name")


def revenue_by_category(products: DataFrame, as_of: Months = None) -> DataFrame:
    return total(this_month(products, as_of), ["category"], ["total_revenue"])


def product_table(products: DataFrame, as_of: Day = None) -> DataFrame:
    columns = (
        "product_name", "category", "total_units_sold", "total_revenue", "gross_margin_pct", "current_cost_price",
    )
    return sort_by(this_month(products, as_of).select(*columns), "-total_revenue", "product_name")


# --- 4: inventory -------------------------------------------------------------------------------------------------


def inventory_value(inventory: DataFrame) -> DataFrame:
    return total(inventory, [], ["inventory_value_at_cost"])


def reorder_count(inventory: DataFrame) -> DataFrame:
    return inventory.filter("needs_reorder").agg(F.count("product_key").alias("products_to_reorder"))


def inventory_table(inventory: DataFrame) -> DataFrame:
    """Out of Stock first, then Low Stock: plain text order would put In Stock first."""
    status = F.col("stock_status")
    urgency = F.when(status == "Out of Stock", 0).when(status == "Low Stock", 1).otherwise(2)
    columns = (
        "product_name", "category", "stock_on_hand", "reorder_level", "stock_status", "inventory_value_at_cost",
        "last_purchase_date",
    )
    return inventory.select(*columns).orderBy(urgency, "product_name")


def fast_movers(products: DataFrame, as_of: Months = None) -> DataFrame:
    moved = total(this_month(products, as_of), ["product_name"], units=["total_units_sold"])
    return top_k(moved, 15, "-total_units_sold", "product_name")


# --- 5: expenses and profit ---------------------------------------------------------------------------------------


def net_profit_trend(profit: DataFrame) -> DataFrame:
    return sort_by(total(profit, ["month"], ["net_profit"]), "month")


def pnl_table(profit: DataFrame) -> DataFrame:
    columns = (
        "month", "gross_revenue", "total_returns", "total_cogs", "total_operating_expenses", "gross_profit",
        "net_profit", "net_margin_pct",
    )
    return sort_by(profit.select(*columns), "-month", "-gross_revenue")


def expense_by_category(expenses: DataFrame, as_of: Months = None) -> DataFrame:
    return total(this_month(expenses, as_of, "month_start"), ["expense_category"], ["total_amount"])


def expense_trend(expenses: DataFrame) -> DataFrame:
    return sort_by(total(expenses, ["month_start"], ["total_amount"]), "month_start")


# --- 6: customers -------------------------------------------------------------------------------------------------


def customer_counts(customers: DataFrame, as_of: Day = None) -> DataFrame:
    return this_month(customers, as_of).agg(
        F.count("customer_phone_masked").alias("customers"), F.count_if("is_repeat_customer").alias("repeat_customers")
    )


def customer_tiers(customers: DataFrame, as_of: Day = None) -> DataFrame:
    tiers = this_month(customers, as_of).groupBy("customer_tier")
    return tiers.agg(F.count("customer_phone_masked").alias("customers"))


def top20_customers(customers: DataFrame, as_of: Day = None) -> DataFrame:
    columns = (
        "customer_phone_masked", "customer_tier", "total_transactions", "total_spent", "avg_transaction_value",
        "last_purchase_date", "days_since_last_purchase",
    )
    # Two phones can share a mask, so the other shown columns break ties too.
    order = ("-total_spent", "customer_phone_masked", "total_transactions", "last_purchase_date")
    return top_k(this_month(customers, as_of).select(*columns), 20, *order)


# --- 7: salespeople -----------------------------------------------------------------------------------------------


def salesperson_bars(people: DataFrame, as_of: Months = None) -> DataFrame:
    return total(this_month(people, as_of), ["salesperson_name"], ["total_revenue"], ["total_transactions"])


def salesperson_table(people: DataFrame, as_of: Day = None) -> DataFrame:
    return this_month(people, as_of).select(
        "salesperson_name", "total_transactions", "total_units_sold", "total_revenue", "total_discounts_given",
        "avg_transaction_value", "active_days",
    )


# --- 8: returns ---------------------------------------------------------------------------------------------------


def returns_this_month(returns: DataFrame, as_of: Months = None) -> DataFrame:
    return total(this_month(returns, as_of, "month_start"), [], ["return_value"], ["units_returned"])


def returns_by_reason(returns: DataFrame) -> DataFrame:
    return total(returns, ["return_reason"], units=["units_returned"])


def returns_by_refund(returns: DataFrame) -> DataFrame:
    return total(returns, ["refund_method"], ["return_value"])


def top10_returned(returns: DataFrame) -> DataFrame:
    back = total(returns, ["product_name"], units=["units_returned"])
    return top_k(back, 10, "-units_returned", "product_name")


def returns_monthly(returns: DataFrame) -> DataFrame:
    return sort_by(total(returns, ["month_start"], ["return_value"], ["units_returned"]), "month_start")


def returns_by_category(returns: DataFrame) -> DataFrame:
    return total(returns, ["category"], ["return_value"])


def returns_vs_sales(people: DataFrame, returns: DataFrame) -> DataFrame:
    sold = total(people, ["salesperson_name"], ["total_revenue"])
    back = total(returns, ["salesperson_name"], ["return_value"])
    both = combine([sold, back], ["salesperson_name"])
    return both.withColumns({c: zero_if_null(F.col(c)) for c in ("total_revenue", "return_value")})


def returns_table(
    returns: DataFrame, product: str | None = None, reason: str | None = None, salesperson: str | None = None
) -> DataFrame:
    for column, wanted in (("product_name", product), ("return_reason", reason), ("salesperson_name", salesperson)):
        if wanted is not None:
            returns = returns.filter(F.col(column) == wanted)
    columns = (
        "return_date", "product_name", "category", "units_returned", "return_value", "return_reason",
        "refund_method", "salesperson_name",
    )
    return sort_by(returns.select(*columns), "-return_date", "product_name")


# --- 9: business units --------------------------------------------------------------------------------------------


def unit_bars(units: DataFrame, as_of: Day = None) -> DataFrame:
    columns = ("unit", "total_revenue", "estimated_net_profit")
    return sort_by(this_month(units, as_of).select(*columns), "-total_revenue", "unit")


def unit_table(units: DataFrame, as_of: Day = None) -> DataFrame:
    columns = (
        "unit", "total_transactions", "total_revenue", "total_cogs", "total_expenses", "gross_profit",
        "estimated_net_profit", "net_margin_pct", "return_rate_pct",
    )
    return sort_by(this_month(units, as_of).select(*columns), "-total_revenue", "unit")


def unit_trend(units: DataFrame) -> DataFrame:
    return sort_by(total(units, ["month", "unit"], ["total_revenue"]), "month", "unit")


# query -> (function, marts it reads in argument order, whether it takes the reporting day)
QUERIES: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...], bool]] = {
    "dash_today_scorecards": (today_scorecards, ("daily_sales_summary",), True),
    "dash_low_stock": (low_stock, ("inventory_position",), False),
    "dash_revenue_last_7_days": (revenue_last_7_days, ("daily_sales_summary",), True),
    "dash_today_returns": (today_returns, ("returns_analysis",), True),
    "dash_daily_revenue_30d": (daily_revenue_30d, ("daily_sales_summary",), True),
    "dash_weekly_revenue_12w": (weekly_revenue_12w, ("daily_sales_summary",), True),
    "dash_monthly_revenue": (monthly_revenue, ("daily_sales_summary",), False),
    "dash_monthly_payment_split": (monthly_payment_split, ("daily_sales_summary",), False),
    "dash_avg_by_day_of_month": (avg_by_day_of_month, ("daily_sales_summary",), False),
    "dash_returns_trend": (returns_trend, ("daily_sales_summary",), False),
    "dash_top10_products": (top10_products, ("product_performance",), True),
    "dash_bottom10_products": (bottom10_products, ("product_performance",), True),
    "dash_top10_profit": (top10_profit, ("product_performance",), True),
    "dash_revenue_by_category": (revenue_by_category, ("product_performance",), True),
    "dash_product_table": (product_table, ("product_performance",), True),
    "dash_inventory_value": (inventory_value, ("inventory_position",), False),
    "dash_reorder_count": (reorder_count, ("inventory_position",), False),
    "dash_inventory_table": (inventory_table, ("inventory_position",), False),
    "dash_fast_movers": (fast_movers, ("product_performance",), True),
    "dash_net_profit_trend": (net_profit_trend, ("monthly_profit",), False),
    "dash_pnl_table": (pnl_table, ("monthly_profit",), False),
    "dash_expense_by_category_tm": (expense_by_category, ("expense_summary",), True),
    "dash_expense_trend": (expense_trend, ("expense_summary",), False),
    "dash_customer_counts": (customer_counts, ("customer_insights",), True),
    "dash_customer_tiers": (customer_tiers, ("customer_insights",), True),
    "dash_top20_customers": (top20_customers, ("customer_insights",), True),
    "dash_salesperson_bars": (salesperson_bars, ("salesperson_performance",), True),
    "dash_salesperson_table": (salesperson_table, ("salesperson_performance",), True),
    "dash_returns_tm": (returns_this_month, ("returns_analysis",), True),
    "dash_returns_by_reason": (returns_by_reason, ("returns_analysis",), False),
    "dash_returns_by_refund": (returns_by_refund, ("returns_analysis",), False),
    "dash_top10_returned": (top10_returned, ("returns_analysis",), False),
    "dash_returns_monthly": (returns_monthly, ("returns_analysis",), False),
    "dash_returns_by_category": (returns_by_category, ("returns_analysis",), False),
    "dash_returns_vs_sales": (returns_vs_sales, ("salesperson_performance", "returns_analysis"), False),
    "dash_returns_table": (returns_table, ("returns_analysis",), False),
    "dash_unit_bars": (unit_bars, ("unit_performance",), True),
    "dash_unit_table": (unit_table, ("unit_performance",), True),
    "dash_unit_trend": (unit_trend, ("unit_performance",), False),
}
