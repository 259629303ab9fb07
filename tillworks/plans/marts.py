"""Business tables, one function per table: staging DataFrames in, mart DataFrame out.

The shape is the same throughout: aggregate each fact once (map-side combined, so hot keys shrink before the shuffle),
bring the small results together, derive the measures. Nothing here sorts or triggers a job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks import functions as fn
from tillworks import schemas
from tillworks.operators.aggregates import combine, paid_by, with_latest
from tillworks.operators.filters import active_only, with_value
from tillworks.operators.joins import explode_spine, left_lookup
from tillworks.operators.sets import union_distinct, with_month_of
from tillworks.values import REGULAR_FROM, VIP_FROM

COLUMNS: dict[str, list[str]] = {table: schemas.names(ddl) for table, ddl in schemas.MARTS.items()}

# Marts whose rows grow with people, customers or returns are stored by month, so that "this month" reads one folder. The
# dense rows of product_performance are written where they are made: storing them by month would shuffle every product's
# attributes once a month, while a product's months next to each other are a few bytes a row. The others hold a few rows
# per day or month at any scale.
PARTITION_BY = {
    "salesperson_performance": "month",
    "customer_insights": "month",
    "returns_analysis": "month_start",
}

# Reading order of each mart (see operators.ordering).
ORDER = {
    "daily_sales_summary": ("-sale_date", "unit"),
    "monthly_profit": ("-month", "unit"),
    "inventory_position": ("category", "product_name"),
    "product_performance": ("-month", "-total_revenue"),
    "unit_performance": ("-month", "-total_revenue"),
    "salesperson_performance": ("-month", "-total_revenue"),
    "expense_summary": ("-expense_date", "-total_amount"),
    "returns_analysis": ("-return_date",),
    "customer_insights": ("-month", "-total_spent"),
}


def _finish(
    df: DataFrame, name: str, zero_filled: list[str] | None = None, columns: list[str] | None = None, **derived: Column
) -> DataFrame:
    """Zero-fill the measures, add the derived columns in order, project the mart's columns or those asked for."""
    df = df.withColumns({c: fn.zero_if_null(F.col(c)) for c in zero_filled or []})
    for column, value in derived.items():
        df = df.withColumn(column, value)
    return df.select(COLUMNS[name] if columns is None else columns)


def _money(c: Column) -> Column:
    return F.round(c, 2).cast(fn.MONEY)


def _by_month(df: DataFrame, date: str) -> DataFrame:
    return df.withColumn("month", fn.month_start(F.col(date)))


def _days_of_month(date: str) -> Column:
    """The number of different days within a group that lies in one month: a bit per day, so no row is grouped by day."""
    days = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.dayofmonth(date)))
    return F.coalesce(F.bit_count(days), F.lit(0)).cast("bigint")


def daily_sales_summary(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """One row per day and unit; the NULL unit is a group of its own."""
    keys = ["sale_date", "unit"]
    # Two distinct counts in one aggregation would expand every sale into three rows. Persons are counted on the way of the
    # sums, phones from a scan of three columns.
    per_person = sales.groupBy(*keys, "salesperson_name").agg(
        F.count("*").alias("transaction_count"),
        F.sum("units_sold").alias("units_sold"),
        F.sum("gross_amount").alias("gross_revenue"),
        F.sum("discount_amount").alias("total_discounts"),
        F.sum("net_amount").alias("net_revenue"),
        paid_by("payment_method", "M-Pesa", "net_amount").alias("mpesa_revenue"),
        paid_by("payment_method", "Bank", "net_amount").alias("bank_revenue"),
    )
    money = [c for c in per_person.columns if "revenue" in c or c == "total_discounts"]
    sold = per_person.groupBy(*keys).agg(
        F.sum("transaction_count").alias("transaction_count"),
        F.sum("units_sold").alias("units_sold"),
        *(fn.money_sum(F.col(c)).alias(c) for c in money),
        F.count("salesperson_name").alias("active_salespeople"),
    )
    phones = with_value(sales, "customer_phone").select(*keys, "customer_phone").distinct().groupBy(*keys).agg(
        F.count("*").alias("unique_customers_with_phone")
    )
    returned = returns.groupBy(F.col("return_date").alias("sale_date"), "unit").agg(
        F.sum("units_returned").alias("units_returned"),
        fn.money_sum(F.col("return_value")).alias("returns_value"),
        F.count("*").alias("return_transaction_count"),
    )
    day = F.col("sale_date")
    parts = [sold, phones, returned]
    measures = [c for part in parts for c in part.columns if c not in keys]
    return _finish(
        combine(parts, keys),
        "daily_sales_summary",
        measures,
        effective_revenue=_money(F.col("net_revenue") - F.col("returns_value")),
        day_of_week=fn.day_of_week(day),
        day_of_month=fn.day_of_month(day),
        week_start=fn.week_start_monday(day),
        month_start=fn.month_start(day),
    )


def monthly_profit(sales: DataFrame, returns: DataFrame, expenses: DataFrame, products: DataFrame) -> DataFrame:
    """Profit and loss per month and unit. Revenue here is net of discounts; cost is the product master's."""
    keys = ["month", "unit"]
    # One pass over sales: a product has one cost, so it can be joined to per-product sums.
    per_product = _by_month(sales, "sale_date").groupBy(*keys, "product_key").agg(
        F.sum("net_amount").alias("net"),
        F.sum("discount_amount").alias("discount"),
        F.count("*").alias("n"),
        F.sum("units_sold").alias("units"),
    )
    costs = products.select("product_key", "cost_price")
    sold = left_lookup(per_product, costs, "product_key").groupBy(*keys).agg(
        fn.money_sum(F.col("net")).alias("gross_revenue"),
        fn.money_sum(F.col("discount")).alias("total_discounts"),
        F.sum("n").alias("sale_count"),
        F.sum("units").alias("units_sold"),
        fn.money_sum(fn.total_value(F.col("units"), fn.zero_if_null(F.col("cost_price")))).alias("total_cogs"),
    )
    returned = _by_month(returns, "return_date").groupBy(*keys).agg(
        fn.money_sum(F.col("return_value")).alias("total_returns"),
        F.sum("units_returned").alias("units_returned"),
        F.count("*").alias("return_count"),
    )
    spent = _by_month(expenses, "expense_date").groupBy(*keys).agg(
        fn.money_sum(F.col("amount")).alias("total_operating_expenses"),
        F.count("*").alias("expense_entries"),
    )
    measures = [c for part in (sold, returned, spent) for c in part.columns if c not in keys]
    return _finish(
        combine([sold, returned, spent], keys),
        "monthly_profit",
        measures,
        net_revenue=_money(F.col("gross_revenue") - F.col("total_returns")),
        gross_profit=_money(F.col("net_revenue") - F.col("total_cogs")),
        net_profit=_money(F.col("gross_profit") - F.col("total_operating_expenses")),
        net_margin_pct=fn.ratio_pct(F.col("net_profit"), F.col("net_revenue"), otherwise=0),
    )


def stock_status(stock: Column, reorder_level: Column) -> Column:
    return F.when(stock <= 0, "Out of Stock").when(stock <= reorder_level, "Low Stock").otherwise("In Stock")


def inventory_position(
    products: DataFrame, purchases: DataFrame, sales: DataFrame, returns: DataFrame
) -> DataFrame:
    """Current stock of each active product, derived from all movements."""
    bought = with_latest(
        purchases, ["product_key"], "unit_cost", "purchase_date", "submitted_at", "latest_unit_cost",
        F.sum("units_purchased").alias("total_purchased"), fn.money_sum(F.col("total_cost")).alias("total_purchase_cost"),
    )
    sold = sales.groupBy("product_key").agg(
        F.sum("units_sold").alias("total_sold"),
        fn.money_sum(F.col("net_amount")).alias("total_revenue"),
    )
    returned = returns.groupBy("product_key").agg(
        F.sum("units_returned").alias("total_returned"),
        fn.money_sum(F.col("return_value")).alias("total_return_value"),
    )
    joined = active_only(products)
    for movements in (bought, sold, returned):  # all three are already partitioned by product_key
        joined = left_lookup(joined, movements, "product_key")
    stock = F.col("stock_on_hand")
    return _finish(
        joined,
        "inventory_position",
        ["total_purchased", "total_purchase_cost", "latest_unit_cost", "total_sold", "total_revenue",
         "total_returned", "total_return_value"],
        latest_unit_cost=F.col("latest_unit_cost").cast(fn.NUMBER),
        total_purchase_cost=F.col("total_purchase_cost").cast(fn.MONEY),
        stock_on_hand=F.col("total_purchased") - F.col("total_sold") + F.col("total_returned"),
        inventory_value_at_cost=_money(fn.total_value(stock, F.col("latest_unit_cost"))),
        inventory_value_at_retail=_money(fn.total_value(stock, F.col("selling_price"))),
        stock_status=stock_status(stock, F.col("reorder_level")),
        needs_reorder=F.coalesce(stock <= F.col("reorder_level"), F.lit(False)),
    )


def _dense_months(activity: DataFrame, products: DataFrame) -> DataFrame:
    """Every product in every month that ``activity`` (one row per product and month) has for any product, and its measures.
    ``product_key`` is never NULL there.

    A product's months are one array, at most one entry per calendar month, joined by product_key alone. The dense rows are
    made after the join, where they need no shuffle: its own entries and, without measures, the months it lacks. No entry is
    searched for and no row is made but the dense ones. The list of all months comes from the same shuffled arrays, so nothing is scanned or aggregated twice.
    """
    measures = [c for c in activity.columns if c not in ("product_key", "month")]
    entry = F.struct("month", *measures)
    arrays = activity.groupBy("product_key").agg(F.collect_list(entry).alias("entries"))
    all_months = arrays.select(F.explode("entries").alias("e")).agg(F.sort_array(F.collect_set("e.month"))).scalar()
    own = F.coalesce("entries", F.array().cast(arrays.schema["entries"].dataType))
    dense = left_lookup(products, arrays, "product_key").withColumn("entries", own)
    # Entries are found by their place: a month beyond the last entry is one that the product lacks.
    own_months = F.col("entries")["month"]
    months = F.concat(own_months, F.array_except(all_months, own_months))
    dense = dense.select(*products.columns, "entries", F.posexplode(months).alias("place", "month"))
    return dense.select(*products.columns, "month", *(F.get("entries", F.col("place"))[m].alias(m) for m in measures))


def product_performance(
    products: DataFrame,
    sales: DataFrame,
    returns: DataFrame,
    as_of: dt.date | None = None,
    only: Callable[[DataFrame], DataFrame] | None = None,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """Every active product in every month in which anything was sold or returned, and in the reporting month.

    ``only`` is a reader's filter by ``month`` and ``columns`` what it reads. A month's rows depend on what was moved in that
    month alone, but rows come out of arrays, through which no optimizer moves a filter or a choice of columns.
    """
    columns = COLUMNS["product_performance"] if columns is None else list(columns)
    # With a key that is never NULL (a blank is no key) the joins filter nothing below, so all uses are the same shuffle.
    key = F.coalesce("product_key", F.lit(" ")).alias("product_key")
    sold = sales.select(
        key, fn.month_start(F.col("sale_date")).alias("month"), "unit_price", F.lit(1).alias("sale"), "units_sold", "net_amount",
        "discount_amount", "sale_date",
    )
    back = returns.select(
        key, fn.month_start(F.col("return_date")).alias("month"), "units_returned", "return_value"
    )
    # The reporting month counts as active for a product that does not exist.
    reporting = products.sparkSession.range(1).select(
        F.lit(" ").alias("product_key"), fn.month_start(fn.as_of_date(as_of)).alias("month")
    )
    moves = sold.unionByName(back, allowMissingColumns=True).unionByName(reporting, allowMissingColumns=True)
    moves = only(moves) if only else moves
    # Margins depend on the sale's own price: sum per price first, then join the product's cost once. Returns take the same
    # way: what the join shuffles by product is not shuffled again, neither per month nor for a product's list of months.
    per_price = moves.groupBy("product_key", "month", "unit_price").agg(
        F.count("sale").alias("n"),
        F.sum("units_sold").alias("units"),
        F.sum("net_amount").alias("net"),
        F.sum("discount_amount").alias("discount"),
        F.min("sale_date").alias("first_day"),
        F.max("sale_date").alias("last_day"),
        F.sum("units_returned").alias("returned"),
        F.sum("return_value").alias("returned_value"),
    )
    price, cost, units = F.col("unit_price"), F.col("cost_price"), F.col("units")
    by_product = per_price.repartition("product_key")  # also where costs are broadcast and their join would shuffle nothing
    costed = left_lookup(by_product, products.select("product_key", "cost_price"), "product_key")
    activity = costed.groupBy("product_key", "month").agg(
        F.sum("n").alias("total_transactions"),
        F.sum("units").alias("total_units_sold"),
        fn.money_sum(F.col("net")).alias("total_revenue"),
        fn.money_sum(F.col("discount")).alias("total_discounts"),
        fn.money_avg(F.sum(fn.total_value(F.col("n"), price)), F.sum("n")).alias("avg_selling_price"),
        F.min("first_day").alias("first_sale_date"),
        F.max("last_day").alias("last_sale_date"),
        fn.money_sum(fn.total_value(units, fn.floored_margin(price, cost))).alias("sales_profit"),
        fn.money_sum(fn.total_value(units, fn.zero_if_null(cost))).alias("total_cogs"),
        F.sum("returned").alias("total_units_returned"),
        fn.money_sum(F.col("returned_value")).alias("total_return_value"),
    )
    # Profits are derived before the rows become dense: a month that a product lacks has 0 and no margin.
    profit = _money(fn.zero_if_null(F.col("sales_profit")) - fn.zero_if_null(F.col("total_return_value")))
    activity = activity.withColumn("total_gross_profit", profit).drop("sales_profit")
    margin = fn.ratio_pct(F.col("total_gross_profit"), fn.zero_if_null(F.col("total_revenue")))
    activity = activity.withColumn("gross_margin_pct", margin)
    activity = activity.select([c for c in activity.columns if c in ("product_key", "month", *columns)])
    unfilled = ("product_key", "month", "first_sale_date", "last_sale_date", "gross_margin_pct")
    return _finish(
        _dense_months(activity, active_only(products)),
        "product_performance",
        [m for m in activity.columns if m not in unfilled],
        current_selling_price=F.col("selling_price"),
        current_cost_price=F.col("cost_price"),
        current_unit_margin_kes=F.col("unit_margin_kes"),
        current_unit_margin_pct=F.col("unit_margin_pct"),
        columns=columns,
    )


def unit_performance(
    business_units: DataFrame,
    sales: DataFrame,
    returns: DataFrame,
    expenses: DataFrame,
    products: DataFrame,
    as_of: dt.date | None = None,
) -> DataFrame:
    """Every seeded unit in every month with activity, and in the reporting month. Rows without a unit are left out."""
    keys = ["unit", "month"]
    sales = _by_month(with_value(sales, "unit"), "sale_date")
    returns = _by_month(with_value(returns, "unit"), "return_date")
    expenses = _by_month(with_value(expenses, "unit"), "expense_date")
    # One pass over sales: by product for the cost, by person and as a bit per day of the month for the distinct counts.
    per_product = sales.groupBy(*keys, "salesperson_name", "product_key").agg(
        F.count("*").alias("n"),
        F.count("net_amount").alias("n_net"),
        F.sum("units_sold").alias("units"),
        F.sum("net_amount").alias("net"),
        F.sum("discount_amount").alias("discount"),
        F.bit_or(F.expr("shiftleft(1L, dayofmonth(sale_date))")).alias("days"),
        F.min("sale_date").alias("first_day"),
        F.max("sale_date").alias("last_day"),
    )
    costed = left_lookup(per_product, products.select("product_key", "cost_price"), "product_key")
    per_person = costed.groupBy(*keys, "salesperson_name").agg(
        *(F.sum(c).alias(c) for c in ("n", "n_net", "units", "net", "discount")),
        F.sum(fn.total_value(F.col("units"), fn.zero_if_null(F.col("cost_price")))).alias("cost"),
        F.bit_or("days").alias("days"), F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"),
    )
    sold = per_person.groupBy(*keys).agg(
        F.sum("n").alias("total_transactions"),
        F.sum("units").alias("total_units_sold"),
        fn.money_sum(F.col("net")).alias("total_revenue"),
        fn.money_sum(F.col("discount")).alias("total_discounts"),
        fn.money_avg(F.sum("net"), F.sum("n_net")).alias("avg_transaction_value"),
        F.count("salesperson_name").alias("salespeople_count"),
        F.bit_count(F.bit_or("days")).cast("long").alias("active_days"),
        F.min("first_day").alias("first_sale_date"),
        F.max("last_day").alias("last_sale_date"),
        fn.money_sum(F.col("cost")).alias("total_cogs"),
    )
    returned = returns.groupBy(*keys).agg(
        F.count("*").alias("total_returns_processed"),
        F.sum("units_returned").alias("total_units_returned"),
        fn.money_sum(F.col("return_value")).alias("total_return_value"),
    )
    spent = expenses.groupBy(*keys).agg(
        F.count("*").alias("total_expense_entries"),
        fn.money_sum(F.col("amount")).alias("total_expenses"),
    )
    activity = combine([sold, returned, spent], keys)
    months = with_month_of(union_distinct(*(f.select("month") for f in (sales, returns, expenses))), as_of)
    spine = explode_spine(business_units.select(F.col("unit_name").alias("unit")), months, "month")
    dates = ("first_sale_date", "last_sale_date")
    revenue, returns_value = F.col("total_revenue"), F.col("total_return_value")
    return _finish(
        left_lookup(spine, activity, keys),
        "unit_performance",
        [c for c in activity.columns if c not in (*keys, *dates)],
        gross_profit=_money(revenue - returns_value - F.col("total_cogs")),
        estimated_net_profit=_money(F.col("gross_profit") - F.col("total_expenses")),
        net_margin_pct=fn.ratio_pct(F.col("estimated_net_profit"), revenue),
        return_rate_pct=fn.count_ratio_pct(F.col("total_units_returned"), F.col("total_units_sold")),
    )


def salesperson_performance(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """One row per salesperson and month with a sale or a return.

    Activity without a name keeps its month rows but no measures: a NULL name equals nothing.
    """
    keys = ["salesperson_name", "month"]
    sold = _by_month(sales, "sale_date").groupBy(*keys).agg(
        F.count("*").alias("total_transactions"),
        _days_of_month("sale_date").alias("active_days"),
        F.sum("units_sold").alias("total_units_sold"),
        fn.money_sum(F.col("net_amount")).alias("total_revenue"),
        fn.money_sum(F.col("discount_amount")).alias("total_discounts_given"),
        fn.money_avg(F.sum("net_amount"), F.count("net_amount")).alias("avg_transaction_value"),
        paid_by("payment_method", "M-Pesa", "net_amount").alias("mpesa_revenue"),
        paid_by("payment_method", "Bank", "net_amount").alias("bank_revenue"),
        F.min("sale_date").alias("first_sale_date"),
        F.max("sale_date").alias("last_sale_date"),
    )
    returned = _by_month(returns, "return_date").groupBy(*keys).agg(
        F.count("*").alias("total_returns_processed"),
        F.sum("units_returned").alias("total_units_returned"),
        fn.money_sum(F.col("return_value")).alias("total_return_value"),
    )
    activity = combine([sold, returned], keys)
    measures = [c for c in activity.columns if c not in keys]
    named = activity.withColumns({m: F.when(F.col("salesperson_name").isNotNull(), F.col(m)) for m in measures})
    return _finish(
        named, "salesperson_performance", [m for m in measures if m not in ("first_sale_date", "last_sale_date")]
    )


def expense_summary(expenses: DataFrame) -> DataFrame:
    summed = expenses.groupBy("expense_date", "expense_category", "unit").agg(
        F.count("*").alias("transaction_count"),
        fn.money_sum(F.col("amount")).alias("total_amount"),
        paid_by("paid_via", "M-Pesa", "amount").alias("mpesa_amount"),
        paid_by("paid_via", "Bank", "amount").alias("bank_amount"),
    )
    day = F.col("expense_date")
    return _finish(
        summed, "expense_summary", month_start=fn.month_start(day), week_start=fn.week_start_monday(day)
    )


def returns_analysis(
    returns: DataFrame, products: DataFrame, sales: DataFrame, mask_phones: bool = False
) -> DataFrame:
    """One row per return with its product and the share of the product's sold units that came back with it.

    Product attributes and sales volume are merged into one lookup first: the returns themselves then go through a
    single join, in which AQE can split a product that holds a large part of them.
    """
    volume = sales.groupBy("product_key").agg(F.sum("units_sold").alias("units_sold"))
    lookup = products.select("product_key", "product_name", "category").join(volume, "product_key", "full")
    day = F.col("return_date")
    phone = F.col("customer_phone")
    return _finish(
        left_lookup(returns, lookup, "product_key"),
        "returns_analysis",
        month_start=fn.month_start(day),
        week_start=fn.week_start_monday(day),
        customer_phone=fn.mask_phone(phone) if mask_phones else phone,
        product_return_rate_pct=fn.count_ratio_pct(F.col("units_returned"), F.col("units_sold")),
    )


def customer_tier(spent: Column) -> Column:
    return F.when(spent >= VIP_FROM, "VIP").when(spent >= REGULAR_FROM, "Regular").otherwise("Occasional")


def customer_insights(sales: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """One row per month and customer phone; the full number groups, only its mask is shown."""
    known = _by_month(with_value(sales, "customer_phone"), "sale_date")
    summed = known.groupBy("month", "customer_phone").agg(
        F.count("*").alias("total_transactions"),
        _days_of_month("sale_date").alias("purchase_days"),
        fn.money_sum(F.col("net_amount")).alias("total_spent"),
        fn.money_avg(F.sum("net_amount"), F.count("net_amount")).alias("avg_transaction_value"),
        F.max("net_amount").cast(fn.MONEY).alias("largest_transaction"),
        F.sum("units_sold").alias("total_units_purchased"),
        F.min("sale_date").alias("first_purchase_date"),
        F.max("sale_date").alias("last_purchase_date"),
    )
    return _finish(
        summed,
        "customer_insights",
        customer_phone_masked=fn.mask_phone(F.col("customer_phone")),
        days_since_last_purchase=fn.days_between(fn.as_of_date(as_of), F.col("last_purchase_date")),
        customer_tier=customer_tier(F.col("total_spent")),
        is_repeat_customer=F.col("purchase_days") > 1,
    )


# mart -> (builder, tables it reads in argument order, whether it takes the reporting day)
BUILDERS = {
    "daily_sales_summary": (daily_sales_summary, ("stg_sales", "stg_returns"), False),
    "monthly_profit": (monthly_profit, ("stg_sales", "stg_returns", "stg_expenses", "stg_products"), False),
    "inventory_position": (
        inventory_position, ("stg_products", "stg_inventory_purchases", "stg_sales", "stg_returns"), False,
    ),
    "product_performance": (product_performance, ("stg_products", "stg_sales", "stg_returns"), True),
    "unit_performance": (
        unit_performance, ("business_units", "stg_sales", "stg_returns", "stg_expenses", "stg_products"), True,
    ),
    "salesperson_performance": (salesperson_performance, ("stg_sales", "stg_returns"), False),
    "expense_summary": (expense_summary, ("stg_expenses",), False),
    "returns_analysis": (returns_analysis, ("stg_returns", "stg_products", "stg_sales"), False),
    "customer_insights": (customer_insights, ("stg_sales",), True),
}
