"""Staging tables, marts, data checks and dashboards over the whole given tables, with their SQL counterparts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from testbed import oracle_base as sql
from testbed.oracle_base import money_avg, month
from testbed.warehouse import AS_OF, CHECK_DAY, REPORT_DAY, Warehouse
from tillworks import functions as fn
from tillworks.operators.sets import stack
from tillworks.plans import dashboards, marts, quality, staging
from tillworks.plans.quality import DECLARED

QUERIES: dict = {}


# --- staging and marts: each built from the layer below, not read back ---------------------------------------------


def _staging(table: str):
    builder, raw_table = staging.BUILDERS[table]
    return lambda w: builder(w.raw(raw_table))


def _mart(mart: str):
    builder, _, takes_as_of = marts.BUILDERS[mart]
    kwargs = {"as_of": AS_OF} if takes_as_of else {}
    return lambda w: builder(*w.mart_inputs(mart), **kwargs)


for _table in staging.BUILDERS:
    QUERIES[_table] = (_staging(_table), f"SELECT * FROM {_table}")
for _name in marts.BUILDERS:
    QUERIES[_name] = (_mart(_name), f"SELECT * FROM {_name}")


# --- data checks --------------------------------------------------------------------------------------------------


def _named(df: DataFrame, table: str, column: str, *rest) -> DataFrame:
    return df.select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), *rest)


def _text(column: str, alias: str = "value"):
    return F.col(column).cast("string").alias(alias)


def _each(get):
    """(table, declared item) pairs of one kind of check."""
    return [(t, item) for t, checks in DECLARED.items() for item in get(checks)]


_TWICE = ("products_raw", "Product_Name")  # a form column that does repeat


def dq_unique(w: Warehouse) -> DataFrame:
    # Of tables that no query has built yet, only what the keys need is derived.
    return stack([
        _named(quality.unique(w.planned(t), c), t, c, _text(c), "n_records")
        for t, c in [*_each(lambda k: k.unique), _TWICE]
    ])


def dq_not_null(w: Warehouse) -> DataFrame:
    counts = [
        quality.null_counts(w.checked(t), checks.not_null).select(F.lit(t).alias("table_name"), "column_name", "n_records")
        for t, checks in DECLARED.items() if checks.not_null
    ]
    return stack(counts).filter("n_records > 0")


def dq_accepted_values(w: Warehouse) -> DataFrame:
    return stack([
        quality.odd_values(w.any(t), checks.accepted).select(F.lit(t).alias("table_name"), "*")
        for t, checks in DECLARED.items() if checks.accepted
    ])


def dq_relationships(w: Warehouse) -> DataFrame:
    products = w.staging("stg_products")
    return stack([
        _named(quality.relationships(w.any(t), products, "product_key"), t, "product_key", _text("product_key"), "n_records")
        for t, checks in DECLARED.items() if checks.has_product
    ])


def dq_unique_combination(w: Warehouse) -> DataFrame:
    return stack([
        _named(
            quality.unique_combination(w.checked(t), list(pair)), t, "+".join(pair), _text(pair[0], "first_value"),
            _text(pair[1], "second_value"), "n_records",
        )
        for t, pair in _each(lambda k: k.unique_combination)
    ])


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _head(t: str, c: str) -> str:
    return f"SELECT '{t}' AS table_name, '{c}' AS column_name"


def _quoted_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


QUERIES["dq_unique"] = (dq_unique, _union([
    f"{_head(t, c)}, {c}::VARCHAR AS value, count(*) AS n_records FROM {t} WHERE {c} IS NOT NULL "
    f"GROUP BY {c} HAVING count(*) > 1"
    for t, c in [*_each(lambda k: k.unique), _TWICE]
]))
QUERIES["dq_not_null"] = (dq_not_null, _union([
    f"{_head(t, c)}, count(*) AS n_records FROM {t} WHERE \"{c}\" IS NULL HAVING count(*) > 0"
    for t, c in _each(lambda k: k.not_null)
]))
QUERIES["dq_accepted_values"] = (dq_accepted_values, _union([
    f"{_head(t, c)}, {c} AS value, count(*) AS n_records FROM {t} WHERE {c} NOT IN ({_quoted_list(v)}) GROUP BY {c}"
    for t, (c, v) in _each(lambda k: k.accepted)
]))
QUERIES["dq_relationships"] = (dq_relationships, _union([
    f"{_head(t, 'product_key')}, product_key AS value, count(*) AS n_records FROM {t} "
    f"WHERE product_key NOT IN (SELECT product_key FROM stg_products) GROUP BY product_key"
    for t, checks in DECLARED.items() if checks.has_product
]))
QUERIES["dq_unique_combination"] = (dq_unique_combination, _union([
    f"{_head(t, '+'.join(p))}, \"{p[0]}\"::VARCHAR AS first_value, {p[1]}::VARCHAR AS second_value, "
    f"count(*) AS n_records FROM {t} GROUP BY \"{p[0]}\", {p[1]} HAVING count(*) > 1"
    for t, p in _each(lambda k: k.unique_combination)
]))

def _all_expenses(w: Warehouse) -> DataFrame:
    """Parsed expenses before staging drops the ones that are not above zero."""
    given = [F.col(c) for c in ("Date_of_Expense", "Expense_Category", "Amount_KES", "Timestamp")]
    return w.raw("expenses_raw").select(
        fn.surrogate_key(*given).alias("expense_id"), fn.parse_form_date(given[0]).alias("expense_date"),
        given[1].alias("expense_category"), fn.parse_form_number(given[2]).alias("amount"),
    )


_LATEST = (
    "SELECT product_key, first(unit_cost ORDER BY purchase_date DESC, submitted_at DESC NULLS LAST, unit_cost DESC) "
    "AS latest_cost_price FROM stg_inventory_purchases GROUP BY product_key"
)
_RULES = {
    "dq_no_future_return_dates": (
        lambda w: quality.no_future_return_dates(w.staging("stg_returns"), CHECK_DAY),
        f"SELECT return_id, return_date, salesperson_name, product_key FROM stg_returns "
        f"WHERE return_date > DATE '{CHECK_DAY}'",
    ),
    "dq_no_future_sale_dates": (
        lambda w: quality.no_future_sale_dates(w.staging("stg_sales"), CHECK_DAY),
        f"SELECT sale_id, sale_date, salesperson_name, product_key FROM stg_sales WHERE sale_date > DATE '{CHECK_DAY}'",
    ),
    "dq_no_negative_expenses": (
        lambda w: quality.no_negative_expenses(_all_expenses(w)),
        f"""SELECT * FROM (SELECT {sql.md5_key('"Date_of_Expense"', "Expense_Category", "Amount_KES", '"Timestamp"')} AS expense_id,
        {sql.date('Date_of_Expense')} AS expense_date, Expense_Category AS expense_category,
        {sql.number('Amount_KES')} AS amount FROM expenses_raw) WHERE amount <= 0""",
    ),
    "dq_no_negative_return_value": (
        lambda w: quality.no_negative_return_value(w.staging("stg_returns")),
        "SELECT return_id, return_date, product_key, units_returned, original_unit_price, return_value "
        "FROM stg_returns WHERE return_value <= 0",
    ),
    "dq_sale_price_above_cost": (
        lambda w: quality.sale_price_above_cost(w.staging("stg_sales"), w.staging("stg_inventory_purchases")),
        f"SELECT sale_id, sale_date, product_key, unit_price AS sale_price, latest_cost_price FROM stg_sales "
        f"JOIN ({_LATEST}) USING (product_key) WHERE unit_price < latest_cost_price",
    ),
    "dq_stock_never_negative": (
        lambda w: quality.stock_never_negative(w.mart("inventory_position")),
        "SELECT product_key, product_name, stock_on_hand FROM inventory_position WHERE stock_on_hand < 0",
    ),
}
QUERIES |= _RULES


def _suite_sql() -> str:
    def row(table: str, check: str, column: str, failures: str) -> str:
        return (
            f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{column}' AS column_name, "
            f"({failures})::BIGINT AS failures"
        )

    parts = [
        row(t, "not_null", c, f'SELECT count(*) FROM {t} WHERE "{c}" IS NULL') for t, c in _each(lambda k: k.not_null)
    ]
    parts += [
        row(t, "accepted_values", c, f"SELECT count(DISTINCT {c}) FROM {t} WHERE {c} NOT IN ({_quoted_list(v)})")
        for t, (c, v) in _each(lambda k: k.accepted)
    ]
    parts += [
        row(t, "unique", c, f"SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
        for t, c in _each(lambda k: k.unique)
    ]
    parts += [
        row(
            t, "unique_combination", "+".join(p),
            f'SELECT count(*) FROM (SELECT 1 FROM {t} GROUP BY "{p[0]}", "{p[1]}" HAVING count(*) > 1)',
        )
        for t, p in _each(lambda k: k.unique_combination)
    ]
    parts += [
        row(
            t, "relationships", "product_key",
            f"SELECT count(*) FROM {t} WHERE product_key NOT IN (SELECT product_key FROM stg_products)",
        )
        for t, checks in DECLARED.items() if checks.has_product
    ]
    where = {
        "dq_no_future_return_dates": ("stg_returns", "return_date"),
        "dq_no_future_sale_dates": ("stg_sales", "sale_date"),
        "dq_no_negative_expenses": ("stg_expenses", "amount"),
        "dq_no_negative_return_value": ("stg_returns", "return_value"),
        "dq_sale_price_above_cost": ("stg_sales", "unit_price"),
        "dq_stock_never_negative": ("inventory_position", "stock_on_hand"),
    }
    where_sql = {"dq_no_negative_expenses": "SELECT 1 FROM stg_expenses WHERE amount <= 0"}  # the suite reads stored tables
    parts += [
        row(t, name.removeprefix("dq_"), c, f"SELECT count(*) FROM ({where_sql.get(name, _RULES[name][1])})")
        for name, (t, c) in where.items()
    ]
    return f"SELECT *, CASE WHEN failures > 0 THEN 'warn' ELSE 'pass' END AS status FROM ({_union(parts)})"


QUERIES["dq_suite_summary"] = (lambda w: quality.suite_summary(w.checked, CHECK_DAY), _suite_sql())


# --- dashboards ---------------------------------------------------------------------------------------------------


def _reads(mart: str, months) -> dict:
    """Pages on products show some months, and a filter by month does not move through that mart by itself."""
    return {"only": lambda rows: dashboards.this_month(rows, months)} if mart == "product_performance" else {}


def _dashboard(name: str):
    build, inputs, takes_as_of = dashboards.QUERIES[name]
    kwargs = {"as_of": REPORT_DAY} if takes_as_of else {}
    return lambda w: build(*(w.report_on(m, name, whole=not takes_as_of, **_reads(m, REPORT_DAY)) for m in inputs), **kwargs)


def _sums(mart: str, by: str = "", money: str = "", units: str = "", where: str = "") -> str:
    cols = by.split() + [f"sum({c})::DECIMAL(38,2) AS {c}" for c in money.split()]
    cols += [f"sum({c})::BIGINT AS {c}" for c in units.split()]
    sql = f"SELECT {', '.join(cols)} FROM {mart}" + (f" WHERE {where}" if where else "")
    return sql + (f" GROUP BY {', '.join(by.split())}" if by else "")


_DAY = f"DATE '{REPORT_DAY}'"
_TM = f'"month" = {month(_DAY)}'
_TMS = f"month_start = {month(_DAY)}"


def _last(days: int) -> str:
    return f"sale_date >= {_DAY} - {days} AND sale_date < {_DAY}"


_DASH_SQL = {
    "dash_today_scorecards": _sums(
        "daily_sales_summary", "", "effective_revenue mpesa_revenue bank_revenue", "transaction_count units_sold",
        f"sale_date = {_DAY}",
    ),
    "dash_low_stock": "SELECT product_name, category, stock_on_hand, reorder_level, stock_status "
    "FROM inventory_position WHERE needs_reorder",
    "dash_revenue_last_7_days": _sums("daily_sales_summary", "sale_date", "effective_revenue", "", _last(7)),
    "dash_today_returns": _sums("returns_analysis", "", "return_value", "", f"return_date = {_DAY}"),
    "dash_daily_revenue_30d": _sums("daily_sales_summary", "sale_date", "effective_revenue", "", _last(30)),
    "dash_weekly_revenue_12w": _sums("daily_sales_summary", "week_start", "effective_revenue", "", _last(84)),
    "dash_monthly_revenue": _sums("daily_sales_summary", "month_start", "effective_revenue"),
    "dash_monthly_payment_split": _sums("daily_sales_summary", "month_start", "mpesa_revenue bank_revenue"),
    "dash_avg_by_day_of_month": f"SELECT day_of_month, {money_avg('sum(effective_revenue)', 'count(*)')} "
    "AS avg_effective_revenue FROM daily_sales_summary GROUP BY day_of_month",
    "dash_returns_trend": _sums("daily_sales_summary", "sale_date", "returns_value"),
    "dash_top10_products": _sums("product_performance", "product_name", "total_revenue", "", _TM)
    + " ORDER BY total_revenue DESC, product_name LIMIT 10",
    "dash_bottom10_products": _sums(
        "product_performance", "product_name", "total_revenue", "", f"{_TM} AND total_transactions > 0"
    ) + " ORDER BY total_revenue, product_name LIMIT 10",
    "dash_top10_profit": _sums("product_performance", "product_name", "total_gross_profit", "", _TM)
    + " ORDER BY total_gross_profit DESC, product_name LIMIT 10",
    "dash_revenue_by_category": _sums("product_performance", "category", "total_revenue", "", _TM),
    "dash_product_table": "SELECT product_name, category, total_units_sold, total_revenue, gross_margin_pct, "
    f"current_cost_price FROM product_performance WHERE {_TM}",
    "dash_inventory_value": _sums("inventory_position", "", "inventory_value_at_cost"),
    "dash_reorder_count": "SELECT count(product_key) AS products_to_reorder FROM inventory_position WHERE needs_reorder",
    "dash_inventory_table": "SELECT product_name, category, stock_on_hand, reorder_level, stock_status, "
    "inventory_value_at_cost, last_purchase_date FROM inventory_position",
    "dash_fast_movers": _sums("product_performance", "product_name", "", "total_units_sold", _TM)
    + " ORDER BY total_units_sold DESC, product_name LIMIT 15",
    "dash_net_profit_trend": _sums("monthly_profit", '"month"', "net_profit"),
    "dash_pnl_table": 'SELECT "month", gross_revenue, total_returns, total_cogs, total_operating_expenses, '
    "gross_profit, net_profit, net_margin_pct FROM monthly_profit",
    "dash_expense_by_category_tm": _sums("expense_summary", "expense_category", "total_amount", "", _TMS),
    "dash_expense_trend": _sums("expense_summary", "month_start", "total_amount"),
    "dash_customer_counts": "SELECT count(customer_phone_masked) AS customers, "
    f"count(*) FILTER (is_repeat_customer) AS repeat_customers FROM customer_insights WHERE {_TM}",
    "dash_customer_tiers": "SELECT customer_tier, count(customer_phone_masked) AS customers FROM customer_insights "
    f"WHERE {_TM} GROUP BY customer_tier",
    "dash_top20_customers": "SELECT customer_phone_masked, customer_tier, total_transactions, total_spent, "
    f"avg_transaction_value, last_purchase_date, days_since_last_purchase FROM customer_insights WHERE {_TM} "
    "ORDER BY total_spent DESC, customer_phone_masked, total_transactions, last_purchase_date LIMIT 20",
    "dash_salesperson_bars": _sums(
        "salesperson_performance", "salesperson_name", "total_revenue", "total_transactions", _TM
    ),
    "dash_salesperson_table": "SELECT salesperson_name, total_transactions, total_units_sold, total_revenue, "
    f"total_discounts_given, avg_transaction_value, active_days FROM salesperson_performance WHERE {_TM}",
    "dash_returns_tm": _sums("returns_analysis", "", "return_value", "units_returned", _TMS),
    "dash_returns_by_reason": _sums("returns_analysis", "return_reason", "", "units_returned"),
    "dash_returns_by_refund": _sums("returns_analysis", "refund_method", "return_value"),
    "dash_top10_returned": _sums("returns_analysis", "product_name", "", "units_returned")
    + " ORDER BY units_returned DESC, product_name LIMIT 10",
    "dash_returns_monthly": _sums("returns_analysis", "month_start", "return_value", "units_returned"),
    "dash_returns_by_category": _sums("returns_analysis", "category", "return_value"),
    "dash_returns_vs_sales": "SELECT salesperson_name, sum(revenue)::DECIMAL(38,2) AS total_revenue, "
    "sum(back)::DECIMAL(38,2) AS return_value FROM ("
    "SELECT salesperson_name, total_revenue AS revenue, 0 AS back FROM salesperson_performance UNION ALL "
    "SELECT salesperson_name, 0, return_value FROM returns_analysis) GROUP BY salesperson_name",
    "dash_returns_table": "SELECT return_date, product_name, category, units_returned, return_value, return_reason, "
    "refund_method, salesperson_name FROM returns_analysis",
    "dash_unit_bars": f"SELECT unit, total_revenue, estimated_net_profit FROM unit_performance WHERE {_TM}",
    "dash_unit_table": "SELECT unit, total_transactions, total_revenue, total_cogs, total_expenses, gross_profit, "
    f"estimated_net_profit, net_margin_pct, return_rate_pct FROM unit_performance WHERE {_TM}",
    "dash_unit_trend": _sums("unit_performance", '"month" unit', "total_revenue"),
}


for _name in dashboards.QUERIES:
    QUERIES[_name] = (_dashboard(_name), _DASH_SQL[_name])

# --- the date control set to several months, and the returns table with its filters ----------------------------------

_SPAN = (dt.date(2000, 2, 10), REPORT_DAY)


def _in_span(column: str) -> str:
    return f"{column} BETWEEN DATE '2000-02-01' AND {month(_DAY)}"


def _over_months(name: str):
    build, inputs, _ = dashboards.QUERIES[name]
    return lambda w: build(*(w.report_on(m, f"{name}_months", whole=False, **_reads(m, _SPAN)) for m in inputs), as_of=_SPAN)


QUERIES |= {
    "dash_top10_products_months": (
        _over_months("dash_top10_products"),
        _sums("product_performance", "product_name", "total_revenue", "", _in_span('"month"'))
        + " ORDER BY total_revenue DESC, product_name LIMIT 10",
    ),
    "dash_revenue_by_category_months": (
        _over_months("dash_revenue_by_category"),
        _sums("product_performance", "category", "total_revenue", "", _in_span('"month"')),
    ),
    "dash_expense_by_category_months": (
        _over_months("dash_expense_by_category_tm"),
        _sums("expense_summary", "expense_category", "total_amount", "", _in_span("month_start")),
    ),
    "dash_salesperson_bars_months": (
        _over_months("dash_salesperson_bars"),
        _sums("salesperson_performance", "salesperson_name", "total_revenue", "total_transactions", _in_span('"month"')),
    ),
    "dash_returns_months": (
        _over_months("dash_returns_tm"),
        _sums("returns_analysis", "", "return_value", "units_returned", _in_span("month_start")),
    ),
    "dash_returns_table_filtered": (
        lambda w: dashboards.returns_table(w.report_on("returns_analysis", "dash_returns_table_filtered"), reason="Defective", salesperson="SUPPLIER#000000001"),
        _DASH_SQL["dash_returns_table"] + " WHERE return_reason = 'Defective' AND salesperson_name = 'SUPPLIER#000000001'",
    ),
}
