"""Evidence that the plain queries do not give: the order of sorted reports, and a store that runs low on stock.

``order_*`` number the rows of a report in the order in which it returns them, next to its sort keys. Their SQL numbers the
same rows by the order that the report promises, written down here once more. ``*_unbooked`` look at a store whose purchases
are booked up to a day only, so that some products are low and some below zero.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from testbed import oracle_base, queries_operators, queries_relations
from testbed.warehouse import Warehouse
from tillworks.operators.ordering import numbered
from tillworks.plans import dashboards, marts, quality

BOOKED_UNTIL = dt.date(1995, 1, 1)

# report -> its sort keys; a leading minus sorts descending, NULL last, else ascending, NULL first
ORDER = {
    "sort_multi_key": "-expense_date -total_amount",
    "topk_global": "-revenue product_key",
    "dash_daily_revenue_30d": "sale_date",
    "dash_weekly_revenue_12w": "week_start",
    "dash_monthly_revenue": "month_start",
    "dash_avg_by_day_of_month": "day_of_month",
    "dash_returns_trend": "sale_date",
    "dash_top10_products": "-total_revenue product_name",
    "dash_bottom10_products": "total_revenue product_name",
    "dash_top10_profit": "-total_gross_profit product_name",
    "dash_product_table": "-total_revenue product_name",
    "dash_fast_movers": "-total_units_sold product_name",
    "dash_pnl_table": "-month -gross_revenue",
    "dash_expense_trend": "month_start",
    "dash_top20_customers": "-total_spent customer_phone_masked total_transactions last_purchase_date",
    "dash_top10_returned": "-units_returned product_name",
    "dash_returns_monthly": "month_start",
    "dash_returns_table": "-return_date product_name",
    "dash_unit_table": "-total_revenue unit",
    "dash_unit_trend": "month unit",
}


def _report(name: str):
    build, sql = (queries_operators.QUERIES | queries_relations.QUERIES)[name]
    specs = ORDER[name].split()
    keys = [s.removeprefix("-") for s in specs]
    order = ", ".join(f'"{s[1:]}" DESC NULLS LAST' if s.startswith("-") else f'"{s}" ASC NULLS FIRST' for s in specs)
    quoted = ", ".join(f'"{k}"' for k in keys)
    rows = f"SELECT {quoted}, row_number() OVER (ORDER BY {order}) AS position FROM ({sql})"
    return (lambda w: numbered(build(w)).select(*keys, "position")), rows


def _inventory(w: Warehouse) -> DataFrame:
    products, purchases, sales, returns = w.mart_inputs("inventory_position")
    booked = purchases.filter(F.col("purchase_date") < F.lit(BOOKED_UNTIL))
    return marts.inventory_position(products, booked, sales, returns)


oracle_base.CTE["purchased_until"] = oracle_base.CTE["purchased"].replace(
    "stg_inventory_purchases", f"(SELECT * FROM stg_inventory_purchases WHERE purchase_date < DATE '{BOOKED_UNTIL}')"
)
oracle_base.CTE["inventory_unbooked"] = oracle_base.CTE["inventory_position"].replace("JOIN purchased ", "JOIN purchased_until ")

QUERIES = {f"order_{name.removeprefix('dash_')}": _report(name) for name in ORDER} | {
    "dash_low_stock_unbooked": (
        lambda w: numbered(dashboards.low_stock(_inventory(w))),
        "SELECT product_name, category, stock_on_hand, reorder_level, stock_status, row_number() OVER "
        "(ORDER BY stock_on_hand NULLS FIRST, product_name NULLS FIRST) AS position FROM inventory_unbooked WHERE needs_reorder",
    ),
    "dq_stock_never_negative_unbooked": (
        lambda w: quality.stock_never_negative(_inventory(w)),
        "SELECT product_key, product_name, stock_on_hand FROM inventory_unbooked WHERE stock_on_hand < 0",
    ),
}
