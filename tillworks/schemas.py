"""Declared columns and types of the layer tables, in order. A table that differs is not written."""

from __future__ import annotations

import re

STAGING: dict[str, str] = {
    "stg_products": """
        product_key string, product_name string, product_family string, product_variant string, category string,
        unit_of_measure string, selling_price decimal(38,9), cost_price decimal(38,9), unit_margin_kes decimal(38,2),
        unit_margin_pct decimal(28,1), reorder_level bigint, is_active boolean, submitted_at timestamp
    """,
    "stg_sales": """
        sale_id string, sale_date date, salesperson_name string, product_key string, units_sold bigint,
        unit_price decimal(38,9), discount_amount decimal(38,9), payment_method string, customer_phone string,
        customer_type string, unit string, notes string, submitted_at timestamp, gross_amount decimal(38,2),
        net_amount decimal(38,2)
    """,
    "stg_expenses": """
        expense_id string, expense_date date, expense_category string, amount decimal(38,9), description string,
        paid_via string, recorded_by string, unit string, submitted_at timestamp
    """,
    "stg_inventory_purchases": """
        purchase_id string, purchase_date date, product_key string, units_purchased bigint, unit_cost decimal(38,9),
        total_cost decimal(38,2), supplier_name string, payment_method string, unit string, notes string,
        submitted_at timestamp
    """,
    "stg_returns": """
        return_id string, return_date date, salesperson_name string, product_key string, units_returned bigint,
        original_unit_price decimal(38,9), return_value decimal(38,2), return_reason string, refund_method string,
        customer_phone string, unit string, notes string, submitted_at timestamp
    """,
}

MARTS: dict[str, str] = {
    "daily_sales_summary": """
        sale_date date, unit string, transaction_count bigint, units_sold bigint, gross_revenue decimal(38,2),
        total_discounts decimal(38,2), net_revenue decimal(38,2), units_returned bigint, returns_value decimal(38,2),
        return_transaction_count bigint, effective_revenue decimal(38,2), mpesa_revenue decimal(38,2),
        bank_revenue decimal(38,2), unique_customers_with_phone bigint, active_salespeople bigint, day_of_week bigint,
        day_of_month bigint, week_start date, month_start date
    """,
    "monthly_profit": """
        month date, unit string, gross_revenue decimal(38,2), total_discounts decimal(38,2),
        total_returns decimal(38,2), units_returned bigint, return_count bigint, net_revenue decimal(38,2),
        total_cogs decimal(38,2), total_operating_expenses decimal(38,2), gross_profit decimal(38,2),
        net_profit decimal(38,2), net_margin_pct decimal(28,1), sale_count bigint, units_sold bigint,
        expense_entries bigint
    """,
    "inventory_position": """
        product_key string, product_name string, category string, unit_of_measure string, selling_price decimal(38,9),
        reorder_level bigint, total_purchased bigint, total_purchase_cost decimal(38,2), last_purchase_date date,
        latest_unit_cost decimal(38,9), total_sold bigint, total_returned bigint, total_revenue decimal(38,2),
        total_return_value decimal(38,2), stock_on_hand bigint, inventory_value_at_cost decimal(38,2),
        inventory_value_at_retail decimal(38,2), stock_status string, needs_reorder boolean
    """,
    "product_performance": """
        month date, product_key string, product_name string, product_family string, product_variant string,
        category string, unit_of_measure string, current_selling_price decimal(38,9), current_cost_price decimal(38,9),
        current_unit_margin_kes decimal(38,2), current_unit_margin_pct decimal(28,1), reorder_level bigint,
        total_transactions bigint, total_units_sold bigint, total_units_returned bigint, total_revenue decimal(38,2),
        total_return_value decimal(38,2), total_discounts decimal(38,2), avg_selling_price decimal(38,2),
        first_sale_date date, last_sale_date date, total_cogs decimal(38,2), total_gross_profit decimal(38,2),
        gross_margin_pct decimal(28,1)
    """,
    "unit_performance": """
        month date, unit string, total_transactions bigint, total_units_sold bigint, total_revenue decimal(38,2),
        total_discounts decimal(38,2), avg_transaction_value decimal(38,2), salespeople_count bigint,
        active_days bigint, first_sale_date date, last_sale_date date, total_returns_processed bigint,
        total_units_returned bigint, total_return_value decimal(38,2), total_expense_entries bigint,
        total_expenses decimal(38,2), total_cogs decimal(38,2), gross_profit decimal(38,2),
        estimated_net_profit decimal(38,2), net_margin_pct decimal(28,1), return_rate_pct double
    """,
    "salesperson_performance": """
        salesperson_name string, month date, total_transactions bigint, active_days bigint, total_units_sold bigint,
        total_returns_processed bigint, total_units_returned bigint, total_revenue decimal(38,2),
        total_return_value decimal(38,2), total_discounts_given decimal(38,2), avg_transaction_value decimal(38,2),
        mpesa_revenue decimal(38,2), bank_revenue decimal(38,2), first_sale_date date, last_sale_date date
    """,
    "expense_summary": """
        expense_date date, expense_category string, unit string, transaction_count bigint, total_amount decimal(38,2),
        mpesa_amount decimal(38,2), bank_amount decimal(38,2), month_start date, week_start date
    """,
    "returns_analysis": """
        return_id string, return_date date, month_start date, week_start date, salesperson_name string, unit string,
        product_key string, product_name string, category string, units_returned bigint,
        original_unit_price decimal(38,9), return_value decimal(38,2), return_reason string, refund_method string,
        customer_phone string, notes string, product_return_rate_pct double
    """,
    "customer_insights": """
        month date, customer_phone_masked string, total_transactions bigint, purchase_days bigint,
        total_spent decimal(38,2), avg_transaction_value decimal(38,2), largest_transaction decimal(38,2),
        total_units_purchased bigint, first_purchase_date date, last_purchase_date date,
        days_since_last_purchase bigint, customer_tier string, is_repeat_customer boolean
    """,
}


def names(ddl: str) -> list[str]:
    """The columns of a declaration."""
    return [c.split()[0] for c in re.split(r",(?![^(]*\))", ddl)]
