"""One query per cleaning expression, scalar function and relational operator, each over a whole layer table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from testbed import oracle_base as sql
from testbed.warehouse import AS_OF, CHECK_DAY, Warehouse
from tillworks import functions as fn
from tillworks.operators import aggregates, filters, joins, ordering, sets, windows
from tillworks.operators.sets import stack
from tillworks.plans import marts

QUERIES: dict = {}


def _col(name: str) -> Column:
    return F.col(name)


def _project(name: str, table: str, oracle: str, *shown: str, derived: Callable[[], dict[str, Column]]) -> None:
    """A query that shows input columns next to the expressions computed from them, for every row of a table."""

    def build(w: Warehouse) -> DataFrame:
        source = w.staging(table) if table.startswith("stg_") else w.raw(table)
        return source.select(*shown, *(value.alias(alias) for alias, value in derived().items()))

    keep = "".join(f'"{c}", ' for c in shown)
    QUERIES[name] = (build, f"SELECT {keep}{oracle} FROM {table}")


def _query(name: str, oracle: str) -> Callable:
    def register(build: Callable[[Warehouse], DataFrame]) -> Callable:
        QUERIES[name] = (build, oracle)
        return build

    return register


# --- cleaning and parsing (raw tables) ----------------------------------------------------------------------------

_project(
    "parse_form_date", "sales_raw", f"""{sql.date('"Date"')} AS sale_date""", "Date",
    derived=lambda: {
        "sale_date": fn.parse_form_date(_col("Date")),
    },
)
_project(
    "parse_form_timestamp", "sales_raw",
    f"""{sql.stamp('"Timestamp"')} AS submitted_at, {sql.stamp('"Date"')} AS date_as_timestamp""", "Timestamp", "Date",
    derived=lambda: {
        "submitted_at": fn.parse_form_timestamp(_col("Timestamp")),
        "date_as_timestamp": fn.parse_form_timestamp(_col("Date")),
    },
)
_project(
    "parse_form_number", "sales_raw",
    f"""{sql.number('Unit_Price_KES')} AS unit_price, {sql.number('Discount_Amount_KES')} AS discount,
    {sql.number('"Date"')} AS date_digits""", "Unit_Price_KES",
    derived=lambda: {
        "unit_price": fn.parse_form_number(_col("Unit_Price_KES")),
        "discount": fn.parse_form_number(_col("Discount_Amount_KES")),
        "date_digits": fn.parse_form_number(_col("Date")),
    },
)
_project(
    "parse_form_int", "sales_raw",
    f"{sql.integer('Units_Sold')} AS units_sold, {sql.integer('Unit_Price_KES')} AS whole_price", "Unit_Price_KES",
    derived=lambda: {
        "units_sold": fn.parse_form_int(_col("Units_Sold")),
        "whole_price": fn.parse_form_int(_col("Unit_Price_KES")),
    },
)
_project(
    "surrogate_key_md5", "sales_raw",
    sql.md5_key('"Date"', "Salesperson_Name", "Product", "Notes", '"Timestamp"') + " AS row_key",
    derived=lambda: {
        "row_key": fn.surrogate_key(*(_col(c) for c in ("Date", "Salesperson_Name", "Product", "Notes", "Timestamp"))),
    },
)
_project(
    "safe_divide", "stg_sales",
    "CASE WHEN discount_amount = 0 THEN 0 ELSE "
    + sql.fixed(sql.half_away(f"{sql.scaled('net_amount', 9)} * 10000", sql.scaled("discount_amount", 9)), 4)
    + " END::DECIMAL(28,4) AS net_per_discount", "net_amount", "discount_amount",
    derived=lambda: {
        "net_per_discount": fn.safe_divide(*(_col(c).cast("decimal(28,9)") for c in ("net_amount", "discount_amount"))).cast("decimal(28,4)"),
    },
)
_project(
    "product_key_slug", "products_raw", f"{sql.slug('Product_Name')} AS product_key", "Product_Name",
    derived=lambda: {
        "product_key": fn.product_key_slug(_col("Product_Name")),
    },
)
_project(
    "validate_phone", "sales_raw", f"{sql.phone('Customer_Phone_Number')} AS customer_phone", "Customer_Phone_Number",
    derived=lambda: {
        "customer_phone": fn.validate_phone(_col("Customer_Phone_Number")),
    },
)
_project(
    "mask_phone", "stg_sales", f"{sql.mask('customer_phone')} AS masked",
    derived=lambda: {
        "masked": fn.mask_phone(_col("customer_phone")),
    },
)
_project(
    "blank_to_null", "sales_raw", f"{sql.blank_null('Business_Unit')} AS unit", "Business_Unit",
    derived=lambda: {
        "unit": fn.blank_to_null(_col("Business_Unit")),
    },
)
_project(
    "null_to_blank", "sales_raw", f"coalesce({sql.trim('Customer_Type')}, '') AS customer_type",
    derived=lambda: {
        "customer_type": fn.null_to_blank(_col("Customer_Type")),
    },
)
_project(
    "upper_name", "sales_raw", f"upper({sql.trim('Salesperson_Name')}) AS salesperson_name", "Salesperson_Name",
    derived=lambda: {
        "salesperson_name": fn.upper_name(_col("Salesperson_Name")),
    },
)
QUERIES["split_family_variant"] = (
    lambda w: w.raw("products_raw").select(
        "Product_Name", fn.product_family(_col("Product_Name")).alias("product_family"),
        fn.product_variant(_col("Product_Name")).alias("product_variant"),
    ),
    "SELECT Product_Name, product_family, product_variant FROM products_raw JOIN "
    "(SELECT DISTINCT product_name AS clean_name, product_family, product_variant FROM parsed_products) "
    "ON clean_name = Product_Name",
)
_project(
    "parse_bool_flag", "products_raw",
    f"coalesce(lower({sql.trim('Is_Active')}) IN ('yes', 'true', '1'), false) AS is_active", "Product_Name", "Is_Active",
    derived=lambda: {
        "is_active": fn.parse_bool_flag(_col("Is_Active")),
    },
)
_project(
    "default_if_unparsable", "products_raw",
    f"""coalesce({sql.integer('Reorder_Level')}, 5)::BIGINT AS reorder_level,
    coalesce({sql.number('Cost_Price_KES')}, 0)::DECIMAL(38,9) AS cost_price""", "Product_Name",
    derived=lambda: {
        "reorder_level": fn.default_if_unparsable(fn.parse_form_int(_col("Reorder_Level")), 5),
        "cost_price": fn.default_if_unparsable(fn.parse_form_number(_col("Cost_Price_KES")), 0).cast(fn.NUMBER),
    },
)

# --- scalar functions (staging tables) ----------------------------------------------------------------------------

_project(
    "fn_month_start", "stg_sales", f"{sql.month('sale_date')} AS month_start", "sale_date",
    derived=lambda: {
        "month_start": fn.month_start(_col("sale_date")),
    },
)
_project(
    "fn_week_start_monday", "stg_sales", f"{sql.week('sale_date')} AS week_start", "sale_date",
    derived=lambda: {
        "week_start": fn.week_start_monday(_col("sale_date")),
    },
)
_project(
    "fn_day_of_week", "stg_sales", "(dayofweek(sale_date) + 1)::BIGINT AS day_of_week", "sale_date",
    derived=lambda: {
        "day_of_week": fn.day_of_week(_col("sale_date")),
    },
)
_project(
    "fn_day_of_month", "stg_sales", "day(sale_date)::BIGINT AS day_of_month", "sale_date",
    derived=lambda: {
        "day_of_month": fn.day_of_month(_col("sale_date")),
    },
)
_project(
    "fn_days_between", "stg_sales", f"({sql.AS_OF_SQL} - sale_date)::BIGINT AS days_since", "sale_date",
    derived=lambda: {
        "days_since": fn.days_between(fn.as_of_date(AS_OF), _col("sale_date")),
    },
)
_project(
    "fn_as_of_date", "stg_expenses",
    f"DATE '{CHECK_DAY}' AS as_of, expense_date > DATE '{CHECK_DAY}' AS is_future", "expense_id",
    derived=lambda: {
        "as_of": fn.as_of_date(CHECK_DAY),
        "is_future": _col("expense_date") > fn.as_of_date(CHECK_DAY),
    },
)
_project(
    "fn_round_half_away", "stg_sales",
    "round(unit_price, 1)::DECIMAL(28,1) AS one_digit, round(-unit_price, 0)::DECIMAL(28,0) AS negative, "
    "round(unit_price, 2)::DECIMAL(38,2) AS two_digits", "unit_price",
    derived=lambda: {
        "one_digit": F.round("unit_price", 1).cast("decimal(28,1)"),
        "negative": F.round(-_col("unit_price"), 0).cast("decimal(28,0)"),
        "two_digits": F.round("unit_price", 2).cast(fn.MONEY),
    },
)
_project(
    "fn_coalesce", "stg_products", "coalesce(cost_price, 0)::DECIMAL(38,9) AS cost", "product_key", "cost_price",
    derived=lambda: {
        "cost": fn.zero_if_null(_col("cost_price")).cast(fn.NUMBER),
    },
)
_project(
    "fn_greatest_floor0", "stg_products",
    "greatest(coalesce(cost_price, 0) - selling_price + 1000, 0)::DECIMAL(28,9) AS floored", "product_key",
    derived=lambda: {
        "floored": fn.greatest_or_zero(
            fn.difference(fn.zero_if_null(_col("cost_price")), _col("selling_price")).cast("decimal(28,9)") + 1000
        ).cast("decimal(28,9)"),
    },
)
_project(
    "fn_case_bucket", "stg_sales",
    """CASE WHEN net_amount >= 10000 THEN 'VIP' WHEN net_amount >= 3000 THEN 'Regular' ELSE 'Occasional' END AS tier,
    CASE WHEN units_sold - 10 <= 0 THEN 'Out of Stock' WHEN units_sold - 10 <= 5 THEN 'Low Stock' ELSE 'In Stock' END
    AS status""", "net_amount", "units_sold",
    derived=lambda: {
        "tier": marts.customer_tier(_col("net_amount")),
        "status": marts.stock_status(_col("units_sold") - 10, F.lit(5)),
    },
)
_project(
    "fn_ratio_pct", "stg_products",
    f"""{sql.pct('(selling_price - coalesce(cost_price, 0))', 'selling_price', 9)} AS margin_pct,
    {sql.count_pct('reorder_level', '(reorder_level - 100)')} AS level_pct""", "product_key",
    derived=lambda: {
        "margin_pct": fn.ratio_pct(fn.difference(_col("selling_price"), fn.zero_if_null(_col("cost_price"))), _col("selling_price")),
        "level_pct": fn.count_ratio_pct(_col("reorder_level"), _col("reorder_level") - 100),
    },
)
_NAME = "Product_Name"
_project(
    "fn_string_misc", "products_raw",
    f"""lower({sql.trim(_NAME)}) AS lowered, upper({_NAME}) AS uppered, length({_NAME})::INT AS n_chars,
    substr({_NAME}, 2, 5) AS part, strpos({_NAME}, ' - ')::INT AS dash_at, split_part({_NAME}, ' - ', 1) AS head,
    regexp_matches({_NAME}, '[0-9]{{3}}$') AS ends_in_number, regexp_replace({_NAME}, '[aeiou]', '*', 'g') AS starred,
    nullif(Is_Active, 'No') AS active_or_null, md5({_NAME}) AS hashed, concat(Category, ': ', {_NAME}) AS label""",
    derived=lambda: {
        "lowered": F.lower(fn.trim_ws(_col(_NAME))),
        "uppered": F.upper(_NAME),
        "n_chars": F.length(_NAME),
        "part": F.substring(_NAME, 2, 5),
        "dash_at": F.instr(_NAME, " - "),
        "head": F.get(F.split(_NAME, " - "), F.lit(0)),
        "ends_in_number": _col(_NAME).rlike("[0-9]{3}$"),
        "starred": F.regexp_replace(_NAME, "[aeiou]", "*"),
        "active_or_null": F.nullif(_col("Is_Active"), F.lit("No")),
        "hashed": F.md5(_NAME),
        "label": F.concat("Category", F.lit(": "), _NAME),
    },
)
_project(
    "fn_arith", "stg_sales",
    """(units_sold * 2 - 3)::BIGINT AS whole, (units_sold::DECIMAL(10,0) * unit_price)::DECIMAL(38,9) AS product,
    (unit_price - discount_amount)::DECIMAL(38,9) AS difference, (unit_price + discount_amount)::DECIMAL(38,9) AS total""",
    derived=lambda: {
        "whole": _col("units_sold") * 2 - 3,
        "product": fn.total_value(_col("units_sold"), _col("unit_price")),
        "difference": fn.difference(_col("unit_price"), _col("discount_amount")),
        "total": fn.difference(_col("unit_price"), -_col("discount_amount")),
    },
)

# --- filters ------------------------------------------------------------------------------------------------------

_REQUIRED = {
    "sales_raw": (["Date", "Product"], []),
    "returns_raw": (["Date_of_Return", "Product_Returned"], []),
    "products_raw": (["Product_Name"], []),
    "expenses_raw": (["Date_of_Expense"], ["Expense_Category"]),
    "inventory_purchases_raw": (["Date_of_Purchase"], ["Product_Purchased"]),
}
_POSITIVE = {
    "sales_raw": {"Units_Sold": "int"},
    "expenses_raw": {"Amount_KES": "number"},
    "inventory_purchases_raw": {"Units_Purchased": "int", "Unit_Cost_KES": "number"},
    "returns_raw": {"Units_Returned": "int"},
    "products_raw": {"Current_Selling_Price": "number"},
}
_DATES = {
    "sales_raw": "Date", "expenses_raw": "Date_of_Expense", "inventory_purchases_raw": "Date_of_Purchase",
    "returns_raw": "Date_of_Return",
}


def _count_of(df: DataFrame, table: str, *more: Column) -> DataFrame:
    return df.agg(F.lit(table).alias("table_name"), F.count("*").alias("n_records"), *more)


def _count_sql(table: str, where: str, more: str = "") -> str:
    return f"SELECT '{table}' AS table_name, count(*) AS n_records{more} FROM {table} WHERE {where}"


@_query("flt_required_present", " UNION ALL ".join(
    _count_sql(t, " AND ".join([f"{sql.trim(chr(34) + c + chr(34))} <> ''" for c in blank] + [f"{c} IS NOT NULL" for c in null]))
    for t, (blank, null) in _REQUIRED.items()
))
def _(w: Warehouse) -> DataFrame:
    return stack([
        _count_of(filters.required_present(w.raw(t), blank, null), t) for t, (blank, null) in _REQUIRED.items()
    ])


_PARSE = {"int": (fn.parse_form_int, sql.integer), "number": (fn.parse_form_number, sql.number)}


@_query("flt_positive_parsed", " UNION ALL ".join(
    _count_sql(t, " AND ".join(f"{_PARSE[k][1](c)} > 0" for c, k in cols.items())) for t, cols in _POSITIVE.items()
))
def _(w: Warehouse) -> DataFrame:
    return stack([
        _count_of(filters.positive(w.raw(t).select(*(_PARSE[k][0](_col(c)).alias(c) for c, k in cols.items())), *cols), t)
        for t, cols in _POSITIVE.items()
    ])


@_query("flt_date_parsed", " UNION ALL ".join(
    _count_sql(t, f"""{sql.date(f'"{c}"')} IS NOT NULL""", f""", min({sql.date(f'"{c}"')}) AS first_day""")
    for t, c in _DATES.items()
))
def _(w: Warehouse) -> DataFrame:
    return stack([
        _count_of(filters.date_parsed(w.raw(t).select(fn.parse_form_date(_col(c)).alias("d")), "d"), t, F.min("d").alias("first_day"))
        for t, c in _DATES.items()
    ])


@_query("flt_is_active", "SELECT product_key, product_name FROM stg_products WHERE is_active")
def _(w: Warehouse) -> DataFrame:
    return filters.active_only(w.staging("stg_products")).select("product_key", "product_name")


@_query("flt_not_null_group", "SELECT unit, count(*) AS n_records FROM stg_sales WHERE unit IS NOT NULL GROUP BY unit")
def _(w: Warehouse) -> DataFrame:
    return filters.with_value(w.staging("stg_sales"), "unit").groupBy("unit").agg(F.count("*").alias("n_records"))


def _latest_purchase(w: Warehouse) -> DataFrame:
    newest = [_col(c).desc_nulls_last() for c in ("purchase_date", "submitted_at", "unit_cost", "purchase_id")]
    return windows.latest_per_key(w.staging("stg_inventory_purchases"), ["product_key"], newest)


_LATEST_PURCHASE = (
    "FROM stg_inventory_purchases QUALIFY row_number() OVER (PARTITION BY product_key ORDER BY purchase_date DESC, "
    "submitted_at DESC NULLS LAST, unit_cost DESC, purchase_id DESC) = 1"
)


@_query("flt_rank_one", """
SELECT customer_phone, sale_date, net_amount FROM stg_sales WHERE customer_phone IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY customer_phone ORDER BY sale_date DESC, net_amount DESC) = 1""")
def _(w: Warehouse) -> DataFrame:
    sales = filters.with_value(w.staging("stg_sales"), "customer_phone").select("customer_phone", "sale_date", "net_amount")
    return windows.latest_per_key(sales, ["customer_phone"], [_col("sale_date").desc(), _col("net_amount").desc()])


@_query("flt_theta_violation", f"""
SELECT 'late sale' AS rule, sale_id AS record FROM stg_sales WHERE sale_date > DATE '{CHECK_DAY}' UNION ALL
SELECT 'no value', return_id FROM stg_returns WHERE return_value <= 0 UNION ALL
SELECT 'below cost', product_key FROM stg_products WHERE selling_price * 2 < cost_price * 3 + 1""")
def _(w: Warehouse) -> DataFrame:
    late = filters.later_than(w.staging("stg_sales"), "sale_date", fn.as_of_date(CHECK_DAY))
    worthless = filters.not_above_zero(w.staging("stg_returns"), "return_value")
    priced = w.staging("stg_products").withColumns({"twice": _col("selling_price") * 2, "bound": _col("cost_price") * 3 + 1})
    found = {"late sale": (late, "sale_id"), "no value": (worthless, "return_id"),
             "below cost": (filters.below(priced, "twice", "bound"), "product_key")}
    return stack([df.select(F.lit(rule).alias("rule"), _col(c).alias("record")) for rule, (df, c) in found.items()])


# --- projections --------------------------------------------------------------------------------------------------


@_query("proj_star", "SELECT * FROM stg_expenses")
def _(w: Warehouse) -> DataFrame:
    return w.staging("stg_expenses").select("*")


_project(
    "proj_derived_amounts", "stg_sales",
    """round(units_sold::DECIMAL(10,0) * unit_price, 2)::DECIMAL(38,2) AS gross,
    round(units_sold::DECIMAL(10,0) * unit_price - discount_amount, 2)::DECIMAL(38,2) AS net""", "sale_id", "units_sold",
    derived=lambda: {
        "gross": fn.line_amount(_col("units_sold"), _col("unit_price")),
        "net": fn.line_amount(_col("units_sold"), _col("unit_price"), less=_col("discount_amount")),
    },
)
_project(
    "proj_explicit_reorder", "stg_inventory_purchases",
    "round(units_purchased::DECIMAL(10,0) * unit_cost, 2)::DECIMAL(38,2) AS cost, supplier_name", "purchase_id",
    "unit_cost",
    derived=lambda: {
        "cost": fn.line_amount(_col("units_purchased"), _col("unit_cost")),
        "supplier_name": _col("supplier_name"),
    },
)
_project(
    "proj_alias_rename", "stg_returns", "return_date AS sale_date, original_unit_price AS sold_for", "return_id",
    derived=lambda: {
        "sale_date": _col("return_date"),
        "sold_for": _col("original_unit_price"),
    },
)


# --- joins --------------------------------------------------------------------------------------------------------


@_query(
    "join_left_equi",
    "SELECT return_id, product_key, product_name, category FROM stg_returns LEFT JOIN stg_products USING (product_key)",
)
def _(w: Warehouse) -> DataFrame:
    products = w.staging("stg_products").select("product_key", "product_name", "category")
    returns = w.staging("stg_returns").select("return_id", "product_key")
    return joins.left_lookup(returns, products, "product_key")


_BY_PRODUCT_MONTH = """(SELECT product_key, {m} AS "month", sum({q})::BIGINT AS {q} FROM {t} GROUP BY ALL)"""


def _units_by(df: DataFrame, date: str, units: str) -> DataFrame:
    return df.groupBy("product_key", fn.month_start(_col(date)).alias("month")).agg(F.sum(units).alias(units))


@_query("join_left_composite", (
    'SELECT product_key, "month", units_sold, units_returned FROM '
    + _BY_PRODUCT_MONTH.format(m=sql.month("sale_date"), q="units_sold", t="stg_sales") + " LEFT JOIN "
    + _BY_PRODUCT_MONTH.format(m=sql.month("return_date"), q="units_returned", t="stg_returns")
    + ' USING (product_key, "month")'
))
def _(w: Warehouse) -> DataFrame:
    sold = _units_by(w.staging("stg_sales"), "sale_date", "units_sold")
    back = _units_by(w.staging("stg_returns"), "return_date", "units_returned")
    return joins.left_lookup(sold, back, ["product_key", "month"])


@_query("join_left_null_safe", """
SELECT s.d, s.unit, s.n AS sales, r.n AS returns
FROM (SELECT d, unit, count(*) AS n FROM moves WHERE kind = 'sale' GROUP BY d, unit) s
LEFT JOIN (SELECT d, unit, count(*) AS n FROM moves WHERE kind = 'return' GROUP BY d, unit) r
ON s.d = r.d AND s.unit IS NOT DISTINCT FROM r.unit""")
def _(w: Warehouse) -> DataFrame:
    sold = w.staging("stg_sales").groupBy(_col("sale_date").alias("d"), "unit").agg(F.count("*").alias("sales"))
    back = w.staging("stg_returns").groupBy(_col("return_date").alias("d"), "unit").agg(F.count("*").alias("returns"))
    return joins.left_null_safe(sold, back, ["d", "unit"])


@_query("join_inner_equi", """
SELECT product_key, product_name, sum(units_sold)::BIGINT AS units FROM stg_sales
JOIN (SELECT product_key, product_name FROM stg_products WHERE is_active) USING (product_key) GROUP BY ALL""")
def _(w: Warehouse) -> DataFrame:
    sold = w.staging("stg_sales").groupBy("product_key").agg(F.sum("units_sold").alias("units"))
    return filters.active_only(w.staging("stg_products")).select("product_key", "product_name").join(sold, "product_key")


_LATEST_COST = (
    "(SELECT product_key, first(unit_cost ORDER BY purchase_date DESC, submitted_at DESC NULLS LAST, unit_cost DESC) "
    "AS latest_cost FROM stg_inventory_purchases GROUP BY product_key)"
)


def _latest_cost(w: Warehouse) -> DataFrame:
    purchases = w.staging("stg_inventory_purchases")
    latest = aggregates.with_latest(purchases, ["product_key"], "unit_cost", "purchase_date", "submitted_at", "latest_cost")
    return latest.select("product_key", "latest_cost")


@_query("join_inner_to_aggregate", (
    f"SELECT sale_id, unit_price, latest_cost FROM stg_sales JOIN {_LATEST_COST} USING (product_key) "
    "WHERE unit_price < latest_cost"
))
def _(w: Warehouse) -> DataFrame:
    latest = joins.with_own_shuffle(_latest_cost(w), "product_key")
    joined = w.staging("stg_sales").select("sale_id", "product_key", "unit_price").join(latest, "product_key")
    return filters.below(joined, "unit_price", "latest_cost").drop("product_key")


@_query("join_cross_spine", f"""
SELECT product_key, mon AS "month" FROM stg_products CROSS JOIN
(SELECT DISTINCT {sql.month('sale_date')} AS mon FROM stg_sales) WHERE is_active""")
def _(w: Warehouse) -> DataFrame:
    months = w.staging("stg_sales").select(fn.month_start(_col("sale_date")).alias("month")).distinct()
    return joins.explode_spine(filters.active_only(w.staging("stg_products")).select("product_key"), months, "month")


@_query("join_star_of_aggregates", f"""
SELECT mon AS "month", unit, {sql.zero_money("sum(amt) FILTER (kind = 'sale')")} AS revenue,
  {sql.zero_money("sum(amt) FILTER (kind = 'return')")} AS refunds,
  {sql.zero_money("sum(amt) FILTER (kind = 'expense')")} AS spent
FROM moves GROUP BY mon, unit""")
def _(w: Warehouse) -> DataFrame:
    facts = {"revenue": ("stg_sales", "sale_date", "net_amount"), "refunds": ("stg_returns", "return_date", "return_value"),
             "spent": ("stg_expenses", "expense_date", "amount")}
    parts = [
        w.staging(t).groupBy(fn.month_start(_col(d)).alias("month"), "unit").agg(fn.money_sum(_col(v)).alias(name))
        for name, (t, d, v) in facts.items()
    ]
    both = aggregates.combine(parts, ["month", "unit"])
    return both.withColumns({name: fn.zero_if_null(_col(name)) for name in facts})


@_query("join_left_anti", """
SELECT sale_id, product_key FROM stg_sales WHERE product_key NOT IN (SELECT product_key FROM stg_products)""")
def _(w: Warehouse) -> DataFrame:
    child = w.staging("stg_sales").select("sale_id", "product_key")
    return joins.orphans(child, w.staging("stg_products"), "product_key").select("sale_id", "product_key")


# --- aggregates ---------------------------------------------------------------------------------------------------


def _grouped(name: str, table: str, by: list[str], oracle: str, measures: Callable[[], dict[str, Column]]) -> None:
    keys = ", ".join(by)

    def build(w: Warehouse) -> DataFrame:
        return w.staging(table).groupBy(*by).agg(*(m.alias(alias) for alias, m in measures().items()))

    QUERIES[name] = (build, f"SELECT {keys}, {oracle} FROM {table} GROUP BY {keys}")


_grouped("agg_count_star", "stg_sales", ["sale_date", "unit"], "count(*) AS n",
    measures=lambda: {
        "n": F.count("*"),
    },
)
_grouped(
    "agg_sum_round", "stg_sales", ["unit"],
    f"{sql.money('sum(net_amount)')} AS net, {sql.money('sum(discount_amount)')} AS discounts",
    measures=lambda: {
        "net": fn.money_sum(_col("net_amount")),
        "discounts": fn.money_sum(_col("discount_amount")),
    },
)
_grouped(
    "agg_sum_int", "stg_returns", ["product_key"], "sum(units_returned)::BIGINT AS units",
    measures=lambda: {
        "units": F.sum("units_returned"),
    },
)
_grouped(
    "agg_avg_round", "stg_sales", ["salesperson_name"],
    f"{sql.money_avg('sum(net_amount)', 'count(*)')} AS avg_net, {sql.money_avg('sum(unit_price)', 'count(*)', 9)} AS avg_price",
    measures=lambda: {
        "avg_net": F.round(F.avg("net_amount"), 2).cast(fn.MONEY),
        "avg_price": F.round(F.avg("unit_price"), 2).cast(fn.MONEY),
    },
)
_grouped(
    "agg_min_max", "stg_sales", ["product_key"],
    "min(sale_date) AS first_day, max(sale_date) AS last_day, max(net_amount) AS largest",
    measures=lambda: {
        "first_day": F.min("sale_date"),
        "last_day": F.max("sale_date"),
        "largest": F.max("net_amount"),
    },
)
_grouped(
    "agg_count_distinct", "stg_sales", ["unit"],
    "count(DISTINCT customer_phone) AS phones, count(DISTINCT salesperson_name) AS people, count(DISTINCT sale_date) AS days",
    measures=lambda: {
        "phones": F.count_distinct("customer_phone"),
        "people": F.count_distinct("salesperson_name"),
        "days": F.count_distinct("sale_date"),
    },
)
_grouped(
    "agg_conditional_sum", "stg_expenses", ["expense_category"],
    f"""{sql.zero_money("sum(amount) FILTER (paid_via = 'M-Pesa')")} AS mpesa,
    {sql.zero_money("sum(amount) FILTER (paid_via = 'Bank')")} AS bank,
    {sql.zero_money("sum(amount) FILTER (paid_via = 'Cash')")} AS cash""",
    measures=lambda: {
        "mpesa": aggregates.paid_by("paid_via", "M-Pesa", "amount"),
        "bank": aggregates.paid_by("paid_via", "Bank", "amount"),
        "cash": aggregates.paid_by("paid_via", "Cash", "amount"),
    },
)
_COST_JOIN = "moves LEFT JOIN stg_products USING (product_key) WHERE kind = 'sale'"


@_query("agg_sum_product", f"""
SELECT mon AS "month", unit, {sql.money('sum(q::DECIMAL(10,0) * coalesce(cost_price, 0))')} AS total_cogs
FROM {_COST_JOIN} GROUP BY mon, unit""")
def _(w: Warehouse) -> DataFrame:
    sales = w.staging("stg_sales").withColumn("month", fn.month_start(_col("sale_date")))
    return aggregates.cost_of_goods(sales, w.staging("stg_products"), ["month", "unit"])


@_query("agg_sum_floored_margin", f"""
SELECT product_key,
  {sql.money('sum(q::DECIMAL(10,0) * greatest(price - coalesce(cost_price, 0), 0)::DECIMAL(38,9))')} AS profit
FROM {_COST_JOIN} GROUP BY product_key""")
def _(w: Warehouse) -> DataFrame:
    units = w.staging("stg_sales").groupBy("product_key", "unit_price").agg(F.sum("units_sold").alias("units"))
    costed = joins.left_lookup(units, w.staging("stg_products").select("product_key", "cost_price"), "product_key")
    margin = fn.floored_margin(_col("unit_price"), _col("cost_price"))
    return costed.groupBy("product_key").agg(fn.money_sum(fn.total_value(_col("units"), margin)).alias("profit"))


@_query("agg_latest_by", f"SELECT product_key, latest_cost FROM {_LATEST_COST}")
def _(w: Warehouse) -> DataFrame:
    return _latest_cost(w)


@_query("agg_group_by_expr", f"""
SELECT {sql.month('expense_date')} AS "month", count(*) AS n FROM stg_expenses GROUP BY {sql.month('expense_date')}""")
def _(w: Warehouse) -> DataFrame:
    return w.staging("stg_expenses").groupBy(fn.month_start(_col("expense_date")).alias("month")).agg(F.count("*").alias("n"))


_grouped("agg_group_by_null_key", "stg_returns", ["unit"], "count(*) AS n",
    measures=lambda: {
        "n": F.count("*"),
    },
)


@_query("agg_case_over_agg", """
SELECT salesperson_name, CASE WHEN sum(net_amount) >= 10000 THEN 'VIP' WHEN sum(net_amount) >= 3000 THEN 'Regular'
  ELSE 'Occasional' END AS tier, count(DISTINCT sale_date) > 1 AS is_repeat FROM stg_sales GROUP BY salesperson_name""")
def _(w: Warehouse) -> DataFrame:
    summed = w.staging("stg_sales").groupBy("salesperson_name").agg(
        F.sum("net_amount").alias("spent"), F.count_distinct("sale_date").alias("days")
    )
    return summed.select(
        "salesperson_name", marts.customer_tier(_col("spent")).alias("tier"), (_col("days") > 1).alias("is_repeat")
    )


@_query("agg_group_hidden_key", f"""
SELECT {sql.month('sale_date')} AS "month", {sql.mask('customer_phone')} AS masked, count(*) AS n
FROM stg_sales WHERE customer_phone IS NOT NULL GROUP BY {sql.month('sale_date')}, customer_phone""")
def _(w: Warehouse) -> DataFrame:
    known = filters.with_value(w.staging("stg_sales"), "customer_phone")
    counted = known.groupBy(fn.month_start(_col("sale_date")).alias("month"), "customer_phone").agg(F.count("*").alias("n"))
    return counted.select("month", fn.mask_phone(_col("customer_phone")).alias("masked"), "n")


# --- windows, sorts, limits, sets ---------------------------------------------------------------------------------


@_query("win_row_number_latest", f"SELECT product_key, purchase_id, purchase_date, unit_cost {_LATEST_PURCHASE}")
def _(w: Warehouse) -> DataFrame:
    return _latest_purchase(w).select("product_key", "purchase_id", "purchase_date", "unit_cost")


@_query("sort_multi_key", "SELECT * FROM expense_summary ORDER BY expense_date DESC, total_amount DESC")
def _(w: Warehouse) -> DataFrame:
    return ordering.sort_by(marts.expense_summary(w.staging("stg_expenses")), *marts.ORDER["expense_summary"])


@_query("topk_per_group", f"""
SELECT unit, salesperson_name, revenue FROM (
  SELECT unit, salesperson_name, {sql.money('sum(net_amount)')} AS revenue FROM stg_sales
  WHERE unit IS NOT NULL AND salesperson_name IS NOT NULL GROUP BY unit, salesperson_name)
QUALIFY row_number() OVER (PARTITION BY unit ORDER BY revenue DESC, salesperson_name) <= 3""")
def _(w: Warehouse) -> DataFrame:
    named = filters.with_value(filters.with_value(w.staging("stg_sales"), "unit"), "salesperson_name")
    revenue = named.groupBy("unit", "salesperson_name").agg(fn.money_sum(_col("net_amount")).alias("revenue"))
    return windows.top_per_key(revenue, ["unit"], [_col("revenue").desc(), _col("salesperson_name").asc()], 3)


@_query("topk_global", f"""
SELECT product_key, {sql.money('sum(net_amount)')} AS revenue FROM stg_sales GROUP BY product_key
ORDER BY revenue DESC, product_key LIMIT 20""")
def _(w: Warehouse) -> DataFrame:
    revenue = w.staging("stg_sales").groupBy("product_key").agg(fn.money_sum(_col("net_amount")).alias("revenue"))
    return ordering.top_k(revenue, 20, "-revenue", "product_key")


@_query("set_union_distinct_keys", """
SELECT sale_date AS d, unit FROM stg_sales UNION SELECT return_date, unit FROM stg_returns
UNION SELECT expense_date, unit FROM stg_expenses""")
def _(w: Warehouse) -> DataFrame:
    facts = {"stg_sales": "sale_date", "stg_returns": "return_date", "stg_expenses": "expense_date"}
    return sets.union_distinct(*(w.staging(t).select(_col(d).alias("d"), "unit") for t, d in facts.items()))


@_query("set_union_with_constant", f"""
SELECT {sql.month('sale_date')} AS "month" FROM stg_sales UNION SELECT {sql.month('return_date')} FROM stg_returns
UNION SELECT {sql.month(sql.AS_OF_SQL)}""")
def _(w: Warehouse) -> DataFrame:
    facts = {"stg_sales": "sale_date", "stg_returns": "return_date"}
    months = [w.staging(t).select(fn.month_start(_col(d)).alias("month")) for t, d in facts.items()]
    return sets.with_month_of(sets.union_distinct(*months), AS_OF)
