"""The layers in DuckDB SQL, written as named subqueries that a query pulls in as it needs them."""

from __future__ import annotations

import re

from testbed.warehouse import AS_OF
from tillworks.functions.text import WHITE_SPACE
from tillworks.values import CATEGORY_NAMES, REFUND_METHODS, RETURN_REASONS, UNITS_OF_MEASURE

# --- expressions --------------------------------------------------------------------------------------------------

AS_OF_SQL = f"DATE '{AS_OF}'"


def trim(c: str) -> str:
    return f"trim({c}, '{WHITE_SPACE}')"


def blank_null(c: str) -> str:
    return f"nullif({trim(c)}, '')"


def number(c: str) -> str:
    return f"try_cast(nullif(regexp_replace({c}, '[^0-9.\\-]', '', 'g'), '') AS DECIMAL(38,9))"


def integer(c: str) -> str:
    return f"try_cast(round({number(c)}) AS BIGINT)"


def stamp(c: str, iso_date_too: bool = True) -> str:
    t = trim(c)
    iso = r"\d{4}-\d{1,2}-\d{1,2}" + (r"([ Tt]" if iso_date_too else r"[ Tt]")
    iso += r"\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?"
    iso += ")?" if iso_date_too else ""
    slash = r"\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2}"
    return (
        f"coalesce(CASE WHEN regexp_full_match({t}, '{iso}') THEN try_cast({t} AS TIMESTAMP) END, "
        f"CASE WHEN regexp_full_match({t}, '{slash}') THEN coalesce(try_strptime({t}, '%m/%d/%Y %H:%M:%S'), "
        f"try_strptime({t}, '%d/%m/%Y %H:%M:%S')) END)"
    )


def date(c: str) -> str:
    t = trim(c)
    return (
        f"coalesce(CASE WHEN regexp_full_match({t}, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN try_cast({t} AS DATE) END, "
        f"CASE WHEN regexp_full_match({t}, '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}') THEN "
        f"coalesce(try_strptime({t}, '%m/%d/%Y'), try_strptime({t}, '%d/%m/%Y')) END::DATE, "
        f"{stamp(c, iso_date_too=False)}::DATE)"
    )


def slug(c: str) -> str:
    return f"lower(regexp_replace(regexp_replace({trim(c)}, '[^a-zA-Z0-9\\s]', '', 'g'), '\\s+', '_', 'g'))"


def md5_key(*parts: str) -> str:
    return "md5(" + " || '|' || ".join(f"coalesce({p}, '')" for p in parts) + ")"


def phone(c: str) -> str:
    return f"CASE WHEN regexp_full_match({trim(c)}, '(07|01)[0-9]{{8}}') THEN {trim(c)} END"


def mask(c: str) -> str:
    return f"left({c}, 4) || '****' || right({c}, 2)"


def month(c: str) -> str:
    return f"date_trunc('month', {c})::DATE"


def week(c: str) -> str:
    return f"date_trunc('week', {c})::DATE"


def money(c: str) -> str:
    return f"round({c}, 2)::DECIMAL(38,2)"


def zero_money(c: str) -> str:
    return f"coalesce({money(c)}, 0)::DECIMAL(38,2)"


def zero_count(c: str) -> str:
    return f"coalesce({c}, 0)::BIGINT"


def half_away(n: str, d: str) -> str:
    """Integer quotient rounded half away from zero, for whole numbers and d > 0."""
    return (
        f"(CASE WHEN ({n}) < 0 THEN -((2 * -({n}) + ({d})) // (2 * ({d}))) "
        f"ELSE (2 * ({n}) + ({d})) // (2 * ({d})) END)"
    )


def scaled(c: str, digits: int) -> str:
    return f"(({c})::DECIMAL(38,{digits}) * {10 ** digits})::HUGEINT"


def fixed(n: str, digits: int, width: int = 38) -> str:
    """A whole number of 10^-digits as DECIMAL."""
    unit = "0." + "0" * (digits - 1) + "1"
    return f"(({n})::DECIMAL({width - digits},0) * {unit})::DECIMAL({width},{digits})"


def money_avg(total: str, n: str, digits: int = 2) -> str:
    return fixed(half_away(scaled(total, digits), f"({n}) * {10 ** (digits - 2)}::HUGEINT"), 2)


def pct(part: str, whole: str, digits: int = 2, otherwise: str = "NULL") -> str:
    """part / whole to nine digits, times 100, to one digit; for amounts with ``digits`` decimals."""
    quotient = half_away(f"{scaled(part, digits)} * 1000000000", scaled(whole, digits))
    return (
        f"CASE WHEN {whole} > 0 THEN {fixed(half_away(f'{quotient} * 1000', '1000000000'), 1, 28)} "
        f"ELSE {otherwise} END::DECIMAL(28,1)"
    )


def count_pct(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN round(({part})::BIGINT / ({whole})::BIGINT * 100, 2) END"


def _case_list(n: str, values: tuple[str, ...]) -> str:
    return f"[{', '.join(repr(v) for v in values)}][{n} + 1]"


# --- raw tabs from the given tables -------------------------------------------------------------------------------

_STAMP = "strftime({}, '%-m/%-d/%Y %-H:%M:%S')"
_RETAIL = "p_retailprice::DECIMAL(18,2)"
_PRODUCT = (
    "list_aggregate(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), "
    "'string_agg', ' ') || ' - ' || p_brand || ' ' || p_partkey::VARCHAR"
)
_PERSON = "CASE WHEN l_suppkey % 50 <> 0 THEN ' ' || s_name || ' ' END"
_PRICE = f"({_RETAIL} * (CASE WHEN l_orderkey % 41 = 0 THEN 1 ELSE 3 END))"
_PRETTY = f"format('{{:,.2f}}', {_PRICE}::DOUBLE)"
_UNIT = "CASE WHEN n_nationkey >= 20 THEN '' ELSE n_name END"
_PAID = "CASE WHEN l_linestatus = 'O' THEN 'M-Pesa' ELSE 'Bank' END"
_LINES = (
    "lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey "
    "JOIN nation ON s_nationkey = n_nationkey"
)

CTE: dict[str, str] = {}

CTE["sales_raw"] = f"""
SELECT {_STAMP.format('l_shipdate')} AS "Timestamp",
  CASE l_orderkey % 5
    WHEN 0 THEN strftime(l_shipdate, '%m/%d/%Y') WHEN 1 THEN strftime(l_shipdate, '%d/%m/%Y')
    WHEN 2 THEN strftime(l_shipdate, '%Y-%m-%d') WHEN 3 THEN {_STAMP.format('l_shipdate')}
    ELSE CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE ' ' || strftime(l_shipdate, '%-m/%-d/%Y') || ' ' END
  END AS "Date",
  {_PERSON} AS Salesperson_Name,
  CASE WHEN l_partkey % 251 = 3 THEN 'Ghost ' || l_partkey::VARCHAR ELSE {_PRODUCT} END AS Product,
  l_quantity::INT::VARCHAR AS Units_Sold,
  CASE l_linenumber % 3 WHEN 0 THEN 'KES ' || {_PRETTY} WHEN 1 THEN {_PRETTY} ELSE {_PRICE}::VARCHAR END
    AS Unit_Price_KES,
  (l_discount::DECIMAL(18,2) * 100)::VARCHAR AS Discount_Amount_KES,
  {_PAID} AS Payment_Method,
  CASE WHEN o_custkey % 7 = 0 THEN NULL WHEN o_custkey % 5 = 0 THEN '254' || lpad(o_custkey::VARCHAR, 9, '0')
    ELSE '07' || lpad(o_custkey::VARCHAR, 8, '0') END AS Customer_Phone_Number,
  CASE WHEN l_linenumber % 2 = 0 THEN 'Retail' END AS Customer_Type,
  {_UNIT} AS Business_Unit, NULL::VARCHAR AS Notes
FROM {_LINES} JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R'"""

CTE["returns_raw"] = f"""
SELECT {_STAMP.format('l_shipdate')} AS "Timestamp",
  CASE WHEN l_linenumber % 3 = 0 THEN strftime(l_shipdate, '%d/%m/%Y') ELSE strftime(l_shipdate, '%Y-%m-%d') END
    AS Date_of_Return,
  {_PERSON} AS Salesperson_Name, {_PRODUCT} AS Product_Returned,
  (1 + l_orderkey % 3)::VARCHAR AS Units_Returned,
  CASE WHEN l_linenumber <> 7 THEN ({_RETAIL} * 3)::VARCHAR END AS Original_Unit_Price_KES,
  {_case_list('l_linenumber % 4', RETURN_REASONS)} AS Reason_for_Return,
  {_case_list('l_suppkey % 4', REFUND_METHODS)} AS Requested_Refund_Method,
  '01' || lpad(o_custkey::VARCHAR, 8, '0') AS Customer_Phone_Number, NULL::VARCHAR AS Notes,
  {_UNIT} AS Business_Unit
FROM {_LINES} JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'"""

CTE["expenses_raw"] = f"""
SELECT {_STAMP.format('o_orderdate')} AS "Timestamp",
  CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%-m/%-d/%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
    ELSE ' ' || {_STAMP.format('o_orderdate')} END AS Date_of_Expense,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Water' WHEN '2-HIGH' THEN 'Stationery'
    WHEN '3-MEDIUM' THEN 'Supplier Transport' WHEN '4-NOT SPECIFIED' THEN 'Customer Delivery' ELSE 'Other' END
    AS Expense_Category,
  CASE WHEN o_orderkey % 97 = 0 THEN '-5' ELSE 'KES ' || o_totalprice::DECIMAL(18,2)::VARCHAR END AS Amount_KES,
  'order ' || o_orderkey::VARCHAR AS Description,
  CASE WHEN o_orderstatus = 'F' THEN 'Bank' ELSE 'M-Pesa' END AS Paid_Via, c_name AS Recorded_By,
  CASE WHEN n_nationkey < 20 THEN n_name END AS Business_Unit
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

CTE["inventory_purchases_raw"] = f"""
SELECT {_STAMP.format('l_shipdate')} AS "Timestamp", strftime(l_shipdate, '%Y-%m-%d') AS Date_of_Purchase,
  {_PRODUCT} AS Product_Purchased, (l_quantity * 3)::INT::VARCHAR AS Units_Purchased,
  ({_RETAIL} * 2 + l_linenumber * 10)::VARCHAR AS Unit_Cost_KES, s_name AS Supplier_Name,
  {_PAID} AS Payment_Method, NULL::VARCHAR AS Notes_Comments,
  CASE WHEN n_nationkey < 20 THEN n_name END AS Business_Unit
FROM {_LINES}"""

CTE["products_raw"] = f"""
SELECT CASE WHEN v = 1 THEN '2/1/1995 8:00:00' ELSE '1/1/1995 8:00:00' END AS "Timestamp",
  {_PRODUCT} AS Product_Name,
  {_case_list('p_size % 7', CATEGORY_NAMES)} AS Category, {_case_list('p_size % 5', UNITS_OF_MEASURE)} AS Unit_of_Measure,
  ({_RETAIL} * 3 + v)::VARCHAR AS Current_Selling_Price,
  CASE WHEN p_partkey % 4 <> 0 THEN (p_size * 10)::VARCHAR END AS Reorder_Level,
  CASE WHEN p_partkey % 20 = 0 THEN 'No' WHEN p_partkey % 3 = 0 THEN 'TRUE' ELSE 'Yes' END AS Is_Active,
  CASE WHEN p_partkey % 11 <> 0 THEN ({_RETAIL} * 2)::VARCHAR END AS Cost_Price_KES
FROM part CROSS JOIN (VALUES (0), (1)) AS versions(v) WHERE v = 0 OR p_partkey % 10 = 0"""

CTE["business_units"] = "SELECT n_name AS unit_name, n_nationkey + 1 AS sort_order FROM nation WHERE n_nationkey < 12"

# --- staging ------------------------------------------------------------------------------------------------------

_SUBMITTED = f'{stamp(chr(34) + "Timestamp" + chr(34))} AS submitted_at'
_UNIT_CLEAN = f"{blank_null('Business_Unit')} AS unit"


def _line(units: str, price: str) -> str:
    return f"({units}::DECIMAL(10,0) * {price})"


CTE["parsed_products"] = f"""
SELECT {slug('Product_Name')} AS product_key, {trim('Product_Name')} AS product_name,
  {trim("split_part(" + trim('Product_Name') + ", ' - ', 1)")} AS product_family,
  CASE WHEN contains({trim('Product_Name')}, ' - ') THEN
    {trim("split_part(" + trim('Product_Name') + ", ' - ', 2)")} END AS product_variant,
  {trim('Category')} AS category, {trim('Unit_of_Measure')} AS unit_of_measure,
  {number('Current_Selling_Price')} AS selling_price, {number('Cost_Price_KES')} AS cost_price,
  coalesce({integer('Reorder_Level')}, 5)::BIGINT AS reorder_level,
  coalesce(lower({trim('Is_Active')}) IN ('yes', 'true', '1'), false) AS is_active, {_SUBMITTED}
FROM products_raw WHERE {trim('Product_Name')} <> ''"""

CTE["stg_products"] = f"""
SELECT product_key, product_name, product_family, product_variant, category, unit_of_measure, selling_price,
  cost_price, {money('selling_price - coalesce(cost_price, 0)')} AS unit_margin_kes,
  CASE WHEN cost_price IS NOT NULL THEN {pct('(selling_price - cost_price)', 'selling_price', 9)} END
    AS unit_margin_pct,
  reorder_level, is_active, submitted_at
FROM parsed_products WHERE selling_price > 0
QUALIFY row_number() OVER (PARTITION BY product_key ORDER BY submitted_at DESC NULLS LAST,
  product_name DESC NULLS LAST, selling_price DESC NULLS LAST, cost_price DESC NULLS LAST,
  reorder_level DESC NULLS LAST, is_active DESC NULLS LAST, category DESC NULLS LAST,
  unit_of_measure DESC NULLS LAST) = 1"""

_SALE_ID = md5_key(trim('"Date"'), trim("Salesperson_Name"), trim("Product"), '"Timestamp"')

CTE["stg_sales"] = f"""
SELECT *, round({_line('units_sold', 'unit_price')}, 2)::DECIMAL(38,2) AS gross_amount,
  round({_line('units_sold', 'unit_price')} - discount_amount, 2)::DECIMAL(38,2) AS net_amount
FROM (
  SELECT {_SALE_ID} AS sale_id, {date('"Date"')} AS sale_date, upper({trim('Salesperson_Name')}) AS salesperson_name,
    {slug('Product')} AS product_key, {integer('Units_Sold')} AS units_sold,
    coalesce({number('Unit_Price_KES')}, 0)::DECIMAL(38,9) AS unit_price,
    coalesce({number('Discount_Amount_KES')}, 0)::DECIMAL(38,9) AS discount_amount,
    {trim('Payment_Method')} AS payment_method, {phone('Customer_Phone_Number')} AS customer_phone,
    coalesce({trim('Customer_Type')}, '') AS customer_type, {_UNIT_CLEAN}, {blank_null('Notes')} AS notes, {_SUBMITTED}
  FROM sales_raw WHERE {trim('"Date"')} <> '' AND {trim('Product')} <> '')
WHERE units_sold > 0 AND sale_date IS NOT NULL"""

_EXPENSE_ID = md5_key(trim("Date_of_Expense"), trim("Expense_Category"), trim("Amount_KES"), '"Timestamp"')

CTE["stg_expenses"] = f"""
FROM (
  SELECT {_EXPENSE_ID} AS expense_id, {date('Date_of_Expense')} AS expense_date,
    {trim('Expense_Category')} AS expense_category, {number('Amount_KES')} AS amount,
    {blank_null('Description')} AS description, {trim('Paid_Via')} AS paid_via,
    upper({trim('Recorded_By')}) AS recorded_by, {_UNIT_CLEAN}, {_SUBMITTED}
  FROM expenses_raw WHERE {trim('Date_of_Expense')} <> '' AND Expense_Category IS NOT NULL)
WHERE amount > 0 AND expense_date IS NOT NULL"""

_PURCHASE_ID = md5_key(trim("Date_of_Purchase"), trim("Product_Purchased"), trim("Units_Purchased"), '"Timestamp"')

CTE["stg_inventory_purchases"] = f"""
SELECT *, round({_line('units_purchased', 'unit_cost')}, 2)::DECIMAL(38,2) AS total_cost
FROM (
  SELECT {_PURCHASE_ID} AS purchase_id, {date('Date_of_Purchase')} AS purchase_date,
    {slug('Product_Purchased')} AS product_key, {integer('Units_Purchased')} AS units_purchased,
    {number('Unit_Cost_KES')} AS unit_cost, {blank_null('Supplier_Name')} AS supplier_name,
    {trim('Payment_Method')} AS payment_method, {_UNIT_CLEAN}, {blank_null('Notes_Comments')} AS notes, {_SUBMITTED}
  FROM inventory_purchases_raw WHERE {trim('Date_of_Purchase')} <> '' AND Product_Purchased IS NOT NULL)
WHERE units_purchased > 0 AND unit_cost > 0 AND purchase_date IS NOT NULL"""

_RETURN_ID = md5_key(
    trim("Date_of_Return"), trim("Salesperson_Name"), trim("Product_Returned"), trim("Units_Returned"), '"Timestamp"'
)

CTE["stg_returns"] = f"""
SELECT *, round({_line('units_returned', 'original_unit_price')}, 2)::DECIMAL(38,2) AS return_value
FROM (
  SELECT {_RETURN_ID} AS return_id, {date('Date_of_Return')} AS return_date,
    upper({trim('Salesperson_Name')}) AS salesperson_name, {slug('Product_Returned')} AS product_key,
    {integer('Units_Returned')} AS units_returned,
    coalesce({number('Original_Unit_Price_KES')}, 0)::DECIMAL(38,9) AS original_unit_price,
    {trim('Reason_for_Return')} AS return_reason, {trim('Requested_Refund_Method')} AS refund_method,
    {phone('Customer_Phone_Number')} AS customer_phone, {_UNIT_CLEAN}, {blank_null('Notes')} AS notes, {_SUBMITTED}
  FROM returns_raw WHERE {trim('Date_of_Return')} <> '' AND {trim('Product_Returned')} <> '')
WHERE units_returned > 0 AND return_date IS NOT NULL"""

# --- marts --------------------------------------------------------------------------------------------------------
# All movements as one stream of tagged rows; marts pick theirs with FILTER.

CTE["moves"] = f"""
SELECT 'sale' AS kind, sale_date AS d, {month('sale_date')} AS mon, unit, salesperson_name AS who, product_key,
  customer_phone AS phone, payment_method AS pay, units_sold AS q, unit_price AS price, gross_amount AS gross,
  discount_amount AS disc, net_amount AS amt FROM stg_sales
UNION ALL BY NAME
SELECT 'return' AS kind, return_date AS d, {month('return_date')} AS mon, unit, salesperson_name AS who, product_key,
  units_returned AS q, return_value AS amt FROM stg_returns
UNION ALL BY NAME
SELECT 'expense' AS kind, expense_date AS d, {month('expense_date')} AS mon, unit, amount AS amt FROM stg_expenses"""

_S, _R, _E = (f"FILTER (kind = '{k}')" for k in ("sale", "return", "expense"))

CTE["daily_sales_summary"] = f"""
SELECT *, {money('net_revenue - returns_value')} AS effective_revenue
FROM (
  SELECT d AS sale_date, unit, count(*) {_S} AS transaction_count, {zero_count(f'sum(q) {_S}')} AS units_sold,
    {zero_money(f'sum(gross) {_S}')} AS gross_revenue, {zero_money(f'sum(disc) {_S}')} AS total_discounts,
    {zero_money(f'sum(amt) {_S}')} AS net_revenue, {zero_count(f'sum(q) {_R}')} AS units_returned,
    {zero_money(f'sum(amt) {_R}')} AS returns_value, count(*) {_R} AS return_transaction_count,
    {zero_money("sum(amt) FILTER (kind = 'sale' AND pay = 'M-Pesa')")} AS mpesa_revenue,
    {zero_money("sum(amt) FILTER (kind = 'sale' AND pay = 'Bank')")} AS bank_revenue,
    count(DISTINCT phone) {_S} AS unique_customers_with_phone, count(DISTINCT who) {_S} AS active_salespeople,
    (dayofweek(d) + 1)::BIGINT AS day_of_week, day(d)::BIGINT AS day_of_month, {week('d')} AS week_start,
    {month('d')} AS month_start
  FROM moves WHERE kind <> 'expense' GROUP BY d, unit)"""

_COST = "q::DECIMAL(10,0) * coalesce(cost_price, 0)"

CTE["monthly_profit"] = f"""
SELECT *, {pct('net_profit', 'net_revenue', 2, '0')} AS net_margin_pct
FROM (
  SELECT *, {money('gross_revenue - total_returns')} AS net_revenue,
    {money('gross_revenue - total_returns - total_cogs')} AS gross_profit,
    {money('gross_revenue - total_returns - total_cogs - total_operating_expenses')} AS net_profit
  FROM (
    SELECT mon AS "month", unit, {zero_money(f'sum(amt) {_S}')} AS gross_revenue,
      {zero_money(f'sum(disc) {_S}')} AS total_discounts, {zero_money(f'sum(amt) {_R}')} AS total_returns,
      {zero_count(f'sum(q) {_R}')} AS units_returned, count(*) {_R} AS return_count,
      {zero_money(f'sum({_COST}) {_S}')} AS total_cogs,
      {zero_money(f'sum(amt) {_E}')} AS total_operating_expenses, count(*) {_S} AS sale_count,
      {zero_count(f'sum(q) {_S}')} AS units_sold, count(*) {_E} AS expense_entries
    FROM moves LEFT JOIN stg_products USING (product_key) GROUP BY ALL))"""

_LATEST_COST = "first(unit_cost ORDER BY purchase_date DESC, submitted_at DESC NULLS LAST, unit_cost DESC)"

CTE["purchased"] = f"""
SELECT product_key, sum(units_purchased)::BIGINT AS bought, sum(total_cost) AS spent, max(purchase_date) AS last_day,
  {_LATEST_COST} AS latest_cost FROM stg_inventory_purchases GROUP BY product_key"""

CTE["moved"] = f"""
SELECT product_key, sum(q) {_S} AS sold, sum(amt) {_S} AS revenue, sum(q) {_R} AS back, sum(amt) {_R} AS refunded
FROM moves WHERE kind <> 'expense' GROUP BY product_key"""

CTE["inventory_position"] = f"""
SELECT *, {money('stock_on_hand::DECIMAL(12,0) * latest_unit_cost')} AS inventory_value_at_cost,
  {money('stock_on_hand::DECIMAL(11,0) * selling_price')} AS inventory_value_at_retail,
  CASE WHEN stock_on_hand <= 0 THEN 'Out of Stock' WHEN stock_on_hand > reorder_level THEN 'In Stock'
    ELSE 'Low Stock' END AS stock_status,
  stock_on_hand <= reorder_level AS needs_reorder
FROM (
  SELECT product_key, product_name, category, unit_of_measure, selling_price, reorder_level,
    {zero_count('bought')} AS total_purchased, {zero_money('spent')} AS total_purchase_cost,
    last_day AS last_purchase_date, coalesce(latest_cost, 0)::DECIMAL(38,9) AS latest_unit_cost,
    {zero_count('sold')} AS total_sold, {zero_count('back')} AS total_returned, {zero_money('revenue')} AS total_revenue,
    {zero_money('refunded')} AS total_return_value,
    (coalesce(bought, 0) - coalesce(sold, 0) + coalesce(back, 0))::BIGINT AS stock_on_hand
  FROM stg_products LEFT JOIN purchased USING (product_key) LEFT JOIN moved USING (product_key) WHERE is_active)"""

CTE["product_months"] = f"""
SELECT product_key, mon, count(*) {_S} AS n, sum(q) {_S} AS units, sum(q) {_R} AS back, sum(amt) {_S} AS revenue,
  sum(amt) {_R} AS refunded, sum(disc) {_S} AS disc, {money_avg(f'sum(price) {_S}', f'count(*) {_S}', 9)} AS avg_price,
  min(d) {_S} AS first_day, max(d) {_S} AS last_day, sum({_COST}) {_S} AS cogs,
  {money(f"sum(q::DECIMAL(10,0) * greatest(price - coalesce(cost_price, 0), 0)::DECIMAL(38,9)) {_S}")} AS profit
FROM moves LEFT JOIN stg_products USING (product_key) WHERE kind <> 'expense' GROUP BY product_key, mon"""

CTE["product_performance"] = f"""
SELECT *, {pct('total_gross_profit', 'total_revenue')} AS gross_margin_pct
FROM (
  SELECT mon AS "month", product_key, product_name, product_family, product_variant, category, unit_of_measure,
    selling_price AS current_selling_price, cost_price AS current_cost_price,
    unit_margin_kes AS current_unit_margin_kes, unit_margin_pct AS current_unit_margin_pct, reorder_level,
    {zero_count('n')} AS total_transactions, {zero_count('units')} AS total_units_sold,
    {zero_count('back')} AS total_units_returned, {zero_money('revenue')} AS total_revenue,
    {zero_money('refunded')} AS total_return_value, {zero_money('disc')} AS total_discounts,
    {zero_money('avg_price')} AS avg_selling_price, first_day AS first_sale_date, last_day AS last_sale_date,
    {zero_money('cogs')} AS total_cogs,
    {money('coalesce(profit, 0) - coalesce(' + money('refunded') + ', 0)')} AS total_gross_profit
  FROM (SELECT * FROM stg_products WHERE is_active)
  CROSS JOIN (SELECT DISTINCT mon FROM moves WHERE kind <> 'expense' UNION SELECT {month(AS_OF_SQL)})
  LEFT JOIN product_months USING (product_key, mon))"""

CTE["unit_months"] = f"""
SELECT unit, mon, count(*) {_S} AS n, sum(q) {_S} AS units, sum(amt) {_S} AS revenue, sum(disc) {_S} AS disc,
  {money_avg(f'sum(amt) {_S}', f'count(*) {_S}')} AS avg_value, count(DISTINCT who) {_S} AS people,
  count(DISTINCT d) {_S} AS days, min(d) {_S} AS first_day, max(d) {_S} AS last_day, count(*) {_R} AS n_back,
  sum(q) {_R} AS back, sum(amt) {_R} AS refunded, count(*) {_E} AS n_spent, sum(amt) {_E} AS spent,
  sum({_COST}) {_S} AS cogs
FROM moves LEFT JOIN stg_products USING (product_key) WHERE unit IS NOT NULL GROUP BY unit, mon"""

CTE["unit_performance"] = f"""
SELECT *, {pct('estimated_net_profit', 'total_revenue')} AS net_margin_pct,
  {count_pct('total_units_returned', 'total_units_sold')} AS return_rate_pct
FROM (
  SELECT *, {money('total_revenue - total_return_value - total_cogs')} AS gross_profit,
    {money('total_revenue - total_return_value - total_cogs - total_expenses')} AS estimated_net_profit
  FROM (
    SELECT mon AS "month", unit, {zero_count('n')} AS total_transactions, {zero_count('units')} AS total_units_sold,
      {zero_money('revenue')} AS total_revenue, {zero_money('disc')} AS total_discounts,
      {zero_money('avg_value')} AS avg_transaction_value, {zero_count('people')} AS salespeople_count,
      {zero_count('days')} AS active_days, first_day AS first_sale_date, last_day AS last_sale_date,
      {zero_count('n_back')} AS total_returns_processed, {zero_count('back')} AS total_units_returned,
      {zero_money('refunded')} AS total_return_value, {zero_count('n_spent')} AS total_expense_entries,
      {zero_money('spent')} AS total_expenses, {zero_money('cogs')} AS total_cogs
    FROM (SELECT unit_name AS unit FROM business_units)
    CROSS JOIN (SELECT DISTINCT mon FROM moves WHERE unit IS NOT NULL UNION SELECT {month(AS_OF_SQL)})
    LEFT JOIN unit_months USING (unit, mon)))"""

_NAMED = "FILTER (kind = '{}' AND who IS NOT NULL{})"
_NS, _NR = _NAMED.format("sale", ""), _NAMED.format("return", "")

CTE["salesperson_performance"] = f"""
SELECT who AS salesperson_name, mon AS "month", count(*) {_NS} AS total_transactions,
  count(DISTINCT d) {_NS} AS active_days, {zero_count(f'sum(q) {_NS}')} AS total_units_sold,
  count(*) {_NR} AS total_returns_processed, {zero_count(f'sum(q) {_NR}')} AS total_units_returned,
  {zero_money(f'sum(amt) {_NS}')} AS total_revenue, {zero_money(f'sum(amt) {_NR}')} AS total_return_value,
  {zero_money(f'sum(disc) {_NS}')} AS total_discounts_given,
  coalesce(CASE WHEN count(*) {_NS} > 0 THEN {money_avg(f'sum(amt) {_NS}', f'count(*) {_NS}')} END, 0)::DECIMAL(38,2)
    AS avg_transaction_value,
  {zero_money("sum(amt) " + _NAMED.format("sale", " AND pay = 'M-Pesa'"))} AS mpesa_revenue,
  {zero_money("sum(amt) " + _NAMED.format("sale", " AND pay = 'Bank'"))} AS bank_revenue,
  min(d) {_NS} AS first_sale_date, max(d) {_NS} AS last_sale_date
FROM moves WHERE kind <> 'expense' GROUP BY who, mon"""

CTE["expense_summary"] = f"""
SELECT expense_date, expense_category, unit, count(*) AS transaction_count, {money('sum(amount)')} AS total_amount,
  {zero_money("sum(amount) FILTER (paid_via = 'M-Pesa')")} AS mpesa_amount,
  {zero_money("sum(amount) FILTER (paid_via = 'Bank')")} AS bank_amount, {month('expense_date')} AS month_start,
  {week('expense_date')} AS week_start
FROM stg_expenses GROUP BY expense_date, expense_category, unit"""

CTE["returns_analysis"] = f"""
SELECT return_id, return_date, {month('return_date')} AS month_start, {week('return_date')} AS week_start,
  salesperson_name, unit, product_key, product_name, category, units_returned, original_unit_price, return_value,
  return_reason, refund_method, customer_phone, notes, {count_pct('units_returned', 'sold')} AS product_return_rate_pct
FROM stg_returns LEFT JOIN (SELECT product_key, product_name, category FROM stg_products) USING (product_key)
LEFT JOIN moved USING (product_key)"""

CTE["customer_insights"] = f"""
SELECT mon AS "month", {mask('phone')} AS customer_phone_masked, count(*) AS total_transactions,
  count(DISTINCT d) AS purchase_days, {money('sum(amt)')} AS total_spent,
  {money_avg('sum(amt)', 'count(*)')} AS avg_transaction_value, {money('max(amt)')} AS largest_transaction,
  sum(q)::BIGINT AS total_units_purchased, min(d) AS first_purchase_date, max(d) AS last_purchase_date,
  ({AS_OF_SQL} - max(d))::BIGINT AS days_since_last_purchase,
  CASE WHEN sum(amt) >= 10000 THEN 'VIP' WHEN sum(amt) >= 3000 THEN 'Regular' ELSE 'Occasional' END AS customer_tier,
  count(DISTINCT d) > 1 AS is_repeat_customer
FROM moves WHERE phone IS NOT NULL GROUP BY mon, phone"""


def needed(sql: str) -> list[str]:
    """Names of the subqueries a statement uses, directly or not, in the order they are defined."""
    found: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in words & CTE.keys() - found:
            found.add(name)
            todo.append(CTE[name])
    return [name for name in CTE if name in found]


def with_layers(sql: str) -> str:
    """A complete statement: the needed layers as subqueries in front of ``sql``."""
    ctes = ",\n".join(f"{name} AS ({CTE[name]})" for name in needed(sql))
    return f"WITH {ctes}\n{sql}" if ctes else sql
