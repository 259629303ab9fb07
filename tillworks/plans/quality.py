"""Data checks. Each returns the violating rows or groups; an empty result passes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.functions import as_of_date
from tillworks.operators.aggregates import with_latest
from tillworks.operators.filters import below, later_than, not_above_zero
from tillworks.operators.joins import left_lookup, orphans, with_own_shuffle
from tillworks.operators.sets import stack
from tillworks.values import (
    BUSINESS_UNITS,
    CATEGORY_NAMES,
    EXPENSE_CATEGORIES,
    PAYMENT_METHODS,
    REFUND_METHODS,
    RETURN_REASONS,
    UNITS_OF_MEASURE,
)


# --- single checks ------------------------------------------------------------------------------------------------


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once."""
    return unique_combination(df.filter(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Combinations that occur more than once; NULLs count as equal."""
    return df.groupBy(*columns).agg(F.count("*").alias("n_records")).filter("n_records > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Values outside the list with their row counts; NULL passes."""
    strange = df.filter(~F.col(column).isin(*values))
    return strange.groupBy(column).agg(F.count("*").alias("n_records"))


def null_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``(column_name, n_records)`` of the NULLs in several columns, from one pass."""
    columns = list(columns)
    counted = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_records")) for c in columns]
    return counted.select(F.inline(F.array(*rows)))


def odd_values(df: DataFrame, accepted: Iterable[tuple[str, Iterable[str]]]) -> DataFrame:
    """``(column_name, value, n_records)`` of the values outside several columns' lists, from one pass.

    Accepted values are dropped before the rows multiply, so clean data shuffles nothing.
    """
    found = [
        F.struct(F.lit(c).alias("column_name"), F.when(~F.col(c).isin(*values), F.col(c)).alias("value"))
        for c, values in accepted
    ]
    odd = df.select(F.inline(F.filter(F.array(*found), lambda cell: cell["value"].isNotNull())))
    return odd.groupBy("column_name", "value").agg(F.count("*").alias("n_records"))


def relationships(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child keys without a parent and their row counts: keys are counted first, so a hot key joins as one row."""
    keys = child.groupBy(key).agg(F.count("*").alias("n_records"))
    return orphans(keys, parent, key)


def no_future_sale_dates(sales: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return later_than(sales, "sale_date", as_of_date(as_of)).select(
        "sale_id", "sale_date", "salesperson_name", "product_key"
    )


def no_future_return_dates(returns: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return later_than(returns, "return_date", as_of_date(as_of)).select(
        "return_id", "return_date", "salesperson_name", "product_key"
    )


def no_negative_expenses(expenses: DataFrame) -> DataFrame:
    return not_above_zero(expenses, "amount").select("expense_id", "expense_date", "expense_category", "amount")


def no_negative_return_value(returns: DataFrame) -> DataFrame:
    return not_above_zero(returns, "return_value").select(
        "return_id", "return_date", "product_key", "units_returned", "original_unit_price", "return_value"
    )


def _latest_costs(purchases: DataFrame) -> DataFrame:
    latest = with_latest(purchases, ["product_key"], "unit_cost", "purchase_date", "submitted_at", "latest_cost_price")
    return latest.select("product_key", "latest_cost_price")


def sale_price_above_cost(sales: DataFrame, purchases: DataFrame) -> DataFrame:
    """Sales below the product's latest purchase cost: suspicious, not necessarily wrong."""
    priced = sales.select("sale_id", "sale_date", "product_key", F.col("unit_price").alias("sale_price"))
    costed = priced.join(with_own_shuffle(_latest_costs(purchases), "product_key"), "product_key")
    return below(costed, "sale_price", "latest_cost_price").select(
        "sale_id", "sale_date", "product_key", "sale_price", "latest_cost_price"
    )


def stock_never_negative(inventory: DataFrame) -> DataFrame:
    return inventory.filter("stock_on_hand < 0").select("product_key", "product_name", "stock_on_hand")


# --- declared checks ----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class TableChecks:
    """What must hold in one table."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    unique_combination: tuple[tuple[str, ...], ...] = ()
    accepted: tuple[tuple[str, tuple[str, ...]], ...] = ()
    has_product: bool = False  # product_key must exist in stg_products


# --- fixed values: the declared checks of each table --------------------------------------------------------------
DECLARED: dict[str, TableChecks] = {
    "stg_products": TableChecks(
        not_null=("product_key", "product_name", "category", "selling_price", "cost_price", "is_active"),
        unique=("product_key",),
        accepted=(("category", CATEGORY_NAMES), ("unit_of_measure", UNITS_OF_MEASURE)),
    ),
    "stg_sales": TableChecks(
        not_null=(
            "sale_id", "sale_date", "salesperson_name", "product_key", "units_sold", "unit_price", "payment_method",
        ),
        unique=("sale_id",),
        accepted=(("payment_method", PAYMENT_METHODS), ("unit", BUSINESS_UNITS)),
        has_product=True,
    ),
    "stg_expenses": TableChecks(
        not_null=("expense_id", "expense_date", "expense_category", "amount", "paid_via"),
        unique=("expense_id",),
        accepted=(
            ("expense_category", EXPENSE_CATEGORIES), ("paid_via", PAYMENT_METHODS), ("unit", BUSINESS_UNITS),
        ),
    ),
    "stg_returns": TableChecks(
        not_null=(
            "return_id", "return_date", "salesperson_name", "product_key", "units_returned", "original_unit_price",
            "return_reason", "refund_method",
        ),
        unique=("return_id",),
        accepted=(("return_reason", RETURN_REASONS), ("refund_method", REFUND_METHODS), ("unit", BUSINESS_UNITS)),
        has_product=True,
    ),
    "stg_inventory_purchases": TableChecks(
        not_null=("purchase_id", "purchase_date", "product_key", "units_purchased", "unit_cost"),
        unique=("purchase_id",),
        accepted=(("unit", BUSINESS_UNITS),),
        has_product=True,
    ),
    "inventory_position": TableChecks(not_null=("product_key",), unique=("product_key",)),
    "daily_sales_summary": TableChecks(not_null=("sale_date",), unique_combination=(("sale_date", "unit"),)),
    "product_performance": TableChecks(
        not_null=("month", "product_key"), unique_combination=(("month", "product_key"),),
    ),
    "salesperson_performance": TableChecks(
        not_null=("month", "salesperson_name"), unique_combination=(("month", "salesperson_name"),),
    ),
    "monthly_profit": TableChecks(unique_combination=(("month", "unit"),)),
    "unit_performance": TableChecks(not_null=("month", "unit"), unique_combination=(("month", "unit"),)),
    "returns_analysis": TableChecks(
        not_null=("return_id", "return_date"),
        unique=("return_id",),
        accepted=(("return_reason", RETURN_REASONS), ("refund_method", REFUND_METHODS)),
    ),
    "customer_insights": TableChecks(
        not_null=("month", "customer_phone_masked"), unique_combination=(("month", "customer_phone_masked"),),
    ),
}


def columns_read(table: str) -> list[str]:
    """The columns that the checks of a table on nulls, keys, values and rows look at."""
    checks = DECLARED[table]
    rules = [column for _, column, _ in _row_rules(F.current_date()).get(table, [])]
    read = [*checks.not_null, *checks.unique, *sum(checks.unique_combination, ()), *(c for c, _ in checks.accepted), *rules]
    return list(dict.fromkeys(read))


# Business rules on single rows: table -> (check, column, violated when). ``as_of`` stands for the reporting day.
def _row_rules(as_of: Column) -> dict[str, list[tuple[str, str, Column]]]:
    return {
        "stg_returns": [
            ("no_future_return_dates", "return_date", F.col("return_date") > as_of),
            ("no_negative_return_value", "return_value", F.col("return_value") <= 0),
        ],
        "stg_sales": [("no_future_sale_dates", "sale_date", F.col("sale_date") > as_of)],
        "stg_expenses": [("no_negative_expenses", "amount", F.col("amount") <= 0)],
        "inventory_position": [("stock_never_negative", "stock_on_hand", F.col("stock_on_hand") < 0)],
    }


def _key_text(columns: Iterable[str]) -> Column:
    """A text that is equal for two rows only if they are equal in all columns; NULLs count as equal."""
    parts = [F.when(F.col(c).isNull(), "-").otherwise(F.concat(F.length(F.col(c).cast("string")), F.lit(":"), F.col(c))) for c in columns]
    return F.concat(*parts)


def _key_checks(df: DataFrame, table: str, checks: TableChecks) -> DataFrame:
    """All checks of a table that are about the columns of one combination: rows are counted by those columns alone, which
    takes no shuffle where they lie together already."""
    columns, = checks.unique_combination
    n = F.col("n_records")
    found = [("not_null", c, F.sum(F.when(F.col(c).isNull(), n))) for c in checks.not_null]
    found.append(("unique_combination", "+".join(columns), F.count_if(n > 1)))
    counted = df.groupBy(*columns).agg(F.count("*").alias("n_records"))
    one = counted.agg(*(F.coalesce(how, F.lit(0)).alias(f"failures_{i}") for i, (_, _, how) in enumerate(found)))
    results = [F.struct(*_result(table, check, c, F.col(f"failures_{i}"))) for i, (check, c, _) in enumerate(found)]
    return one.select(F.inline(F.array(*results)))


def _about_one_key(checks: TableChecks) -> bool:
    about = (checks.unique_combination[0],) if len(checks.unique_combination) == 1 else ()
    return bool(about) and checks == TableChecks(not_null=checks.not_null, unique_combination=about) and set(checks.not_null) <= {*about[0]}


def _table_checks(
    df: DataFrame, table: str, checks: TableChecks, rules: list[tuple[str, str, Column]],
    products: DataFrame | None = None, costs: DataFrame | None = None,
) -> DataFrame:
    """All checks of a table from one pass over it.

    Each row is counted under what it says (the violated checks as bits, its strange values, product and price) and under
    each of its keys, in one aggregation. Keys are exact, as texts; once they are counted, a second aggregation leaves one
    row for all of them, so only the few combinations that the rows say are joined with products and latest costs.
    """
    violated = [("not_null", c, F.col(c).isNull()) for c in checks.not_null] + rules
    keys = [("unique", c, F.when(F.col(c).isNotNull(), F.col(c).cast("string"))) for c in checks.unique]
    keys += [("unique_combination", "+".join(cs), _key_text(cs)) for cs in checks.unique_combination]
    bits = sum((F.when(bad, 1 << i).otherwise(0) for i, (_, _, bad) in enumerate(violated)), F.lit(0)).cast("int")
    said = {f"odd_{c}": F.when(~F.col(c).isin(*values), F.col(c)) for c, values in checks.accepted}
    said |= {"product_key": F.col("product_key")} if products is not None else {}
    said |= {"unit_price": F.col("unit_price")} if costs is not None else {}
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.select(*(v.alias(c) for c, v in said.items())).schema] if said else []

    def counted_as(tag: int, key: Column, bits: Column, values: list[Column]) -> Column:
        return F.struct(F.lit(tag).alias("tag"), key.alias("key"), bits.alias("bits"), *values)

    rows = [counted_as(0, F.lit(None).cast("string"), bits, [v.alias(c) for c, v in said.items()])]
    rows += [counted_as(i, key, F.lit(0), nothing) for i, (_, _, key) in enumerate(keys, 1)]
    counted = df.select(F.inline(F.array(*rows))).where("tag = 0 or key is not null")
    counted = counted.groupBy("tag", "key", "bits", *said).agg(F.count("*").alias("n_records"))
    profile = counted.groupBy("tag", "bits", *said).agg(
        F.sum("n_records").alias("n_records"), F.count_if(F.col("n_records") > 1).alias("repeated")
    )
    n = F.col("n_records")
    failures = [(check, c, F.sum(F.when(F.col("bits").bitwiseAND(1 << i) != 0, n))) for i, (check, c, _) in enumerate(violated)]
    failures += [("accepted_values", c, F.count_distinct(f"odd_{c}")) for c, _ in checks.accepted]
    if products is not None:
        profile = left_lookup(profile, products.select("product_key", F.lit(True).alias("known")), "product_key")
        orphan = F.col("known").isNull() & F.col("product_key").isNotNull()
        failures.append(("relationships", "product_key", F.sum(F.when(orphan, n))))
    if costs is not None:
        profile = left_lookup(profile, costs, "product_key")
        failures.append(("sale_price_above_cost", "unit_price", F.sum(F.when(F.col("unit_price") < F.col("latest_cost_price"), n))))
    failures += [(check, c, F.sum(F.when(F.col("tag") == i, F.col("repeated")))) for i, (check, c, _) in enumerate(keys, 1)]
    names = [f"failures_{i}" for i in range(len(failures))]
    one = profile.agg(*(F.coalesce(how, F.lit(0)).alias(name) for name, (_, _, how) in zip(names, failures)))
    return one.select(F.inline(F.array(*(F.struct(*_result(table, check, c, F.col(name))) for name, (check, c, _) in zip(names, failures)))))


def _result(table: str, check: str, column: str, failures: Column) -> list[Column]:
    return [
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(column).alias("column_name"),
        failures.cast("bigint").alias("failures"),
    ]


def suite_summary(read: Callable[[str], DataFrame], as_of: dt.date | None = None) -> DataFrame:
    """One row per declared check: ``(table_name, check_name, column_name, failures, status)``.

    Failures count violating rows (not_null, relationships, the business rules) or values and combinations (unique,
    accepted_values). A failed check warns; it does not stop anything.
    """
    results: list[DataFrame] = []
    rules = _row_rules(as_of_date(as_of))
    tables = {table: read(table) for table in DECLARED}
    for table, checks in DECLARED.items():
        df = tables[table]
        if _about_one_key(checks) and table not in rules:
            results.append(_key_checks(df, table, checks))
            continue
        products = tables["stg_products"] if checks.has_product else None
        costs = _latest_costs(tables["stg_inventory_purchases"]) if table == "stg_sales" else None
        results.append(_table_checks(df, table, checks, rules.get(table, []), products, costs))
    status = F.when(F.col("failures") > 0, "warn").otherwise("pass").alias("status")
    return stack(results).select("*", status)
