"""Aggregates. All of them combine on the map side, so a hot group shuffles as one row per task."""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.functions.numeric import money_sum, total_value, zero_if_null
from tillworks.operators.joins import left_lookup


def sum_where(value: Column, condition: Column) -> Column:
    """Conditional sum: 0, not NULL, when no row qualifies."""
    return money_sum(F.when(condition, value).otherwise(F.lit(0)))


def paid_by(method_column: str, method: str, value_column: str) -> Column:
    return sum_where(F.col(value_column), F.col(method_column) == method)


def _instant(day: str, stamp: str) -> Column:
    """Day, then timestamp, as one number of fixed width; a missing one comes before all others."""
    days = F.coalesce(F.datediff(F.col(day), F.lit("1970-01-01").cast("date")), F.lit(-10_000_000)).cast("decimal(10,0)")
    micros = F.coalesce(F.unix_micros(F.col(stamp)), F.lit(-4 * 10**17)).cast("decimal(20,0)")
    return (days * F.lit(Decimal(10**18)) + micros).cast("decimal(38,0)")


def with_latest(df: DataFrame, keys: list[str], value: str, day: str, stamp: str, alias: str, *more: Column) -> DataFrame:
    """The value of each key's latest row by day and timestamp, the largest of equally late ones, as ``alias``; also
    ``last_<day>`` and the sums given in ``more``.

    Ties are settled in a first aggregation; both can hash, because no buffer holds a struct.
    """
    once = df.groupBy(*keys, day, stamp).agg(F.max(value).alias(value), *more)
    names = [c for c in once.columns if c not in (*keys, day, stamp, value)]
    latest = F.max_by(value, _instant(day, stamp)).alias(alias)
    return once.groupBy(*keys).agg(latest, F.max(day).alias(f"last_{day}"), *(F.sum(c).alias(c) for c in names))


def cost_of_goods(sales: DataFrame, products: DataFrame, keys: Iterable[str]) -> DataFrame:
    """``total_cogs`` per key: units sold at the product master's cost price (0 when it has none).

    The cost is one number per product, so units are first summed per key and product and only those sums are joined.
    """
    keys = list(keys)
    units = sales.groupBy(*keys, "product_key").agg(F.sum("units_sold").alias("units"))
    priced = left_lookup(units, products.select("product_key", "cost_price"), "product_key")
    cost = total_value(F.col("units"), zero_if_null(F.col("cost_price")))
    return priced.groupBy(*keys).agg(money_sum(cost).alias("total_cogs"))


def combine(parts: Iterable[DataFrame], keys: list[str]) -> DataFrame:
    """One row per key over several inputs that were aggregated by the same keys and share no measure.

    Takes the place of a union of all keys left-joined to every input: NULL keys group together by themselves, and
    only aggregated rows are shuffled. A key has at most one row per input, so max() picks that row's value.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.groupBy(*keys).agg(*(F.max(m).alias(m) for m in stacked.columns if m not in keys))
