"""Row filters. A predicate that is NULL drops the row, as in SQL."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.functions.text import trim_ws


def all_of(predicates: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, predicates)


def required_present(df: DataFrame, non_blank: Iterable[str], non_null: Iterable[str] = ()) -> DataFrame:
    """Keep rows whose required raw fields were filled in."""
    filled = [trim_ws(F.col(c)) != "" for c in non_blank]
    return df.filter(all_of([*filled, *(F.col(c).isNotNull() for c in non_null)]))


def computed_once(df: DataFrame) -> DataFrame:
    """Compute what ``df`` derives before any filter above looks at it.

    Spark moves a filter below a projection and computes there, once more and part by part, what it asks for: a parsed date
    is parsed for the filter and again for the row. A column of the task's number, which is no function of the row, keeps
    filters above. A reader's own filters do not move below either, so this suits tables that are read whole.
    """
    return df.withColumn("_task", F.spark_partition_id()).filter("_task >= 0")


def positive(df: DataFrame, *columns: str) -> DataFrame:
    return df.filter(all_of(F.col(c) > 0 for c in columns))


def date_parsed(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def active_only(products: DataFrame) -> DataFrame:
    return products.filter("is_active")


def with_value(df: DataFrame, column: str) -> DataFrame:
    """Drop the NULL group before grouping."""
    return df.filter(F.col(column).isNotNull())


def later_than(df: DataFrame, column: str, day: Column) -> DataFrame:
    return df.filter(F.col(column) > day)


def not_above_zero(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) <= 0)


def below(df: DataFrame, column: str, bound: str) -> DataFrame:
    return df.filter(F.col(column) < F.col(bound))
