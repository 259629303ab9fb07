"""Joins.

No join here carries a broadcast hint: Catalyst broadcasts a stored table whose files are under
``spark.sql.autoBroadcastJoinThreshold`` and AQE does the same for a shuffled side once its size is known. Larger sides
are sort-merge joined, where AQE splits a partition that one hot key has filled. Rows that are to be summed are
aggregated before they are joined, so a hot key reaches the join as a few rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_lookup(facts: DataFrame, lookup: DataFrame, on: str | list[str]) -> DataFrame:
    """LEFT JOIN to a table that is unique on ``on``; every fact row is kept exactly once."""
    return facts.join(lookup, on, "left")


def with_own_shuffle(lookup: DataFrame, key: str) -> DataFrame:
    """An aggregated lookup whose join with unaggregated facts AQE can split.

    AQE splits a skewed join partition only where both sides come straight out of a shuffle. A lookup grouped by the
    join key is already partitioned by it, so Spark would join on top of the aggregate and one task would get all rows
    of a hot key. Recomputing the (text) key makes Spark shuffle the small lookup once more, right below the join.
    """
    return lookup.withColumn(key, F.concat(F.col(key), F.lit("")))


def null_safe_condition(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def left_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """LEFT JOIN in which NULL keys match each other; still a hash- or sort-merge-able equi-join."""
    joined = left.join(right, null_safe_condition(left, right, keys), "left")
    return reduce(lambda df, k: df.drop(right[k]), keys, joined)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    return child.filter(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")


def explode_spine(dimension: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """Every dimension row with every value of a one-column table of calendar values.

    The values (months: at most twelve a year) travel as one array inside a scalar subquery, so the dimension is
    expanded where it lies: no cross join, no shuffle.
    """
    as_array = values.agg(F.sort_array(F.collect_set(values.columns[0])))
    return dimension.withColumn(name, F.explode(as_array.scalar()))
