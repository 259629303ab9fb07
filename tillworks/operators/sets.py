"""Distinct unions of key sets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from itertools import batched

from pyspark.sql import DataFrame

from tillworks.functions.dates import as_of_date, month_start


def stack(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by name, paired up as a tree: each step re-checks the plan below it, so a chain of n unions costs n²."""
    parts = list(frames)
    while len(parts) > 1:
        parts = [a.unionByName(*b) if b else a for a, *b in batched(parts, 2)]
    return parts[0]


def union_distinct(*keys: DataFrame) -> DataFrame:
    """Distinct rows of all inputs; NULLs count as equal. Each input is made distinct before the shuffle."""
    return stack(keys).distinct()


def with_month_of(months: DataFrame, as_of: dt.date | None) -> DataFrame:
    """Distinct months plus the reporting month, which is there even before anything happened in it."""
    current = months.sparkSession.range(1).select(month_start(as_of_date(as_of)).alias("month"))
    return union_distinct(months, current)
