"""Sorts and top-k for readers. Stored tables carry no order, so writers never pay for a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_column(spec: str) -> Column:
    """``"-total"`` sorts descending, ``"total"`` ascending; NULLs go last descending and first ascending."""
    return F.col(spec[1:]).desc_nulls_last() if spec.startswith("-") else F.col(spec).asc_nulls_first()


def sort_by(df: DataFrame, *specs: str) -> DataFrame:
    return df.orderBy(*(order_column(s) for s in specs))


def top_k(df: DataFrame, k: int, *specs: str) -> DataFrame:
    """First ``k`` rows; the specs should end in a unique column. Each task keeps k rows, the driver merges them."""
    return sort_by(df, *specs).limit(k)


def numbered(report: DataFrame) -> DataFrame:
    """The rows with their ``position`` (from 1) in the report's own order. For reports that someone reads: one task numbers
    all rows."""
    place = report.withColumn("position", F.monotonically_increasing_id())
    return place.withColumn("position", F.row_number().over(Window.orderBy("position")).cast("long"))
