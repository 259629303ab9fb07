"""Calendar helpers that keep DATE (``date_trunc`` would return TIMESTAMP)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def week_start_monday(d: Column) -> Column:
    return F.trunc(d, "WEEK")


def day_of_week(d: Column) -> Column:
    """1 = Sunday."""
    return F.dayofweek(d).cast("bigint")


def day_of_month(d: Column) -> Column:
    return F.dayofmonth(d).cast("bigint")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier).cast("bigint")


def as_of_date(as_of: dt.date | None = None) -> Column:
    """The reporting day: today unless a day is given, which makes a run repeatable."""
    return F.current_date() if as_of is None else F.lit(as_of)
