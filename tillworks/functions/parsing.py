"""Tolerant parsers for form text: NULL instead of an error, month-first on ambiguous dates.

Spark's casts accept more than a full date (``2025``, ``today``, ``10:00``), so each format is tried only on text of
its own shape. The shapes exclude one another, which also means one parse attempt per value and no thrown and caught
format errors on the hot path. Two-digit years are not accepted.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillworks.functions.numeric import NUMBER
from tillworks.functions.text import trim_ws
from tillworks.values import TRUE_WORDS

ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"
ISO_TIMESTAMP = (
    r"^\d{4}-\d{1,2}-\d{1,2}[ Tt]\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?( ?([Zz]|UTC|[+-]\d{1,2}:\d{2}))?$"
)
SLASH_DATE = r"^\d{1,2}/\d{1,2}/\d{4}$"
SLASH_TIMESTAMP = r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2}$"
# Month-first can only fail where day-first succeeds if the first number is no month.
DAY_FIRST = r"^(1[3-9]|[2-9]\d)/"


def _slash_date(d: Column) -> Column:
    return F.when(d.rlike(DAY_FIRST), F.try_to_date(d, "d/M/yyyy")).otherwise(F.try_to_date(d, "M/d/yyyy"))


def _slash_timestamp(d: Column) -> Column:
    return F.when(d.rlike(DAY_FIRST), F.try_to_timestamp(d, F.lit("d/M/yyyy H:m:s"))).otherwise(
        F.try_to_timestamp(d, F.lit("M/d/yyyy H:m:s"))
    )


def parse_form_date(c: Column) -> Column:
    d = trim_ws(c)
    return (
        F.when(d.rlike(SLASH_DATE), _slash_date(d))
        .when(d.rlike(ISO_DATE), d.try_cast("date"))
        .when(d.rlike(SLASH_TIMESTAMP), _slash_timestamp(d).cast("date"))
        .when(d.rlike(ISO_TIMESTAMP), d.try_cast("timestamp").cast("date"))
    )


def parse_form_timestamp(c: Column) -> Column:
    d = trim_ws(c)
    return F.when(d.rlike(SLASH_TIMESTAMP), _slash_timestamp(d)).when(
        d.rlike(ISO_TIMESTAMP) | d.rlike(ISO_DATE), d.try_cast("timestamp")
    )


def parse_form_number(c: Column) -> Column:
    """``KES 1,200.50`` -> 1200.5: everything but digits, dot and minus is dropped before the cast."""
    return F.nullif(F.regexp_replace(c, r"[^0-9.\-]", ""), F.lit("")).try_cast(NUMBER)


def parse_form_int(c: Column) -> Column:
    """Rounds half away from zero, where a plain cast would truncate."""
    return F.round(parse_form_number(c)).try_cast("bigint")


def parse_bool_flag(c: Column) -> Column:
    return F.coalesce(F.lower(trim_ws(c)).isin(*TRUE_WORDS), F.lit(False))


def default_if_unparsable(parsed: Column, default: Any) -> Column:
    return F.coalesce(parsed, F.lit(default))
