"""Exact money arithmetic on decimals: rounding is always half away from zero."""

from __future__ import annotations

from decimal import Decimal
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBER = T.DecimalType(38, 9)  # a parsed form number
MONEY = T.DecimalType(38, 2)  # an amount or a sum of amounts
PERCENT = T.DecimalType(28, 1)
COUNT = T.DecimalType(20, 0)
# Ordinary sizes. Products and quotients of these keep all their digits in 38; those of the full types would not.
SMALL_NUMBER, SMALL_UNITS, SMALL_TOTAL = T.DecimalType(27, 9), T.DecimalType(10, 0), T.DecimalType(28, 2)
SMALL_PART = T.DecimalType(28, 9)
NANO = Decimal(10**9)


def _within(c: Column, digits: int) -> Column:
    return F.abs(c) < F.lit(Decimal(10**digits))


def _stated(value: Column, *inputs: Column) -> Column:
    """The value, or an error where the inputs are known but 38 digits cannot hold the result, in any ANSI mode."""
    lost = value.isNull()
    for c in inputs:
        lost = lost & c.isNotNull()
    return F.when(lost, F.raise_error(F.lit("a result exceeds 38 digits"))).otherwise(value)


def _nano(number: Column) -> Column:
    """A number in units of 10^-9, as a whole decimal."""
    fraction = number % F.lit(Decimal(1))
    whole = (number - fraction).cast("decimal(29,0)")
    return (whole * F.lit(NANO) + (fraction * F.lit(NANO)).cast("decimal(10,0)")).cast("decimal(38,0)")


def _from_nano(nano: Column, kind: T.DataType) -> Column:
    return (nano * F.lit(Decimal("0.000000001"))).cast(kind)


def line_amount(units: Column, price: Column, less: Column | None = None) -> Column:
    """``round(units * price - less, 2)``; the product is not rounded before ``less`` is taken off. Exact for amounts of up
    to 29 digits before the point; larger ones are an error."""
    less = F.lit(Decimal(0)).cast(NUMBER) if less is None else less
    product = (units.try_cast(SMALL_UNITS) * price.try_cast(SMALL_NUMBER)).try_cast("decimal(37,9)")
    amount = product - less.try_cast(SMALL_NUMBER)
    nano = units.cast(COUNT) * _nano(price.cast(NUMBER)) - _nano(less.cast(NUMBER))
    wide = _stated(_from_nano(F.round(nano, -7), MONEY), units, price, less)
    small = _within(units, 10) & _within(price, 18) & _within(less, 18)
    return F.when(small, F.round(amount, 2).cast(MONEY)).otherwise(wide)


def total_value(total_units: Column, price: Column) -> Column:
    """``units * price``: exact in ordinary sizes, to six decimals beyond, an error above 29 digits before the point."""
    narrow = total_units.try_cast(SMALL_UNITS) * price.try_cast(SMALL_NUMBER)
    wide = _stated(_from_nano(total_units.cast(COUNT) * _nano(price.cast(NUMBER)), NUMBER), total_units, price)
    return F.when(_within(total_units, 10) & _within(price, 18), narrow.cast(NUMBER)).otherwise(wide)


def difference(a: Column, b: Column) -> Column:
    """``a - b`` of two numbers: exact in ordinary sizes, to eight decimals beyond."""
    narrow = a.try_cast(SMALL_NUMBER) - b.try_cast(SMALL_NUMBER)
    wide = _stated((a.cast(NUMBER) - b.cast(NUMBER)).cast(NUMBER), a, b)
    return F.when(_within(a, 18) & _within(b, 18), narrow.cast(NUMBER)).otherwise(wide)


def money_sum(c: Column) -> Column:
    return F.round(F.sum(c), 2).cast(MONEY)


def money_avg(total: Column, n: Column) -> Column:
    """Average from its parts, so that partial results can be combined first."""
    count = n.cast(COUNT)
    narrow, wide = F.try_divide(total.try_cast(SMALL_PART), count), F.try_divide(total, count)
    return F.when(_within(total, 19), F.round(narrow, 2).cast(MONEY)).otherwise(F.round(wide, 2).cast(MONEY))


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def greatest_or_zero(c: Column) -> Column:
    return F.greatest(c, F.lit(0))


def floored_margin(price: Column, cost: Column) -> Column:
    return greatest_or_zero(difference(price, zero_if_null(cost))).cast(NUMBER)


def ratio_pct(part: Column, whole: Column, digits: int = 1, otherwise: Any = None) -> Column:
    """``part / whole * 100`` of two decimals where ``whole`` is positive, else ``otherwise``.

    The quotient is kept to 9 digits before it is scaled and rounded, to 6 where an amount has 20 digits or more.
    """
    narrow = F.try_divide(part.try_cast(SMALL_PART), whole.try_cast(SMALL_PART))
    wide = F.try_divide(part, whole)
    small = _within(part, 19) & _within(whole, 19)
    quotient = F.when(small, F.round(narrow, 9).cast(SMALL_NUMBER)).otherwise(wide.cast(SMALL_NUMBER))
    return F.when(whole > 0, F.round(quotient * 100, digits)).otherwise(F.lit(otherwise)).cast(PERCENT)


def count_ratio_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """The same for two counts: a double, NULL where ``whole`` is not positive."""
    return F.when(whole > 0, F.round(F.try_divide(part, whole) * 100, digits))


def safe_divide(numerator: Column, denominator: Column, default: Any = 0) -> Column:
    """Quotient to 4 digits; ``default`` for a zero or NULL denominator."""
    return F.when(denominator.isNull() | (denominator == 0), F.lit(default)).otherwise(
        F.round(F.try_divide(numerator, denominator), 4)
    )
