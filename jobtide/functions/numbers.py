"""Arithmetic that yields NULL, never NaN, infinity or an ANSI error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; NULL when the denominator is 0 or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def exact_mean(value: Column) -> Column:
    """Aggregate mean of amounts with up to eight decimals; the exact sum makes it independent of the order of rows."""
    return ratio(F.sum(value.cast("decimal(28,8)")), F.count(value))


def pct_change(value: Column, earlier: Column) -> Column:
    return ratio(value, earlier) - F.lit(1.0)


def clip(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """Bound *value*; NULL stays NULL (``least``/``greatest`` alone would skip it)."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def finite_or_zero(value: Column) -> Column:
    number = value.cast("double")
    unusable = number.isNull() | F.isnan(number) | (F.abs(number) == F.lit(float("inf")))
    return F.when(unusable, F.lit(0.0)).otherwise(number)


def mean(values: list[Column]) -> Column:
    total = values[0]
    for value in values[1:]:
        total = total + value
    return total / F.lit(float(len(values)))
