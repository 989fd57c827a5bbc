"""Week arithmetic and reference dates. Weeks start on Monday."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def week_start(date: Column) -> Column:
    return F.trunc(date, "week")


def reference_date(as_of: Column | dt.date | str | None) -> Column:
    """The day that stands for 'today': a Column (for instance a scalar subquery), a date, or the current date."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def weeks_before(as_of: Column | dt.date | str | None, weeks: int) -> Column:
    return F.date_sub(reference_date(as_of), 7 * weeks)


def latest(df: DataFrame, column: str = "posted_date") -> Column:
    """Newest date of *df* as a scalar subquery: it stays inside the plan, nothing is collected."""
    return df.agg(F.max(column)).scalar()


def since(df: DataFrame, start: Column) -> DataFrame:
    """Rows from *start* on; the extra year-month test prunes the partitions of the stored tables."""
    kept = df.filter(F.col("posted_date") >= start)
    if {"year", "month"} <= set(df.columns):
        kept = kept.filter(F.col("year") * 100 + F.col("month") >= F.year(start) * 100 + F.month(start))
    return kept
