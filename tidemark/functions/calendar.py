"""Date helpers on DATE columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def month_start(day: Column | str) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(day, "MM")


def month_label(day: Column | str) -> Column:
    """First day of the month, as the string 'YYYY-MM-01'."""
    return F.date_format(day, "yyyy-MM-01")


def first_month_on_or_after(day: Column) -> Column:
    """Earliest first-of-month that is not before `day`."""
    return F.when(F.dayofmonth(day) == 1, day).otherwise(F.add_months(month_start(day), 1))


def whole_months(start: Column, end: Column) -> Column:
    """Completed months from start to end, truncated towards zero."""
    return F.timestamp_diff("MONTH", start, end).cast("int")


def periods_of_30_days(start: Column, end: Column) -> Column:
    """Whole 30-day periods between two dates, rounded down."""
    return F.floor(F.datediff(end, start) / 30).cast("int")


def plus_periods(start: Column, periods: Column) -> Column:
    """Date that lies `periods` spans of 30 days after `start`."""
    return F.date_add(start, (periods * 30).cast("int"))
