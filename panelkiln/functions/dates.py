"""Dates, Monday-to-Friday business days and ISO weeks as closed-form expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F


def timestamp(value: Column | str) -> Column:
    """Timestamp, or NULL when the text cannot be read as one."""
    c = F.col(value) if isinstance(value, str) else value
    return F.try_to_timestamp(F.trim(c.cast("string")))


def day(value: Column | str) -> Column:
    """Calendar day, or NULL when the value is no date."""
    return F.to_date(timestamp(value))


def add_business_days(start: Column, n: int) -> Column:
    """``start`` moved ``n >= 0`` business days ahead.

    A weekend start first rolls: to the next Monday for n = 0, else it counts
    from the Friday before. Whole weeks then add two weekend days each.
    """
    if n < 0:
        raise ValueError("n must be >= 0")
    weekday = F.weekday(start)
    if n == 0:
        return F.when(weekday >= 5, F.date_add(start, F.lit(7) - weekday)).otherwise(start)
    friday_or_day = F.when(weekday >= 5, F.date_add(start, F.lit(4) - weekday)).otherwise(start)
    index = F.least(weekday, F.lit(4))
    weekends = F.floor((index + F.lit(n)) / F.lit(5)).cast("int")
    return F.date_add(friday_or_day, F.lit(n) + F.lit(2) * weekends)


def business_days(start: Column | date, end: Column | date) -> Column:
    """Array of the business days in ``[start, end]`` (empty when there are none)."""
    a, b = _as_date(start), _as_date(end)
    days = F.when(a <= b, F.sequence(a, b))
    return F.coalesce(F.filter(days, lambda d: F.weekday(d) < 5), F.array().cast("array<date>"))


def is_business_day(value: Column) -> Column:
    return F.weekday(value) < 5


def iso_week(value: Column) -> Column:
    """Integer token ``year * 100 + week`` of the ISO week."""
    return (F.extract(F.lit("YEAROFWEEK"), value) * 100 + F.weekofyear(value)).cast("int")


def _as_date(value: Column | date) -> Column:
    return F.lit(value) if isinstance(value, date) else value
