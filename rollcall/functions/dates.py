"""Date expressions. Nothing here reads the clock: dates to compare with are arguments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(text: Column) -> Column:
    """ISO date text to DATE; anything unreadable becomes NULL instead of failing the job."""
    return F.try_to_date(text, "yyyy-MM-dd")


def active_at(moment: Column, start: Column, end: Column) -> Column:
    """True when the interval [start, end) holds at `moment`; an open end is NULL."""
    return (start <= moment) & (end.isNull() | (end > moment))


def month_key(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def months_between_calendar(start: Column, end: Column) -> Column:
    """Calendar months between two dates, days ignored."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
