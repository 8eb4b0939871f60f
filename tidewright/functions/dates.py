"""Dates from epoch milliseconds and ISO text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = "yyyy-MM-dd"
DAY_FIRST = "dd/MM/yyyy"


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def date_of_millis(ms: Column) -> Column:
    return F.to_date(from_millis(ms))


def iso_date(text: Column) -> Column:
    """DATE from ``yyyy-MM-dd`` text, NULL when it is not a real day."""
    return F.try_to_date(text, ISO)


def date_parts(date: Column) -> dict[str, Column]:
    return {"year": F.year(date), "month": F.month(date), "day": F.dayofmonth(date)}


def days_before(as_of: dt.date | Column, days: int) -> Column:
    base = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return F.date_sub(base, days)


def day_first(date: Column) -> Column:
    return F.date_format(date, DAY_FIRST)
