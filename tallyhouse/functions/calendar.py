"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column | str) -> Column:
    """yyyymmdd as an integer, computed from the parts (no text formatting per row)."""
    day = F.col(day) if isinstance(day, str) else day
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def calendar_columns(day: Column | str) -> dict[str, Column]:
    """All attributes of the date dimension, in published order.

    `week_of_year` follows ISO 8601 while `year` is the calendar year, so the last
    days of December may carry week 1. Weekdays count from 1 = Monday.
    """
    day = F.col(day) if isinstance(day, str) else day
    weekday = F.weekday(day) + 1
    return {
        "date_key": date_key(day),
        "full_date": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "quarter_name": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "month_abbr": F.date_format(day, "MMM"),
        "week_of_year": F.weekofyear(day),
        "day_of_week": weekday,
        "day_name": F.date_format(day, "EEEE"),
        "day_of_month": F.dayofmonth(day),
        "is_weekend": (weekday >= 6).cast("int"),
        "year_month": F.date_format(day, "yyyy-MM"),
    }
