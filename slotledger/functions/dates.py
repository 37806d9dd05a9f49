"""Lenient date parsing and calendar columns.

Week and month starts use ``trunc`` on dates, which never goes through a time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotledger import settings


def parse_created_at(text: Column) -> Column:
    """Delivery time of a webhook; whitespace is dropped, the offset honoured, bad text is NULL."""
    return F.try_to_timestamp(F.regexp_replace(text, r"\s+", ""), F.lit(settings.CREATED_AT_PATTERN))


def parse_iso(text: Column) -> Column:
    return F.try_to_timestamp(text)


def parse_day(text: Column) -> Column:
    return F.try_to_date(text, settings.DAY_PATTERN)


def to_day(value: Column) -> Column:
    """Date of a date, timestamp or text; NULL when it is none."""
    return value.try_cast("date")


def week_start(day: Column) -> Column:
    """Monday on or before the day."""
    return F.trunc(day, "week")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def week_ending_monday(day: Column) -> Column:
    """Monday on or after the day: the label of a Tuesday-to-Monday week."""
    return F.next_day(F.date_sub(day, 1), "Mon")


def day_label(day: Column) -> Column:
    """``yyyy-MM-dd``, which is a date's own text."""
    return day.cast("string")


def calendar_columns(day: Column) -> dict[str, Column]:
    """Weekday number (1 = Sunday), weekday name, week start and month start of a date."""
    return {
        "day_of_week_number": F.dayofweek(day),
        "day_of_week_name": F.date_format(day, "EEEE"),
        "week_start_date": week_start(day),
        "month_start_date": month_start(day),
    }
