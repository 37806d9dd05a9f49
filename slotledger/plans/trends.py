"""Report on bookings over time: daily totals, trailing means and weeks per channel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotledger.functions import dates, numbers
from slotledger.operators.calendar import calendar_grid, densify, rolling_mean
from slotledger.operators.ranking import preview
from slotledger.operators.rows import require_not_null
from slotledger.plans.channels import daily_channel_bookings
from slotledger.schemas import require_columns
from slotledger.settings import TRAILING_ROWS

_DAY, _LABEL, _COUNT, _MEAN = "performance_date", "channel_display", "bookings_count", "bookings_7_day_avg"

# Headings that readers of the reports rely on.
TREND_LABELS = {
    "performance_date": "Date",
    "channel_display": "Channel",
    "bookings_count": "Daily Bookings",
    "bookings_7_day_avg": "7-Day Average",
}
WEEKLY_LABELS = {
    "week_start_date": "Week Starting",
    "channel_display": "Channel",
    "bookings_count": "Weekly Bookings",
}


def daily_totals(daily: DataFrame) -> DataFrame:
    """Bookings per day over all channels."""
    require_columns(daily, (_DAY, "channel", _COUNT), "bookings trend")
    counts = daily.select(_DAY, numbers.numeric_or_zero(daily, _COUNT).alias(_COUNT))
    return require_not_null(counts, _DAY).groupBy(_DAY).agg(F.sum(_COUNT).alias(_COUNT))


def rolling_total(daily: DataFrame) -> DataFrame:
    """Mean over the last seven days that have rows; days without any are not counted."""
    return rolling_mean(daily_totals(daily), _DAY, _COUNT, _MEAN)


def channel_grid(daily: DataFrame) -> DataFrame:
    """Every day of the span for every channel."""
    return calendar_grid(daily_channel_bookings(daily), _DAY, _LABEL)


def densify_daily(daily: DataFrame) -> DataFrame:
    """Bookings of every channel on every day of the span, 0 where there are none."""
    return densify(daily_channel_bookings(daily), _DAY, _LABEL, _COUNT)


def rolling_by_channel(daily: DataFrame) -> DataFrame:
    """Mean over the last seven calendar days of each channel."""
    return rolling_mean(densify_daily(daily), _DAY, _COUNT, _MEAN, by=_LABEL)


def weekly_bookings(daily: DataFrame) -> DataFrame:
    """Bookings per channel in weeks from Tuesday to Monday, labelled by that Monday.

    The label is called ``week_start_date``, as the report has always named it. Days are summed to
    weeks before the gaps are filled, which gives the weeks of the filled calendar with fewer rows.
    """
    week = dates.week_ending_monday(F.col(_DAY)).alias("week_start_date")
    weekly = daily_channel_bookings(daily).groupBy(week, _LABEL).agg(F.sum(_COUNT).alias(_COUNT))
    return densify(weekly, "week_start_date", _LABEL, _COUNT, step_days=7)


def trend_kpis(daily: DataFrame) -> DataFrame:
    """Total, latest day, and how the trailing mean moved from the first day to the last.

    The mean at the first day is that day's count and the mean at the last is over the last seven
    rows, so neither needs a window over the whole calendar. No rows give no row.
    """
    days = daily_totals(daily)
    recent = preview(days, [F.desc(_DAY)], TRAILING_ROWS).agg(F.avg(_COUNT)).scalar()
    summary = days.agg(
        F.sum(_COUNT).alias("total_bookings"),
        F.max(_DAY).alias("latest_day"),
        F.max_by(_COUNT, _DAY).alias("latest_day_bookings"),
        F.min_by(_COUNT, _DAY).cast("double").alias("first_7_day_avg"),
    ).filter(F.col("latest_day").isNotNull())
    return summary.withColumn("latest_7_day_avg", recent).withColumn(
        "avg_delta", F.col("latest_7_day_avg") - F.col("first_7_day_avg")
    )
