"""Declared table shapes (as DDL) and the column contract check."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

# Declared, never inferred: inference costs a pass over every file and changes with the data. What a document
# holds besides is kept by the readers as ``undeclared_fields``.
RAW_WEBHOOK = (
    "event string, created_at string, created_by string, "
    "payload struct<event: string, email: string, first_name: string, last_name: string, name: string, "
    "scheduled_event: struct<start_time: string, end_time: string, name: string, status: string, "
    "event_type: string, event_memberships: array<struct<user_email: string>>>, "
    "tracking: struct<utm_source: string, utm_medium: string, utm_campaign: string, "
    "utm_content: string, utm_term: string>>"
)

# Amounts arrive as numbers or as text, so they are read as text and parsed once.
RAW_SPEND = "date string, channel string, spend string"

DAILY_PERFORMANCE = ("performance_date", "channel", "bookings_count", "marketing_spend")
TIME_PATTERNS = (
    "booking_date",
    "day_of_week_name",
    "day_of_week_number",
    "hour_of_day",
    "time_slot",
    "channel",
    "bookings_count",
)
MEETING_LOAD = ("user_email", "week_start_date", "weekly_meetings")


class MissingColumnsError(ValueError):
    """A report was given a table without the columns it needs."""


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "input") -> DataFrame:
    """Fail while the plan is built, not in the middle of a job."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise MissingColumnsError(f"{what} is missing required columns: {', '.join(missing)}")
    return df
