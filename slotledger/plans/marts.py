"""The three marts.

Bookings are counted before anything is joined to them: counting combines inside each map task, so a
popular event type or employee never gathers its raw rows anywhere, and every join sees totals only.

``keyed=True`` says that a table has one row per key, as merging keeps the stored ones. Nothing can
repeat then, so repeats are not looked for, which saves the only shuffles of raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slotledger.functions import dates, numbers, rules
from slotledger.operators.combine import attach_channel, channel_mapping, full_outer_coalesce
from slotledger.operators.rows import require_not_null, since, with_load_stamp


# When a booking counts: on delivery of its notice. Marts can be asked for another time column.
BOOKED_AT = "webhook_created_at"


def _eligible(webhooks: DataFrame, key: str, booked_at: str, event_types: Sequence[str] | None) -> DataFrame:
    """Rows with a booking time and the key; by default every kind of notice counts, cancellations too."""
    rows = require_not_null(webhooks, booked_at, key)
    return rows if event_types is None else rows.filter(F.col("webhook_event_type").isin(list(event_types)))


def bookings_daily(
    webhooks: DataFrame, event_types: Sequence[str] | None = None, booked_at: str = BOOKED_AT
) -> DataFrame:
    """Bookings per day and event type."""
    return (
        _eligible(webhooks, "event_type_code", booked_at, event_types)
        .groupBy(F.to_date(booked_at).alias("booking_date"), "event_type_code")
        .agg(F.count(F.lit(1)).alias("bookings_count"))
    )


def spend_daily(spend: DataFrame) -> DataFrame:
    """Spend per day, channel and event type."""
    return (
        require_not_null(spend, "spend_date", "channel", "event_type_code")
        .groupBy("spend_date", "channel", "event_type_code")
        .agg(F.sum("spend").alias("marketing_spend"))
    )


def distinct_spend(spend: DataFrame, cutoff: date | None = None, keyed: bool = False) -> DataFrame:
    """Exact copies of a spend row once; with a cutoff, only spend from that day on."""
    recent = spend if cutoff is None else since(spend, "spend_date", cutoff)
    return recent if keyed else recent.distinct()


def daily_channel_performance(
    webhooks: DataFrame,
    spend: DataFrame,
    cutoff: date | None = None,
    event_types: Sequence[str] | None = None,
    booked_at: str = BOOKED_AT,
    keyed: bool = False,
) -> DataFrame:
    """Bookings beside spend per day and channel, with days that have only one of them.

    Channels that share an event type each show all of its bookings; bookings without spend have
    no channel. All spend counts unless a cutoff is asked for; bookings before it then stand without cost.
    Give ``spend`` the current version of the table, not its superseded files.
    """
    booked = bookings_daily(webhooks, event_types, booked_at).withColumnRenamed("booking_date", "performance_date")
    spent = spend_daily(distinct_spend(spend, cutoff, keyed)).withColumnRenamed("spend_date", "performance_date")
    both = full_outer_coalesce(
        spent, booked, ["performance_date", "event_type_code"], {"marketing_spend": 0, "bookings_count": 0}
    )
    return both.select(
        "performance_date",
        *[c.alias(name) for name, c in dates.calendar_columns(F.col("performance_date")).items()],
        "channel",
        "event_type_code",
        "bookings_count",
        F.col("marketing_spend").cast(numbers.MONEY_TOTAL).alias("marketing_spend"),
        numbers.cost_per_booking(F.col("marketing_spend"), F.col("bookings_count")).alias("cost_per_booking"),
    )


def booking_time_patterns(
    webhooks: DataFrame,
    mapping: DataFrame,
    event_types: Sequence[str] | None = None,
    booked_at: str = BOOKED_AT,
) -> DataFrame:
    """Bookings by day, hour, part of the day and channel.

    Day, hour and event type fix every other column of the grain, so bookings are counted by these
    three and the rest is computed on the totals.
    """
    hourly = (
        _eligible(webhooks, "event_type_code", booked_at, event_types)
        .groupBy(
            F.to_date(booked_at).alias("booking_date"),
            F.hour(booked_at).alias("hour_of_day"),
            "event_type_code",
        )
        .agg(F.count(F.lit(1)).alias("bookings_count"))
    )
    calendar = dates.calendar_columns(F.col("booking_date"))
    slot = rules.time_slot(F.col("hour_of_day"))
    return attach_channel(hourly, mapping).select(
        "booking_date",
        *[calendar[c].alias(c) for c in ("week_start_date", "month_start_date")],
        *[calendar[c].alias(c) for c in ("day_of_week_number", "day_of_week_name")],
        "hour_of_day",
        slot.alias("time_slot"),
        rules.time_slot_sort(slot).alias("time_slot_sort"),
        "channel",
        "event_type_code",
        "bookings_count",
    )


def weekly_load(
    webhooks: DataFrame,
    event_types: Sequence[str] | None = None,
    booked_at: str = BOOKED_AT,
    keyed: bool = False,
) -> DataFrame:
    """Distinct meetings per employee and week, with the first and last day booked.

    Spark removes repeated meetings by (employee, week, meeting) before it counts, so the meetings of
    a busy employee spread over all tasks.
    """
    day = F.to_date(booked_at)
    meetings = F.count("meeting_key") if keyed else F.count_distinct("meeting_key")
    return (
        _eligible(webhooks, "user_email", booked_at, event_types)
        .select(
            "user_email",
            dates.week_start(day).alias("week_start_date"),
            day.alias("booking_date"),
            F.coalesce("webhook_key", "event_id").alias("meeting_key"),
        )
        .groupBy("user_email", "week_start_date")
        .agg(
            meetings.alias("weekly_meetings"),
            F.min("booking_date").alias("first_booking_date_in_week"),
            F.max("booking_date").alias("last_booking_date_in_week"),
        )
    )


def _summary_of_weeks() -> dict[str, object]:
    return {
        "total_meetings": F.sum("weekly_meetings"),
        "number_of_weeks": F.count("week_start_date"),
        "avg_meetings_per_week": F.avg("weekly_meetings"),
        "max_meetings_in_week": F.max("weekly_meetings"),
    }


def employee_summary(weekly: DataFrame) -> DataFrame:
    """Per employee: weeks, meetings, mean and largest week. Weeks are unique, so they are just counted."""
    return weekly.groupBy("user_email").agg(*[c.alias(name) for name, c in _summary_of_weeks().items()])


def employee_meeting_load(
    webhooks: DataFrame,
    event_types: Sequence[str] | None = None,
    booked_at: str = BOOKED_AT,
    keyed: bool = False,
) -> DataFrame:
    """Weekly load beside the employee's summary.

    The summary is a window over the weekly totals: one scan, where joining an aggregate back takes
    two. A window holds one row per week of one employee.
    """
    per_employee = Window.partitionBy("user_email")
    summary = {name: c.over(per_employee) for name, c in _summary_of_weeks().items()}
    summary["avg_meetings_per_week"] = F.round(summary["avg_meetings_per_week"], 2)
    return weekly_load(webhooks, event_types, booked_at, keyed).select(
        "user_email",
        "week_start_date",
        "weekly_meetings",
        *[c.alias(name) for name, c in summary.items()],
        "first_booking_date_in_week",
        "last_booking_date_in_week",
    )


def build_marts(
    webhooks: DataFrame,
    spend: DataFrame,
    cutoff: date | None = None,
    as_of: datetime | None = None,
    keyed: bool = False,
) -> dict[str, DataFrame]:
    """All three marts, stamped and ready for ``sinks.tables.publish_mart``."""
    marts = {
        "daily": daily_channel_performance(webhooks, spend, cutoff, keyed=keyed),
        "patterns": booking_time_patterns(webhooks, channel_mapping(spend)),
        "load": employee_meeting_load(webhooks, keyed=keyed),
    }
    return {name: with_load_stamp(mart, as_of) for name, mart in marts.items()}
