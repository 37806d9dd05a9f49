"""The six reports, each as the named tables it shows. All tables are lazy; run the ones you need."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotledger.operators.rows import drop_missing, present
from slotledger.plans import channels, patterns, trends, workload

Report = dict[str, DataFrame]


def daily_calls(daily: DataFrame) -> Report:
    """Bookings by day and channel."""
    by_day = channels.daily_channel_bookings(daily).orderBy("performance_date", "channel_display")
    return {
        "kpis": channels.activity_kpis(daily),
        "top_channel": channels.top_channel(daily),
        "daily": by_day,
        "daily_table": present(by_day, channels.COLUMN_LABELS),
        "by_channel": channels.channel_totals(daily).orderBy(F.desc("bookings_count"), "channel_display"),
    }


def cost_per_booking(daily: DataFrame) -> Report:
    """What a booking costs, by day and over the selection."""
    per_channel = channels.channel_cpb(daily)
    return {
        "overall": channels.overall_cpb(daily),
        "best_channel": channels.best_cpb_channel(daily),
        "trend": channels.cpb_trend(daily).orderBy("performance_date", "channel_display"),
        "by_channel": per_channel.orderBy(F.asc_nulls_last("cost_per_booking"), "channel_display"),
        "by_channel_table": channels.cost_table(per_channel),
        "daily_table": channels.cost_table(channels.daily_cpb(daily)),
    }


def bookings_trend(daily: DataFrame) -> Report:
    """Bookings over time, overall and per channel."""
    by_day = trends.rolling_total(daily).orderBy("performance_date")
    by_channel = trends.rolling_by_channel(daily).orderBy("channel_display", "performance_date")
    weekly = trends.weekly_bookings(daily).orderBy("week_start_date", "channel_display")
    return {
        "kpis": trends.trend_kpis(daily),
        "daily": by_day,
        "daily_table": present(by_day, trends.TREND_LABELS),
        "by_channel": by_channel,
        "by_channel_table": present(by_channel, trends.TREND_LABELS),
        "weekly": weekly,
        "weekly_table": present(weekly, trends.WEEKLY_LABELS),
    }


def channel_leaderboard(daily: DataFrame) -> Report:
    """Channels ranked by volume and price."""
    board = channels.channel_leaderboard(daily)
    ordered = board.orderBy(*channels.leaderboard_order())
    return {
        "overall": channels.overall_figures(daily),
        "best": channels.best_channels(board),
        "leaderboard": ordered,
        "leaderboard_table": channels.leaderboard_table(ordered),
        "detail_table": channels.leaderboard_detail(ordered),
        "volume_versus_cost": drop_missing(board, "cost_per_booking"),
        "heatmap": channels.metric_heatmap(board),
    }


def booking_times(times: DataFrame) -> Report:
    """When bookings are made."""
    by_hour = patterns.weekday_hour(times).orderBy("weekday_order", "hour_of_day")
    by_slot = patterns.weekday_slot(times).orderBy("weekday_order", "slot_order")
    labels, day, count = patterns.PATTERN_LABELS, "day_of_week_name", "bookings_count"
    return {
        "kpis": patterns.pattern_kpis(times),
        "busiest": patterns.busiest_slots(times),
        "by_hour": patterns.by_hour(times).orderBy("hour_of_day"),
        "by_weekday": patterns.by_weekday(times).orderBy("day_of_week_number"),
        "by_slot": patterns.by_slot(times),
        "weekday_hour": by_hour,
        "weekday_hour_table": present(by_hour, labels, [day, "hour_display", count]),
        "weekday_slot": by_slot,
        "weekday_slot_table": present(by_slot, labels, [day, "time_slot_display", count]),
        "hour_channel": patterns.hour_channel(times).orderBy("hour_of_day", "channel_display"),
        "weekday_channel": patterns.weekday_channel(times).orderBy("day_of_week_number", "channel_display"),
        "rows_table": patterns.pattern_table(times),
    }


def meeting_load(load: DataFrame) -> Report:
    """How many meetings employees have."""
    board = workload.employee_leaderboard(load).orderBy(*workload.leaderboard_order())
    weekly = workload.employee_weekly(load).orderBy("user_email", "week_start_date")
    return {
        "kpis": workload.employee_kpis(load),
        "leaderboard": board,
        "leaderboard_table": workload.leaderboard_table(board),
        "weekly": weekly,
        "weekly_table": present(weekly, workload.LOAD_LABELS, ["week_start_date", "user_email", "weekly_meetings"]),
        "heatmap": workload.employee_heatmap(load),
        "load_levels": workload.load_level_summary(load).orderBy("level_order"),
        "rows_table": workload.load_table(load),
    }
