"""Dashboard selections and the six reports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from slotledger.catalog import ctes
from slotledger.catalog.adapters import EVENT_PERIOD, SALES_PERIOD, Tables
from slotledger.catalog.registry import query
from slotledger.operators import ranking
from slotledger.plans import channels, dashboard, patterns, trends, workload
from slotledger.settings import Selection

_SALES = """performance_date BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'
    AND channel IN ('1-urgent', '3-medium', 'unknown')"""
_EVENTS = "BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'"
_CPB = f"{ctes.cost()} AS cost_per_booking"
_TOTALS = """CAST(coalesce(sum(bookings_count), 0) AS BIGINT) AS total_bookings,
    CAST(coalesce(sum(marketing_spend), 0) AS DECIMAL(32,2)) AS total_spend,
    CASE WHEN sum(bookings_count) > 0 THEN CAST(CAST(sum(marketing_spend) AS DECIMAL(32,2)) AS DOUBLE)
        / CAST(sum(bookings_count) AS BIGINT) END AS overall_cost_per_booking"""
_PER_HOUR = f"CAST(hour_of_day AS INTEGER) AS hour_of_day, {ctes.hour_label('hour_of_day')} AS hour_display"
_PER_SLOT = f"time_slot, {ctes.display('time_slot', 'no suffix')} AS time_slot_display"


# Selections


@query(f"SELECT * FROM patterns WHERE booking_date {_EVENTS} AND channel IN ('1-urgent', 'unknown')", "patterns")
def dashboard_filter(t: Tables) -> DataFrame:
    return dashboard.select_patterns(t.patterns(), EVENT_PERIOD)


@query(f"SELECT * FROM perf WHERE {_SALES}", "perf")
def dashboard_filter_daily(t: Tables) -> DataFrame:
    return dashboard.select_daily(t.perf(), SALES_PERIOD)


@query(f"SELECT * FROM load WHERE week_start_date {_EVENTS}", "load")
def dashboard_filter_load(t: Tables) -> DataFrame:
    return dashboard.select_load(t.load(), EVENT_PERIOD)


@query("SELECT * FROM patterns WHERE channel IN (SELECT channel FROM perf)", "patterns", "perf")
def dashboard_filter_shown_channels(t: Tables) -> DataFrame:
    _, shown, _ = dashboard.select_all(t.perf(), t.patterns(), t.load(), Selection())
    return shown


@query(
    """SELECT 'period' AS "option", CAST(NULL AS VARCHAR) AS channel, min(performance_date) AS first_date,
            max(performance_date) AS last_date FROM perf
        UNION ALL SELECT 'channel', channel, min(performance_date), max(performance_date) FROM perf GROUP BY channel""",
    "perf",
)
def filter_options(t: Tables) -> DataFrame:
    return dashboard.filter_options(t.perf())


@query(
    f"SELECT {_TOTALS}, min(performance_date) AS first_date, max(performance_date) AS last_date FROM perf",
    "perf",
)
def headline_kpis(t: Tables) -> DataFrame:
    return dashboard.headline_kpis(t.perf())


# Bookings by day and channel


@query("SELECT performance_date, channel_display, bookings_count FROM cells", "cells")
def daily_channel_bookings(t: Tables) -> DataFrame:
    return channels.daily_channel_bookings(t.perf())


@query(
    """SELECT CAST(sum(bookings_count) AS BIGINT) AS total_bookings, active AS active_days,
            coalesce(CAST(sum(bookings_count) AS DOUBLE) / nullif(active, 0), 0) AS avg_bookings_per_active_day
        FROM cells, (SELECT count(DISTINCT performance_date) AS active FROM cells WHERE bookings_count > 0)
        GROUP BY active""",
    "cells",
)
def activity_kpis(t: Tables) -> DataFrame:
    return channels.activity_kpis(t.perf())


@query(f"SELECT channel_display, {ctes.SUM_N} FROM cells GROUP BY ALL", "cells")
def channel_totals(t: Tables) -> DataFrame:
    return channels.channel_totals(t.perf())


@query(
    f"""SELECT channel_display, {ctes.SUM_N} FROM cells GROUP BY channel_display
        ORDER BY sum(cells.bookings_count) DESC, channel_display LIMIT 1""",
    "cells",
)
def top_channel(t: Tables) -> DataFrame:
    return channels.top_channel(t.perf())


# Cost per booking


@query(f"SELECT *, {_CPB} FROM cells", "cells")
def daily_cpb(t: Tables) -> DataFrame:
    return channels.daily_cpb(t.perf())


@query(
    f"SELECT *, {_CPB} FROM (SELECT channel_display, {ctes.SUM_N}, {ctes.SUM_S} FROM cells GROUP BY ALL)",
    "cells",
)
def channel_cpb(t: Tables) -> DataFrame:
    return channels.channel_cpb(t.perf())


@query(f"SELECT {_TOTALS} FROM perf WHERE performance_date IS NOT NULL", "perf")
def overall_cpb(t: Tables) -> DataFrame:
    return channels.overall_cpb(t.perf())


@query(
    """SELECT channel_display, bookings_count, marketing_spend, cost_per_booking FROM summary
        WHERE cost_per_booking IS NOT NULL ORDER BY cost_per_booking, channel_display LIMIT 1""",
    "summary",
)
def best_cpb_channel(t: Tables) -> DataFrame:
    return channels.best_cpb_channel(t.perf())


@query(
    f"""SELECT performance_date AS "Date", channel_display AS "Channel", bookings_count AS "Bookings",
            {ctes.money("marketing_spend")} AS "Spend", {ctes.money(ctes.cost())} AS "Cost Per Booking" FROM cells""",
    "cells",
)
def daily_cpb_table(t: Tables) -> DataFrame:
    return channels.cost_table(channels.daily_cpb(t.perf()))


# Trend


@query("SELECT * FROM days", "days")
def daily_totals(t: Tables) -> DataFrame:
    return trends.daily_totals(t.perf())


@query(
    """SELECT *, avg(bookings_count) OVER (ORDER BY performance_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
            AS bookings_7_day_avg FROM days""",
    "days",
)
def rolling_total(t: Tables) -> DataFrame:
    return trends.rolling_total(t.perf())


@query("SELECT * FROM grid", "grid")
def calendar_grid(t: Tables) -> DataFrame:
    return trends.channel_grid(t.perf())


@query("SELECT * FROM dense", "dense")
def densify_daily(t: Tables) -> DataFrame:
    return trends.densify_daily(t.perf())


@query(
    """SELECT *, avg(bookings_count) OVER (PARTITION BY channel_display ORDER BY performance_date
            ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS bookings_7_day_avg FROM dense""",
    "dense",
)
def rolling_by_channel(t: Tables) -> DataFrame:
    return trends.rolling_by_channel(t.perf())


@query(
    f"""SELECT channel_display, performance_date + CAST((8 - isodow(performance_date)) % 7 AS INTEGER)
            AS week_start_date, {ctes.SUM_N} FROM dense GROUP BY 1, 2""",
    "dense",
)
def weekly_bookings_wmon(t: Tables) -> DataFrame:
    return trends.weekly_bookings(t.perf())


@query(
    """SELECT total_bookings, latest_day, latest_day_bookings, first_7_day_avg, latest_7_day_avg,
            latest_7_day_avg - first_7_day_avg AS avg_delta
        FROM (SELECT CAST(sum(bookings_count) AS BIGINT) AS total_bookings, max(performance_date) AS latest_day,
                arg_max(bookings_count, performance_date) AS latest_day_bookings,
                arg_min(mean, performance_date) AS first_7_day_avg, arg_max(mean, performance_date) AS latest_7_day_avg
            FROM (SELECT *, avg(bookings_count) OVER (ORDER BY performance_date
                ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS mean FROM days))""",
    "days",
)
def trend_kpis(t: Tables) -> DataFrame:
    return trends.trend_kpis(t.perf())


# Leaderboard


@query("SELECT * FROM leaderboard", "leaderboard")
def channel_leaderboard(t: Tables) -> DataFrame:
    return channels.channel_leaderboard(t.perf())


@query("SELECT * FROM leaderboard", "leaderboard")
def channel_leaderboard_spread(t: Tables) -> DataFrame:
    """The same with the last rank spread by quantiles of its scores, the way for scores of unknown range."""
    board = channels.channel_leaderboard(t.perf())
    return channels.composite_rank(board.drop("performance_score", "overall_rank"))


@query(
    """SELECT * FROM (SELECT 'volume' AS best_by, channel_display, bookings_count, cost_per_booking, overall_rank
            FROM leaderboard ORDER BY bookings_count DESC, cost_per_booking NULLS LAST, channel_display LIMIT 1)
        UNION ALL SELECT * FROM (SELECT 'cost_per_booking', channel_display, bookings_count, cost_per_booking,
            overall_rank FROM leaderboard WHERE cost_per_booking IS NOT NULL
            ORDER BY cost_per_booking, bookings_count DESC, channel_display LIMIT 1)
        UNION ALL SELECT * FROM (SELECT 'overall', channel_display, bookings_count, cost_per_booking, overall_rank
            FROM leaderboard
            ORDER BY overall_rank, cost_per_booking NULLS LAST, bookings_count DESC, channel_display LIMIT 1)""",
    "leaderboard",
)
def best_channels(t: Tables) -> DataFrame:
    return channels.best_channels(channels.channel_leaderboard(t.perf()))


@query(
    f"""SELECT overall_rank AS "Rank", channel_display AS "Channel", bookings_count AS "Bookings",
            {ctes.money("marketing_spend")} AS "Spend", {ctes.money("cost_per_booking")} AS "Cost Per Booking"
        FROM leaderboard""",
    "leaderboard",
)
def leaderboard_table(t: Tables) -> DataFrame:
    return channels.leaderboard_table(channels.channel_leaderboard(t.perf()))


@query("SELECT * FROM metrics", "metrics")
def unpivot_metrics(t: Tables) -> DataFrame:
    return ranking.unpivot_metrics(channels.channel_summary(t.perf()), "channel_display")


@query(
    f"""SELECT * EXCLUDE (low, high, score), CASE WHEN metric = 'cost_per_booking' THEN 1 - score ELSE score END
                AS normalized_score,
            CASE WHEN metric = 'bookings_count' THEN {ctes.count("metric_value")} ELSE {ctes.money("metric_value")} END
                AS metric_value_display
        FROM (SELECT *, CASE WHEN low IS NULL OR low = high THEN 0.5::DOUBLE
                ELSE (metric_value - low) / (high - low) END AS score
            FROM (SELECT *, min(metric_value) OVER (PARTITION BY metric) AS low,
                max(metric_value) OVER (PARTITION BY metric) AS high FROM metrics))""",
    "metrics",
)
def metric_heatmap(t: Tables) -> DataFrame:
    return channels.metric_heatmap(channels.channel_summary(t.perf()))


# Booking times


@query(
    "SELECT CAST(coalesce(sum(bookings_count), 0) AS BIGINT) AS total_bookings FROM patterns",
    "patterns",
)
def pattern_kpis(t: Tables) -> DataFrame:
    return patterns.pattern_kpis(t.patterns())


@query(f"SELECT {_PER_HOUR}, {ctes.SUM_N} FROM patterns GROUP BY ALL", "patterns")
def bookings_by_hour(t: Tables) -> DataFrame:
    return patterns.by_hour(t.patterns())


@query(f"SELECT day_of_week_number, day_of_week_name, {ctes.SUM_N} FROM patterns GROUP BY ALL", "patterns")
def bookings_by_weekday(t: Tables) -> DataFrame:
    return patterns.by_weekday(t.patterns())


@query(f"SELECT {_PER_SLOT}, {ctes.SUM_N} FROM patterns GROUP BY ALL", "patterns")
def bookings_by_slot(t: Tables) -> DataFrame:
    return patterns.by_slot(t.patterns())


@query(
    f"""SELECT day_of_week_name, {ctes.weekday_sort("day_of_week_name")} AS weekday_order, {_PER_HOUR}, {ctes.SUM_N}
        FROM patterns GROUP BY ALL""",
    "patterns",
)
def weekday_hour(t: Tables) -> DataFrame:
    return patterns.weekday_hour(t.patterns())


@query(
    f"""SELECT day_of_week_name, {ctes.weekday_sort("day_of_week_name")} AS weekday_order, {_PER_SLOT},
            {ctes.slot_sort("time_slot")} AS slot_order, {ctes.SUM_N} FROM patterns GROUP BY ALL""",
    "patterns",
)
def weekday_slot(t: Tables) -> DataFrame:
    return patterns.weekday_slot(t.patterns())


@query(f"SELECT {_PER_HOUR}, {ctes.DISPLAY} AS channel_display, {ctes.SUM_N} FROM patterns GROUP BY ALL", "patterns")
def hour_channel(t: Tables) -> DataFrame:
    return patterns.hour_channel(t.patterns())


@query(
    f"""SELECT day_of_week_number, day_of_week_name, {ctes.DISPLAY} AS channel_display, {ctes.SUM_N}
        FROM patterns GROUP BY ALL""",
    "patterns",
)
def weekday_channel(t: Tables) -> DataFrame:
    return patterns.weekday_channel(t.patterns())


@query(
    f"""SELECT * FROM (SELECT 'hour' AS busiest, {ctes.hour_label("hour_of_day")} AS label, {ctes.SUM_N}
            FROM patterns GROUP BY hour_of_day ORDER BY sum(patterns.bookings_count) DESC, hour_of_day LIMIT 1)
        UNION ALL SELECT * FROM (SELECT 'weekday', day_of_week_name, {ctes.SUM_N} FROM patterns
            GROUP BY day_of_week_number, day_of_week_name
            ORDER BY sum(patterns.bookings_count) DESC, day_of_week_number LIMIT 1)
        UNION ALL SELECT * FROM (SELECT 'time_slot', {ctes.display("time_slot", "no suffix")}, {ctes.SUM_N}
            FROM patterns GROUP BY time_slot ORDER BY sum(patterns.bookings_count) DESC, time_slot LIMIT 1)""",
    "patterns",
)
def busiest_slots(t: Tables) -> DataFrame:
    return patterns.busiest_slots(t.patterns())


@query(
    f"""SELECT booking_date AS "Booking Date", day_of_week_name AS "Day", {ctes.hour_label("hour_of_day")} AS "Hour",
            {ctes.display("time_slot", "no suffix")} AS "Time Slot", {ctes.DISPLAY} AS "Channel",
            bookings_count AS "Bookings", event_type_code AS "Event Type Code" FROM patterns""",
    "patterns",
)
def pattern_table(t: Tables) -> DataFrame:
    return patterns.pattern_table(t.patterns())


# Meeting load


@query("SELECT * FROM employees", "employees")
def employee_leaderboard(t: Tables) -> DataFrame:
    return workload.employee_leaderboard(t.load())


@query(
    """SELECT week_start_date, user_email, CAST(sum(weekly_meetings) AS BIGINT) AS weekly_meetings,
            strftime(week_start_date, '%Y-%m-%d') AS week_label FROM load GROUP BY ALL""",
    "load",
)
def employee_weekly(t: Tables) -> DataFrame:
    return workload.employee_weekly(t.load())


@query(
    """SELECT l.week_start_date, l.user_email, l.weekly_meetings, strftime(l.week_start_date, '%Y-%m-%d') AS week_label,
            e.avg_meetings_per_week, e.total_meetings
        FROM load l JOIN employees e USING (user_email)""",
    "employees",
)
def employee_heatmap(t: Tables) -> DataFrame:
    return workload.employee_heatmap(t.load())


@query(
    """SELECT load_level, count(*) AS employee_count, CAST(sum(total_meetings) AS BIGINT) AS total_meetings,
            round_even(CAST(sum(CAST(avg_meetings_per_week AS DECIMAL(18,2))) AS DOUBLE) / count(*) * 100, 0) / 100
                AS avg_meetings_per_week,
            CAST(CASE load_level WHEN 'Very high' THEN 1 WHEN 'High' THEN 2 WHEN 'Moderate' THEN 3 WHEN 'Low' THEN 4
                ELSE 5 END AS INTEGER) AS level_order
        FROM employees GROUP BY load_level""",
    "employees",
)
def load_level_summary(t: Tables) -> DataFrame:
    return workload.load_level_summary(t.load())


@query(
    """SELECT CAST(sum(total_meetings) AS BIGINT) AS total_meetings, count(*) AS active_employees,
            CAST(sum(CAST(avg_meetings_per_week AS DECIMAL(18,2))) AS DOUBLE) / count(*)
                AS avg_meetings_per_employee_week,
            max(max_meetings_in_week) AS highest_weekly_load,
            (SELECT user_email FROM employees ORDER BY avg_meetings_per_week DESC, total_meetings DESC, user_email
                LIMIT 1) AS busiest_employee FROM employees""",
    "employees",
)
def employee_kpis(t: Tables) -> DataFrame:
    return workload.employee_kpis(t.load())


@query(
    "SELECT * FROM employees ORDER BY avg_meetings_per_week DESC, total_meetings DESC, user_email LIMIT 1",
    "employees",
)
def busiest_employee(t: Tables) -> DataFrame:
    return workload.busiest_employee(t.load())
