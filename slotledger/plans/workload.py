"""Report on meeting load per employee, recomputed from the weeks in the selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slotledger import schemas
from slotledger.functions import dates, numbers, rules, text
from slotledger.operators.ranking import top_one
from slotledger.operators.rows import drop_missing, present
from slotledger.schemas import require_columns

# Headings that readers of the reports rely on.
LOAD_LABELS = {
    "user_email": "Employee",
    "week_start_date": "Week Starting",
    "weekly_meetings": "Weekly Meetings",
    "total_meetings": "Total Meetings",
    "number_of_weeks": "Weeks Active",
    "avg_meetings_per_week": "Avg Meetings / Week",
    "max_meetings_in_week": "Max Meetings In One Week",
    "load_level": "Load Level",
    "first_booking_date_in_week": "First Booking Date In Week",
    "last_booking_date_in_week": "Last Booking Date In Week",
}


# Columns that a report shows if the table has them, read as leniently as the required ones.
OPTIONAL_NUMBERS = ("total_meetings", "number_of_weeks", "avg_meetings_per_week", "max_meetings_in_week")
OPTIONAL_DATES = ("first_booking_date_in_week", "last_booking_date_in_week")


def valid_load(load: DataFrame) -> DataFrame:
    """Typed rows that have a week, with one spelling per employee."""
    require_columns(load, schemas.MEETING_LOAD, "meeting load report")
    typed = load.withColumns(
        {
            "user_email": text.normalize_email(F.col("user_email")),
            "week_start_date": dates.to_day(F.col("week_start_date")),
            "weekly_meetings": numbers.numeric_or_zero(load, "weekly_meetings"),
        }
        | {c: numbers.numeric(load, c) for c in OPTIONAL_NUMBERS if c in load.columns}
        | {c: dates.to_day(F.col(c)) for c in OPTIONAL_DATES if c in load.columns}
    )
    return drop_missing(typed, "week_start_date")


def employee_leaderboard(load: DataFrame) -> DataFrame:
    """Totals, mean week and load level per employee. Order by ``leaderboard_order()`` to show."""
    return (
        valid_load(load)
        .groupBy("user_email")
        .agg(
            F.sum("weekly_meetings").alias("total_meetings"),
            F.count_distinct("week_start_date").alias("number_of_weeks"),
            numbers.round_to_even(F.avg("weekly_meetings")).alias("avg_meetings_per_week"),
            F.max("weekly_meetings").alias("max_meetings_in_week"),
        )
        .withColumn("load_level", rules.load_level(F.col("avg_meetings_per_week")))
    )


def leaderboard_order() -> list:
    return [F.desc("avg_meetings_per_week"), F.desc("total_meetings"), F.asc("user_email")]


def employee_kpis(load: DataFrame) -> DataFrame:
    """Meetings, employees, mean of their weekly means, largest week and the busiest employee."""
    first = F.struct(-F.col("avg_meetings_per_week"), -F.col("total_meetings"), "user_email")
    return employee_leaderboard(load).agg(
        numbers.total(F.col("total_meetings")).alias("total_meetings"),
        F.count("user_email").alias("active_employees"),
        numbers.mean_of_cents(F.col("avg_meetings_per_week")).alias("avg_meetings_per_employee_week"),
        F.max("max_meetings_in_week").alias("highest_weekly_load"),
        F.min_by("user_email", first).alias("busiest_employee"),
    )


def busiest_employee(load: DataFrame) -> DataFrame:
    return top_one(employee_leaderboard(load), leaderboard_order())


def employee_weekly(load: DataFrame) -> DataFrame:
    """Meetings per week and employee, with the week as text."""
    weekly = (
        valid_load(load)
        .groupBy("week_start_date", "user_email")
        .agg(F.sum("weekly_meetings").alias("weekly_meetings"))
    )
    return weekly.withColumn("week_label", dates.day_label(F.col("week_start_date")))


def employee_heatmap(load: DataFrame) -> DataFrame:
    """Weekly cells with the employee's leaderboard figures, which give the order of employees.

    Cells carry how many rows they hold, so a window over an employee's weeks gives the mean over rows.
    """
    cells = (
        valid_load(load)
        .groupBy("week_start_date", "user_email")
        .agg(F.sum("weekly_meetings").alias("weekly_meetings"), F.count(F.lit(1)).alias("_rows"))
    )
    employee = Window.partitionBy("user_email")
    total, rows = F.sum("weekly_meetings").over(employee), F.sum("_rows").over(employee)
    return cells.select(
        "week_start_date",
        "user_email",
        "weekly_meetings",
        dates.day_label(F.col("week_start_date")).alias("week_label"),
        numbers.round_to_even(numbers.ratio(total, rows)).alias("avg_meetings_per_week"),
        total.alias("total_meetings"),
    )


def load_level_summary(load: DataFrame) -> DataFrame:
    """Employees and meetings per load level. Order by ``level_order`` to show."""
    summary = (
        employee_leaderboard(load)
        .groupBy("load_level")
        .agg(
            F.count("user_email").alias("employee_count"),
            F.sum("total_meetings").alias("total_meetings"),
            numbers.round_to_even(numbers.mean_of_cents(F.col("avg_meetings_per_week"))).alias(
                "avg_meetings_per_week"
            ),
        )
    )
    return summary.withColumn("level_order", rules.load_level_sort(F.col("load_level")))


def load_table(load: DataFrame) -> DataFrame:
    """The weekly rows for reading; columns that a mart lacks are left out."""
    return present(valid_load(load), LOAD_LABELS, [c for c in LOAD_LABELS if c != "load_level"])


def leaderboard_table(leaderboard: DataFrame) -> DataFrame:
    return present(leaderboard, LOAD_LABELS)
