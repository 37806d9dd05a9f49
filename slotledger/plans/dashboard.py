"""What every report shares: selection, choices to offer and headline figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotledger.functions import numbers
from slotledger.operators.rows import in_channels, in_period
from slotledger.settings import Selection


def select_daily(daily: DataFrame, chosen: Selection) -> DataFrame:
    return in_channels(in_period(daily, "performance_date", chosen.start, chosen.end), chosen.channels)


def select_patterns(patterns: DataFrame, chosen: Selection) -> DataFrame:
    return in_channels(in_period(patterns, "booking_date", chosen.start, chosen.end), chosen.channels)


def select_load(load: DataFrame, chosen: Selection) -> DataFrame:
    """Weeks that start in the period. Employees have no channel."""
    return in_period(load, "week_start_date", chosen.start, chosen.end)


def select_all(
    daily: DataFrame, patterns: DataFrame, load: DataFrame, chosen: Selection
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One selection over the three marts.

    When no channels were picked, time patterns follow the channels that the daily mart shows in the
    period, as a semi-join, so the list of channels never passes through the driver.
    """
    shown = select_daily(daily, chosen)
    if chosen.channels is None:
        within = in_period(patterns, "booking_date", chosen.start, chosen.end)
        return shown, in_channels(within, shown.select("channel").distinct()), select_load(load, chosen)
    return shown, select_patterns(patterns, chosen), select_load(load, chosen)


def filter_options(daily: DataFrame) -> DataFrame:
    """What can be picked: one row with the whole period, and one row per channel with its own.

    Both levels come from one pass. Order by ``option, channel`` for a pick list.
    """
    return (
        daily.groupingSets([["channel"], []], "channel")
        .agg(
            F.when(F.grouping("channel") == 1, "period").otherwise("channel").alias("option"),
            F.min("performance_date").alias("first_date"),
            F.max("performance_date").alias("last_date"),
        )
        .filter((F.col("option") == "period") | F.col("channel").isNotNull())
        .select("option", "channel", "first_date", "last_date")
    )


def spend_figures() -> list:
    """Bookings, spend and their ratio over the rows of a group."""
    bookings, spend = numbers.total(F.col("bookings_count")), numbers.total(F.col("marketing_spend"))
    return [
        bookings.alias("total_bookings"),
        spend.alias("total_spend"),
        numbers.ratio(spend, bookings).alias("overall_cost_per_booking"),
    ]


def headline_kpis(daily: DataFrame) -> DataFrame:
    """Totals of the selection and the dates it spans."""
    return daily.agg(
        *spend_figures(),
        F.min("performance_date").alias("first_date"),
        F.max("performance_date").alias("last_date"),
    )
