"""Report on booking times: by hour, weekday, part of the day and channel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotledger import schemas
from slotledger.functions import dates, numbers, rules, text
from slotledger.operators.rows import drop_missing, present
from slotledger.schemas import require_columns
from slotledger.settings import WEEKDAYS

_COUNT = "bookings_count"
# Labels that follow from another column, so they are added to totals instead of to rows.
_LABELS = {
    "hour_of_day": ("hour_display", text.display_hour),
    "time_slot": ("time_slot_display", text.display_slot),
}

# Headings that readers of the reports rely on.
PATTERN_LABELS = {
    "booking_date": "Booking Date",
    "day_of_week_name": "Day",
    "hour_display": "Hour",
    "time_slot_display": "Time Slot",
    "channel_display": "Channel",
    "bookings_count": "Bookings",
    "event_type_code": "Event Type Code",
}


def valid_patterns(patterns: DataFrame) -> DataFrame:
    """Typed rows that have a day, a weekday and an hour, with the channel's label."""
    require_columns(patterns, schemas.TIME_PATTERNS, "booking time report")
    typed = patterns.withColumns(
        {
            "booking_date": dates.to_day(F.col("booking_date")),
            "hour_of_day": numbers.numeric(patterns, "hour_of_day"),
            "day_of_week_number": numbers.numeric(patterns, "day_of_week_number"),
            _COUNT: numbers.numeric_or_zero(patterns, _COUNT),
            "channel_display": text.display_channel(F.col("channel")),
        }
    )
    return drop_missing(typed, "booking_date", "day_of_week_name", "hour_of_day")


def _counted_by(patterns: DataFrame, *keys: str) -> DataFrame:
    """Bookings per group, without the rows that lack a key, with the labels of the keys."""
    groups = drop_missing(valid_patterns(patterns), *keys).groupBy(*keys)
    labels = {name: label(F.col(key)) for key, (name, label) in _LABELS.items() if key in keys}
    return groups.agg(F.sum(_COUNT).alias(_COUNT)).withColumns(labels)


def pattern_kpis(patterns: DataFrame) -> DataFrame:
    return valid_patterns(patterns).agg(numbers.total(F.col(_COUNT)).alias("total_bookings"))


def by_hour(patterns: DataFrame) -> DataFrame:
    return _counted_by(patterns, "hour_of_day")


def by_weekday(patterns: DataFrame) -> DataFrame:
    return _counted_by(patterns, "day_of_week_number", "day_of_week_name")


def by_slot(patterns: DataFrame) -> DataFrame:
    return _counted_by(patterns, "time_slot")


def weekday_hour(patterns: DataFrame) -> DataFrame:
    """Cells that have bookings; order by ``weekday_order, hour_of_day`` to show."""
    return _with_weekday_order(_counted_by(patterns, "day_of_week_name", "hour_of_day"))


def weekday_slot(patterns: DataFrame) -> DataFrame:
    """Cells that have bookings; order by ``weekday_order, slot_order`` to show."""
    cells = _with_weekday_order(_counted_by(patterns, "day_of_week_name", "time_slot"))
    return cells.withColumn("slot_order", rules.time_slot_sort(F.col("time_slot")))


def hour_channel(patterns: DataFrame) -> DataFrame:
    return _counted_by(patterns, "hour_of_day", "channel_display")


def weekday_channel(patterns: DataFrame) -> DataFrame:
    return _counted_by(patterns, "day_of_week_number", "day_of_week_name", "channel_display")


def _with_weekday_order(cells: DataFrame) -> DataFrame:
    return cells.withColumn("weekday_order", rules.category_position(F.col("day_of_week_name"), WEEKDAYS))


def busiest_slots(patterns: DataFrame) -> DataFrame:
    """Busiest hour, weekday and part of the day, one row each; ties go to the earlier key.

    One pass over the rows with three grouping sets, then the best of each few dozen totals.
    """
    hour, number, name, slot = "hour_of_day", "day_of_week_number", "day_of_week_name", "time_slot"
    totals = (
        valid_patterns(patterns)
        .groupingSets([[hour], [number, name], [slot]], hour, number, name, slot)
        .agg(
            F.sum(_COUNT).alias(_COUNT),
            F.when(F.grouping(hour) == 0, "hour")
            .when(F.grouping(number) == 0, "weekday")
            .otherwise("time_slot")
            .alias("busiest"),
        )
        .filter((F.col("busiest") != "weekday") | F.col(number).isNotNull())
        .filter((F.col("busiest") != "time_slot") | F.col(slot).isNotNull())
    )
    label = (
        F.when(F.col("busiest") == "hour", text.display_hour(F.col(hour)))
        .when(F.col("busiest") == "weekday", F.col(name))
        .otherwise(text.display_slot(F.col(slot)))
    )
    return (
        totals.groupBy("busiest")
        .agg(F.min_by(F.struct(label.alias("label"), _COUNT), F.struct(-F.col(_COUNT), hour, number, slot)).alias("top"))
        .select("busiest", "top.*")
    )


def pattern_table(patterns: DataFrame) -> DataFrame:
    """The rows themselves for reading, labelled."""
    labels = {name: label(F.col(key)) for key, (name, label) in _LABELS.items()}
    return present(valid_patterns(patterns).withColumns(labels), PATTERN_LABELS, PATTERN_LABELS)
