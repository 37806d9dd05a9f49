"""Business categories as column expressions over the rule tables in ``settings``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotledger import settings


def _first_match(cases: Sequence[tuple[Column, object]], default: object) -> Column:
    (condition, value), *rest = cases
    chain = reduce(lambda acc, case: acc.when(case[0], F.lit(case[1])), rest, F.when(condition, F.lit(value)))
    return chain.otherwise(F.lit(default))


def map_codes(value: Column, codes: Mapping[str, str], default: str | None = settings.UNKNOWN) -> Column:
    """Code of a value from a small literal table."""
    if not codes:
        return F.lit(default)
    return _first_match([(value == key, code) for key, code in codes.items()], default)


def time_slot(hour: Column) -> Column:
    """Named part of the day."""
    *bounded, (last, _) = settings.TIME_SLOTS
    return _first_match([((hour >= 0) & (hour <= end), name) for name, end in bounded], last)


def time_slot_sort(slot: Column) -> Column:
    return category_position(slot, [name for name, _ in settings.TIME_SLOTS], settings.NO_SLOT_SORT)


def category_position(value: Column, order: Sequence[str], missing: int | None = None) -> Column:
    """1-based place of a value in a fixed order."""
    place = F.nullif(F.array_position(F.array(*map(F.lit, order)), value), F.lit(0)).cast("int")
    return place if missing is None else F.coalesce(place, F.lit(missing))


def load_level(weekly_mean: Column) -> Column:
    """Workload band of a weekly mean."""
    *bounded, (lowest, _) = settings.LOAD_LEVELS
    cases = [(weekly_mean.isNull(), settings.UNKNOWN_LABEL)]
    cases += [(weekly_mean >= start, name) for name, start in bounded]
    return _first_match(cases, lowest)


def load_level_sort(level: Column) -> Column:
    order = [name for name, _ in settings.LOAD_LEVELS] + [settings.UNKNOWN_LABEL]
    return category_position(level, order)
