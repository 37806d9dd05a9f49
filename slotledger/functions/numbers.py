"""Money, ratios and lenient numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(12,2)"
# A day's total over a very large table can leave decimal(12,2), so sums keep Spark's wider type.
MONEY_TOTAL = "decimal(22,2)"


def parse_money(amount: Column) -> Column:
    """Two decimals, half up; text that is no number is NULL."""
    return amount.try_cast(MONEY)


def cost_per_booking(spend: Column, bookings: Column) -> Column:
    """Spend per booking in cents, half up; NULL without bookings."""
    return F.when(bookings > 0, F.round(spend / bookings, 2)).cast(MONEY_TOTAL)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Unrounded ratio as double; NULL unless the denominator is positive."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double"))


def round_to_even(value: Column, places: int = 2) -> Column:
    """Report rounding: scale, round to the nearest even integer, scale back, all in double."""
    scale = F.lit(float(10**places))
    return F.rint(value * scale) / scale


def to_number(value: Column, default: float | None = None) -> Column:
    """Number from anything; what is no number, NaN included, becomes ``default`` (NULL unless given)."""
    parsed = F.nullif(value.try_cast("double"), F.lit(float("nan")))
    return parsed if default is None else F.coalesce(parsed, F.lit(float(default)))


def numeric(df: DataFrame, name: str) -> Column:
    """A column as a number: counts and decimals stay as they are, so that their sums are exact."""
    if isinstance(df.schema[name].dataType, (T.IntegralType, T.DecimalType)):
        return F.col(name)
    return to_number(F.col(name))


def numeric_or_zero(df: DataFrame, name: str) -> Column:
    return F.coalesce(numeric(df, name), F.lit(0))


def total(amount: Column) -> Column:
    """Sum that is 0, not NULL, over no values."""
    return F.coalesce(F.sum(amount), F.lit(0))


def mean_of_cents(value: Column) -> Column:
    """Mean of values that have two decimals: summed as decimals, so task order cannot change it."""
    return F.sum(value.cast("decimal(18,2)")).cast("double") / F.count(value)
