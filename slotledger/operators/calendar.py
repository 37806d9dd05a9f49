"""Dense calendars and trailing means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slotledger.operators.rows import require_not_null
from slotledger.settings import TRAILING_ROWS


def _span(df: DataFrame, day: str, *also: str) -> Column:
    """First and last day of a table as one struct, computed once as a scalar subquery.

    ``also`` names the other columns the outer query reads. They ride along behind the day in the
    compared structs, so both plans need the same columns and Spark runs the table's shuffle once.
    """
    row = F.struct(day, *also)
    return df.agg(
        F.struct(F.min(row)[day].alias("first"), F.max(row)[day].alias("last")).alias("span")
    ).scalar()


def _days(first: Column, last: Column, step_days: int) -> Column:
    return F.explode(F.sequence(first, last, F.expr(f"interval {step_days} days")))


def calendar_grid(df: DataFrame, day: str, series: str, step_days: int = 1) -> DataFrame:
    """Every day between the first and the last for every series.

    The span is a scalar, so each distinct series expands by itself and no join is needed.
    """
    dated = require_not_null(df, day).select(day, series)
    spanned = dated.select(series).distinct().withColumn("_span", _span(dated, day))
    return spanned.select(_days(F.col("_span.first"), F.col("_span.last"), step_days).alias(day), series)


def densify(df: DataFrame, day: str, series: str, value: str, fill: object = 0, step_days: int = 1) -> DataFrame:
    """Add the missing days of every series with ``fill`` as their value.

    ``df`` holds one row per series and day. Each row expands over the gap up to the next row of its
    series, the first also back to the overall start and the last to the overall end. That gives the
    rows of the grid joined with the data, from one pass and without the join.
    """
    rows = require_not_null(df, day).select(day, series, value)
    in_order = Window.partitionBy(series).orderBy(day)
    gaps = rows.select(
        series,
        value,
        F.col(day).alias("_own"),
        F.lag(day).over(in_order).alias("_before"),
        F.lead(day).over(in_order).alias("_after"),
    ).withColumn("_span", _span(rows, day, series, value))
    first = F.when(F.col("_before").isNull(), F.col("_span.first")).otherwise(F.col("_own"))
    last = F.coalesce(F.date_sub("_after", step_days), F.col("_span.last"))
    return gaps.select(series, value, "_own", _days(first, last, step_days).alias(day)).select(
        day, series, F.when(F.col("_own") == F.col(day), F.col(value)).otherwise(F.lit(fill)).alias(value)
    )


RANGES = 64


def rolling_mean(
    df: DataFrame, order: str, value: str, name: str, rows: int = TRAILING_ROWS, by: str | None = None
) -> DataFrame:
    """Mean over this and the ``rows - 1`` rows before it, or fewer at the start.

    Without ``by`` and ordered by a date, all rows share one window, so ``df`` must hold one row per day: a date column
    has fewer than four million values, whatever the table's size. Ordered by anything else, e.g. a time, the rows are
    cut into ranges, and each range also gets the ``rows - 1`` rows that come before it, so no task holds them all.
    """
    if by is None and df.schema[order].dataType.typeName() != "date":
        return _rolling_in_ranges(df, order, value, name, rows)
    window = Window.partitionBy(by) if by else Window.partitionBy()
    trailing = window.orderBy(order).rowsBetween(1 - rows, Window.currentRow)
    return df.withColumn(name, F.avg(value).over(trailing))


def _rolling_in_ranges(df: DataFrame, order: str, value: str, name: str, rows: int) -> DataFrame:
    """Ranges of the order column come from approximate quantiles, which only divide the work.

    The last ``rows - 1`` rows of each range go to all later ones as well, so that short ranges do no harm. Rows of one
    order value are in one range, and are ordered by ``value``; a column that is no number or time is a single range.
    """
    place = F.expr(f"try_cast(`{order}` AS double)")
    parts = [i / RANGES for i in range(1, RANGES)]
    bounds = df.agg(F.percentile_approx(place, parts, 1000)).scalar()
    lower = F.filter("_bounds", lambda b: b < F.col("_size"))
    ranged = df.select("*", place.alias("_size"), bounds.alias("_bounds"))
    ranged = ranged.select(*df.columns, F.coalesce(F.when(F.col("_bounds").isNotNull(), F.size(lower)), F.lit(0)).alias("_range"))
    from_end = F.row_number().over(Window.partitionBy("_range").orderBy(F.col(order).desc(), F.col(value).desc()))
    later = F.when((from_end < rows) & (F.col("_range") < RANGES), F.sequence(F.col("_range") + 1, F.lit(RANGES)))
    sent = ranged.withColumn("_to", F.concat(F.array("_range"), F.coalesce(later, F.array().cast("array<int>"))))
    shared = sent.select(*df.columns, "_range", F.explode("_to").alias("_to"))
    trailing = Window.partitionBy("_to").orderBy(order, value).rowsBetween(1 - rows, Window.currentRow)
    return shared.withColumn(name, F.avg(value).over(trailing)).filter("_range = _to").drop("_range", "_to")
