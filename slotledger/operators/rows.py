"""Row filters, projections and load stamps."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger.functions.text import default_unknown


def require_not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Rows whose key columns are all present, as plain NOT NULL tests, which file scans understand."""
    return df.filter(reduce(Column.__and__, [F.col(c).isNotNull() for c in columns]))


def drop_missing(df: DataFrame, *columns: str) -> DataFrame:
    """As ``require_not_null``, and a NaN counts as missing too."""
    floating = [c for c in columns if df.schema[c].dataType.typeName() in ("double", "float")]
    rows = require_not_null(df, *columns)
    return rows.filter(reduce(Column.__and__, [~F.isnan(c) for c in floating])) if floating else rows


def since(df: DataFrame, column: str, day: date) -> DataFrame:
    """Rows on or after a day. The bare column is compared, so the bound reaches the file scan."""
    return df.filter(F.col(column) >= F.lit(day))


def in_period(df: DataFrame, column: str, start: date | None, end: date | None) -> DataFrame:
    """Rows of an inclusive period; an end that is not given is open."""
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start))
    return df if end is None else df.filter(F.col(column) <= F.lit(end))


def in_channels(
    df: DataFrame, channels: Sequence[str] | DataFrame | None, column: str = "channel"
) -> DataFrame:
    """Rows of the chosen channels: a list, or a one-column table of any size. An empty choice is empty."""
    if channels is None:
        return df
    if isinstance(channels, DataFrame):
        chosen = channels.select(F.col(channels.columns[0]).alias(column))
        return df.join(chosen, column, "left_semi")
    return df.filter(F.col(column).isin(list(channels)) if channels else F.lit(False))


def fill_unknown(df: DataFrame, *columns: str) -> DataFrame:
    """Empty or missing text becomes ``unknown`` in those of the columns that exist."""
    return df.withColumns({c: default_unknown(F.col(c)) for c in columns if c in df.columns})


def present(df: DataFrame, labels: Mapping[str, str], columns: Iterable[str] | None = None) -> DataFrame:
    """Choose the columns to show and label them for reading; columns the table lacks are left out."""
    shown = df.columns if columns is None else [c for c in columns if c in df.columns]
    return df.select(*[F.col(c).alias(labels.get(c, c)) for c in shown])


def with_load_stamp(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """``processed_at``: the given time, else the start time of the query."""
    stamp = F.current_timestamp() if as_of is None else F.lit(as_of)
    return df.withColumn("processed_at", stamp)
