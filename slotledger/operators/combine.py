"""Joins that keep both sides or attach a dimension."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger import settings
from slotledger.operators.rows import require_not_null
from slotledger.operators.versions import latest_by


def full_outer_coalesce(
    left: DataFrame, right: DataFrame, keys: Sequence[str], defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Rows of both sides with one copy of the keys; missing measures take their default."""
    defaults = defaults or {}
    l, r = left.alias("l"), right.alias("r")
    matched = reduce(Column.__and__, [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys])

    def measure(side: str, name: str) -> Column:
        value = F.col(f"{side}.{name}")
        return (F.coalesce(value, F.lit(defaults[name])) if name in defaults else value).alias(name)

    return l.join(r, matched, "full_outer").select(
        *[F.coalesce(F.col(f"l.{k}"), F.col(f"r.{k}")).alias(k) for k in keys],
        *[measure("l", c) for c in left.columns if c not in keys],
        *[measure("r", c) for c in right.columns if c not in keys],
    )


def attach_channel(df: DataFrame, mapping: DataFrame, code: str = "event_type_code") -> DataFrame:
    """Channel of each row's code, ``unknown`` when there is none.

    No broadcast hint: the mapping comes from data, so Spark decides from its measured size.
    Give this the aggregated rows, not the raw ones, and a popular code is no hot key.
    """
    dimension = mapping.select(F.col(code), F.col("channel"))
    return df.join(dimension, code, "left").withColumn(
        "channel", F.coalesce("channel", F.lit(settings.UNKNOWN))
    )


def channel_mapping(spend: DataFrame) -> DataFrame:
    """One channel per event type; of several, the first by name.

    Pairs are made distinct first, which hashes in every task and leaves few. A plain minimum would
    sort all rows, as aggregating text does.
    """
    pairs = require_not_null(spend, "event_type_code", "channel").select("event_type_code", "channel").distinct()
    return latest_by(pairs, ["event_type_code"], [F.asc("channel")])
