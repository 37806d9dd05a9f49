"""Row counts and freshness of pipeline stages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from slotledger import settings


def stage_audit(passes: Sequence[tuple[DataFrame, Mapping[str, tuple[Column, Column]]]]) -> DataFrame:
    """One row per stage: its row count and how many of its rows lack something.

    Stages that can be counted on the same rows are given together, each as its two measures, so every table is
    scanned once however many stages it went through.
    """

    def counted(df: DataFrame, stages: Mapping[str, tuple[Column, Column]]) -> DataFrame:
        measures = [F.struct(F.lit(name).alias("stage"), n.alias("row_count"), k.alias("incomplete_rows")) for name, (n, k) in stages.items()]
        return df.agg(F.array(*measures).alias("stages")).select(F.inline("stages"))

    return reduce(DataFrame.unionAll, [counted(df, stages) for df, stages in passes])


def counted_in_passing(df: DataFrame, name: str, measures: Mapping[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """The same rows; their number, and further measures, are recorded while a later write runs, without a job of its own."""
    observation = Observation(name)
    named = [c.alias(measure) for measure, c in (measures or {}).items()]
    return df.observe(observation, F.count(F.lit(1)).alias("row_count"), *named), observation


def date_profile(df: DataFrame, day: str, n: int = settings.AUDIT_PREVIEW_ROWS) -> DataFrame:
    """Rows per date for the earliest dates: shows how far back a table reaches."""
    return df.groupBy(day).agg(F.count(F.lit(1)).alias("row_count")).orderBy(day).limit(n)
