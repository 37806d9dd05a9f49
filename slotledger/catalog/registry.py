"""Name -> query and equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotledger.catalog.adapters import Tables
from slotledger.catalog.ctes import with_ctes


@dataclass(frozen=True)
class Entry:
    build: Callable[[Tables], DataFrame]
    sql: str


_ENTRIES: dict[str, Entry] = {}


def query(sql: str, *ctes: str) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a query under its function's name with its SQL, which may use named CTEs."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        _ENTRIES[build.__name__] = Entry(build, with_ctes(sql, *ctes))
        return build

    return register


def _zone_free(df: DataFrame) -> DataFrame:
    """UTC times as plain times, so that the reader's own zone does not show."""
    times = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times}) if times else df


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(entry: Entry) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: _zone_free(entry.build(Tables(spark, sf_dir)))

    return {name: runner(entry) for name, entry in _ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: entry.sql for name, entry in _ENTRIES.items()}
