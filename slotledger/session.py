"""Session settings the library relies on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Runtime settings, safe to set on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",  # a document that repeats a field is readable; the last one counts
}


# Only for sessions built here: plans are built faster without a Python stack for every expression.
BUILD_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the zone to UTC, so a booking day is the same for every reader, and keep AQE on.

    Jobs and queries call this, so it changes these settings of the session it is given, for good.
    """
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app_name: str = "slotledger", options: Mapping[str, str] | None = None) -> SparkSession:
    """A session with the settings above; the cluster's own come from ``options`` or spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in (BUILD_SETTINGS | dict(options or {})).items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())
