"""Results that are needed more than once, stored in between."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from slotledger.sources.tables import remove_folder

_SETTING = "spark.checkpoint.dir"


def staging_folder(spark: SparkSession) -> str:
    """The shared folder that the cluster names."""
    shared = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    return shared.rstrip("/")


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """The same rows, read from files: computed once, and still there when executors are lost; removed at the end."""
    spark, path = df.sparkSession, f"{staging_folder(df.sparkSession)}/slotledger-{uuid.uuid4()}"
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_folder(spark, path)
