"""What the operators of this subpackage share: tables, intermediate files, text buffers, free column names."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new name in the shared folder of the cluster; where none is set, in the warehouse, which is shared as well."""
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/slotledger-llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The same rows read from files: computed once, short lineage, and safe when executors are lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns most operators read; other columns cannot clash afterwards. Null text is empty."""
    return docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def with_text(docs: DataFrame, new: Column) -> DataFrame:
    """The same rows and columns with ``new`` as their text where it is not null; a column n_chars of longs follows."""
    name = free_name(docs, "new_text")

    def value(column: str, kind: str) -> Column:
        old, replaced = F.col(f"`{column}`"), F.col(name)
        if column.lower() == "text":
            return F.coalesce(replaced, old).alias(column)
        if column.lower() == "n_chars" and kind == "bigint":
            return F.coalesce(F.char_length(replaced).cast("long"), old).alias(column)
        return old

    return docs.withColumn(name, new).select(*[value(*c) for c in docs.dtypes])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls, and the n + 1 offsets of its values; no copy is made."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and len(buffers[2]) else np.zeros(0, np.uint8)
    return data, offsets.astype(np.int64)


def slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Cut rows into consecutive ranges of about ``most`` bytes; a longer row is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges start, start + 1, ... of the given lengths: the owner of each number, and the number."""
    owner = np.repeat(np.arange(len(starts)), lengths)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return owner, np.repeat(starts, lengths) + within


def mix64(x: np.ndarray) -> np.ndarray:
    """An invertible mix of 64-bit words, so that nearby values end up far apart."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD1342543DE82EF95)
    return x ^ (x >> np.uint64(32))
