"""Raw JSON files with their lineage."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import StructType

from slotledger import schemas
from slotledger.functions.shapes import is_object, shaped, undeclared

UNREADABLE = "unreadable_text"
UNDECLARED = "undeclared_fields"


def with_lineage(df: DataFrame) -> DataFrame:
    """Path and modification time of the file each row came from."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("raw_file_path"),
        F.col("_metadata.file_modification_time").alias("raw_file_modified_at"),
    )


def _since(reader: DataFrameReader, modified_after: datetime | None) -> DataFrameReader:
    """Only files changed later. A moment without a zone is in the session's; one with a zone is taken in UTC."""
    if modified_after is None:
        return reader
    if modified_after.tzinfo is not None:
        reader, modified_after = reader.option("timeZone", "UTC"), modified_after.astimezone(timezone.utc)
    return reader.option("modifiedAfter", modified_after.strftime("%Y-%m-%dT%H:%M:%S"))


def _documents(spark: SparkSession, modified_after: datetime | None) -> DataFrameReader:
    """Whole documents, whatever they hold; a file that is not JSON is kept as text in ``unreadable_text``."""
    reader = spark.read.option("multiLine", True).option("singleVariantColumn", "document").option("columnNameOfCorruptRecord", UNREADABLE)
    return _since(reader.schema(f"document variant, {UNREADABLE} string"), modified_after)


def _as_declared(files: DataFrame, schema: str) -> DataFrame:
    """One row per document, or per element of a file that is an array, in the declared shape and with lineage.

    A field of another type is NULL. It, and every field that the shape does not know, is kept in ``undeclared_fields``
    (JSON, by JSON pointer; NULL if there is none). What is no object has no fields and is unreadable.
    """
    shape, document = StructType.fromDDL(schema), F.col("document")
    lineage = ["raw_file_path", "raw_file_modified_at"]
    elements = F.coalesce(F.try_variant_get(document, "$", "array<variant>"), F.array(document))
    each = with_lineage(files).select(F.explode(elements).alias("document"), UNREADABLE, *lineage)
    text = F.coalesce(F.col(UNREADABLE), F.when(~is_object(document), F.to_json(document)))
    return each.select(
        shaped(document, shape).alias("shaped"), text.alias(UNREADABLE), *lineage, undeclared(document, shape).alias(UNDECLARED)
    ).select("shaped.*", UNREADABLE, *lineage, UNDECLARED)


def list_files(spark: SparkSession, path: str | list[str], recursive: bool = False, modified_after: datetime | None = None) -> DataFrame:
    """path, modified and length of the raw files that a reader of ``path`` would take, without opening them."""
    reader = _since(spark.read.format("binaryFile"), modified_after)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.load(path).select("path", F.col("modificationTime").alias("modified"), "length")


def not_in_ledger(listed: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """The files that are not in the ledger as they are now: new ones, and those changed since they were read."""
    return listed if ledger is None else listed.join(ledger, ["path", "modified", "length"], "left_anti")


def updated_ledger(new: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """The ledger after ``new`` files were read: one row per path."""
    return new if ledger is None else ledger.join(new.select("path"), "path", "left_anti").unionByName(new)


def read_webhooks(
    spark: SparkSession,
    path: str | list[str],
    schema: str = schemas.RAW_WEBHOOK,
    recursive: bool = True,
    modified_after: datetime | None = None,
) -> DataFrame:
    """Booking webhooks, one JSON document per file, from a folder tree or from ``*.json`` of one folder.

    With ``modified_after`` (whole seconds; in its own zone, or else the session's), only files changed later are read.
    By default everything is read; the jobs read what their ledger does not hold. Unreadable documents are rows of their own; see
    ``readable`` and ``unreadable``.
    """
    reader = _documents(spark, modified_after)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    else:
        reader = reader.option("pathGlobFilter", "*.json")
    return _as_declared(reader.json(path), schema)


def read_spend(
    spark: SparkSession, path: str | list[str], schema: str = schemas.RAW_SPEND, modified_after: datetime | None = None
) -> DataFrame:
    """Spend snapshots: each file is a JSON array, each element a row. ``modified_after`` as for webhooks."""
    return _as_declared(_documents(spark, modified_after).json(path), schema)


def readable(raw: DataFrame) -> DataFrame:
    """The documents that are JSON objects."""
    return raw.filter(F.col(UNREADABLE).isNull()).drop(UNREADABLE)


def unreadable(raw: DataFrame) -> DataFrame:
    """The other documents as text, with the files they came from."""
    return raw.filter(F.col(UNREADABLE).isNotNull()).drop(UNDECLARED)
