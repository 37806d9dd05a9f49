"""Overwrites, exports, and merging batches into stored tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotledger.operators.audit import counted_in_passing
from slotledger.operators.versions import Side, upsert
from slotledger.sources.tables import (
    PART,
    Version,
    commit_snapshot,
    forget_versions,
    has_data,
    holdings,
    latest_snapshot,
    load_table,
    load_version,
    new_snapshot_path,
    next_number,
    read_version,
    write_text,
)

NO_PART = "none"  # the part of rows whose split is NULL
FILE_FORMATS = ("parquet", "orc", "csv", "json", "text", "avro", "xml", "binaryfile", "hive")


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    replace_schema: bool = False,
) -> None:
    """Create or fully replace a table. Plain Parquet takes any new schema; a table format is told to.

    A folder of Parquet is replaced in one step: the rows go to a folder of their own, which a record then makes the
    current version (see load_table). The version before it stays for readers that have begun; older ones are removed.
    Rows of a partitioned table are rebalanced by partition first: adaptive execution gives a large
    partition several tasks and small ones a common task, instead of every task a file in each.
    """
    if fmt == "parquet":
        newest = latest_snapshot(df.sparkSession, path)
        _commit_written(df.sparkSession, path, newest, _write_files(df, new_snapshot_path(path), partition_by))
        forget_versions(df.sparkSession, path, 2)
        return
    writer = _rebalanced(df, partition_by).write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if replace_schema:
        writer = writer.option("overwriteSchema", "true")
    writer.save(path)


def _rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def _write_files(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    writer = _rebalanced(df, partition_by).write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def _commit_written(
    spark: SparkSession, root: str, newest: int | None, path: str, ledger: str | None = None, export: str | None = None
) -> int:
    """Commit a written folder as the version after ``newest``; the record says what the folder holds."""
    number = next_number(spark, root, newest)
    files, size = holdings(spark, path)
    rows = spark.read.parquet(path).count() if files else 0  # from the files' footers
    commit_snapshot(spark, root, number, Version(path.rsplit("/", 1)[1], rows, files, size, ledger, export))
    return number


def export_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def publish_mart(df: DataFrame, table_path: str, export_path: str, fmt: str = "parquet") -> int:
    """Build a mart once and export what was written, so both copies hold the same rows and load stamp.

    Both are folders of their own that one record names, so readers of either (load_table, load_mart) see the old
    rows or the new ones, and never a half or an empty mart. With another format the mart is replaced as that format
    does, and the export after it. Returns the number of rows, counted while they are written.
    """
    spark = df.sparkSession
    counted, rows = counted_in_passing(df, table_path)
    if fmt != "parquet":
        write_table(counted, table_path, fmt, replace_schema=True)
        write_table(load_table(spark, table_path, fmt), export_path)
        return rows.get["row_count"]
    newest = latest_snapshot(spark, table_path)
    path = _write_files(counted, new_snapshot_path(table_path))
    export = _write_files(spark.read.schema(df.schema).parquet(path), new_snapshot_path(export_path))
    write_text(spark, f"{export_path.rstrip('/')}/_mart", table_path)
    _commit_written(spark, table_path, newest, path, export=export)
    forget_versions(spark, table_path, 2)
    return rows.get["row_count"]


def write_snapshot(df: DataFrame, root: str, newest: int | None = None, ledger: str | None = None) -> int:
    """Write the version after ``newest`` (the one the rows were made from) beside it, and commit it by a record.

    The data goes to a folder of its own, and only one writer can create a version's record. A job that dies half way,
    or a second writer of the same version, leaves the table as it was; the second one fails and can run again. A first
    version is refused where other data lies. ``ledger`` names the folder that lists the raw files in this version.
    """
    if newest is None:
        _refuse_hiding(df.sparkSession, root)
    return _commit_written(df.sparkSession, root, newest, _write_files(df, new_snapshot_path(root)), ledger)


def _refuse_hiding(spark: SparkSession, root: str) -> None:
    """Fail where a first version would hide other rows."""
    if latest_snapshot(spark, root) is not None:
        raise FileExistsError(f"{root} has versions already")
    if has_data(spark, root):
        raise FileExistsError(f"{root} holds data that is not a committed version; it would be hidden by a first one")


class RepeatedKeysError(ValueError):
    """A batch holds a key more than once, so that a merge could not tell which of its rows counts."""


def refuse_repeats(batch: DataFrame, keys: Sequence[str]) -> None:
    """Fail if two rows share a key, as MERGE does; NULL keys match nothing and may repeat. Only keys are read and shuffled."""
    repeated = batch.dropna(subset=list(keys)).groupBy(*keys).count().filter("count > 1").first()
    if repeated:
        raise RepeatedKeysError(f"the batch has {repeated['count']} rows with {', '.join(f'{k}={repeated[k]}' for k in keys)}")


def upsert_snapshot(
    spark: SparkSession,
    root: str,
    batch: DataFrame,
    keys: Sequence[str],
    update_when: Callable[[Side, Side], Column] | None = None,
    ledger: str | None = None,
    split_by: Column | None = None,
) -> tuple[int, int]:
    """Create the table from the batch, or merge the batch into its current version.

    Returns the version and its number of rows. A batch that repeats a key is refused. With ``split_by`` the rows of
    each of its values (text, or what casts to it) are a part, and a version writes only the parts that the batch
    touches; without it each version is a full copy. A table changes from one way to the other by a merge.
    """
    refuse_repeats(batch, keys)
    newest = latest_snapshot(spark, root)
    if split_by is not None:
        return _upsert_parts(spark, root, newest, batch, keys, update_when, ledger, split_by)
    rows = batch if newest is None else upsert(load_version(spark, root, newest), batch, keys, update_when)
    counted, count = counted_in_passing(rows, root)
    return write_snapshot(counted, root, newest, ledger), count.get["row_count"]


def _touched(table: DataFrame, batch: DataFrame, keys: Sequence[str], part: Column) -> set[str]:
    """Parts that hold keys of the batch, or will hold its rows. Of the table only keys are read; names of parts come back."""
    own = F.regexp_extract("_metadata.file_path", f"/{PART}=([^/]+)/", 1)
    holding = table.select(*keys, own.alias(PART)).join(batch.select(*keys), list(keys), "left_semi").select(PART)
    names = holding.union(batch.select(part.alias(PART))).distinct()
    return set(names.agg(F.collect_set(PART)).first()[0])


def _upsert_parts(
    spark: SparkSession,
    root: str,
    newest: int | None,
    batch: DataFrame,
    keys: Sequence[str],
    update_when: Callable[[Side, Side], Column] | None,
    ledger: str | None,
    split_by: Column,
) -> tuple[int, int]:
    """Merge into the touched parts, write those anew, and commit them together with the folders of all others.

    A row that moves to another part leaves the one that held it, as both are touched. A part that is split by
    something else than the rest would be replaced by a few of its rows; that is found before the commit and refused.
    """
    part = F.coalesce(split_by.cast("string"), F.lit(NO_PART))
    version = None if newest is None else read_version(spark, root, newest)
    stay: dict[str, tuple[str, int]] = {}
    if version is None:
        _refuse_hiding(spark, root)
        rows = batch
    elif not version.parts:
        rows = upsert(load_version(spark, root, newest), batch, keys, update_when)
    else:
        touched = _touched(load_version(spark, root, newest), batch, keys, part)
        stay = {name: tuple(place) for name, place in version.parts.items() if name not in touched}
        rows = upsert(load_version(spark, root, newest, touched), batch, keys, update_when)
    parted = rows.withColumn(PART, part)
    path = _write_files(parted, new_snapshot_path(root), [PART])
    sizes = spark.read.schema(parted.schema).parquet(path).groupBy(PART).count()
    written = dict(sizes.agg(F.collect_list(F.struct(PART, "count"))).first()[0])
    if unfit := [name for name in written if name in stay or not re.fullmatch(r"[\w.+-]+", name, re.ASCII)]:
        raise ValueError(f"{root} is split by something else, or this is no name of a part: {', '.join(sorted(unfit)[:3])}")
    folder = path.rsplit("/", 1)[1]
    parts = stay | {name: (folder, n) for name, n in written.items()}
    total = sum(n for _, n in parts.values())
    files, size = holdings(spark, path)
    number = next_number(spark, root, newest)
    commit_snapshot(spark, root, number, Version(folder, total, files, size, ledger, parts=parts, schema=rows.schema.json()))
    return number, total


def _can_merge(spark: SparkSession, table: str, provider: str | None) -> bool:
    """Whether a table that would be created now could take MERGE: plain files cannot, table formats and catalogs can."""
    parts = table.split(".")
    own_catalog = len(parts) > 2 or (len(parts) == 2 and spark.conf.get(f"spark.sql.catalog.{parts[0]}", None) is not None)
    replaced = spark.conf.get("spark.sql.catalog.spark_catalog", None) is not None
    if provider is None:
        if own_catalog or replaced:
            return True
        provider = spark.conf.get("spark.sql.sources.default")
    return provider.lower() not in FILE_FORMATS


def merge_into_table(
    batch: DataFrame,
    table: str,
    keys: Sequence[str],
    update_when: Callable[[Side, Side], Column] | None = None,
    provider: str | None = None,
) -> None:
    """The same merge by MERGE INTO, for catalogs with row-level changes, which rewrite only touched files.

    The first batch creates the table, with ``provider`` or the catalog's own format; a format that could not take the
    second batch is refused before anything is created.
    """
    spark = batch.sparkSession
    refuse_repeats(batch, keys)
    if not spark.catalog.tableExists(table):
        if not _can_merge(spark, table, provider):
            raise ValueError(f"{table} would be a table of plain files, which cannot take MERGE; name a provider or catalog that can")
        writer = batch.writeTo(table)
        (writer.using(provider) if provider else writer).create()
        return
    t: Side = lambda name: F.col(f"{table}.{name}")
    b: Side = lambda name: F.col(f"batch.{name}")
    matched = reduce(Column.__and__, [t(k) == b(k) for k in keys])
    merge = batch.alias("batch").mergeInto(table, matched)
    condition = update_when(t, b) if update_when else None
    when_matched = merge.whenMatched(condition) if condition is not None else merge.whenMatched()
    when_matched.updateAll().whenNotMatched().insertAll().merge()
