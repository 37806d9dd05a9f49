"""Tables and marts, and whether they exist."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Collection
from dataclasses import asdict, dataclass

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from slotledger.functions.dates import to_day
from slotledger.operators.rows import fill_unknown

# Date column and text columns that every reader of a mart cleans the same way.
MART_CLEANING = {
    "daily": ("performance_date", ("channel",)),
    "patterns": ("booking_date", ()),
    "load": ("week_start_date", ("user_email",)),
}
_SNAPSHOT = "snapshot="
_VERSIONS = "_versions"
_MART = "_mart"
PART = "stored_part"  # column and folder name of the parts of a split table
EXCLUSIVE = ("file", "hdfs", "viewfs", "abfs", "abfss", "ofs")  # a rename onto an existing file fails there
SINGLE_WRITER = "spark.slotledger.singleWriter"


def _hadoop_path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The path and the file system it lives on, whatever its scheme.

    The only use of the session's private handles; so tables in folders need a classic session, not Spark Connect.
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def load_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """A stored table; with a declared schema no file is opened before the query runs. Of a folder with versions, the current one."""
    number = latest_snapshot(spark, path) if fmt == "parquet" else None
    if number is not None:
        return load_version(spark, path, number, schema=schema)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True if the path holds a committed version, or data files of a plain table; no success marker is needed."""
    return latest_snapshot(spark, path) is not None or has_data(spark, path)


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether there are data files below the path, other than hidden ones and those of snapshots."""
    target, fs = _hadoop_path(spark, path)
    if not fs.exists(target):
        return False
    skipped = ("_", ".", _SNAPSHOT)
    depth, files = len(fs.makeQualified(target).toString().rstrip("/")) + 1, fs.listFiles(target, True)
    while files.hasNext():
        inside = files.next().getPath().toString()[depth:]
        if not any(part.startswith(skipped) for part in inside.split("/")):
            return True
    return False


@dataclass(frozen=True)
class Version:
    """What the record of a version says: its folder, what that must hold, and the folder of the ledger of raw files.

    The folder of a split table holds only the parts that this version wrote. ``parts`` says of every part in which
    version's folder it lies and how many rows it has, and ``schema`` (JSON) is that of the table: older parts may lack
    columns.
    """

    folder: str
    rows: int | None = None
    files: int | None = None
    bytes: int | None = None
    ledger: str | None = None
    export: str | None = None
    parts: dict[str, tuple[str, int]] | None = None
    schema: str | None = None

    def places(self) -> set[str]:
        """Folders, below the table's, of all its rows."""
        return {self.folder} if self.parts is None else {f"{folder}/{PART}={name}" for name, (folder, _) in self.parts.items()}


def _read_text(spark: SparkSession, path: str) -> str:
    target, fs = _hadoop_path(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all records, whole or not, newest first."""
    target, fs = _hadoop_path(spark, f"{root.rstrip('/')}/{_VERSIONS}/*")
    names = (f.getPath().getName() for f in fs.globStatus(target) or [])
    return sorted((int(n) for n in names if n.isdigit()), reverse=True)


def holdings(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """Number and bytes of the data files of a folder, by listing it; None if there is no such folder."""
    target, fs = _hadoop_path(spark, path)
    if not fs.exists(target):
        return None
    files = size = 0
    found = fs.listFiles(target, True)
    while found.hasNext():
        file = found.next()
        if not file.getPath().getName().startswith(("_", ".")):
            files, size = files + 1, size + file.getLen()
    return files, size


def read_version(spark: SparkSession, root: str, number: int) -> Version | None:
    """The record of a version; None if it is torn, or its folder does not hold what the record says.

    Records of earlier releases are the bare name of the folder.
    """
    text = _read_text(spark, f"{root.rstrip('/')}/{_VERSIONS}/{number}")
    if re.fullmatch(_SNAPSHOT + "[0-9a-f]{32}", text):
        version = Version(text)
    else:
        try:
            version = Version(**json.loads(text))
        except (ValueError, TypeError):
            return None
    held = holdings(spark, f"{root.rstrip('/')}/{version.folder}")
    if held is None or (version.files is not None and held != (version.files, version.bytes)):
        return None
    return version


def latest_snapshot(spark: SparkSession, root: str) -> int | None:
    """Number of the newest committed version below ``root``; torn records and uncommitted data are passed over."""
    return next((n for n in _numbers(spark, root) if read_version(spark, root, n)), None)


def new_snapshot_path(root: str) -> str:
    """A folder that no other writer uses."""
    return f"{root.rstrip('/')}/{_SNAPSHOT}{uuid.uuid4().hex}"


def load_version(
    spark: SparkSession, root: str, number: int, only: Collection[str] | None = None, schema: str | StructType | None = None
) -> DataFrame:
    """The rows of a committed version; of a split table ``only`` some parts, and no folder but theirs is listed."""
    version = read_version(spark, root, number)
    if version is None:
        raise FileNotFoundError(f"version {number} of {root} is not whole")
    if version.schema and schema is None:
        schema = StructType.fromJson(json.loads(version.schema))
    keep = [f"/{PART}={name}" for name in (version.parts if only is None else only)] if version.parts is not None else [""]
    paths = [f"{root.rstrip('/')}/{place}" for place in sorted(version.places()) if place.endswith(tuple(keep))]
    if not paths:
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema) if schema else spark.read).parquet(*paths)


def next_number(spark: SparkSession, root: str, newest: int | None) -> int:
    """The version after ``newest``. Numbers of torn records are passed over; a whole one is another writer's version."""
    number, taken = 0 if newest is None else newest + 1, set(_numbers(spark, root))
    while number in taken and read_version(spark, root, number) is None:
        number += 1
    return number


def commit_snapshot(spark: SparkSession, root: str, number: int, version: Version) -> None:
    """Make a written folder version ``number``: its record is written whole under another name, then renamed.

    The rename fails if there is a record of that number. Only file systems on which that is one step for all writers
    are accepted (EXCLUSIVE); for others SINGLE_WRITER must be set, which says that one job at a time writes a table.
    """
    name = f"{root.rstrip('/')}/{_VERSIONS}/{number}"
    target, fs = _hadoop_path(spark, name)
    scheme = fs.makeQualified(target).toUri().getScheme()
    if scheme not in EXCLUSIVE and spark.conf.get(SINGLE_WRITER, "false").lower() != "true":
        raise ValueError(f"renaming is not exclusive on {scheme}://, so two writers could lose rows; set {SINGLE_WRITER} if there is one at a time")
    draft, _ = _hadoop_path(spark, f"{root.rstrip('/')}/{_VERSIONS}/.{uuid.uuid4().hex}")
    hadoop = spark._jvm.org.apache.hadoop.fs
    stream = fs.create(draft, False)
    stream.write(bytearray(json.dumps(asdict(version)).encode()))
    stream.close()
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    never_over = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        context.rename(draft, target, never_over)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(error.java_exception.getClass().getName()) or fs.exists(target):
            folder = f"{root.rstrip('/')}/{version.folder}"
            raise FileExistsError(f"another writer has committed version {number} of {root}; its data and this folder stay: {folder}") from error
        raise


def forget_versions(spark: SparkSession, root: str, keep: int) -> None:
    """Remove all but the newest ``keep`` whole versions, records first. Parts that a kept version uses stay."""
    whole = [(n, v) for n in _numbers(spark, root) if (v := read_version(spark, root, n))]
    used = {place for _, version in whole[:keep] for place in version.places() | {version.folder}}
    for number, version in whole[keep:]:
        target, fs = _hadoop_path(spark, f"{root.rstrip('/')}/{_VERSIONS}/{number}")
        fs.delete(target, False)
        unused = version.places() - used
        if not any(place.startswith(version.folder) for place in used):
            unused.add(version.folder)
        for folder in filter(None, (*(f"{root.rstrip('/')}/{place}" for place in unused), version.export)):
            remove_folder(spark, folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete exactly this folder."""
    target, fs = _hadoop_path(spark, path)
    fs.delete(target, True)


def load_ledger(spark: SparkSession, root: str) -> DataFrame | None:
    """path, modified and length of the raw files in the current version of a snapshot table; None if it has no such list."""
    number = latest_snapshot(spark, root)
    version = None if number is None else read_version(spark, root, number)
    return spark.read.parquet(f"{root.rstrip('/')}/{version.ledger}") if version and version.ledger else None


def load_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """Current version of a snapshot table, and only that one."""
    number = latest_snapshot(spark, root)
    if number is None:
        raise FileNotFoundError(f"no committed snapshot below {root}")
    return load_version(spark, root, number)


def clean_mart(df: DataFrame, kind: str) -> DataFrame:
    """Typed date and filled labels, as every report expects them."""
    day, labels = MART_CLEANING[kind]
    if day in df.columns and df.schema[day].dataType.typeName() != "date":
        df = df.withColumn(day, to_day(F.col(day)))
    return fill_unknown(df, *labels)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    target, fs = _hadoop_path(spark, path)
    stream = fs.create(target, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def exported(spark: SparkSession, path: str) -> str:
    """The folder of the current export: the one that the mart's committed version names, if ``path`` belongs to a mart."""
    link = f"{path.rstrip('/')}/{_MART}"
    target, fs = _hadoop_path(spark, link)
    if not fs.exists(target):
        return path
    mart = _read_text(spark, link)
    number = latest_snapshot(spark, mart)
    version = None if number is None else read_version(spark, mart, number)
    if version is None or version.export is None:
        raise FileNotFoundError(f"no committed version of {mart}, which {path} is an export of")
    return version.export


def load_mart(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A mart export, cleaned: ``kind`` is daily, patterns or load."""
    return clean_mart(load_table(spark, exported(spark, path)), kind)
