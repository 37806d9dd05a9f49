"""The batch jobs: raw files into tables, tables into marts, marts into a dashboard."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotledger import settings
from slotledger.operators.audit import counted_in_passing
from slotledger.operators.versions import Side, is_keyed
from slotledger.plans import dashboard, marts, silver
from slotledger.session import configure
from slotledger.sinks.staging import staged
from slotledger.sinks.tables import merge_into_table, publish_mart, upsert_snapshot
from slotledger.sources.raw import UNDECLARED, UNREADABLE, list_files, not_in_ledger, read_spend, read_webhooks, readable, unreadable, updated_ledger
from slotledger.sources.tables import latest_snapshot, load_ledger, load_mart, load_snapshot, table_exists

MARTS = ("daily", "patterns", "load")


@dataclass(frozen=True)
class Ingested:
    """The table's new version (a catalog keeps its own), and what was counted on the way.

    ``counts``: rows of the table after the merge (not with a catalog, which knows them), documents that could not be read, and batch rows that lack a date,
    an amount or a known event type.
    """

    version: int | None
    raw_rows: int
    batch_rows: int
    counts: Mapping[str, int] = field(default_factory=dict, compare=False)


@dataclass(frozen=True)
class Source:
    """How raw files are found and parsed, and whether those that an earlier run has merged are read again."""

    path: str
    read: Callable[..., DataFrame]
    recursive: bool
    modified_after: datetime | None
    everything: bool


def _ingest(
    spark: SparkSession,
    source: Source,
    clean: Callable[[DataFrame], DataFrame],
    measures: Mapping[str, Column],
    table: str,
    in_catalog: bool,
    keys: Sequence[str],
    update_when: Callable[[Side, Side], Column] | None,
    split_by: Column,
    provider: str | None,
) -> Ingested:
    """Read new and changed files, clean, store and merge them; everything is counted while it is stored.

    The ledger of a snapshot table is part of its version, so a file is in it if and only if its rows are in the table.
    Files are listed before they are read: one that changes in between is read again by the next run, which does no harm.
    Fields that the declared shape does not know go along in ``undeclared_fields``, unless a catalog table lacks that column.
    Documents that cannot be read are not merged. In a snapshot table their text and file go to ``_unreadable`` below
    it, once; with a catalog they stay in the raw folder, and their number is returned.
    """
    ledger = None if in_catalog else load_ledger(spark, table)
    with staged(list_files(spark, source.path, source.recursive, source.modified_after)) as listed:
        new = listed if source.everything else not_in_ledger(listed, ledger)
        if ledger is None or source.everything:
            raw = source.read(spark, source.path, modified_after=source.modified_after)
        elif paths := new.agg(F.collect_list("path")).first()[0]:  # a reader takes its files by name
            raw = source.read(spark, paths)
        else:
            rows = load_snapshot(spark, table).count()  # from the files' footers
            return Ingested(latest_snapshot(spark, table), 0, 0, {"unreadable": 0, **dict.fromkeys(measures, 0), "table_rows": rows})
        counted, raw_rows = counted_in_passing(raw, "raw", {"unreadable": F.count_if(F.col(UNREADABLE).isNotNull())})
        batch, batch_rows = counted_in_passing(clean(readable(counted)), "batch", measures)
        with staged(batch) as batch:
            found = {"unreadable": raw_rows.get["unreadable"]} | {name: batch_rows.get[name] for name in measures}
            if in_catalog:
                if spark.catalog.tableExists(table) and UNDECLARED not in spark.table(table).columns:
                    batch = batch.drop(UNDECLARED)  # the owner of a catalog table decides on its columns
                merge_into_table(batch, table, keys, update_when, provider)
                version = None
            else:
                if found["unreadable"]:
                    keep_unreadable(raw, f"{table.rstrip('/')}/_unreadable")
                folder = f"_ledger/{uuid.uuid4().hex}"
                updated_ledger(new, ledger).write.parquet(f"{table.rstrip('/')}/{folder}")
                version, found["table_rows"] = upsert_snapshot(spark, table, batch, keys, update_when, folder, split_by)
    return Ingested(version, raw_rows.get["row_count"] - found["unreadable"], batch_rows.get["row_count"], found)


def keep_unreadable(raw: DataFrame, path: str) -> None:
    """Add the unreadable documents to a folder, but for those of files that are there already as they are now."""
    rows = unreadable(raw)
    if table_exists(raw.sparkSession, path):
        known = raw.sparkSession.read.schema(rows.schema).parquet(path).select("raw_file_path", "raw_file_modified_at").distinct()
        rows = rows.join(known, ["raw_file_path", "raw_file_modified_at"], "left_anti").select(rows.columns)
    rows.write.mode("append").parquet(path)


def _missing(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def ingest_webhooks(
    spark: SparkSession,
    raw_path: str,
    table: str,
    in_catalog: bool = False,
    as_of: datetime | None = None,
    modified_after: datetime | None = None,
    provider: str | None = None,
    everything: bool = False,
) -> Ingested:
    """Merge the newest delivery of every key into the webhook table.

    ``table`` is the folder of a snapshot table, of which a run rewrites the days that its batch touches, or,
    ``in_catalog``, the name of a table that supports MERGE INTO. A snapshot table keeps a ledger of the files in it, and only new and changed ones are read, unless ``everything`` is asked for; a delivery that arrives late
    does not replace a newer one. With ``modified_after``, only files changed later are looked at.
    """
    configure(spark)
    source = Source(raw_path, read_webhooks, True, modified_after, everything)
    clean = lambda df: silver.silver_webhooks(df, as_of, (UNDECLARED,))
    measures = {"no_date": _missing("webhook_created_at"), "no_event_type": _missing("event_type_code")}
    return _ingest(spark, source, clean, measures, table, in_catalog, silver.WEBHOOK_KEYS, silver.delivered_later, silver.webhook_part(), provider)


def ingest_spend(
    spark: SparkSession,
    raw_path: str,
    table: str,
    codes: Mapping[str, str] = settings.CHANNEL_CODES,
    in_catalog: bool = False,
    as_of: datetime | None = None,
    modified_after: datetime | None = None,
    provider: str | None = None,
    everything: bool = False,
) -> Ingested:
    """Merge the newest spend of every day and channel into the spend table, where it changed. Files as for webhooks."""
    configure(spark)
    source, keys = Source(raw_path, read_spend, False, modified_after, everything), silver.SPEND_KEYS
    clean = lambda df: silver.silver_spend(df, codes, as_of, (UNDECLARED,))
    measures = {
        "no_date": _missing("spend_date"),
        "no_amount": _missing("spend"),
        "no_event_type": F.count_if(F.col("event_type_code") == settings.UNKNOWN),
    }
    return _ingest(spark, source, clean, measures, table, in_catalog, keys, silver.spend_superseded, silver.spend_part(), provider)


def rebuild_marts(
    spark: SparkSession,
    webhooks_table: str,
    spend_table: str,
    marts_path: str,
    exports_path: str,
    cutoff: date | None = None,
    in_catalog: bool = False,
    as_of: datetime | None = None,
    keyed: bool | None = None,
) -> dict[str, int]:
    """Rebuild every mart from the current tables and export it for the dashboard; returns their rows.

    ``keyed`` says that both tables have one row per key, as the jobs above keep them; repeats are then not looked for.
    By default that is checked, by counting keys only. All spend is used unless there is a cutoff.
    """
    configure(spark)
    current = spark.table if in_catalog else partial(load_snapshot, spark)
    webhooks, spend = current(webhooks_table), current(spend_table)
    if keyed is None:
        keyed = is_keyed(webhooks, silver.WEBHOOK_KEYS) and is_keyed(spend, silver.SPEND_KEYS)
    return {
        name: publish_mart(mart, f"{marts_path.rstrip('/')}/{name}", f"{exports_path.rstrip('/')}/{name}")
        for name, mart in marts.build_marts(webhooks, spend, cutoff, as_of, keyed=keyed).items()
    }


def open_dashboard(
    spark: SparkSession, exports_path: str, chosen: settings.Selection = settings.Selection()
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The exported marts under one selection, ready for the reports."""
    configure(spark)
    daily, patterns, load = (load_mart(spark, f"{exports_path.rstrip('/')}/{name}", name) for name in MARTS)
    return dashboard.select_all(daily, patterns, load, chosen)
