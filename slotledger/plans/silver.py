"""Raw deliveries to cleaned, keyed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger import settings
from slotledger.functions import dates, numbers, rules, text
from slotledger.operators.rows import with_load_stamp
from slotledger.operators.versions import Side, latest_by

# What identifies a row when a batch is merged into its table.
WEBHOOK_KEYS = ("webhook_key",)
SPEND_KEYS = ("spend_date", "channel")


def webhook_part() -> Column:
    """Stored webhooks are split by the day of delivery, so a batch rewrites the days it touches."""
    return F.date_format("webhook_created_at", "yyyy-MM-dd")


def spend_part() -> Column:
    """Stored spend has few rows a day and is split by month."""
    return F.date_format("spend_date", "yyyy-MM")


def flatten_webhooks(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One flat row per delivery, in a single projection over the nested document; columns to ``keep`` go along."""
    meeting = "payload.scheduled_event"
    utm = [
        F.col(f"payload.tracking.utm_{part}").alias(f"tracking_utm_{part}")
        for part in ("source", "medium", "campaign", "content", "term")
    ]
    return raw.select(
        F.get(f"{meeting}.event_memberships", F.lit(0))["user_email"].alias("user_email"),
        text.uri_part(F.col("payload.event"), "scheduled_events").alias("event_id"),
        F.col("payload.event").alias("event_uri"),
        F.col("event").alias("webhook_event_type"),
        dates.parse_created_at(F.col("created_at")).alias("webhook_created_at"),
        F.col(f"{meeting}.name").alias("event_name"),
        F.col(f"{meeting}.status").alias("event_status"),
        dates.parse_iso(F.col(f"{meeting}.start_time")).alias("event_start_time"),
        dates.parse_iso(F.col(f"{meeting}.end_time")).alias("event_end_time"),
        text.uri_part(F.col(f"{meeting}.event_type"), "event_types").alias("event_type_code"),
        F.col("payload.email").alias("invitee_email"),
        F.col("payload.name").alias("invitee_name"),
        text.slug_name(F.col("payload.name")).alias("invitee_name_safe"),
        F.col("payload.first_name").alias("invitee_first_name"),
        F.col("payload.last_name").alias("invitee_last_name"),
        *utm,
        "raw_file_path",
        *keep,
    )


def with_webhook_key(flat: DataFrame) -> DataFrame:
    """Who booked, and one key per meeting, kind of notice and invitee."""
    identity = text.invitee_identity(F.col("invitee_email"), F.col("invitee_name_safe"))
    return flat.withColumn("invitee_identity", identity).withColumn(
        "webhook_key", text.surrogate_key(F.col("event_id"), F.col("webhook_event_type"), F.col("invitee_identity"))
    )


def latest_webhooks(keyed: DataFrame) -> DataFrame:
    """Newest delivery per key; of equally new ones, the one with the last file path."""
    newest = [F.col("webhook_created_at").desc_nulls_last(), F.col("raw_file_path").desc_nulls_last()]
    return latest_by(keyed, WEBHOOK_KEYS, newest)


def silver_webhooks(raw: DataFrame, as_of: datetime | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Raw webhooks (with lineage) to one row per key; merge into the table by ``WEBHOOK_KEYS``."""
    return latest_webhooks(with_webhook_key(with_load_stamp(flatten_webhooks(raw, keep), as_of)))


def clean_spend(raw: DataFrame, codes: Mapping[str, str] = settings.CHANNEL_CODES, keep: Sequence[str] = ()) -> DataFrame:
    """Typed date and amount, normalised channel and its event type code."""
    channel = text.normalize_channel(F.col("channel"))
    return raw.select(
        dates.parse_day(F.col("date")).alias("spend_date"),
        channel.alias("channel"),
        rules.map_codes(channel, codes).alias("event_type_code"),
        numbers.parse_money(F.col("spend")).alias("spend"),
        "raw_file_path",
        "raw_file_modified_at",
        *keep,
    )


def latest_spend(clean: DataFrame) -> DataFrame:
    """Row of the newest file per day and channel."""
    newest = [F.col("raw_file_modified_at").desc_nulls_last(), F.col("raw_file_path").desc_nulls_last()]
    return latest_by(clean, SPEND_KEYS, newest)


def silver_spend(
    raw: DataFrame, codes: Mapping[str, str] = settings.CHANNEL_CODES, as_of: datetime | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Raw spend (with lineage) to one row per day and channel; merge with ``spend_changed``."""
    return latest_spend(with_load_stamp(clean_spend(raw, codes, keep), as_of))


def spend_changed(table: Side, batch: Side) -> Column:
    """When a spend row is replaced: another amount, or a newer file."""
    return (table("spend") != batch("spend")) | (table("raw_file_modified_at") < batch("raw_file_modified_at"))


def spend_superseded(table: Side, batch: Side) -> Column:
    """The same for a batch of new files only, in which an older file may arrive late: that one changes nothing."""
    older = F.coalesce(batch("raw_file_modified_at") < table("raw_file_modified_at"), F.lit(False))
    return spend_changed(table, batch) & ~older


def delivered_later(table: Side, batch: Side) -> Column:
    """When a webhook is replaced by one of a batch of new files only: unless the table's was delivered after it."""
    return table("webhook_created_at").isNull() | (batch("webhook_created_at") >= table("webhook_created_at"))
