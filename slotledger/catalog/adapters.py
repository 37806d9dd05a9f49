"""The driver's tables seen as webhooks and spend.

``lineitem`` stands for bookings by day, ``orders`` for spend and ``events`` for webhooks with a time
of day. Whole tables are mapped; nothing is filtered out.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotledger import schemas
from slotledger.functions import numbers, rules, text
from slotledger.operators.combine import channel_mapping
from slotledger.plans import marts
from slotledger.session import configure
from slotledger.settings import Selection
from slotledger.sources.tables import clean_mart, load_table

# Fixed values shared with the SQL in ``ctes``.
CUTOFF = date(1995, 6, 9)
ORDER_CODES = {"1-urgent": "A", "2-high": "N", "3-medium": "R"}
EVENT_CODES = {"1-urgent": "click", "2-high": "view", "3-medium": "purchase"}
SALES_PERIOD = Selection(date(1996, 1, 1), date(1997, 6, 30), ("1-urgent", "3-medium", "unknown"))
EVENT_PERIOD = Selection(date(2024, 1, 8), date(2024, 1, 21), ("1-urgent", "unknown"))
API = "https://api.example.com"
# Declared, so that no job runs just to find out the columns.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
CREATED_AT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


class Tables:
    """Tables of one folder, and the shapes the library works on."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return load_table(self.spark, f"{self.folder}/{name}.parquet", schema=SCHEMAS[name])

    def raw_spend(self) -> DataFrame:
        """Orders as rows of spend files: date and amount as text, the channel as typed in."""
        return self.table("orders").select(
            F.to_date("o_orderdate").cast("string").alias("date"),
            F.col("o_orderpriority").alias("channel"),
            F.col("o_totalprice").cast("string").alias("spend"),
            *_order_lineage(),
        )

    def spend(self, codes: Mapping[str, str] = ORDER_CODES) -> DataFrame:
        """Orders as cleaned spend rows."""
        channel = text.normalize_channel(F.col("o_orderpriority"))
        return self.table("orders").select(
            F.to_date("o_orderdate").alias("spend_date"),
            channel.alias("channel"),
            rules.map_codes(channel, codes).alias("event_type_code"),
            numbers.parse_money(F.col("o_totalprice")).alias("spend"),
            *_order_lineage(),
        )

    def bookings(self) -> DataFrame:
        """Line items as bookings without a time of day."""
        return self.table("lineitem").select(
            F.col("l_shipdate").alias("webhook_created_at"), F.col("l_returnflag").alias("event_type_code")
        )

    def webhooks(self) -> DataFrame:
        """Events as cleaned webhooks; one user's events of a day are one meeting, views have no key."""
        meeting = meeting_id()
        return self.table("events").select(
            employee_email().alias("user_email"),
            meeting.alias("event_id"),
            F.col("ts").alias("webhook_created_at"),
            F.col("event_type").alias("event_type_code"),
            F.when(F.col("event_type") != "view", F.concat(F.lit("K"), F.col("event_id"))).alias("webhook_key"),
        )

    def raw_webhooks(self) -> DataFrame:
        """Events as nested webhook documents."""
        end = F.col("ts") + F.expr("interval 30 minutes")
        meeting = F.struct(
            F.date_format("ts", CREATED_AT).alias("start_time"),
            F.date_format(end, CREATED_AT).alias("end_time"),
            F.initcap("event_type").alias("name"),
            F.lit("active").alias("status"),
            F.concat(F.lit(f"{API}/event_types/"), F.col("event_type")).alias("event_type"),
            F.when(F.col("event_type") == "purchase", F.array().cast("array<struct<user_email:string>>"))
            .otherwise(F.array(F.struct(employee_email().alias("user_email"))))
            .alias("event_memberships"),
        )
        tracking = F.struct(
            F.lit("newsletter").alias("utm_source"),
            F.lit(None).cast("string").alias("utm_medium"),
            F.get_json_object("props", "$.k").alias("utm_campaign"),
            F.lit(None).cast("string").alias("utm_content"),
            F.lit(None).cast("string").alias("utm_term"),
        )
        return self.table("events").select(
            notice().alias("event"),
            created_at_text().alias("created_at"),
            F.lit("adapter").alias("created_by"),
            F.struct(
                F.concat(F.lit(f"{API}/scheduled_events/"), meeting_id(), F.lit("?src=x")).alias("event"),
                invitee_email().alias("email"),
                F.lit("Ann").alias("first_name"),
                F.lit("Lee").alias("last_name"),
                invitee_name().alias("name"),
                meeting.alias("scheduled_event"),
                tracking.alias("tracking"),
            ).alias("payload"),
            event_path().alias("raw_file_path"),
        )

    def raw_webhooks_json(self) -> DataFrame:
        """The same documents, written to JSON text and read back with the declared schema."""
        document = F.to_json(F.struct("event", "created_at", "created_by", "payload"))
        return self.raw_webhooks().select(
            F.from_json(document, schemas.RAW_WEBHOOK).alias("d"), "raw_file_path"
        ).select("d.*", "raw_file_path")

    def mapping(self) -> DataFrame:
        return channel_mapping(self.spend(EVENT_CODES))

    def perf(self) -> DataFrame:
        return clean_mart(marts.daily_channel_performance(self.bookings(), self.spend()), "daily")

    def patterns(self) -> DataFrame:
        return clean_mart(marts.booking_time_patterns(self.webhooks(), self.mapping()), "patterns")

    def load(self) -> DataFrame:
        return clean_mart(marts.employee_meeting_load(self.webhooks()), "load")


def _order_lineage() -> list[Column]:
    return [
        F.concat(F.lit("orders/"), F.col("o_orderkey"), F.lit(".json")).alias("raw_file_path"),
        F.expr("timestampadd(SECOND, CAST(o_custkey AS INT), o_orderdate)").alias("raw_file_modified_at"),
    ]


def employee_email() -> Column:
    return F.concat(F.lit("user"), F.col("user_id"), F.lit("@example.com"))


def meeting_id(day: Column | None = None) -> Column:
    day = F.to_date("ts") if day is None else day
    digits = F.replace(day.cast("string"), F.lit("-"), F.lit(""))
    return F.concat(F.lit("EV"), F.col("user_id"), F.lit("-"), digits)


def notice() -> Column:
    return F.when(F.col("event_type") == "error", "invitee.canceled").otherwise("invitee.created")


def created_at_text() -> Column:
    """Delivery time as text, with a stray space in it; unreadable for sign-ups."""
    readable = F.date_format("ts", "yyyy-MM-dd' T'HH:mm:ss.SSSSSS'Z'")
    return F.when(F.col("event_type") == "signup", "garbage").otherwise(readable)


def invitee_email() -> Column:
    return F.when(~F.col("event_type").isin("view", "click"), F.concat(F.lit(" User"), "user_id", F.lit("@Mail.com ")))


def invitee_name() -> Column:
    return F.when(F.col("event_type") != "view", F.concat(F.lit("Ann  Lee "), "user_id"))


def event_path() -> Column:
    return F.concat(F.lit("webhooks/"), F.col("event_id"), F.lit(".json"))
