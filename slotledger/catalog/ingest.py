"""Sources, cleaned tables, versions and merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger import schemas
from slotledger.catalog import adapters, ctes
from slotledger.catalog.adapters import Tables
from slotledger.catalog.registry import query
from slotledger.functions import text
from slotledger.operators import audit, ranking, versions
from slotledger.operators.combine import channel_mapping as map_channels
from slotledger.plans import marts, silver
from slotledger.settings import SPEND_PREVIEW_ROWS
from slotledger.sources.tables import clean_mart, load_table

_FLAT = f"""SELECT CASE WHEN event_type <> 'purchase' THEN {ctes.EMPLOYEE} END AS user_email,
    {ctes.MEETING} AS event_id, 'https://api.example.com/scheduled_events/' || {ctes.MEETING} || '?src=x' AS event_uri,
    {ctes.NOTICE} AS webhook_event_type, {ctes.CREATED_AT} AS webhook_created_at,
    upper(event_type[1]) || event_type[2:] AS event_name, 'active' AS event_status, ts AS event_start_time,
    ts + INTERVAL 30 MINUTE AS event_end_time, event_type AS event_type_code, {ctes.EMAIL} AS invitee_email,
    {ctes.NAME} AS invitee_name, {ctes.SLUG} AS invitee_name_safe, 'Ann' AS invitee_first_name,
    'Lee' AS invitee_last_name, 'newsletter' AS tracking_utm_source, CAST(NULL AS VARCHAR) AS tracking_utm_medium,
    json_extract_string(props, '$.k') AS tracking_utm_campaign, CAST(NULL AS VARCHAR) AS tracking_utm_content,
    CAST(NULL AS VARCHAR) AS tracking_utm_term, 'webhooks/' || event_id || '.json' AS raw_file_path FROM events"""
_KEYED = f"""SELECT *, sha256(concat_ws('||', event_id, webhook_event_type, invitee_identity)) AS webhook_key
    FROM (SELECT *, coalesce(lower(trim(invitee_email)), lower(trim(invitee_name_safe)), 'unknown') AS invitee_identity
        FROM ({_FLAT}))"""
_NEWEST_WEBHOOK = "PARTITION BY webhook_key ORDER BY webhook_created_at DESC NULLS LAST, raw_file_path DESC"
_NEWEST_SPEND = "PARTITION BY spend_date, channel ORDER BY raw_file_modified_at DESC NULLS LAST, raw_file_path DESC"


@query("SELECT o_orderkey, o_orderpriority, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders")
def scan_parquet(t: Tables) -> DataFrame:
    return load_table(t.spark, f"{t.folder}/orders.parquet").select("o_orderkey", "o_orderpriority", "o_totalprice")


@query(
    f"""SELECT {ctes.NOTICE} AS event, {ctes.MEETING} AS meeting, {ctes.EMAIL} AS email,
            json_extract_string(props, '$.k') AS utm_campaign, 'webhooks/' || event_id || '.json' AS raw_file_path
        FROM events"""
)
def parse_json_document(t: Tables) -> DataFrame:
    return t.raw_webhooks_json().select(
        "event",
        text.uri_part(F.col("payload.event"), "scheduled_events").alias("meeting"),
        "payload.email",
        "payload.tracking.utm_campaign",
        "raw_file_path",
    )


@query(
    f"""SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderpriority AS channel,
            CAST(o_totalprice AS DECIMAL(12,2)) AS spend FROM orders
        UNION ALL SELECT strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d'), o_orderpriority,
            CAST(o_custkey AS DECIMAL(12,2)) FROM orders"""
)
def parse_json_array(t: Tables) -> DataFrame:
    def element(day: Column, amount: Column) -> Column:
        label = F.date_format(day, "yyyy-MM-dd").alias("date")
        return F.struct(label, F.col("o_orderpriority").alias("channel"), amount.alias("spend"))

    next_day = F.date_add(F.to_date("o_orderdate"), 1)
    text_and_number = F.array(
        element(F.to_date("o_orderdate"), F.col("o_totalprice").cast("string")),
        element(next_day, F.col("o_custkey").cast("string")),
    )
    files = t.table("orders").select(F.to_json(text_and_number).alias("file"))
    rows = files.select(F.inline(F.from_json("file", f"array<struct<{schemas.RAW_SPEND.replace(' string', ': string')}>>")))
    return rows.select("date", "channel", F.col("spend").cast("decimal(12,2)").alias("spend"))


@query(_FLAT)
def flatten_nested(t: Tables) -> DataFrame:
    return silver.flatten_webhooks(t.raw_webhooks_json())


@query(
    f"""SELECT 'webhooks/' || event_id || '.json' AS raw_file_path,
            CASE WHEN event_type <> 'purchase' THEN {ctes.EMPLOYEE} END AS user_email FROM events"""
)
def array_first_field(t: Tables) -> DataFrame:
    return silver.flatten_webhooks(t.raw_webhooks()).select("raw_file_path", "user_email")


@query(
    f"""SELECT webhook_key, webhook_created_at, raw_file_path FROM ({_KEYED})
        QUALIFY row_number() OVER ({_NEWEST_WEBHOOK}) = 1"""
)
def latest_webhook(t: Tables) -> DataFrame:
    keyed = silver.with_webhook_key(silver.flatten_webhooks(t.raw_webhooks()))
    return silver.latest_webhooks(keyed).select("webhook_key", "webhook_created_at", "raw_file_path")


@query(f"SELECT * FROM ({_KEYED}) QUALIFY row_number() OVER ({_NEWEST_WEBHOOK}) = 1")
def silver_webhooks(t: Tables) -> DataFrame:
    return silver.silver_webhooks(t.raw_webhooks()).drop("processed_at")


@query(f"SELECT * FROM spend QUALIFY row_number() OVER ({_NEWEST_SPEND}) = 1", "spend")
def latest_spend(t: Tables) -> DataFrame:
    return silver.latest_spend(t.spend())


@query(f"SELECT * FROM spend QUALIFY row_number() OVER ({_NEWEST_SPEND}) = 1", "spend")
def silver_spend(t: Tables) -> DataFrame:
    return silver.silver_spend(t.raw_spend(), adapters.ORDER_CODES).drop("processed_at")


_DELIVERIES = f"""SELECT sha256(concat_ws('||', meeting, {ctes.NOTICE}, {ctes.IDENTITY})) AS webhook_key,
    {ctes.EMPLOYEE} AS user_email, ts AS webhook_created_at FROM
    (SELECT *, {{meeting}} AS meeting FROM events)
    QUALIFY row_number() OVER (PARTITION BY webhook_key ORDER BY ts DESC, event_id DESC) = 1"""


def _deliveries(t: Tables, days_later: int) -> DataFrame:
    """Newest delivery per key, of meetings moved by some days."""
    day = F.date_add(F.to_date("ts"), days_later)
    identity = text.invitee_identity(adapters.invitee_email(), text.slug_name(adapters.invitee_name()))
    keyed = t.table("events").select(
        text.surrogate_key(adapters.meeting_id(day), adapters.notice(), identity).alias("webhook_key"),
        adapters.employee_email().alias("user_email"),
        F.col("ts").alias("webhook_created_at"),
        "event_id",
    )
    newest = versions.latest_by(keyed, ["webhook_key"], [F.desc("webhook_created_at"), F.desc("event_id")])
    return newest.drop("event_id")


@query(
    f"""WITH target AS ({_DELIVERIES.format(meeting=ctes.MEETING)}),
            batch AS ({_DELIVERIES.format(meeting=ctes.MEETING_NEXT_DAY)})
        SELECT coalesce(b.webhook_key, t.webhook_key) AS webhook_key,
            CASE WHEN b.webhook_key IS NOT NULL THEN b.user_email ELSE t.user_email END AS user_email,
            CASE WHEN b.webhook_key IS NOT NULL THEN b.webhook_created_at ELSE t.webhook_created_at END
                AS webhook_created_at
        FROM target t FULL OUTER JOIN batch b ON t.webhook_key = b.webhook_key"""
)
def upsert_replace(t: Tables) -> DataFrame:
    return versions.upsert(_deliveries(t, 0), _deliveries(t, 1), silver.WEBHOOK_KEYS)


_COUNTS = f"""SELECT CAST(o_orderdate + INTERVAL {{days}} DAY AS DATE) AS spend_date, {ctes.CHANNEL} AS channel,
    CAST(count(*) AS DECIMAL(12,2)) AS spend,
    max({ctes.ORDER_MTIME}) + INTERVAL {{days}} DAY AS raw_file_modified_at FROM orders GROUP BY 1, 2"""


def _counts(t: Tables, days_later: int) -> DataFrame:
    """Orders per day and channel as an amount, reported some days later: often equal to the next day's."""
    counts = t.spend().groupBy(F.date_add("spend_date", days_later).alias("spend_date"), "channel")
    return counts.agg(
        F.count(F.lit(1)).cast("decimal(12,2)").alias("spend"),
        (F.max("raw_file_modified_at") + F.expr(f"interval '{days_later}' day")).alias("raw_file_modified_at"),
    )


@query(
    f"""WITH target AS ({_COUNTS.format(days=0)}), batch AS ({_COUNTS.format(days=1)}),
            pair AS (SELECT t, b, t.spend_date IS NULL OR (b.spend_date IS NOT NULL AND coalesce(t.spend <> b.spend
                OR t.raw_file_modified_at < b.raw_file_modified_at, false)) AS take
                FROM target t FULL OUTER JOIN batch b ON t.spend_date = b.spend_date AND t.channel = b.channel)
        SELECT unnest(CASE WHEN take THEN b ELSE t END) FROM pair"""
)
def upsert_conditional(t: Tables) -> DataFrame:
    return versions.upsert(_counts(t, 0), _counts(t, 1), silver.SPEND_KEYS, silver.spend_changed)


@query(
    f"""SELECT 'raw' AS stage, count(*) AS row_count, CAST(0 AS BIGINT) AS incomplete_rows FROM orders
        UNION ALL SELECT 'clean', count(*), CAST(count(*) FILTER (event_type_code = 'unknown' AND spend IS NULL) AS BIGINT)
            FROM spend
        UNION ALL SELECT 'silver', count(*), CAST(0 AS BIGINT) FROM (SELECT DISTINCT spend_date, channel FROM spend)
        UNION ALL SELECT 'webhooks', count(*), count(*) FILTER (webhook_key IS NULL) FROM webhooks""",
    "spend",
    "webhooks",
)
def stage_audit(t: Tables) -> DataFrame:
    rows, nothing = F.count(F.lit(1)), F.lit(0).cast("long")
    spend = {
        "raw": (rows, nothing),
        "clean": (rows, F.count_if(F.col("spend").isNull())),
        "silver": (F.count_distinct(F.struct(*silver.SPEND_KEYS)), nothing),
    }
    webhooks = {"webhooks": (rows, F.count_if(F.col("webhook_key").isNull()))}
    return audit.stage_audit([(t.spend(), spend), (t.webhooks(), webhooks)])


@query("SELECT DISTINCT spend_date, channel, event_type_code FROM spend", "spend")
def distinct_rows(t: Tables) -> DataFrame:
    return marts.distinct_spend(t.spend().select("spend_date", "channel", "event_type_code"))


@query("SELECT event_type_code, min(channel) AS channel FROM spend GROUP BY ALL", "spend")
def channel_mapping(t: Tables) -> DataFrame:
    return map_channels(t.spend())


@query(
    "SELECT spend_date, count(*) AS row_count FROM spend GROUP BY spend_date ORDER BY spend_date LIMIT 5",
    "spend",
)
def date_profile(t: Tables) -> DataFrame:
    return audit.date_profile(t.spend(), "spend_date")


@query(
    f"""SELECT spend_date, channel, event_type_code, spend FROM
            (SELECT * FROM spend QUALIFY row_number() OVER ({_NEWEST_SPEND}) = 1)
        ORDER BY spend_date DESC, channel LIMIT 50""",
    "spend",
)
def ordered_preview(t: Tables) -> DataFrame:
    newest = silver.latest_spend(t.spend()).select("spend_date", "channel", "event_type_code", "spend")
    return ranking.preview(newest, [F.desc_nulls_last("spend_date"), F.asc("channel")], SPEND_PREVIEW_ROWS)


@query("SELECT * FROM perf", "perf")
def load_mart_clean(t: Tables) -> DataFrame:
    return clean_mart(marts.daily_channel_performance(t.bookings(), t.spend()), "daily")
