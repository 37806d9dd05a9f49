"""Column expressions and row filters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotledger.catalog import adapters, ctes
from slotledger.catalog.adapters import Tables
from slotledger.catalog.registry import query
from slotledger.functions import dates, numbers, rules, text
from slotledger.operators import rows
from slotledger.plans.channels import daily_cpb
from slotledger.settings import LOAD_LEVELS, WEEKDAYS


@query(f"SELECT event_id, {ctes.CREATED_AT} AS webhook_created_at FROM events")
def parse_created_at(t: Tables) -> DataFrame:
    parsed = dates.parse_created_at(adapters.created_at_text())
    return t.table("events").select("event_id", parsed.alias("webhook_created_at"))


@query("SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS start_time FROM events")
def parse_iso(t: Tables) -> DataFrame:
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    as_text = F.when(F.col("event_type") != "error", iso).otherwise("not a time")
    return t.table("events").select("event_id", dates.parse_iso(as_text).alias("start_time"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS spend_date FROM orders")
def parse_day(t: Tables) -> DataFrame:
    as_text = F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("05.01.1995")
    return t.table("orders").select("o_orderkey", dates.parse_day(as_text).alias("spend_date"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS day FROM orders")
def lenient_date(t: Tables) -> DataFrame:
    as_text = F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("soon")
    return t.table("orders").select("o_orderkey", dates.to_day(as_text).alias("day"))


@query(
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS number,
            CASE WHEN event_type <> 'error' THEN value ELSE 0 END AS number_or_zero FROM events"""
)
def lenient_number(t: Tables) -> DataFrame:
    as_text = F.when(F.col("event_type") != "error", F.col("value").cast("string")).otherwise("n/a")
    return t.table("events").select(
        "event_id",
        numbers.to_number(as_text).alias("number"),
        numbers.to_number(as_text, 0).alias("number_or_zero"),
    )


@query(
    """SELECT o_orderkey, CAST(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice || '5' END AS DECIMAL(12,2)) AS spend
        FROM orders"""
)
def parse_money(t: Tables) -> DataFrame:
    with_digit = F.concat(F.col("o_totalprice").cast("string"), F.lit("5"))
    as_text = F.when(F.col("o_orderstatus") != "P", with_digit).otherwise("tba")
    return t.table("orders").select("o_orderkey", numbers.parse_money(as_text).alias("spend"))


@query(
    f"""SELECT event_id, {ctes.MEETING} AS meeting, CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS kind
        FROM events"""
)
def extract_uri_ids(t: Tables) -> DataFrame:
    meeting = F.concat(F.lit(f"{adapters.API}/scheduled_events/"), adapters.meeting_id(), F.lit("?src=x"))
    kind = F.concat(F.when(F.col("event_type") == "error", "/none/").otherwise("/event_types/"), F.col("event_type"))
    return t.table("events").select(
        "event_id",
        text.uri_part(meeting, "scheduled_events").alias("meeting"),
        text.uri_part(kind, "event_types").alias("kind"),
    )


@query(f"SELECT event_id, {ctes.SLUG} AS invitee_name_safe FROM events")
def slug_name(t: Tables) -> DataFrame:
    return t.table("events").select("event_id", text.slug_name(adapters.invitee_name()).alias("invitee_name_safe"))


@query(f"SELECT o_orderkey, {ctes.CHANNEL} AS channel FROM orders")
def normalize_channel(t: Tables) -> DataFrame:
    padded = F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" "))
    return t.table("orders").select("o_orderkey", text.normalize_channel(padded).alias("channel"))


@query(f"SELECT event_id, {ctes.IDENTITY} AS invitee_identity FROM events")
def invitee_identity(t: Tables) -> DataFrame:
    identity = text.invitee_identity(adapters.invitee_email(), text.slug_name(adapters.invitee_name()))
    return t.table("events").select("event_id", identity.alias("invitee_identity"))


@query(
    f"""SELECT event_id, sha256(concat_ws('||', {ctes.MEETING}, {ctes.NOTICE}, {ctes.IDENTITY})) AS webhook_key
        FROM events"""
)
def webhook_key(t: Tables) -> DataFrame:
    identity = text.invitee_identity(adapters.invitee_email(), text.slug_name(adapters.invitee_name()))
    key = text.surrogate_key(adapters.meeting_id(), adapters.notice(), identity)
    return t.table("events").select("event_id", key.alias("webhook_key"))


@query(
    f"""SELECT channel, {ctes.DISPLAY} AS channel_display, count(*) AS row_count
        FROM (SELECT {ctes.CHANNEL} || '_paid_ads' AS channel FROM orders) GROUP BY ALL"""
)
def display_channel(t: Tables) -> DataFrame:
    channels = t.spend().select(F.concat("channel", F.lit("_paid_ads")).alias("channel"))
    counted = channels.groupBy("channel").agg(F.count(F.lit(1)).alias("row_count"))
    return counted.withColumn("channel_display", text.display_channel(F.col("channel")))


@query(
    f"""SELECT time_slot, {ctes.display("time_slot", "no suffix")} AS time_slot_display, count(*) AS row_count
        FROM (SELECT {ctes.slot("hour(ts)")} AS time_slot FROM events) GROUP BY ALL"""
)
def display_slot(t: Tables) -> DataFrame:
    slots = t.table("events").groupBy(rules.time_slot(F.hour("ts")).alias("time_slot"))
    counted = slots.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.withColumn("time_slot_display", text.display_slot(F.col("time_slot")))


@query(
    f"""SELECT CAST(h AS INTEGER) AS hour_of_day, {ctes.hour_label("h")} AS hour_display, count(*) AS row_count
        FROM (SELECT CASE WHEN event_type <> 'error' THEN hour(ts) END AS h FROM events) GROUP BY ALL"""
)
def display_hour(t: Tables) -> DataFrame:
    hours = t.table("events").groupBy(F.when(F.col("event_type") != "error", F.hour("ts")).alias("hour_of_day"))
    counted = hours.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.withColumn("hour_display", text.display_hour(F.col("hour_of_day")))


@query(f"SELECT event_id, coalesce(lower(trim({ctes.EMAIL})), 'Unknown') AS user_email FROM events")
def normalize_email(t: Tables) -> DataFrame:
    email = text.normalize_email(adapters.invitee_email())
    return t.table("events").select("event_id", email.alias("user_email"))


@query(
    f"""SELECT event_id, coalesce(nullif(CASE event_type WHEN 'error' THEN '' WHEN 'view' THEN NULL
            ELSE event_type END, ''), 'unknown') AS channel FROM events"""
)
def default_unknown(t: Tables) -> DataFrame:
    gappy = F.when(F.col("event_type") == "error", "").when(F.col("event_type") != "view", F.col("event_type"))
    return t.table("events").select("event_id", text.default_unknown(gappy).alias("channel"))


@query(
    f"""SELECT o_orderkey, {ctes.money("price")} AS spend_text, {ctes.count("price")} AS count_text
        FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders)"""
)
def format_metric(t: Tables) -> DataFrame:
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return t.table("orders").select(
        "o_orderkey",
        text.metric_text(F.lit("marketing_spend"), price).alias("spend_text"),
        text.metric_text(F.lit("bookings_count"), price).alias("count_text"),
    )


@query(
    f"""SELECT event_id, booking_date, CAST(hour(ts) AS INTEGER) AS hour_of_day, {ctes.calendar("booking_date")}
        FROM (SELECT event_id, ts, CAST(ts AS DATE) AS booking_date FROM events)"""
)
def calendar_columns(t: Tables) -> DataFrame:
    day = F.to_date("ts")
    calendar = [c.alias(name) for name, c in dates.calendar_columns(day).items()]
    return t.table("events").select("event_id", day.alias("booking_date"), F.hour("ts").alias("hour_of_day"), *calendar)


@query(
    f"""SELECT CAST(h AS INTEGER) AS hour_of_day, {ctes.slot("h")} AS time_slot,
            {ctes.slot_sort(ctes.slot("h"))} AS time_slot_sort, count(*) AS row_count
        FROM (SELECT hour(ts) AS h FROM events) GROUP BY ALL"""
)
def time_slot(t: Tables) -> DataFrame:
    counted = t.table("events").groupBy(F.hour("ts").alias("hour_of_day")).agg(F.count(F.lit(1)).alias("row_count"))
    slot = rules.time_slot(F.col("hour_of_day"))
    slots = {"time_slot": slot, "time_slot_sort": rules.time_slot_sort(slot)}
    return counted.withColumns(slots)


@query(
    f"""SELECT user_email, {ctes.level("avg_meetings_per_week")} AS load_level FROM load""",
    "load",
)
def load_level(t: Tables) -> DataFrame:
    return t.load().select("user_email", rules.load_level(F.col("avg_meetings_per_week")).alias("load_level"))


@query(
    f"""SELECT DISTINCT day_of_week_name, {ctes.weekday_sort("day_of_week_name")} AS weekday_order, time_slot,
            {ctes.slot_sort("time_slot")} AS slot_order, load_level,
            CAST(CASE load_level WHEN 'Very high' THEN 1 WHEN 'High' THEN 2 WHEN 'Moderate' THEN 3 WHEN 'Low' THEN 4
                END AS INTEGER) AS level_order
        FROM (SELECT dayname(ts) AS day_of_week_name, {ctes.slot("hour(ts)")} AS time_slot,
            {ctes.level("value")} AS load_level FROM events)"""
)
def category_order(t: Tables) -> DataFrame:
    kinds = t.table("events").select(
        F.date_format("ts", "EEEE").alias("day_of_week_name"),
        rules.time_slot(F.hour("ts")).alias("time_slot"),
        rules.load_level(F.col("value")).alias("load_level"),
    )
    return kinds.distinct().select(
        "*",
        rules.category_position(F.col("day_of_week_name"), WEEKDAYS).alias("weekday_order"),
        rules.time_slot_sort(F.col("time_slot")).alias("slot_order"),
        rules.category_position(F.col("load_level"), [name for name, _ in LOAD_LEVELS]).alias("level_order"),
    )


@query("SELECT channel, event_type_code, count(*) AS row_count FROM spend GROUP BY ALL", "spend")
def channel_code_map(t: Tables) -> DataFrame:
    coded = t.spend().select("channel", rules.map_codes(F.col("channel"), adapters.ORDER_CODES).alias("event_type_code"))
    return coded.groupBy("channel", "event_type_code").agg(F.count(F.lit(1)).alias("row_count"))


@query("SELECT user_email, event_id, webhook_key FROM webhooks WHERE webhook_key IS NOT NULL", "webhooks")
def filter_not_null(t: Tables) -> DataFrame:
    return rows.require_not_null(t.webhooks(), "webhook_key").select("user_email", "event_id", "webhook_key")


@query("SELECT spend_date, channel, spend FROM spend WHERE spend_date >= DATE '1995-06-09'", "spend")
def filter_since(t: Tables) -> DataFrame:
    return rows.since(t.spend(), "spend_date", adapters.CUTOFF).select("spend_date", "channel", "spend")


@query(
    "SELECT spend_date, channel, spend FROM spend WHERE spend_date BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'",
    "spend",
)
def filter_period(t: Tables) -> DataFrame:
    chosen = rows.in_period(t.spend(), "spend_date", date(1996, 1, 1), date(1997, 6, 30))
    return chosen.select("spend_date", "channel", "spend")


@query("SELECT spend_date, channel, spend FROM spend WHERE channel IN ('1-urgent', '5-low')", "spend")
def filter_channels(t: Tables) -> DataFrame:
    return rows.in_channels(t.spend(), ["1-urgent", "5-low"]).select("spend_date", "channel", "spend")


@query(
    f"""SELECT performance_date, channel_display, cost_per_booking
        FROM (SELECT *, {ctes.cost()} AS cost_per_booking FROM cells) WHERE cost_per_booking IS NOT NULL""",
    "cells",
)
def drop_missing(t: Tables) -> DataFrame:
    priced = rows.drop_missing(daily_cpb(t.perf()), "performance_date", "cost_per_booking")
    return priced.select("performance_date", "channel_display", "cost_per_booking")


@query(
    """SELECT user_email AS "Employee", week_start_date AS "Week Starting", weekly_meetings AS "Weekly Meetings"
        FROM load""",
    "load",
)
def present_columns(t: Tables) -> DataFrame:
    labels = {"user_email": "Employee", "week_start_date": "Week Starting", "weekly_meetings": "Weekly Meetings"}
    return rows.present(t.load(), labels, [*labels, "not_there"])
