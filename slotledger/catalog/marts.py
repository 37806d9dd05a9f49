"""The marts and the steps they are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame

from slotledger.catalog import adapters
from slotledger.catalog.adapters import Tables
from slotledger.catalog.registry import query
from slotledger.operators import combine
from slotledger.plans import marts, silver


@query("SELECT * FROM bookings_daily", "bookings_daily")
def bookings_daily(t: Tables) -> DataFrame:
    return marts.bookings_daily(t.bookings())


@query("SELECT * FROM spend_daily", "spend_daily")
def spend_daily(t: Tables) -> DataFrame:
    return marts.spend_daily(marts.distinct_spend(t.spend()))


@query("SELECT * FROM recent_mart", "recent_mart")
def daily_channel_performance(t: Tables) -> DataFrame:
    return marts.daily_channel_performance(t.bookings(), t.spend(), adapters.CUTOFF)


@query(
    """SELECT CAST(webhook_created_at AS DATE) AS booking_date, w.event_type_code, count(*) AS bookings_count,
            coalesce(m.channel, 'unknown') AS channel
        FROM webhooks w LEFT JOIN mapping m ON w.event_type_code = m.event_type_code GROUP BY ALL""",
    "webhooks",
    "mapping",
)
def attach_channel(t: Tables) -> DataFrame:
    return combine.attach_channel(marts.bookings_daily(t.webhooks()), t.mapping())


@query("SELECT * FROM patterns", "patterns")
def booking_time_patterns(t: Tables) -> DataFrame:
    return marts.booking_time_patterns(t.webhooks(), t.mapping())


@query("SELECT * FROM weekly", "weekly")
def weekly_load(t: Tables) -> DataFrame:
    return marts.weekly_load(t.webhooks())


@query(
    """SELECT user_email, CAST(sum(weekly_meetings) AS BIGINT) AS total_meetings, count(*) AS number_of_weeks,
            avg(weekly_meetings) AS avg_meetings_per_week, max(weekly_meetings) AS max_meetings_in_week
        FROM weekly GROUP BY user_email""",
    "weekly",
)
def employee_summary(t: Tables) -> DataFrame:
    return marts.employee_summary(marts.weekly_load(t.webhooks()))


@query("SELECT * FROM load", "load")
def employee_meeting_load(t: Tables) -> DataFrame:
    return marts.employee_meeting_load(t.webhooks())


# The production path: raw documents, cleaned and keyed, into marts that rely on the keys.


@query("SELECT * FROM silver_mart", "silver_mart")
def keyed_daily_performance(t: Tables) -> DataFrame:
    webhooks, spend = silver.silver_webhooks(t.raw_webhooks()), silver.silver_spend(t.raw_spend(), adapters.EVENT_CODES)
    return marts.daily_channel_performance(webhooks, spend, keyed=True)


@query("SELECT * FROM silver_patterns", "silver_patterns")
def keyed_time_patterns(t: Tables) -> DataFrame:
    spend = silver.silver_spend(t.raw_spend(), adapters.EVENT_CODES)
    return marts.booking_time_patterns(silver.silver_webhooks(t.raw_webhooks()), combine.channel_mapping(spend))


@query("SELECT * FROM silver_load", "silver_load")
def keyed_meeting_load(t: Tables) -> DataFrame:
    return marts.employee_meeting_load(silver.silver_webhooks(t.raw_webhooks()), keyed=True)
