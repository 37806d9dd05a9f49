"""The adapters and marts in SQL, as named CTEs and expressions."""

from __future__ import annotations

CHANNEL = r"regexp_replace(lower(trim(o_orderpriority)), '\s+', '_', 'g')"
EMPLOYEE = "'user' || user_id || '@example.com'"
MEETING = "'EV' || user_id || '-' || strftime(ts, '%Y%m%d')"
MEETING_NEXT_DAY = "'EV' || user_id || '-' || strftime(ts + INTERVAL 1 DAY, '%Y%m%d')"
NOTICE = "CASE WHEN event_type = 'error' THEN 'invitee.canceled' ELSE 'invitee.created' END"
EMAIL = "CASE WHEN event_type NOT IN ('view', 'click') THEN ' User' || user_id || '@Mail.com ' END"
NAME = "CASE WHEN event_type <> 'view' THEN 'Ann  Lee ' || user_id END"
SLUG = rf"lower(regexp_replace({NAME}, '\s+', '_', 'g'))"
IDENTITY = f"coalesce(lower(trim({EMAIL})), lower(trim({SLUG})), 'unknown')"
CREATED_AT = "CASE WHEN event_type <> 'signup' THEN ts END"
ORDER_PATH = "'orders/' || o_orderkey || '.json'"
ORDER_MTIME = "o_orderdate + to_seconds(o_custkey)"


def code(channel: str, one: str, two: str, three: str) -> str:
    return (
        f"CASE {channel} WHEN '1-urgent' THEN '{one}' WHEN '2-high' THEN '{two}' "
        f"WHEN '3-medium' THEN '{three}' ELSE 'unknown' END"
    )


def display(text: str, suffix: str = "_paid_ads") -> str:
    """Title case after every non-letter."""
    words = f"lower(replace(replace({text}, '{suffix}', ''), '_', ' '))"
    return (
        f"coalesce(array_to_string(list_transform(regexp_extract_all({words}, '[a-z]+|[^a-z]+'), "
        "lambda w: upper(w[1]) || w[2:]), ''), 'Unknown')"
    )


def hour_label(hour: str) -> str:
    return (
        f"CASE WHEN {hour} IS NULL THEN 'Unknown' WHEN {hour} = 0 THEN '12 AM' WHEN {hour} < 12 THEN {hour} || ' AM' "
        f"WHEN {hour} = 12 THEN '12 PM' ELSE ({hour} - 12) || ' PM' END"
    )


def slot(hour: str) -> str:
    return (
        f"CASE WHEN {hour} BETWEEN 0 AND 5 THEN 'overnight' WHEN {hour} BETWEEN 6 AND 8 THEN 'early_morning' "
        f"WHEN {hour} BETWEEN 9 AND 11 THEN 'morning' WHEN {hour} BETWEEN 12 AND 16 THEN 'afternoon' "
        f"WHEN {hour} BETWEEN 17 AND 20 THEN 'evening' ELSE 'late_evening' END"
    )


def slot_sort(name: str) -> str:
    return (
        f"CAST(CASE {name} WHEN 'overnight' THEN 1 WHEN 'early_morning' THEN 2 WHEN 'morning' THEN 3 "
        f"WHEN 'afternoon' THEN 4 WHEN 'evening' THEN 5 WHEN 'late_evening' THEN 6 ELSE 99 END AS INTEGER)"
    )


def weekday_sort(name: str) -> str:
    return (
        f"CAST(CASE {name} WHEN 'Sunday' THEN 1 WHEN 'Monday' THEN 2 WHEN 'Tuesday' THEN 3 WHEN 'Wednesday' THEN 4 "
        f"WHEN 'Thursday' THEN 5 WHEN 'Friday' THEN 6 WHEN 'Saturday' THEN 7 END AS INTEGER)"
    )


def level(mean: str) -> str:
    return (
        f"CASE WHEN {mean} IS NULL THEN 'Unknown' WHEN {mean} >= 15 THEN 'Very high' WHEN {mean} >= 10 THEN 'High' "
        f"WHEN {mean} >= 5 THEN 'Moderate' ELSE 'Low' END"
    )


def calendar(day: str) -> str:
    return (
        f"CAST(dayofweek({day}) + 1 AS INTEGER) AS day_of_week_number, dayname({day}) AS day_of_week_name, "
        f"CAST(date_trunc('week', {day}) AS DATE) AS week_start_date, "
        f"CAST(date_trunc('month', {day}) AS DATE) AS month_start_date"
    )


def cents_ratio(amount: str, n: str) -> str:
    """amount / n to two decimals, half up, in whole numbers; amount is a non-negative DECIMAL(22,2)."""
    return (
        f"CASE WHEN {n} > 0 THEN CAST(CAST((2 * CAST({amount} * 100 AS HUGEINT) + {n}) // (2 * {n}) "
        "AS DECIMAL(22,0)) * 0.01 AS DECIMAL(22,2)) END"
    )


def money(value: str) -> str:
    return f"coalesce('$' || format('{{:,.2f}}', CAST({value} AS DOUBLE)), 'N/A')"


def count(value: str) -> str:
    return f"coalesce(format('{{:,.0f}}', CAST({value} AS DOUBLE)), 'N/A')"


def cost(spend: str = "marketing_spend", n: str = "bookings_count") -> str:
    return f"CASE WHEN {n} > 0 THEN CAST({spend} AS DOUBLE) / {n} END"


DISPLAY = display("channel")
SUM_N = "CAST(sum(bookings_count) AS BIGINT) AS bookings_count"
SUM_S = "CAST(sum(marketing_spend) AS DECIMAL(32,2)) AS marketing_spend"
# Mean of weekly counts to two decimals, nearest even on the scaled double.
MEAN_WEEK = "round_even(avg(weekly_meetings) * 100, 0) / 100"


def _daily(spent: str, booked: str = "bookings_daily") -> str:
    return f"""SELECT performance_date, {calendar("performance_date")}, channel, event_type_code, bookings_count,
                marketing_spend, {cents_ratio("marketing_spend", "bookings_count")} AS cost_per_booking
            FROM (SELECT coalesce(b.booking_date, s.spend_date) AS performance_date, s.channel,
                    coalesce(b.event_type_code, s.event_type_code) AS event_type_code,
                    coalesce(b.bookings_count, 0) AS bookings_count,
                    coalesce(s.marketing_spend, CAST(0 AS DECIMAL(22,2))) AS marketing_spend
                FROM {spent} s FULL OUTER JOIN {booked} b
                ON s.spend_date = b.booking_date AND s.event_type_code = b.event_type_code)"""


def _patterns(webhooks: str) -> str:
    return f"""SELECT booking_date, {calendar("booking_date")}, hour_of_day, time_slot,
                {slot_sort("time_slot")} AS time_slot_sort, channel, event_type_code, bookings_count
            FROM (SELECT CAST(webhook_created_at AS DATE) AS booking_date,
                    CAST(hour(webhook_created_at) AS INTEGER) AS hour_of_day,
                    {slot("hour(webhook_created_at)")} AS time_slot, coalesce(m.channel, 'unknown') AS channel,
                    w.event_type_code, count(*) AS bookings_count
                FROM {webhooks} w LEFT JOIN mapping m ON w.event_type_code = m.event_type_code
                WHERE webhook_created_at IS NOT NULL AND w.event_type_code IS NOT NULL GROUP BY ALL)"""


def _weekly(webhooks: str) -> str:
    return f"""SELECT user_email, CAST(date_trunc('week', webhook_created_at) AS DATE) AS week_start_date,
                count(DISTINCT coalesce(webhook_key, event_id)) AS weekly_meetings,
                CAST(min(webhook_created_at) AS DATE) AS first_booking_date_in_week,
                CAST(max(webhook_created_at) AS DATE) AS last_booking_date_in_week
            FROM {webhooks} WHERE webhook_created_at IS NOT NULL AND user_email IS NOT NULL GROUP BY 1, 2"""


def _load(weekly: str) -> str:
    return f"""SELECT user_email, week_start_date, weekly_meetings, total_meetings, number_of_weeks,
                ((200 * total_meetings + number_of_weeks) // (2 * number_of_weeks)) / 100.0::DOUBLE
                    AS avg_meetings_per_week,
                max_meetings_in_week, first_booking_date_in_week, last_booking_date_in_week
            FROM {weekly} JOIN (SELECT user_email, CAST(sum(weekly_meetings) AS BIGINT) AS total_meetings,
                    count(*) AS number_of_weeks, max(weekly_meetings) AS max_meetings_in_week
                FROM {weekly} GROUP BY user_email) USING (user_email)"""


_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "spend": (
        (),
        f"""SELECT CAST(o_orderdate AS DATE) AS spend_date, {CHANNEL} AS channel,
                {code(CHANNEL, "A", "N", "R")} AS event_type_code,
                CAST(o_totalprice AS DECIMAL(12,2)) AS spend, {ORDER_PATH} AS raw_file_path,
                {ORDER_MTIME} AS raw_file_modified_at FROM orders""",
    ),
    "bookings": ((), "SELECT l_shipdate AS webhook_created_at, l_returnflag AS event_type_code FROM lineitem"),
    "webhooks": (
        (),
        f"""SELECT {EMPLOYEE} AS user_email, {MEETING} AS event_id, ts AS webhook_created_at,
                event_type AS event_type_code,
                CASE WHEN event_type <> 'view' THEN 'K' || event_id END AS webhook_key FROM events""",
    ),
    "bookings_daily": (
        ("bookings",),
        """SELECT CAST(webhook_created_at AS DATE) AS booking_date, event_type_code, count(*) AS bookings_count
            FROM bookings WHERE webhook_created_at IS NOT NULL AND event_type_code IS NOT NULL GROUP BY ALL""",
    ),
    "spend_daily": (
        ("spend",),
        """SELECT spend_date, channel, event_type_code, CAST(sum(spend) AS DECIMAL(22,2)) AS marketing_spend
            FROM (SELECT DISTINCT * FROM spend) WHERE channel IS NOT NULL AND event_type_code IS NOT NULL GROUP BY ALL""",
    ),
    "mart": (("bookings_daily", "spend_daily"), _daily("spend_daily")),
    "recent_spend_daily": (
        ("spend",),
        """SELECT spend_date, channel, event_type_code, CAST(sum(spend) AS DECIMAL(22,2)) AS marketing_spend
            FROM (SELECT DISTINCT * FROM spend WHERE spend_date >= DATE '1995-06-09')
            WHERE channel IS NOT NULL AND event_type_code IS NOT NULL GROUP BY ALL""",
    ),
    "recent_mart": (("bookings_daily", "recent_spend_daily"), _daily("recent_spend_daily")),
    "perf": (
        ("mart",),
        "SELECT * REPLACE (coalesce(nullif(channel, ''), 'unknown') AS channel) FROM mart",
    ),
    "cells": (
        ("perf",),
        f"""SELECT performance_date, {DISPLAY} AS channel_display, {SUM_N}, {SUM_S} FROM perf
            WHERE performance_date IS NOT NULL GROUP BY ALL""",
    ),
    "days": (("perf",), f"SELECT performance_date, {SUM_N} FROM perf WHERE performance_date IS NOT NULL GROUP BY ALL"),
    "grid": (
        ("cells",),
        """SELECT CAST(d AS DATE) AS performance_date, channel_display
            FROM (SELECT unnest(generate_series(min(performance_date), max(performance_date), INTERVAL 1 DAY)) AS d
                FROM cells) CROSS JOIN (SELECT DISTINCT channel_display FROM cells)""",
    ),
    "dense": (
        ("grid", "cells"),
        """SELECT g.performance_date, g.channel_display, coalesce(c.bookings_count, 0) AS bookings_count
            FROM grid g LEFT JOIN cells c USING (performance_date, channel_display)""",
    ),
    "summary": (
        ("perf",),
        f"""SELECT *, {cost()} AS cost_per_booking
            FROM (SELECT {DISPLAY} AS channel_display, {SUM_N}, {SUM_S} FROM perf GROUP BY ALL)""",
    ),
    "leaderboard": (
        ("summary",),
        """SELECT *, CAST(dense_rank() OVER (ORDER BY performance_score) AS INTEGER) AS overall_rank
            FROM (SELECT *, booking_rank + cpb_rank AS performance_score
                FROM (SELECT *, CAST(dense_rank() OVER (ORDER BY bookings_count DESC) AS INTEGER) AS booking_rank,
                        CAST(dense_rank() OVER (ORDER BY marketing_spend DESC) AS INTEGER) AS spend_rank,
                        CAST(dense_rank() OVER (ORDER BY cost_per_booking ASC NULLS LAST) AS INTEGER) AS cpb_rank
                    FROM summary))""",
    ),
    "metrics": (
        ("summary",),
        """SELECT channel_display, 'bookings_count' AS metric, 'Bookings' AS metric_display,
                CAST(bookings_count AS DOUBLE) AS metric_value FROM summary
            UNION ALL SELECT channel_display, 'marketing_spend', 'Spend', CAST(marketing_spend AS DOUBLE) FROM summary
            UNION ALL SELECT channel_display, 'cost_per_booking', 'CPB', cost_per_booking FROM summary""",
    ),
    "mapping": (
        (),
        f"""SELECT {code(CHANNEL, "click", "view", "purchase")} AS event_type_code, min({CHANNEL}) AS channel
            FROM orders GROUP BY ALL""",
    ),
    "patterns": (("webhooks", "mapping"), _patterns("webhooks")),
    "weekly": (("webhooks",), _weekly("webhooks")),
    "load": (("weekly",), _load("weekly")),
    # the same marts over cleaned, keyed deliveries
    "silver_webhooks": (
        (),
        f"""SELECT *, sha256(concat_ws('||', event_id, webhook_event_type, invitee_identity)) AS webhook_key
            FROM (SELECT {MEETING} AS event_id, {NOTICE} AS webhook_event_type, {IDENTITY} AS invitee_identity,
                    {CREATED_AT} AS webhook_created_at, event_type AS event_type_code,
                    CASE WHEN event_type <> 'purchase' THEN {EMPLOYEE} END AS user_email,
                    'webhooks/' || event_id || '.json' AS raw_file_path FROM events)
            QUALIFY row_number() OVER (PARTITION BY webhook_key
                ORDER BY webhook_created_at DESC NULLS LAST, raw_file_path DESC) = 1""",
    ),
    "silver_spend": (
        ("spend",),
        f"""SELECT spend_date, channel, {code("channel", "click", "view", "purchase")} AS event_type_code, spend FROM spend
            QUALIFY row_number() OVER (PARTITION BY spend_date, channel
                ORDER BY raw_file_modified_at DESC NULLS LAST, raw_file_path DESC) = 1""",
    ),
    "silver_bookings_daily": (
        ("silver_webhooks",),
        """SELECT CAST(webhook_created_at AS DATE) AS booking_date, event_type_code, count(*) AS bookings_count
            FROM silver_webhooks WHERE webhook_created_at IS NOT NULL GROUP BY ALL""",
    ),
    "silver_spend_daily": (
        ("silver_spend",),
        """SELECT spend_date, channel, event_type_code, CAST(sum(spend) AS DECIMAL(22,2)) AS marketing_spend
            FROM silver_spend GROUP BY ALL""",
    ),
    "silver_mart": (
        ("silver_bookings_daily", "silver_spend_daily"),
        _daily("silver_spend_daily", "silver_bookings_daily"),
    ),
    "silver_patterns": (("silver_webhooks", "mapping"), _patterns("silver_webhooks")),
    "silver_weekly": (("silver_webhooks",), _weekly("silver_webhooks")),
    "silver_load": (("silver_weekly",), _load("silver_weekly")),
    "employees": (
        ("load",),
        f"""SELECT *, {level("avg_meetings_per_week")} AS load_level
            FROM (SELECT lower(trim(user_email)) AS user_email,
                    CAST(sum(weekly_meetings) AS BIGINT) AS total_meetings,
                    count(DISTINCT week_start_date) AS number_of_weeks, {MEAN_WEEK} AS avg_meetings_per_week,
                    max(weekly_meetings) AS max_meetings_in_week
                FROM load WHERE week_start_date IS NOT NULL GROUP BY 1)""",
    ),
}


def _needed(names: tuple[str, ...], found: dict[str, str]) -> dict[str, str]:
    for name in names:
        if name not in found:
            needs, body = _CTES[name]
            _needed(needs, found)
            found[name] = body
    return found


def with_ctes(sql: str, *names: str) -> str:
    """The statement with the named CTEs, and those they need, in front."""
    if not names:
        return sql.strip()
    parts = ", ".join(f"{name} AS ({body})" for name, body in _needed(names, {}).items())
    return f"WITH {parts} {sql.strip()}"
