"""Business rules as values: every one is a default that callers can replace."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# These must equal the business rules for the results to be right.
UNKNOWN = "unknown"
UNKNOWN_LABEL = "Unknown"
NOT_AVAILABLE = "N/A"
KEY_SEPARATOR = "||"
CREATED_AT_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSX"
DAY_PATTERN = "yyyy-MM-dd"
PAID_ADS_SUFFIX = "_paid_ads"
SPEND_CUTOFF = date(2026, 6, 9)  # used only where a caller asks for it
CHANNEL_CODES = {
    "facebook_paid_ads": "d639ecd3-8718-4068-955a-436b10d72c78",
    "youtube_paid_ads": "dbb4ec50-38cd-4bcd-bbff-efb7b5a6f098",
    "tiktok_paid_ads": "bb339e98-7a67-4af2-b584-8dbf95564312",
}
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
# Slot name and its last hour, in sort order; the last slot also takes a missing hour.
TIME_SLOTS = (
    ("overnight", 5),
    ("early_morning", 8),
    ("morning", 11),
    ("afternoon", 16),
    ("evening", 20),
    ("late_evening", None),
)
NO_SLOT_SORT = 99
# Load level and the lowest weekly mean it starts at, in sort order.
LOAD_LEVELS = (("Very high", 15), ("High", 10), ("Moderate", 5), ("Low", None))
METRIC_LABELS = {"bookings_count": "Bookings", "marketing_spend": "Spend", "cost_per_booking": "CPB"}
MONEY_METRICS = ("marketing_spend", "cost_per_booking")
LOWER_IS_BETTER = ("cost_per_booking",)
NEUTRAL_SCORE = 0.5
TRAILING_ROWS = 7
AUDIT_PREVIEW_ROWS = 5
SPEND_PREVIEW_ROWS = 50


@dataclass(frozen=True)
class Selection:
    """What a dashboard user picked. ``None`` means "not restricted"."""

    start: date | None = None
    end: date | None = None
    channels: tuple[str, ...] | None = None
