"""Reports on channels: bookings by day, cost per booking, and the leaderboard."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger import schemas, settings
from slotledger.functions import numbers, text
from slotledger.operators.ranking import BUCKETS, dense_ranks, minmax_score, top_one, unpivot_metrics
from slotledger.operators.rows import drop_missing, present
from slotledger.plans.dashboard import spend_figures
from slotledger.schemas import require_columns


_LABEL = "channel_display"
_BOOKED = ("performance_date", "channel", "bookings_count")

# Headings that readers of the reports rely on.
COLUMN_LABELS = {
    "performance_date": "Date",
    "channel_display": "Channel",
    "bookings_count": "Bookings",
    "marketing_spend": "Spend",
    "cost_per_booking": "Cost Per Booking",
}
# Headings that readers of the reports rely on.
LEADERBOARD_LABELS = {"overall_rank": "Rank"} | COLUMN_LABELS
LEADERBOARD_DETAIL_LABELS = COLUMN_LABELS | {
    "booking_rank": "Booking Rank",
    "spend_rank": "Spend Rank",
    "cpb_rank": "CPB Rank",
    "overall_rank": "Overall Rank",
}


def _labelled(daily: DataFrame, *measures: str) -> DataFrame:
    return daily.select(
        *[c for c in daily.columns if c not in measures and c != "channel"],
        text.display_channel(F.col("channel")).alias(_LABEL),
        *[numbers.numeric(daily, m).alias(m) for m in measures],
    )


def _dated(daily: DataFrame) -> DataFrame:
    return drop_missing(daily, "performance_date")


def _bookings() -> Column:
    return numbers.total(F.col("bookings_count")).alias("bookings_count")


def _spend() -> Column:
    return numbers.total(F.col("marketing_spend")).alias("marketing_spend")


def _with_cost(summary: DataFrame) -> DataFrame:
    cost = numbers.ratio(F.col("marketing_spend"), F.col("bookings_count"))
    return summary.withColumn("cost_per_booking", cost)


# Bookings by day and channel


def daily_channel_bookings(daily: DataFrame) -> DataFrame:
    require_columns(daily, _BOOKED, "daily bookings report")
    return _labelled(_dated(daily), "bookings_count").groupBy("performance_date", _LABEL).agg(_bookings())


def activity_kpis(daily: DataFrame) -> DataFrame:
    """Bookings, days on which some channel was booked, and bookings per such day."""
    days = daily_channel_bookings(daily).groupBy("performance_date").agg(
        _bookings(), F.max(F.col("bookings_count") > 0).alias("active")
    )
    total, active = numbers.total(F.col("bookings_count")), F.count_if("active")
    return days.agg(
        total.alias("total_bookings"),
        active.alias("active_days"),
        F.coalesce(numbers.ratio(total, active), F.lit(0.0)).alias("avg_bookings_per_active_day"),
    )


def channel_totals(daily: DataFrame) -> DataFrame:
    """Bookings per channel. Order by ``bookings_count`` descending to show."""
    require_columns(daily, _BOOKED, "daily bookings report")
    return _labelled(_dated(daily), "bookings_count").groupBy(_LABEL).agg(_bookings())


def top_channel(daily: DataFrame) -> DataFrame:
    return top_one(channel_totals(daily), [F.desc("bookings_count"), F.asc(_LABEL)])


# Cost per booking


def _costed(daily: DataFrame, what: str) -> DataFrame:
    require_columns(daily, schemas.DAILY_PERFORMANCE, what)
    return _labelled(daily, "bookings_count", "marketing_spend")


def daily_cpb(daily: DataFrame) -> DataFrame:
    """Cost per booking of each day and channel, from its sums; the mart's own ratio is not used."""
    rows = _costed(_dated(daily), "cost per booking report")
    return _with_cost(rows.groupBy("performance_date", _LABEL).agg(_bookings(), _spend()))


def cpb_trend(daily: DataFrame) -> DataFrame:
    """The days that have a cost per booking."""
    return drop_missing(daily_cpb(daily), "performance_date", "cost_per_booking")


def channel_cpb(daily: DataFrame) -> DataFrame:
    """Cost per booking of each channel. Order by it with NULLs last to show."""
    rows = _costed(_dated(daily), "cost per booking report")
    return _with_cost(rows.groupBy(_LABEL).agg(_bookings(), _spend()))


def overall_figures(daily: DataFrame) -> DataFrame:
    """Bookings, spend and cost per booking of everything, undated rows included."""
    return _costed(daily, "channel leaderboard").agg(*spend_figures())


def overall_cpb(daily: DataFrame) -> DataFrame:
    """The same over the dated rows that the cost per booking report shows."""
    return overall_figures(_dated(daily))


def best_cpb_channel(daily: DataFrame) -> DataFrame:
    priced = drop_missing(channel_cpb(daily), "cost_per_booking")
    return top_one(priced, [F.asc("cost_per_booking"), F.asc(_LABEL)])


def cost_table(costs: DataFrame) -> DataFrame:
    """A cost table as text for reading: money formatted, columns labelled."""
    return present(_with_money_text(costs), COLUMN_LABELS, COLUMN_LABELS)


def _with_money_text(df: DataFrame) -> DataFrame:
    return df.withColumns({m: text.money_text(F.col(m)) for m in settings.MONEY_METRICS})


# Leaderboard


def channel_summary(daily: DataFrame) -> DataFrame:
    """Bookings, spend and cost per booking of each channel, undated rows included."""
    rows = _costed(daily, "channel leaderboard")
    return _with_cost(rows.groupBy(_LABEL).agg(_bookings(), _spend()))


def composite_rank(ranked: DataFrame, buckets: Column | None = None) -> DataFrame:
    """Score from volume and price ranks, lower is better, and the rank of that score; ``buckets`` as for dense_ranks."""
    scored = ranked.withColumn("performance_score", F.col("booking_rank") + F.col("cpb_rank"))
    return dense_ranks(scored, {"overall_rank": F.col("performance_score")}, {"overall_rank": buckets} if buckets is not None else None)


def channel_leaderboard(daily: DataFrame) -> DataFrame:
    """Every channel with its ranks. Order by ``leaderboard_order()`` to show."""
    ranks = {
        "booking_rank": -F.col("bookings_count"),
        "spend_rank": -F.col("marketing_spend"),
        "cpb_rank": F.col("cost_per_booking"),
    }
    ranked = dense_ranks(channel_summary(daily), ranks, last=True)
    # scores lie between 2 and the sum of the last places, so their buckets need no look at the data
    steps = F.col("booking_rank_last") + F.col("cpb_rank_last") - 1
    bucket = ((F.col("booking_rank") + F.col("cpb_rank") - 2) * BUCKETS / steps).cast("int")
    return composite_rank(ranked, bucket).drop(*[f"{name}_last" for name in ranks])


def leaderboard_order() -> list[Column]:
    return [
        F.asc("overall_rank"),
        F.asc_nulls_last("cost_per_booking"),
        F.desc("bookings_count"),
        F.asc(_LABEL),
    ]


def best_channels(leaderboard: DataFrame) -> DataFrame:
    """The channel that leads in volume, in price, and overall; one row each, from one pass."""
    cost_last = F.coalesce("cost_per_booking", F.lit(float("inf")))
    order = {
        "volume": F.struct(-F.col("bookings_count"), cost_last, _LABEL),
        "cost_per_booking": F.when(
            F.col("cost_per_booking").isNotNull(), F.struct("cost_per_booking", -F.col("bookings_count"), _LABEL)
        ),
        "overall": F.struct("overall_rank", cost_last, -F.col("bookings_count"), _LABEL),
    }
    row = F.struct(_LABEL, "bookings_count", "cost_per_booking", "overall_rank")
    winners = leaderboard.agg(*[F.min_by(row, by).alias(name) for name, by in order.items()])
    return (
        winners.unpivot([], list(order), "best_by", "winner")
        .filter(F.col("winner").isNotNull())
        .select("best_by", "winner.*")
    )


def leaderboard_table(leaderboard: DataFrame) -> DataFrame:
    return present(_with_money_text(leaderboard), LEADERBOARD_LABELS, LEADERBOARD_LABELS)


def leaderboard_detail(leaderboard: DataFrame) -> DataFrame:
    return present(_with_money_text(leaderboard), LEADERBOARD_DETAIL_LABELS)


def metric_heatmap(leaderboard: DataFrame) -> DataFrame:
    """One cell per channel and metric with its score between the metric's extremes and its text."""
    cells = unpivot_metrics(leaderboard, _LABEL)
    scored = minmax_score(cells, "metric", "metric_value", "normalized_score", settings.LOWER_IS_BETTER)
    shown = text.metric_text(F.col("metric"), F.col("metric_value"))
    return scored.withColumn("metric_value_display", shown)
