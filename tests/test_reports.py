"""Marts and reports against hand-made cases and brute-force pandas."""

import re
from datetime import date, datetime, timedelta
from decimal import Decimal

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slotledger.catalog import queries
from slotledger.operators import calendar, ranking, rows as row_ops
from slotledger.operators.combine import channel_mapping
from slotledger.operators.rows import in_period
from slotledger.plans import channels, dashboard, marts, patterns, trends, workload
from slotledger.schemas import MissingColumnsError
from slotledger.settings import SPEND_CUTOFF, Selection
from slotledger.sources.tables import clean_mart
from tests.conftest import SF_TINY, rows

DAY = date(2026, 6, 10)
PERF = "performance_date date, channel string, bookings_count bigint, marketing_spend decimal(22,2)"
PATTERNS = (
    "booking_date date, day_of_week_name string, day_of_week_number int, hour_of_day int, time_slot string, "
    "channel string, bookings_count bigint"
)
LOAD = "user_email string, week_start_date date, weekly_meetings bigint"
WEBHOOKS = (
    "user_email string, event_id string, webhook_event_type string, webhook_created_at timestamp, "
    "event_type_code string, webhook_key string"
)
SPEND = "spend_date date, channel string, event_type_code string, spend decimal(12,2), raw_file_path string"
HOSTILE = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

cells = st.lists(
    st.tuples(
        st.integers(0, 25).map(lambda n: DAY + timedelta(n)),
        st.sampled_from(["google_paid_ads", "google", "b2b", None]),
        st.integers(0, 9),
        st.integers(0, 500_000).map(lambda n: Decimal(n).scaleb(-2)),
    ),
    min_size=1,
    max_size=40,
)


@pytest.fixture
def perf(spark):
    return spark.createDataFrame(
        [
            (DAY, "google_paid_ads", 3, Decimal("30.00")),
            (DAY, "b2b_paid_ads", 0, Decimal("5.00")),
            (DAY + timedelta(3), "google_paid_ads", 2, Decimal("0.00")),
            (DAY + timedelta(3), "unknown", 4, Decimal("0.00")),
            (None, "b2b_paid_ads", 9, Decimal("9.00")),
        ],
        PERF,
    )


def webhook(who, key, when, code, kind="invitee.created"):
    return (who, f"EV{key}", kind, when, code, key)


# Marts


def test_daily_performance(spark):
    at = datetime(2026, 6, 10, 9)
    webhooks = spark.createDataFrame(
        [webhook("e", "1", at, "T"), webhook("e", "2", at, "T", "invitee.canceled"), webhook("e", "3", at, "T")]
        + [webhook("e", "4", at, "U"), webhook("e", "5", None, "T"), webhook("e", "6", at, None)],
        WEBHOOKS,
    )
    spend = spark.createDataFrame(
        [(DAY, "one", "T", Decimal("10.00"), "a"), (DAY, "one", "T", Decimal("10.00"), "a")]  # the same row twice
        + [(DAY, "two", "T", Decimal("0.00"), "a"), (date(2026, 6, 8), "one", "T", Decimal("9.00"), "a")]
        + [(date(2026, 6, 9), "one", "T", Decimal("7.00"), "a"), (DAY, None, "T", Decimal("1.00"), "a")],
        SPEND,
    )
    found = marts.daily_channel_performance(webhooks, spend, SPEND_CUTOFF)
    columns = ["performance_date", "channel", "event_type_code", "bookings_count", "marketing_spend", "cost_per_booking"]
    assert rows(found.select(*columns)) == rows(
        spark.createDataFrame(
            [
                (date(2026, 6, 9), "one", "T", 0, Decimal("7.00"), None),
                # channels that share a code each show all of its bookings
                (DAY, "one", "T", 3, Decimal("10.00"), Decimal("3.33")),
                (DAY, "two", "T", 3, Decimal("0.00"), Decimal("0.00")),
                (DAY, None, "U", 1, Decimal("0.00"), Decimal("0.00")),
            ],
            found.select(*columns).schema,
        )
    )
    created_only = marts.daily_channel_performance(webhooks, spend, event_types=["invitee.created"])
    assert created_only.filter("channel = 'one' AND bookings_count > 0").first()["bookings_count"] == 2


def test_time_patterns_keep_every_eligible_webhook(spark):
    at = datetime(2026, 6, 14, 23, 59)
    webhooks = spark.createDataFrame(
        [webhook("e", "1", at, "T"), webhook("e", "2", at, "T"), webhook("e", "3", at, "X"), webhook("e", "4", None, "T")],
        WEBHOOKS,
    )
    spend = spark.createDataFrame(
        [(DAY, c, t, Decimal("1.00"), "a") for c, t in [("b", "T"), ("a", "T"), (None, "T"), ("z", None)]], SPEND
    )
    assert rows(channel_mapping(spend)) == [("T", "a")]
    found = marts.booking_time_patterns(webhooks, channel_mapping(spend))
    assert rows(found.select("booking_date", "day_of_week_number", "hour_of_day", "time_slot", "channel", "bookings_count")) == [
        (at.date(), 1, 23, "late_evening", "a", 2),
        (at.date(), 1, 23, "late_evening", "unknown", 1),
    ]


def test_meeting_load(spark):
    monday = datetime(2026, 6, 8)
    webhooks = spark.createDataFrame(
        [webhook("e", "1", monday, "T"), webhook("e", "1", monday + timedelta(2), "T"), webhook("e", "2", monday, "T")]
        + [("e", "EV9", "x", monday, "T", None), ("e", None, "x", monday, "T", None)]
        + [webhook("e", "3", monday + timedelta(7), "T"), webhook("e", "4", monday + timedelta(14), "T")]
        + [webhook(None, "5", monday, "T"), webhook("e", "6", None, "T")],
        WEBHOOKS,
    )
    assert rows(marts.employee_meeting_load(webhooks)) == [
        ("e", date(2026, 6, 8), 3, 5, 3, 1.67, 3, date(2026, 6, 8), date(2026, 6, 10)),
        ("e", date(2026, 6, 15), 1, 5, 3, 1.67, 3, date(2026, 6, 15), date(2026, 6, 15)),
        ("e", date(2026, 6, 22), 1, 5, 3, 1.67, 3, date(2026, 6, 22), date(2026, 6, 22)),
    ]
    weekly = marts.weekly_load(webhooks)
    assert rows(marts.employee_summary(weekly)) == [("e", 5, 3, 5 / 3, 3)]


# Selection


def test_selection(spark, perf):
    assert dashboard.select_daily(perf, Selection()).count() == 5
    assert dashboard.select_daily(perf, Selection(DAY, DAY)).count() == 2
    assert dashboard.select_daily(perf, Selection(DAY, None)).count() == 4
    assert dashboard.select_daily(perf, Selection(channels=())).count() == 0
    assert dashboard.select_daily(perf, Selection(channels=("unknown",))).count() == 1


def test_patterns_follow_the_channels_shown(spark, perf):
    seen = spark.createDataFrame(
        [(DAY, "Wednesday", 4, 9, "morning", c, 1) for c in ("google_paid_ads", "unknown", "elsewhere", None)], PATTERNS
    )
    load = spark.createDataFrame([("e", DAY, 1), ("e", DAY - timedelta(1), 1)], LOAD)
    _, shown, weeks = dashboard.select_all(perf, seen, load, Selection(DAY, DAY))
    assert rows(shown.select("channel")) == [("google_paid_ads",)]
    assert weeks.count() == 1
    _, chosen, _ = dashboard.select_all(perf, seen, load, Selection(DAY, DAY, ("elsewhere",)))
    assert rows(chosen.select("channel")) == [("elsewhere",)]


def test_options_and_headline(perf):
    last = DAY + timedelta(3)
    assert rows(dashboard.filter_options(perf)) == [
        ("channel", "b2b_paid_ads", DAY, DAY),
        ("channel", "google_paid_ads", DAY, last),
        ("channel", "unknown", last, last),
        ("period", None, DAY, last),
    ]
    assert rows(dashboard.headline_kpis(perf)) == [(18, Decimal("44.00"), 44 / 18, DAY, last)]


def test_mart_cleaning(spark):
    raw = spark.createDataFrame([("2026-06-10", ""), ("bad", None), ("2026-06-11", "x")], "performance_date string, channel string")
    assert rows(clean_mart(raw, "daily")) == [(None, "unknown"), (DAY, "unknown"), (DAY + timedelta(1), "x")]


# Channel reports


def test_channel_reports(perf):
    assert rows(channels.activity_kpis(perf)) == [(9, 2, 4.5)]
    assert rows(channels.top_channel(perf)) == [("Google", 5)]
    assert rows(channels.channel_cpb(perf)) == [
        ("B2B", 0, Decimal("5.00"), None), ("Google", 5, Decimal("30.00"), 6.0), ("Unknown", 4, Decimal("0.00"), 0.0),
    ]
    assert rows(channels.best_cpb_channel(perf))[0][0] == "Unknown"
    assert channels.cpb_trend(perf).count() == 3
    table = channels.cost_table(channels.channel_cpb(perf))
    assert table.columns == ["Channel", "Bookings", "Spend", "Cost Per Booking"]
    assert rows(table)[0] == ("B2B", 0, "$5.00", "N/A")


def test_leaderboard(perf):
    board = channels.channel_leaderboard(perf)
    shown = [tuple(r) for r in board.orderBy(*channels.leaderboard_order()).collect()]
    assert shown == [  # bookings, spend, cost; ranks by bookings, spend, cost; score; overall
        ("B2B", 9, Decimal("14.00"), 14 / 9, 1, 2, 2, 3, 1),
        ("Unknown", 4, Decimal("0.00"), 0.0, 3, 3, 1, 4, 2),
        ("Google", 5, Decimal("30.00"), 6.0, 2, 1, 3, 5, 3),
    ]
    assert rows(channels.best_channels(board).select("best_by", "channel_display")) == [
        ("cost_per_booking", "Unknown"), ("overall", "B2B"), ("volume", "B2B"),
    ]
    assert channels.leaderboard_table(board).columns == ["Rank", "Channel", "Bookings", "Spend", "Cost Per Booking"]
    assert "CPB Rank" in channels.leaderboard_detail(board).columns


def test_ranks_put_missing_last(spark):
    df = spark.createDataFrame([(0, 3.0), (1, None), (2, 1.0), (3, None), (4, 3.0)], "i int, x double")
    ranked = ranking.dense_ranks(df, {"place": F.col("x")}, last=True).orderBy("i").collect()
    assert [(r["place"], r["place_last"]) for r in ranked] == [(2, 3), (3, 3), (1, 3), (3, 3), (2, 3)]
    known = ranking.dense_ranks(df, {"place": F.col("x")}, {"place": F.col("x") * 20})
    assert [r["place"] for r in known.orderBy("i").collect()] == [2, 3, 1, 3, 2]
    assert ranking.dense_ranks(df.filter("false"), {"place": F.col("x")}).collect() == []


def test_rows_repeated_beyond_one_array_come_back(spark):
    df = spark.range(25_003).select(F.least(F.col("id"), F.lit(2)).alias("x"))
    ranked = ranking.dense_ranks(df, {"place": F.col("x")})
    assert rows(ranked.groupBy("x", "place").count()) == [(0, 1, 1), (1, 2, 1), (2, 3, 25_001)]


def test_ranks_of_ranks_stay_one_small_plan(spark):
    plan = queries()["channel_leaderboard"](spark, SF_TINY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 12
    rows_alone = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert len(rows_alone) == len(re.findall(r"SinglePartition[^\n]*\n[^\n]*partial_collect_list", plan))


def test_spread_ranks_are_the_plain_ones(spark):
    """Many values, close together and far apart, of both signs, a third of them equal; and repeated rows."""
    wide = F.expr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE pow(-1.7, id % 90) + (id % 11) / 7 END")
    df = spark.range(6000).select("id", wide.alias("x"), (F.col("id") % 101).alias("y"))
    df = df.union(df.filter("id % 7 = 0"))
    ranks = {"a": F.col("x"), "b": -F.col("y")}
    plain = df.withColumns({n: F.dense_rank().over(Window.orderBy(k.asc_nulls_last())) for n, k in ranks.items()})
    assert rows(ranking.dense_ranks(df, ranks)) == rows(plain)


def test_close_decimals_do_not_tie_and_spread(spark):
    """200,000 values between 100 and 101, apart only in their last decimals, as doubles equal in part."""
    close = F.concat(F.lit("100."), F.lpad("id", 20, "0")).cast("decimal(38,20)")
    ranked = ranking.dense_ranks(spark.range(1000).select("id", close.alias("x")), {"place": F.col("x")})
    assert ranked.filter("place <> id + 1").count() == 0
    many = spark.range(200_000).select((100 + F.col("id") / 200_000).alias("x"))
    ranked = ranking.dense_ranks(many, {"place": F.col("x")})
    assert ranked.agg(F.max("place")).first()[0] == 200_000
    # the only rows that meet in one task are the quantiles, a row for each rank
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == len(re.findall(r"SinglePartition[^\n]*\n[^\n]*partial_collect_list", plan))


def test_scores_of_rows_without_a_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 5.0), (None, 7.0)], "m string, x double")
    scored = ranking.minmax_score(df, "m", "x", "score")
    assert rows(scored) == [(None, 5.0, 0.0), (None, 7.0, 1.0), ("a", 1.0, 0.0), ("a", 2.0, 1.0)]
    assert "broadcast" not in scored._jdf.queryExecution().logical().toString().lower()


def test_optional_load_columns_are_parsed(spark):
    load = spark.createDataFrame([("A@b.c", "2024-01-01", "3", "x", "2024-01-02T05:00:00")], "user_email string, week_start_date string, weekly_meetings string, total_meetings string, first_booking_date_in_week string")
    assert rows(workload.valid_load(load)) == [("a@b.c", date(2024, 1, 1), 3.0, None, date(2024, 1, 2))]


@pytest.mark.parametrize(("start", "end", "expected"), [(2, None, [2, 3]), (None, 2, [1, 2]), (2, 2, [2]), (None, None, [1, 2, 3])])
def test_half_open_periods(spark, start, end, expected):
    df = spark.createDataFrame([(date(2024, 1, d),) for d in (1, 2, 3)], "d date")
    day = lambda n: n and date(2024, 1, n)
    assert [r[0].day for r in rows(in_period(df, "d", day(start), day(end)))] == expected


def test_scores(spark):
    df = spark.createDataFrame(
        [("up", 1.0), ("up", None), ("up", 3.0), ("down", 1.0), ("down", None), ("down", 3.0)]
        + [("flat", 2.0), ("flat", 2.0), ("flat", None), ("none", None)],
        "m string, x double",
    )
    scored = ranking.minmax_score(df, "m", "x", "score", inverted=["down"])
    assert rows(scored.select("m", "x", "score")) == [
        ("down", None, None), ("down", 1.0, 1.0), ("down", 3.0, 0.0),
        ("flat", None, 0.5), ("flat", 2.0, 0.5), ("flat", 2.0, 0.5),
        ("none", None, 0.5),
        ("up", None, None), ("up", 1.0, 0.0), ("up", 3.0, 1.0),
    ]


@HOSTILE
@given(cells)
def test_leaderboard_ranks_are_those_of_pandas(spark, table):
    board = channels.channel_leaderboard(spark.createDataFrame(table, PERF)).toPandas()
    cost = pd.to_numeric(board["cost_per_booking"])
    volume = board["bookings_count"].rank(method="dense", ascending=False)
    price = cost.rank(method="dense", na_option="bottom")
    assert (board["booking_rank"] == volume).all()
    assert (board["spend_rank"] == board["marketing_spend"].astype(float).rank(method="dense", ascending=False)).all()
    assert (board["cpb_rank"] == price).all()
    assert (board["overall_rank"] == (volume + price).rank(method="dense")).all()


# Trend


@HOSTILE
@given(cells)
def test_trends_are_those_of_pandas(spark, table):
    perf = spark.createDataFrame(table, PERF)
    pdf = pd.DataFrame(table, columns=["day", "channel", "n", "spend"])
    pdf["day"] = pd.to_datetime(pdf["day"])
    pdf["label"] = pdf["channel"].map({"google_paid_ads": "Google", "google": "Google", "b2b": "B2B"}).fillna("Unknown")

    totals = pdf.groupby("day")["n"].sum()
    mean = totals.rolling(7, min_periods=1).mean()
    found = {r[0]: (r[1], r[2]) for r in trends.rolling_total(perf).collect()}
    assert found == {d.date(): (n, pytest.approx(m)) for (d, n), m in zip(totals.items(), mean)}

    grid = pd.MultiIndex.from_product([pd.date_range(totals.index.min(), totals.index.max()), sorted(set(pdf["label"]))])
    dense = pdf.groupby(["day", "label"])["n"].sum().reindex(grid, fill_value=0)
    by_channel = dense.unstack().rolling(7, min_periods=1).mean().stack()
    found = {(r[0], r[1]): (r[2], r[3]) for r in trends.rolling_by_channel(perf).collect()}
    assert found == {(d.date(), c): (n, pytest.approx(by_channel[d, c])) for (d, c), n in dense.items()}
    assert rows(trends.channel_grid(perf)) == rows(trends.densify_daily(perf).drop("bookings_count"))

    weekly = dense.unstack().resample("W-MON").sum().stack()
    assert {(r[0], r[1]): r[2] for r in trends.weekly_bookings(perf).collect()} == {
        (d.date(), c): n for (d, c), n in weekly.items()
    }

    total, last_day, last_n, first_mean, last_mean, delta = trends.trend_kpis(perf).first()
    assert (total, last_day, last_n) == (totals.sum(), totals.index[-1].date(), totals.iloc[-1])
    assert (first_mean, last_mean, delta) == pytest.approx((mean.iloc[0], mean.iloc[-1], mean.iloc[-1] - mean.iloc[0]))


def test_densify_with_one_row(spark):
    df = spark.createDataFrame([(DAY, "a", 5)], "d date, s string, v int")
    assert rows(calendar.densify(df, "d", "s", "v")) == [(DAY, "a", 5)]


def test_densify_reaches_both_ends(spark):
    df = spark.createDataFrame([(DAY, "a", 5), (DAY + timedelta(3), "b", 7), (None, "c", 1)], "d date, s string, v int")
    days = [DAY + timedelta(n) for n in range(4)]
    assert rows(calendar.densify(df, "d", "s", "v", fill=-1)) == rows(
        spark.createDataFrame(
            list(zip(days, "aaaa", [5, -1, -1, -1])) + list(zip(days, "bbbb", [-1, -1, -1, 7])), "d date, s string, v int"
        )
    )


# Booking times


def test_pattern_reports(spark):
    tp = spark.createDataFrame(
        [
            (DAY, "Wednesday", 4, 9, "morning", "a_paid_ads", 2),
            (DAY, "Wednesday", 4, 13, "afternoon", "a", 2),
            (DAY, "Wednesday", None, 9, None, "b", 1),
            (None, "Friday", 6, 9, "morning", "a", 50),
            (DAY, None, 6, 9, "morning", "a", 50),
            (DAY, "Friday", 6, None, "morning", "a", 50),
        ],
        PATTERNS,
    )
    assert rows(patterns.pattern_kpis(tp)) == [(5,)]
    assert rows(patterns.by_hour(tp)) == [(13, 2, "1 PM"), (9, 3, "9 AM")]
    assert rows(patterns.by_weekday(tp)) == [(4, "Wednesday", 4)]
    assert rows(patterns.by_slot(tp)) == [("afternoon", 2, "Afternoon"), ("morning", 2, "Morning")]
    assert rows(patterns.hour_channel(tp).select("hour_of_day", "channel_display", "bookings_count")) == [
        (13, "A", 2), (9, "A", 2), (9, "B", 1),
    ]
    assert rows(patterns.busiest_slots(tp)) == [
        ("hour", "9 AM", 3), ("time_slot", "Afternoon", 2), ("weekday", "Wednesday", 4),
    ]
    assert patterns.pattern_table(tp).columns == ["Booking Date", "Day", "Hour", "Time Slot", "Channel", "Bookings"]


# Meeting load


def test_load_reports(spark):
    week = date(2026, 6, 8)
    load = spark.createDataFrame(
        [(" Ann@x.io", week, 10), ("ann@X.io ", week, 6), ("ann@x.io", week + timedelta(7), None), ("bo@x.io", week, 5)]
        + [("cy@x.io", week, 5), ("cy@x.io", None, 99), (None, week, 2)],
        LOAD,
    )
    board = workload.employee_leaderboard(load)
    shown = [tuple(r) for r in board.orderBy(*workload.leaderboard_order()).collect()]
    assert shown == [
        ("ann@x.io", 16, 2, 5.33, 10, "Moderate"),
        ("bo@x.io", 5, 1, 5.0, 5, "Moderate"),
        ("cy@x.io", 5, 1, 5.0, 5, "Moderate"),
        ("Unknown", 2, 1, 2.0, 2, "Low"),
    ]
    assert rows(workload.employee_kpis(load)) == [(28, 4, pytest.approx(17.33 / 4), 10, "ann@x.io")]
    assert rows(workload.busiest_employee(load))[0][0] == "ann@x.io"
    assert rows(workload.load_level_summary(load)) == [("Low", 1, 2, 2.0, 4), ("Moderate", 3, 26, 5.11, 3)]
    assert (week, "ann@x.io", 16, "2026-06-08") in rows(workload.employee_weekly(load))
    assert workload.load_table(load).columns == ["Employee", "Week Starting", "Weekly Meetings"]
    assert workload.leaderboard_table(board).columns[-1] == "Load Level"


# Contracts


@pytest.mark.parametrize(
    "report",
    [channels.daily_channel_bookings, channels.daily_cpb, channels.channel_leaderboard, trends.daily_totals]
    + [patterns.by_hour, workload.employee_leaderboard],
)
def test_missing_columns_fail_while_planning(spark, report):
    with pytest.raises(MissingColumnsError, match="missing required columns"):
        report(spark.createDataFrame([], "performance_date date, other string"))


def test_empty_input_gives_empty_reports(spark):
    perf, tp, load = (spark.createDataFrame([], schema) for schema in (PERF, PATTERNS, LOAD))
    for report in (channels.daily_channel_bookings, channels.channel_totals, channels.top_channel, channels.daily_cpb,
                   channels.channel_leaderboard, trends.rolling_total, trends.channel_grid, trends.rolling_by_channel,
                   trends.weekly_bookings, trends.trend_kpis):
        assert rows(report(perf)) == [], report
    board = channels.channel_leaderboard(perf)
    assert rows(channels.best_channels(board)) == rows(channels.metric_heatmap(board)) == []
    assert rows(channels.activity_kpis(perf)) == [(0, 0, 0.0)]
    assert rows(dashboard.headline_kpis(perf)) == [(0, Decimal("0.00"), None, None, None)]
    for report in (patterns.by_hour, patterns.weekday_slot, patterns.busiest_slots):
        assert rows(report(tp)) == [], report
    for report in (workload.employee_leaderboard, workload.employee_heatmap, workload.load_level_summary):
        assert rows(report(load)) == [], report


def test_text_numbers_are_read_leniently(spark):
    perf = spark.createDataFrame(
        [(DAY, "a", "3", "1.50"), (DAY, "a", "x", None)],
        "performance_date date, channel string, bookings_count string, marketing_spend string",
    )
    assert rows(channels.channel_cpb(perf)) == [("A", 3.0, 1.5, 0.5)]


def test_present_leaves_out_what_is_not_there(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert row_ops.present(df, {"a": "A"}).columns == ["A", "b"]
    assert row_ops.present(df, {"a": "A", "c": "C"}, ["c", "a"]).columns == ["A"]


@pytest.mark.parametrize(("count", "rows_"), [(3000, 7), (40, 7), (5, 3), (0, 7), (300, 1), (200, 90)])
def test_trailing_mean_over_times_needs_no_single_task(spark, count, rows_):
    at = F.timestamp_seconds(F.col("id") * F.col("id") * 17 + 1_700_000_000)
    df = spark.range(count).select(at.alias("at"), (F.col("id") % 13).cast("double").alias("x"), F.lit("k").alias("_bounds_"))
    found = calendar.rolling_mean(df, "at", "x", "mean", rows_)
    plain = df.withColumn("mean", F.avg("x").over(Window.orderBy("at").rowsBetween(1 - rows_, 0)))
    assert rows(found) == rows(plain)
    text = found._jdf.queryExecution().executedPlan().toString()
    alone = re.findall(r"SinglePartition[^\n]*\n([^\n]*)", text)
    assert all("partial_percentile_approx" in line for line in alone)


def test_trailing_mean_with_missing_and_tied_times(spark):
    df = spark.createDataFrame([(None, 1.0), (2.0, 2.0), (2.0, 4.0), (3.0, 6.0), (None, 3.0)], "at double, x double")
    found = calendar.rolling_mean(df, "at", "x", "mean", 2)
    assert rows(found) == [(None, 1.0, 1.0), (None, 3.0, 2.0), (2.0, 2.0, 2.5), (2.0, 4.0, 3.0), (3.0, 6.0, 5.0)]
