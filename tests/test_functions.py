"""Small semantics, one by one."""

from datetime import date, datetime
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from slotledger.functions import dates, numbers, rules, text

HOSTILE = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def apply(spark, values, kind, expression):
    """The expression over each value, in the order given."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_channel_labels(spark):
    names = ["b2b_paid_ads", "o'neil_x", "GOOGLE_ads", None, "4-not_specified", "a__b", ""]
    assert apply(spark, names, "string", text.display_channel) == [
        "B2B", "O'Neil X", "Google Ads", "Unknown", "4-Not Specified", "A  B", "",
    ]


@HOSTILE
@given(st.lists(st.text("abzAZ09 _-'.é中ß", max_size=12), min_size=1, max_size=50))
def test_title_case_is_pythons(spark, names):
    assert apply(spark, names, "string", text.title_case) == [name.lower().title() for name in names]


def test_normalisation(spark):
    assert apply(spark, [" TikTok\t Paid  Ads ", None, ""], "string", text.normalize_channel) == ["tiktok_paid_ads", None, ""]
    assert apply(spark, ["Jo  Bo", None], "string", text.slug_name) == ["jo_bo", None]
    assert apply(spark, [" A@B.c ", None, ""], "string", text.normalize_email) == ["a@b.c", "Unknown", ""]
    assert apply(spark, ["x", "", None], "string", text.default_unknown) == ["x", "unknown", "unknown"]


def test_uri_parts(spark):
    uris = ["https://h/scheduled_events/EV1?x=1", "https://h/scheduled_events/EV2/invitees/3", "nomatch", "", None]
    found = apply(spark, uris, "string", lambda c: text.uri_part(c, "scheduled_events"))
    assert found == ["EV1", "EV2", "", "", None]


def test_key_skips_missing_parts(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a", "", "b")], "x string, y string, z string")
    keys = [r[0] for r in df.select(text.surrogate_key(F.col("x"), F.col("y"), F.col("z"))).collect()]
    assert keys[0] == keys[1] != keys[2] and len(keys[0]) == 64


def test_hour_labels(spark):
    hours = [0, 1, 11, 12, 13, 23, None]
    assert apply(spark, hours, "int", text.display_hour) == ["12 AM", "1 AM", "11 AM", "12 PM", "1 PM", "11 PM", "Unknown"]
    assert apply(spark, [9.0], "double", text.display_hour) == ["9 AM"]


def test_amount_texts(spark):
    assert apply(spark, [1234.5, 0.0, -5.0, None], "double", text.money_text) == ["$1,234.50", "$0.00", "$-5.00", "N/A"]
    assert apply(spark, [1234567.0, None], "double", text.count_text) == ["1,234,567", "N/A"]


def test_created_at(spark):
    texts = ["2026-06-10T01:02:03.123456Z", "2026-06-10 T05:00:00.000000Z", "2026-06-10T05:00:00Z", "garbage", "", None]
    assert apply(spark, texts, "string", dates.parse_created_at) == [
        datetime(2026, 6, 10, 1, 2, 3, 123456), datetime(2026, 6, 10, 5), None, None, None, None,
    ]


def test_lenient_dates(spark):
    assert apply(spark, ["2026-06-09", "bad", "09/06/2026", None], "string", dates.parse_day) == [date(2026, 6, 9), None, None, None]
    assert apply(spark, ["2026-06-09", "2026-06-09 10:00:00", "bad"], "string", dates.to_day) == [date(2026, 6, 9)] * 2 + [None]
    assert apply(spark, [datetime(2026, 6, 9, 23)], "timestamp", dates.to_day) == [date(2026, 6, 9)]


def test_weeks(spark):
    days = [date(2026, 6, 8), date(2026, 6, 9), date(2026, 6, 15), date(2026, 6, 16)]
    ends = [date(2026, 6, 8), date(2026, 6, 15), date(2026, 6, 15), date(2026, 6, 22)]
    starts = [date(2026, 6, 8), date(2026, 6, 8), date(2026, 6, 15), date(2026, 6, 15)]
    assert apply(spark, days, "date", dates.week_ending_monday) == ends
    assert apply(spark, days, "date", dates.week_start) == starts
    assert apply(spark, days, "date", dates.month_start) == [date(2026, 6, 1)] * 4


def test_calendar(spark):
    day = spark.createDataFrame([(date(2026, 6, 14),), (date(2026, 6, 15),)], "d date")
    found = [tuple(r) for r in day.select(*dates.calendar_columns(F.col("d")).values()).collect()]
    assert found == [
        (1, "Sunday", date(2026, 6, 8), date(2026, 6, 1)),
        (2, "Monday", date(2026, 6, 15), date(2026, 6, 1)),
    ]


def test_calendar_does_not_depend_on_the_zone(spark):
    day = spark.createDataFrame([(date(2026, 3, 29),)], "d date")
    try:
        for zone in ("America/New_York", "Pacific/Auckland", "America/Sao_Paulo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            found = tuple(day.select(*dates.calendar_columns(F.col("d")).values()).first())
            assert found == (1, "Sunday", date(2026, 3, 23), date(2026, 3, 1))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_money(spark):
    texts = ["10.005", "10.004", "1e2", "zz", "", None, "12345678901.00"]
    assert apply(spark, texts, "string", numbers.parse_money) == [
        Decimal("10.01"), Decimal("10.00"), Decimal("100.00"), None, None, None, None,
    ]


def test_lenient_numbers(spark):
    texts = ["1.5", "x", "nan", None]
    assert apply(spark, texts, "string", numbers.to_number) == [1.5, None, None, None]
    assert apply(spark, texts, "string", lambda c: numbers.to_number(c, 0)) == [1.5, 0.0, 0.0, 0.0]


def test_cost_per_booking(spark):
    df = spark.createDataFrame(
        [(Decimal("0.00"), 2), (Decimal("5.00"), 0), (Decimal("0.01"), 2), (Decimal("10.00"), 3)],
        "s decimal(22,2), n bigint",
    )
    found = [r[0] for r in df.select(numbers.cost_per_booking(F.col("s"), F.col("n"))).collect()]
    assert found == [Decimal("0.00"), None, Decimal("0.01"), Decimal("3.33")]


def test_report_rounding_is_the_scaled_nearest_even(spark):
    import numpy as np

    values = [0.125, 1.005, 1.015, 2.675, 1 / 3, 7.0]
    assert apply(spark, values, "double", numbers.round_to_even) == [float(np.round(v, 2)) for v in values]


def test_slots(spark):
    hours = [0, 5, 6, 8, 9, 11, 12, 16, 17, 20, 21, 23, None]
    names = ["overnight"] * 2 + ["early_morning"] * 2 + ["morning"] * 2 + ["afternoon"] * 2 + ["evening"] * 2
    assert apply(spark, hours, "int", rules.time_slot) == names + ["late_evening"] * 3
    slots = ["overnight", "late_evening", "noon", None]
    assert apply(spark, slots, "string", rules.time_slot_sort) == [1, 6, 99, 99]


def test_load_levels(spark):
    means = [15.0, 10.0, 5.0, 4.99, None]
    levels = ["Very high", "High", "Moderate", "Low", "Unknown"]
    assert apply(spark, means, "double", rules.load_level) == levels
    assert apply(spark, levels, "string", rules.load_level_sort) == [1, 2, 3, 4, 5]


def test_codes(spark):
    assert apply(spark, ["a", "b", None], "string", lambda c: rules.map_codes(c, {"a": "1"})) == ["1", "unknown", "unknown"]
    assert apply(spark, ["a"], "string", lambda c: rules.map_codes(c, {})) == ["unknown"]
