"""Sums that must agree across marts and reports, on the test tables."""

import pytest
from pyspark.sql import functions as F

from slotledger.catalog.adapters import Tables
from slotledger.plans import channels, trends, workload
from tests.conftest import SF_TINY


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SF_TINY)


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


def test_every_booking_is_in_the_patterns(tables):
    assert total(tables.patterns(), "bookings_count") == tables.webhooks().count()


def test_every_booking_is_in_the_daily_mart(tables):
    # here no two channels share an event type on a day, so nothing is shown twice
    assert total(tables.perf(), "bookings_count") == tables.bookings().count()


def test_grid_is_days_times_channels(tables):
    perf = tables.perf()
    first, last = perf.agg(F.min("performance_date"), F.max("performance_date")).first()
    names = channels.channel_totals(perf).count()
    assert trends.densify_daily(perf).count() == ((last - first).days + 1) * names


def test_days_weeks_and_channels_hold_the_same_bookings(tables):
    perf = tables.perf()
    sums = {
        total(report(perf), "bookings_count")
        for report in (trends.daily_totals, trends.densify_daily, trends.weekly_bookings, channels.channel_totals)
    }
    assert len(sums) == 1


def test_meeting_totals_agree(tables):
    load = tables.load()
    in_levels = total(workload.load_level_summary(load), "total_meetings")
    assert total(load, "weekly_meetings") == in_levels == workload.employee_kpis(load).first()["total_meetings"]
