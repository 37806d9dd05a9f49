"""What the plans must and must not contain."""

import re

import pytest

from slotledger.catalog import queries
from tests.conftest import SF_TINY


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_python_and_no_pairing(spark, name):
    text = plan(queries()[name](spark, SF_TINY))
    for node in ("Python", "Pandas", "CartesianProduct", "NestedLoopJoin"):
        assert node not in text


@pytest.mark.parametrize(
    "name, columns",
    [
        ("bookings_daily", "l_returnflag:string,l_shipdate:timestamp_ntz"),
        ("booking_time_patterns", "ts:timestamp_ntz,event_type:string"),
        ("channel_mapping", "o_orderpriority:string"),
        ("dashboard_filter_load", "event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string"),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(queries()[name](spark, SF_TINY))


def test_filters_reach_the_scan(spark):
    for name in ("filter_since", "filter_period", "daily_channel_performance"):
        assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", plan(queries()[name](spark, SF_TINY)))
    assert "IsNotNull(l_shipdate), IsNotNull(l_returnflag)" in plan(queries()["bookings_daily"](spark, SF_TINY))


def test_load_mart_scans_once(spark):
    assert plan(queries()["employee_meeting_load"](spark, SF_TINY)).split("== Initial Plan ==")[0].count("FileScan") == 1


def test_latest_version_is_limited_before_the_shuffle(spark):
    for name in ("latest_webhook", "latest_spend", "channel_mapping"):
        text = plan(queries()[name](spark, SF_TINY))
        shuffle = text.rindex("WindowGroupLimit") > text.index("Exchange hashpartitioning")
        assert shuffle and text.count("WindowGroupLimit") == 2, name


def test_bookings_are_counted_before_the_join(spark):
    for name, join in (("daily_channel_performance", "SortMergeJoin"), ("booking_time_patterns", "Join")):
        text = plan(queries()[name](spark, SF_TINY))
        assert text.index(join) < text.index("functions=[count(1)]") < text.index("functions=[partial_count(1)]")


def test_second_uses_of_a_total_reuse_its_shuffle(spark):
    for name in ("densify_daily", "weekly_bookings_wmon", "trend_kpis", "metric_heatmap"):
        assert "ReusedExchange" in final_plan(queries()[name](spark, SF_TINY)), name


def test_merging_a_small_batch_shuffles_no_table(spark, tmp_path):
    from slotledger.operators.versions import upsert

    path = str(tmp_path / "table")
    spark.range(1000).selectExpr("id AS k", "id AS v").write.parquet(path)
    table, batch = spark.read.parquet(path), spark.read.parquet(path).filter("k < 10")
    changed = lambda t, b: t("v") != b("v")
    for condition in (None, changed):
        assert "Exchange hashpartitioning" not in plan(upsert(table, batch, ["k"], condition))
