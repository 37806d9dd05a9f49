"""Raw files to reports, the way a user runs it."""

import json
import os
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest

from slotledger import jobs
from slotledger.plans import channels, dashboard, marts, patterns, reports, workload
from slotledger.settings import Selection
from slotledger.sinks import staging
from slotledger.sinks.tables import write_snapshot
from slotledger.sources.raw import list_files, read_spend
from slotledger.sources.tables import exported, load_ledger, load_snapshot, load_table
from tests.conftest import rows
from tests.test_ingest import spend_dir, webhook_dir  # noqa: F401  (fixtures)

NOW = datetime(2026, 6, 11)


@pytest.fixture
def paths(tmp_path):
    return {name: str(tmp_path / name) for name in ("silver_webhooks", "silver_spend", "marts", "exports")}


def test_from_files_to_reports(spark, webhook_dir, spend_dir, paths):  # noqa: F811
    for version in (0, 1):  # running a job again adds a version and no rows
        ingested = jobs.ingest_webhooks(spark, webhook_dir, paths["silver_webhooks"], as_of=NOW, everything=True)
        assert ingested == jobs.Ingested(version, raw_rows=5, batch_rows=4)
        assert load_snapshot(spark, paths["silver_webhooks"]).count() == 4
    jobs.ingest_spend(spark, spend_dir, paths["silver_spend"], codes={"tiktok_paid_ads": "ET1"}, as_of=NOW)
    assert load_snapshot(spark, paths["silver_spend"]).count() == 3

    folders = [paths[name] for name in ("silver_webhooks", "silver_spend", "marts", "exports")]
    assert jobs.rebuild_marts(spark, *folders, as_of=NOW) == {"daily": 3, "patterns": 3, "load": 1}
    for name, width in zip(jobs.MARTS, (11, 12, 10)):
        mart, export = (load_table(spark, exported(spark, f"{paths[where]}/{name}")) for where in ("marts", "exports"))
        assert len(mart.columns) == width and rows(mart) == rows(export)

    daily, times, load = jobs.open_dashboard(spark, paths["exports"])
    assert rows(channels.channel_totals(daily)) == [("Facebook", 0), ("Tiktok", 2), ("Unknown", 1)]
    assert rows(channels.best_cpb_channel(daily))[0][:3] == ("Unknown", 1, Decimal("0.00"))
    assert rows(patterns.busiest_slots(times)) == [
        ("hour", "5 AM", 1), ("time_slot", "Early Morning", 2), ("weekday", "Wednesday", 3),
    ]
    assert rows(workload.employee_kpis(load)) == [(3, 1, 3.0, 3, "e1@example.com")]

    shown = {
        reports.daily_calls: daily, reports.cost_per_booking: daily, reports.bookings_trend: daily,
        reports.channel_leaderboard: daily, reports.booking_times: times, reports.meeting_load: load,
    }
    for report, mart in shown.items():
        for name, table in report(mart).items():
            assert table.count() > 0, (report.__name__, name)

    daily, _, load = jobs.open_dashboard(spark, paths["exports"], Selection(date(2026, 6, 9), date(2026, 6, 9)))
    assert rows(dashboard.headline_kpis(daily))[0][:3] == (0, Decimal("10.01"), None)
    assert load.count() == 0


def test_catalog_tables(spark, webhook_dir, spend_dir, paths):  # noqa: F811
    """The installed catalog cannot MERGE, so the first run refuses before it creates anything."""
    for ingest, name, path in ((jobs.ingest_spend, "spend_t", spend_dir), (jobs.ingest_webhooks, "webhooks_t", webhook_dir)):
        with pytest.raises(ValueError, match="cannot take MERGE"):
            ingest(spark, path, name, in_catalog=True, as_of=NOW)
        with pytest.raises(ValueError, match="cannot take MERGE"):
            ingest(spark, path, name, in_catalog=True, as_of=NOW, provider="orc")
        assert not spark.catalog.tableExists(name)
    # tables that exist can be read by the marts
    jobs.ingest_webhooks(spark, webhook_dir, paths["silver_webhooks"], as_of=NOW)
    jobs.ingest_spend(spark, spend_dir, paths["silver_spend"], as_of=NOW)
    for name in ("silver_webhooks", "silver_spend"):
        load_snapshot(spark, paths[name]).write.mode("overwrite").saveAsTable(f"{name}_t")
    folders = ["silver_webhooks_t", "silver_spend_t", paths["marts"], paths["exports"]]
    assert jobs.rebuild_marts(spark, *folders, in_catalog=True, as_of=NOW)["patterns"] == 3


def test_marts_keep_all_spend_unless_a_cutoff_is_given(spark, webhook_dir, tmp_path, paths):  # noqa: F811
    folder = tmp_path / "old_spend"
    folder.mkdir()
    (folder / "a.json").write_text('[{"date": "2020-01-01", "channel": "tiktok_paid_ads", "spend": 5}]')
    jobs.ingest_webhooks(spark, webhook_dir, paths["silver_webhooks"], as_of=NOW)
    jobs.ingest_spend(spark, str(folder), paths["silver_spend"], as_of=NOW)
    folders = [paths[name] for name in ("silver_webhooks", "silver_spend", "marts", "exports")]
    jobs.rebuild_marts(spark, *folders)
    days = load_table(spark, f"{paths['marts']}/daily").select("performance_date", "marketing_spend")
    assert (date(2020, 1, 1), Decimal("5.00")) in rows(days)
    jobs.rebuild_marts(spark, *folders, cutoff=date(2021, 1, 1))
    days = load_table(spark, f"{paths['marts']}/daily").select("performance_date", "marketing_spend")
    assert date(2020, 1, 1) not in [r[0] for r in rows(days)]


def test_unreadable_documents_are_kept_apart_and_counted(spark, tmp_path, paths):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "good.json").write_text(
        '[{"date": "2026-06-10", "channel": "tiktok_paid_ads", "spend": "x"}, {"date": "bad", "channel": "new", "spend": 1}]'
    )
    for i in range(3):
        (folder / f"bad{i}.json").write_text("{ not json %d" % i)
    found = jobs.ingest_spend(spark, str(folder), paths["silver_spend"])
    assert (found.raw_rows, found.batch_rows) == (2, 2)
    assert found.counts == {"unreadable": 3, "no_date": 1, "no_amount": 1, "no_event_type": 1, "table_rows": 2}
    kept = spark.read.parquet(f"{paths['silver_spend']}/_unreadable").collect()
    assert sorted(r["raw_file_path"][-9:] for r in kept) == ["bad0.json", "bad1.json", "bad2.json"]
    assert all(r["unreadable_text"].startswith("{ not json") for r in kept)
    assert load_snapshot(spark, paths["silver_spend"]).filter("spend_date IS NULL AND channel IS NULL").count() == 0


def test_only_files_changed_since_are_read(spark, tmp_path, paths):
    folder = tmp_path / "raw"
    folder.mkdir()
    for i, day in enumerate(("2026-06-01", "2026-06-02")):
        file = folder / f"{i}.json"
        file.write_text('[{"date": "%s", "channel": "a", "spend": 1}]' % day)
        os.utime(file, (1_780_000_000 + 86_400 * i,) * 2)
    since = datetime.fromtimestamp(1_780_000_000 + 3_600, timezone.utc).replace(tzinfo=None)
    found = jobs.ingest_spend(spark, str(folder), paths["silver_spend"], modified_after=since)
    assert found.raw_rows == 1
    assert [r["spend_date"] for r in load_snapshot(spark, paths["silver_spend"]).collect()] == [date(2026, 6, 2)]
    assert jobs.ingest_spend(spark, str(folder), paths["silver_spend"]).counts["table_rows"] == 2


def test_keyed_tables_give_the_same_marts_without_shuffling_rows(spark, webhook_dir, spend_dir, paths):  # noqa: F811
    jobs.ingest_webhooks(spark, webhook_dir, paths["silver_webhooks"], as_of=NOW)
    jobs.ingest_spend(spark, spend_dir, paths["silver_spend"], as_of=NOW)
    tables = [load_snapshot(spark, paths[name]) for name in ("silver_webhooks", "silver_spend")]
    plain, keyed = (marts.build_marts(*tables, as_of=NOW, keyed=keyed) for keyed in (False, True))
    for name in jobs.MARTS:
        assert rows(plain[name]) == rows(keyed[name])

    def shuffles(mart):
        plan = mart._jdf.queryExecution().executedPlan().toString()
        return plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning")

    assert [shuffles(plain["daily"]), shuffles(keyed["daily"])] == [4, 3]
    assert [shuffles(plain["load"]), shuffles(keyed["load"])] == [3, 2]


def test_another_booking_time_can_be_asked_for(spark, webhook_dir, paths):  # noqa: F811
    jobs.ingest_webhooks(spark, webhook_dir, paths["silver_webhooks"], as_of=NOW)
    webhooks = load_snapshot(spark, paths["silver_webhooks"])
    found = marts.bookings_daily(webhooks, booked_at="event_start_time")
    assert rows(found) == [(date(2026, 7, 1), "ET1", 2), (date(2026, 7, 1), "ET2", 1)]


def test_staged_rows_are_removed_after_use(spark):
    with staging.staged(spark.range(5)) as kept:
        path = kept.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        assert kept.count() == 5 and path.startswith(staging.staging_folder(spark).removeprefix("file://"))
        assert os.path.exists(path)
    assert not os.path.exists(path)


def test_no_machine_local_folder_on_a_cluster():
    class Cluster:
        conf = {}

        class sparkContext:
            master = "spark://head:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.staging_folder(Cluster)
    Cluster.conf = {"spark.checkpoint.dir": "s3a://shared/tmp/"}
    assert staging.staging_folder(Cluster) == "s3a://shared/tmp"


def test_the_ledger_spares_files_that_are_merged(spark, tmp_path, paths):
    folder, table = tmp_path / "raw", paths["silver_spend"]
    folder.mkdir()
    line = '[{"date": "2026-06-0%d", "channel": "a", "spend": %d}]'
    for i in (1, 2):
        (folder / f"{i}.json").write_text(line % (i, i))
    (folder / "bad.json").write_text("{ not json")
    assert jobs.ingest_spend(spark, str(folder), table).raw_rows == 2
    assert load_ledger(spark, table).count() == 3
    again = jobs.ingest_spend(spark, str(folder), table)
    assert (again.version, again.raw_rows, again.counts["table_rows"]) == (0, 0, 2)
    (folder / "3.json").write_text(line % (3, 3))
    (folder / "1.json").write_text(line % (1, 10))
    os.utime(folder / "1.json", (1_990_000_000,) * 2)
    found = jobs.ingest_spend(spark, str(folder), table)
    assert (found.version, found.raw_rows, found.counts["unreadable"], found.counts["table_rows"]) == (1, 2, 0, 3)
    assert sorted(r["spend"] for r in load_snapshot(spark, table).collect()) == [2, 3, 10]
    assert load_ledger(spark, table).count() == 4
    everything = jobs.ingest_spend(spark, str(folder), table, everything=True)
    assert (everything.raw_rows, everything.counts["unreadable"], everything.counts["table_rows"]) == (3, 1, 3)
    assert spark.read.parquet(f"{table}/_unreadable").count() == 1


def test_a_run_that_dies_before_its_commit_reads_its_files_again(spark, tmp_path, paths, monkeypatch):
    folder, table = tmp_path / "raw", paths["silver_spend"]
    folder.mkdir()
    (folder / "1.json").write_text('[{"date": "2026-06-01", "channel": "a", "spend": 1}]')
    (folder / "bad.json").write_text("{ not json")

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(jobs, "upsert_snapshot", dies)
        with pytest.raises(RuntimeError):
            jobs.ingest_spend(spark, str(folder), table)
    assert load_ledger(spark, table) is None
    assert jobs.ingest_spend(spark, str(folder), table).raw_rows == 1
    assert spark.read.parquet(f"{table}/_unreadable").count() == 1


def test_a_delivery_that_arrives_late_replaces_nothing_newer(spark, tmp_path, paths):
    folder = tmp_path / "raw"
    folder.mkdir()

    def deliver(name, created_at, email):
        payload = {"event": "https://api.example.com/scheduled_events/EV1", "email": email}
        (folder / name).write_text(json.dumps({"event": "invitee.created", "created_at": created_at, "payload": payload}))

    for name, created_at in (("b", "2026-06-10T05:00:00.000000Z"), ("a", "2026-06-09T05:00:00.000000Z"), ("c", "2026-06-11T05:00:00.000000Z")):
        deliver(f"{name}.json", created_at, "x@y.z")
        found = jobs.ingest_webhooks(spark, str(folder), paths["silver_webhooks"], as_of=NOW)
        assert (found.raw_rows, found.counts["table_rows"]) == (1, 1)
        stored = load_snapshot(spark, paths["silver_webhooks"]).first()["raw_file_path"]
        assert stored.endswith("b.json" if name == "a" else f"{name}.json")


def test_the_same_moment_in_any_zone_reads_the_same_files(spark, tmp_path):
    for i in range(2):
        (tmp_path / f"{i}.json").write_text('[{"date": "2026-06-01", "channel": "a", "spend": 1}]')
        os.utime(tmp_path / f"{i}.json", (1_780_000_000 + 86_400 * i,) * 2)
    moment = datetime.fromtimestamp(1_780_000_000 + 3_600, timezone.utc)
    moments = [moment, moment.astimezone(timezone(timedelta(hours=2))), moment.astimezone(timezone(timedelta(hours=-7))), moment.replace(tzinfo=None)]
    for since in moments:
        assert read_spend(spark, str(tmp_path), modified_after=since).count() == 1
        assert list_files(spark, str(tmp_path), modified_after=since).count() == 1


def test_undeclared_fields_reach_the_tables_also_those_made_before(spark, tmp_path, paths):
    folder, table = tmp_path / "raw", paths["silver_spend"]
    folder.mkdir()
    (folder / "1.json").write_text('[{"date": "2026-06-01", "channel": "a", "spend": 1, "currency": "EUR"}]')
    jobs.ingest_spend(spark, str(folder), table)
    older = paths["silver_webhooks"]  # a table without the column
    write_snapshot(load_snapshot(spark, table).drop("undeclared_fields"), older)
    (folder / "2.json").write_text('[{"date": "2026-06-02", "channel": "a", "spend": 2, "currency": "USD"}]')
    jobs.ingest_spend(spark, str(folder), table)
    stored = lambda path: rows(load_snapshot(spark, path).select("spend", "undeclared_fields"))
    assert stored(table) == [(1, '{"/currency":"EUR"}'), (2, '{"/currency":"USD"}')]
    jobs.ingest_spend(spark, str(folder / "2.json"), older)
    assert stored(older) == [(1, None), (2, '{"/currency":"USD"}')]
