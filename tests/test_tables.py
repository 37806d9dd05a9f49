"""Merging, snapshots and exports."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from slotledger.operators.audit import counted_in_passing
from slotledger.operators.rows import with_load_stamp
from slotledger.operators.versions import latest_by, upsert
from slotledger.sinks import tables as sinks
from slotledger.sources import tables as sources
from tests.conftest import rows

SCHEMA = "k int, c string, v int, m int"


def changed(t, b):
    return (t("v") != b("v")) | (t("m") < b("m"))


@pytest.fixture
def table(spark):
    return spark.createDataFrame([(1, "a", 10, 5), (2, "b", 20, 5), (3, "c", 30, 9), (None, "n", 1, 1)], SCHEMA)


@pytest.fixture
def batch(spark):
    return spark.createDataFrame(
        [(1, "a", 10, 5), (2, "b", 21, 4), (3, "c", 30, 3), (4, "d", 40, 1), (None, "n", 1, 1)], SCHEMA
    )


def test_conditional_upsert(table, batch):
    assert rows(upsert(table, batch, ["k", "c"], changed), "k", "v") == [
        (None, "n", 1, 1),
        (None, "n", 1, 1),
        (1, "a", 10, 5),
        (2, "b", 21, 4),
        (3, "c", 30, 9),
        (4, "d", 40, 1),
    ]


def test_newer_file_alone_updates_and_null_condition_keeps(spark):
    table = spark.createDataFrame([(1, "a", 10, 5), (2, "b", None, None)], SCHEMA)
    batch = spark.createDataFrame([(1, "a", 10, 6), (2, "b", 7, 7)], SCHEMA)
    assert rows(upsert(table, batch, ["k", "c"], changed), "k") == [(1, "a", 10, 6), (2, "b", None, None)]


def test_unconditional_upsert_replaces_even_with_older_rows(table, batch):
    found = rows(upsert(table, batch, ["k", "c"]), "k", "v")
    assert [r for r in found if r[0] in (2, 3)] == [(2, "b", 21, 4), (3, "c", 30, 3)]
    assert len(found) == 6


def test_columns_are_matched_by_name(spark, table):
    batch = spark.createDataFrame([("a", 1, 6, 99)], "c string, k int, m int, v int")
    assert (1, "a", 99, 6) in rows(upsert(table, batch, ["k", "c"]))


@pytest.mark.parametrize("condition", [None, changed])
def test_upsert_twice_is_upsert_once(table, batch, condition):
    keyed = batch.filter("k IS NOT NULL")
    once = upsert(table, keyed, ["k", "c"], condition)
    assert rows(upsert(once, keyed, ["k", "c"], condition)) == rows(once)


def test_upsert_of_a_batch_too_large_to_broadcast(spark, table, batch):
    for setting in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(setting, "-1")
    try:
        merged = upsert(table, batch, ["k", "c"], changed)
        assert "SortMergeJoin" in merged._jdf.queryExecution().executedPlan().toString()
        by_shuffle = rows(merged)
    finally:
        for setting in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(setting)
    assert by_shuffle == rows(upsert(table, batch, ["k", "c"], changed))


def test_upsert_can_use_the_table_as_its_own_batch(table):
    keyed = table.filter("k IS NOT NULL")
    assert rows(upsert(keyed, keyed, ["k", "c"], changed)) == rows(keyed)


def test_latest_by_with_a_hot_key(spark):
    many = spark.range(50_000).select(F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id")).alias("k"), "id")
    found = latest_by(many, ["k"], [F.desc("id")])
    assert found.count() == many.select("k").distinct().count()
    assert rows(found.filter("k = 0")) == [(0, 49_999)]


def test_snapshots_survive_a_failed_write(spark, table, batch, tmp_path):
    root = str(tmp_path / "silver")
    assert not sources.table_exists(spark, root)
    with pytest.raises(FileNotFoundError):
        sources.load_snapshot(spark, root)
    assert sinks.upsert_snapshot(spark, root, table, ["k", "c"], changed) == (0, 4)
    assert sources.table_exists(spark, root)
    before = rows(sources.load_snapshot(spark, root))
    broken = batch.withColumn("v", F.raise_error(F.lit("executor lost")).cast("int"))
    with pytest.raises(Exception, match="executor lost"):
        sinks.upsert_snapshot(spark, root, broken, ["k", "c"], changed)
    assert rows(sources.load_snapshot(spark, root)) == before
    assert sinks.upsert_snapshot(spark, root, batch, ["k", "c"], changed) == (1, 6)
    assert rows(sources.load_snapshot(spark, root)) == rows(upsert(table, batch, ["k", "c"], changed))


def test_two_writers_of_a_version_lose_nothing(spark, table, batch, tmp_path):
    root = str(tmp_path / "silver")
    sinks.write_snapshot(table, root)
    first = sinks.write_snapshot(batch, root, 0)
    with pytest.raises(FileExistsError, match="another writer"):
        sinks.write_snapshot(table, root, 0)
    assert first == sources.latest_snapshot(spark, root) == 1
    assert rows(sources.load_snapshot(spark, root)) == rows(batch)
    with pytest.raises(FileExistsError):
        sinks.write_snapshot(table, root)


def test_snapshots_need_no_success_marker(spark, table, batch, tmp_path):
    root, setting = str(tmp_path / "silver"), "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf = spark._jsc.hadoopConfiguration()
    conf.set(setting, "false")
    try:
        sinks.upsert_snapshot(spark, root, table, ["k", "c"], changed)
        assert sinks.upsert_snapshot(spark, root, batch, ["k", "c"], changed)[0] == 1
        sinks.write_table(table, str(tmp_path / "plain"))
    finally:
        conf.unset(setting)
    assert rows(sources.load_snapshot(spark, root)) == rows(upsert(table, batch, ["k", "c"], changed))
    assert sources.table_exists(spark, str(tmp_path / "plain"))


def test_no_first_version_over_other_data(spark, table, tmp_path):
    root = str(tmp_path / "silver")
    table.write.parquet(root)
    with pytest.raises(FileExistsError, match="not a committed version"):
        sinks.upsert_snapshot(spark, root, table, ["k", "c"])
    assert spark.read.parquet(root).count() == 4


def test_rebuild_may_change_the_schema(spark, table, tmp_path):
    path = str(tmp_path / "mart")
    sinks.write_table(table, path)
    sinks.write_table(table.select("k", F.lit("x").alias("new")), path, replace_schema=True)
    assert sources.load_table(spark, path).columns == ["k", "new"]
    assert sources.table_exists(spark, path)


def test_partitioned_write(spark, table, tmp_path):
    path = str(tmp_path / "mart")
    sinks.write_table(table, path, partition_by=["c"])
    pruned = sources.load_table(spark, path).filter("c = 'a'")
    assert "PartitionFilters: [isnotnull(c" in pruned._jdf.queryExecution().toString()
    assert pruned.count() == 1


def test_export_holds_the_rows_of_the_table(spark, table, tmp_path):
    paths = [str(tmp_path / name) for name in ("table", "export")]
    sinks.publish_mart(with_load_stamp(table), *paths)
    first, second = (rows(sources.load_table(spark, sources.exported(spark, path))) for path in paths)
    assert first == second and first[0][-1] is not None


def test_load_stamp(spark, table):
    fixed = with_load_stamp(table, datetime(2026, 1, 2, 3))
    assert {r[-1] for r in rows(fixed)} == {datetime(2026, 1, 2, 3)}
    assert dict(with_load_stamp(table).dtypes)["processed_at"] == "timestamp"


def test_counting_in_passing(table, tmp_path):
    counted, observation = counted_in_passing(table, "silver")
    sinks.export_parquet(counted, str(tmp_path / "out"))
    assert observation.get == {"row_count": 4}


def torn(root, number, text):
    """A record as a job that died while writing it would have left it, without the rename."""
    (root / "_versions" / str(number)).write_text(text)


@pytest.mark.parametrize("text", ["", '{"folder": "snapshot=', "snapshot=123", "[]", '{"other": 1}', '{"folder": "snapshot=none"}'])
def test_torn_records_are_passed_over(spark, table, batch, tmp_path, text):
    root = tmp_path / "silver"
    sinks.upsert_snapshot(spark, str(root), table, ["k", "c"], changed)
    torn(root, 1, text)
    assert sources.latest_snapshot(spark, str(root)) == 0
    assert rows(sources.load_snapshot(spark, str(root))) == rows(table)
    assert sinks.upsert_snapshot(spark, str(root), batch, ["k", "c"], changed) == (2, 6)
    assert rows(sources.load_snapshot(spark, str(root))) == rows(upsert(table, batch, ["k", "c"], changed))


def test_a_table_of_torn_records_only_does_not_exist(spark, table, tmp_path):
    root = tmp_path / "silver"
    (root / "_versions").mkdir(parents=True)
    torn(root, 0, "")
    assert not sources.table_exists(spark, str(root))
    assert sinks.upsert_snapshot(spark, str(root), table, ["k", "c"]) == (1, 4)


def test_a_version_that_lost_a_file_is_passed_over(spark, table, batch, tmp_path):
    root = tmp_path / "silver"
    sinks.write_snapshot(table, str(root))
    sinks.write_snapshot(batch, str(root), 0)
    version = sources.read_version(spark, str(root), 1)
    assert version.rows == 5
    next((root / version.folder).glob("*.parquet")).unlink()
    assert sources.latest_snapshot(spark, str(root)) == 0


def test_records_of_earlier_releases_are_read(spark, table, tmp_path):
    root, folder = tmp_path / "silver", "snapshot=" + "0" * 32
    table.write.parquet(str(root / folder))
    (root / "_versions").mkdir()
    torn(root, 0, folder)
    assert rows(sources.load_snapshot(spark, str(root))) == rows(table)


def test_stores_without_an_exclusive_rename_are_refused(spark, table, tmp_path, monkeypatch):
    monkeypatch.setattr(sources, "EXCLUSIVE", ("hdfs",))
    root = str(tmp_path / "silver")
    with pytest.raises(ValueError, match="not exclusive"):
        sinks.write_snapshot(table, root)
    assert not sources.table_exists(spark, root)
    spark.conf.set(sources.SINGLE_WRITER, "true")
    try:
        assert sinks.write_snapshot(table, root) == 0
    finally:
        spark.conf.unset(sources.SINGLE_WRITER)


def test_a_batch_that_repeats_a_key_is_refused(spark, table, tmp_path):
    root = str(tmp_path / "silver")
    sinks.upsert_snapshot(spark, root, table, ["k", "c"])
    twice = spark.createDataFrame([(1, "a", 1, 1), (1, "a", 2, 1)], SCHEMA)
    with pytest.raises(sinks.RepeatedKeysError, match="2 rows with k=1, c=a"):
        sinks.upsert_snapshot(spark, root, twice, ["k", "c"])
    assert rows(sources.load_snapshot(spark, root)) == rows(table)
    null_keys = spark.createDataFrame([(None, "a", 1, 1), (None, "a", 2, 1)], SCHEMA)
    assert sinks.upsert_snapshot(spark, root, null_keys, ["k", "c"])[1] == 6


def test_a_failing_rebuild_leaves_the_old_mart(spark, table, batch, tmp_path):
    mart, export = (str(tmp_path / name) for name in ("mart", "export"))
    for fresh in (table, batch, table):
        sinks.publish_mart(fresh, mart, export)
        broken = fresh.withColumn("v", F.raise_error(F.lit("executor lost")).cast("int"))
        with pytest.raises(Exception, match="executor lost"):
            sinks.publish_mart(broken, mart, export)
        assert rows(sources.load_table(spark, mart)) == rows(sources.load_table(spark, sources.exported(spark, export))) == rows(fresh)
    kept = [p.name for p in (tmp_path / "mart" / "_versions").glob("[0-9]*")]
    assert sorted(kept) == ["1", "2"]  # the version before stays for readers that have begun


def test_an_overwrite_that_fails_leaves_the_old_rows(spark, table, tmp_path):
    path = str(tmp_path / "plain")
    sinks.write_table(table, path)
    with pytest.raises(Exception, match="executor lost"):
        sinks.write_table(table.withColumn("v", F.raise_error(F.lit("executor lost"))), path)
    assert rows(sources.load_table(spark, path)) == rows(table)


def _files(root, spark):
    """Data files of the current version by part."""
    version = sources.read_version(spark, root, sources.latest_snapshot(spark, root))
    found = {}
    for place in version.places():
        found[place.split("=")[-1]] = sorted(p.name for p in (Path(root) / place).glob("*.parquet"))
    return found


def test_a_merge_writes_only_the_parts_it_touches(spark, tmp_path):
    root = str(tmp_path / "split")
    days = spark.range(60).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("c"), (F.col("id") % 6).cast("int").alias("m"), F.lit(0).alias("v"))
    assert sinks.upsert_snapshot(spark, root, days, ["k", "c"], split_by=F.col("m")) == (0, 60)
    before = _files(root, spark)
    assert sorted(before) == ["0", "1", "2", "3", "4", "5"]
    # one row changes in part 1, one moves from 2 to 4, one is new in a part of its own
    batch = spark.createDataFrame([(1, "x", 1, 7), (2, "x", 4, 7), (99, "x", None, 7)], "k int, c string, m int, v int")
    assert sinks.upsert_snapshot(spark, root, batch, ["k", "c"], split_by=F.col("m")) == (1, 61)
    after = _files(root, spark)
    assert {part for part in after if after[part] != before.get(part)} == {"1", "2", "4", "none"}
    assert rows(sources.load_snapshot(spark, root)) == rows(sources.load_table(spark, root)) == rows(upsert(days, batch, ["k", "c"]))
    written = [p for p in Path(root).glob("snapshot=*") if (p / "stored_part=none").exists()]
    assert sorted(p.name for p in written[0].glob("stored_part=*")) == [f"stored_part={n}" for n in ("1", "2", "4", "none")]


def test_split_tables_equal_whole_ones(spark, tmp_path):
    whole, split = str(tmp_path / "whole"), str(tmp_path / "split")
    for turn in range(4):
        picked = F.pmod(F.hash("id", F.lit(turn)), F.lit(3)) == 0
        value = F.pmod(F.hash("id", F.lit(turn + 50)), F.lit(5)).cast("int")
        batch = spark.range(90).filter(picked).select(
            F.nullif(F.col("id"), F.lit(7)).cast("int").alias("k"), F.lit("x").alias("c"), F.nullif(value, F.lit(4)).alias("v"), (value + turn).alias("m")
        )
        counts = [sinks.upsert_snapshot(spark, root, batch, ["k", "c"], changed, split_by=by) for root, by in ((whole, None), (split, F.col("v")))]
        assert counts[0] == counts[1]
        assert rows(sources.load_snapshot(spark, whole)) == rows(sources.load_snapshot(spark, split))
    empty = batch.limit(0)
    assert sinks.upsert_snapshot(spark, split, empty, ["k", "c"], changed, split_by=F.col("v")) == (4, counts[0][1])
    assert rows(sources.load_snapshot(spark, whole)) == rows(sources.load_snapshot(spark, split))
    # versions before the last go, the files that it shares with them stay
    sources.forget_versions(spark, split, 1)
    assert rows(sources.load_snapshot(spark, whole)) == rows(sources.load_snapshot(spark, split))
    held = {str(p.parent.relative_to(split)) for p in Path(split).rglob("*.parquet")}
    assert held == sources.read_version(spark, split, 4).places()


def test_tables_become_split_and_whole_again_and_take_new_columns(spark, table, batch, tmp_path):
    root = str(tmp_path / "table")
    sinks.upsert_snapshot(spark, root, table, ["k", "c"], changed)
    wider = batch.withColumn("note", F.lit("n"))
    assert sinks.upsert_snapshot(spark, root, wider, ["k", "c"], changed, split_by=F.col("c")) == (1, 6)
    assert rows(sources.load_snapshot(spark, root)) == rows(upsert(table, wider, ["k", "c"], changed))
    more = spark.createDataFrame([(9, "z", 1, 1, "n", True)], SCHEMA + ", note string, seen boolean")
    assert sinks.upsert_snapshot(spark, root, more, ["k", "c"], split_by=F.col("c")) == (2, 7)
    assert sources.load_snapshot(spark, root).filter("seen IS NULL").count() == 6  # parts written before have no such column
    assert sinks.upsert_snapshot(spark, root, more, ["k", "c"]) == (3, 7)
    assert sources.read_version(spark, root, 3).parts is None


def test_an_empty_split_table_can_be_read_and_merged(spark, table, tmp_path):
    root = str(tmp_path / "table")
    assert sinks.upsert_snapshot(spark, root, table.limit(0), ["k", "c"], split_by=F.col("c")) == (0, 0)
    assert sources.load_snapshot(spark, root).columns == table.columns and sources.load_snapshot(spark, root).isEmpty()
    assert sinks.upsert_snapshot(spark, root, table, ["k", "c"], split_by=F.col("c")) == (1, 4)


def test_another_split_cannot_hide_rows(spark, tmp_path):
    root = str(tmp_path / "table")
    old = spark.createDataFrame([(1, "a", 1, 2), (2, "b", 2, 3)], SCHEMA)
    sinks.upsert_snapshot(spark, root, old, ["k", "c"], split_by=F.col("v"))
    with pytest.raises(ValueError, match="split by something else"):  # the old row of the touched part 1 would go to part 2
        sinks.upsert_snapshot(spark, root, spark.createDataFrame([(3, "a", 1, 9)], SCHEMA), ["k", "c"], changed, split_by=F.when(F.col("m") == 9, 1).otherwise(2))
    with pytest.raises(ValueError, match="no name of a part"):
        sinks.upsert_snapshot(spark, str(tmp_path / "other"), old, ["k", "c"], split_by=F.lit("a/b"))
    assert sources.latest_snapshot(spark, str(tmp_path / "other")) is None
    assert rows(sources.load_snapshot(spark, root)) == rows(old)
