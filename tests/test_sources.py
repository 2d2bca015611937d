"""Scans of the sharded export (S1-S5) on literal fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hitsessions.operators.first_touch import first_touch_sessions
from hitsessions.options import SessionOptions
from hitsessions.session import new_work_path
from hitsessions.sources import export as X
from tests.conftest import make_events, p

T0 = 1_705_276_800_000_000  # 2024-01-15 00:00 UTC


def _shards(spark):
    rows = []
    for sfx, date, us, b in (("20240114", "20240114", T0 - 3_600_000_000, 1), ("20240115", "20240115", T0, 2),
                             ("intraday_20240115", "20240115", T0, 2), ("intraday_20240116", "20240116",
                                                                        T0 + 86_400_000_000, 3)):
        rows.append({"event_date": date, "event_timestamp": us, "event_bundle_sequence_id": b,
                     "user_pseudo_id": "u", "event_name": "page_view", "suffix": sfx,
                     "event_params": [p("ga_session_id", i=9), p("source", s=sfx)]})
    return make_events(spark, rows)


def test_shard_window_and_intraday(spark):
    root = new_work_path(spark, "test-export")
    X.write_export(_shards(spark), root)
    ev = X.read_export(spark, root)
    got = sorted(r.suffix for r in X.events_in_window(ev, "2024-01-15", "2024-01-16").collect())
    assert got == ["20240115", "intraday_20240115", "intraday_20240116"]
    daily = X.events_in_window(ev, "2024-01-15", "2024-01-16", SessionOptions(include_intraday=False))
    assert [r.suffix for r in daily.collect()] == ["20240115"]
    assert X.single_shard(ev, "20240114").count() == 1
    plan = X.events_in_window(ev, "2024-01-15", "2024-01-16")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(suffix" in plan and "regexp_extract" in plan


def test_duplicate_daily_and_intraday_shard(spark):
    # The same event in a daily and an intraday shard is read twice, and
    # the session is still built once (first event wins).
    df = first_touch_sessions(_shards(spark), "2024-01-15", "2024-01-15")
    assert df.count() == 1


def test_narrow_read_schema(spark):
    root = new_work_path(spark, "test-export")
    X.write_export(_shards(spark), root)
    plan = X.read_export(spark, root, narrow=True).select("event_params")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "float_value" not in plan and "int_value" in plan


def test_malformed_event_date_raises(spark):
    ev = make_events(spark, [{"event_date": "2024011x", "event_timestamp": T0, "event_bundle_sequence_id": 1,
                              "user_pseudo_id": "u", "event_name": "page_view", "suffix": "20240115",
                              "event_params": [p("ga_session_id", i=1)]}])
    with pytest.raises(Exception):
        first_touch_sessions(ev, "2024-01-15", "2024-01-15").collect()


def test_null_event_timestamp(spark):
    ev = make_events(spark, [{"event_date": "20240115", "event_timestamp": None, "event_bundle_sequence_id": 1,
                              "user_pseudo_id": "u", "event_name": "page_view", "suffix": "20240115",
                              "event_params": [p("ga_session_id", i=1), p("actual_timestamp", i=1705276800000)]}])
    r = first_touch_sessions(ev, "2024-01-15", "2024-01-15").first()
    assert r.event_timestamp is None and r.actual_timestamp == "2024-01-15 01:00:00"


def test_default_window():
    assert X.default_window(dt.date(2024, 3, 10)) == (dt.date(2024, 3, 8), dt.date(2024, 3, 9))


def test_read_sessions_prunes_partitions(spark):
    path = new_work_path(spark, "test-sessions")
    df = spark.createDataFrame([("a", dt.date(2024, 1, d)) for d in (1, 2, 3)], "unique_session_id string, session_date date")
    df.write.partitionBy("session_date").parquet(path)
    got = X.read_sessions(spark, path, "2024-01-02", "2024-01-03")
    assert got.count() == 2
    assert "PartitionFilters: [isnotnull(session_date" in got._jdf.queryExecution().executedPlan().toString()


def test_folder_per_shard_layout(spark):
    root = new_work_path(spark, "test-shards")
    ev = _shards(spark)
    for sfx in ("20240114", "20240115", "intraday_20240115", "intraday_20240116"):
        ev.where(F.col("suffix") == sfx).drop("suffix").write.parquet(f"{root}/events_{sfx}")
    got = X.read_shard_folders(spark, root, "2024-01-15", "2024-01-16")
    assert sorted(r.suffix for r in got.collect()) == ["20240115", "intraday_20240115", "intraday_20240116"]
    daily = X.read_shard_folders(spark, root, "2024-01-14", "2024-01-16", include_intraday=False)
    assert sorted(r.suffix for r in daily.collect()) == ["20240114", "20240115"]
    # Same sessions as from the partitioned layout.
    part = new_work_path(spark, "test-export")
    X.write_export(ev, part)
    a = first_touch_sessions(got, "2024-01-15", "2024-01-16").drop("export_timestamp", "last_update_timestamp")
    b = first_touch_sessions(X.read_export(spark, part), "2024-01-15", "2024-01-16").drop(
        "export_timestamp", "last_update_timestamp")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_any_shard_name_in_both_layouts(spark):
    """The first digit run of any shard name is compared, in the folder layout as well."""
    ev = _shards(spark).withColumn("suffix", F.regexp_replace("suffix", "intraday", "fresh"))
    root, folders = new_work_path(spark, "test-export"), new_work_path(spark, "test-folders")
    X.write_export(ev, root)
    X.write_shard_folders(ev, folders)
    want = ["20240115", "fresh_20240115", "fresh_20240116"]
    assert sorted(r.suffix for r in X.read_window(spark, root, "2024-01-15", "2024-01-16").collect()) == want
    assert sorted(r.suffix for r in X.read_shard_folders(spark, folders, "2024-01-15", "2024-01-16").collect()) == want
    for layout, at in (("partitioned", root), ("folders", folders)):
        assert X.read_single_shard(spark, at, "fresh_20240116", layout).count() == 1
        assert X.read_single_shard(spark, at, "20230101", layout).count() == 0


def test_window_scan_lists_only_its_shards(spark):
    root = new_work_path(spark, "test-export")
    X.write_export(_shards(spark), root)
    files = X.read_window(spark, root, "2024-01-15", "2024-01-15").inputFiles()
    assert {f.split("suffix=")[1].split("/")[0] for f in files} == {"20240115", "intraday_20240115"}
    assert X.read_window(spark, root, "2020-01-01", "2020-01-02").count() == 0


def test_bounds_take_their_defaults_one_by_one(spark):
    today = dt.date(2024, 1, 17)
    assert X.window_bounds(None, None, today) == (dt.date(2024, 1, 15), dt.date(2024, 1, 16))
    assert X.window_bounds("2024-01-01", None, today) == (dt.date(2024, 1, 1), dt.date(2024, 1, 16))
    assert X.window_bounds(None, "2024-01-15", today) == (dt.date(2024, 1, 15), dt.date(2024, 1, 15))
    ev, o = _shards(spark), SessionOptions(today=today)
    assert X.events_in_window(ev, "2024-01-14", opts=o).count() == 4
    assert X.events_in_window(ev, end="2024-01-15", opts=o).count() == 2
    assert X.events_in_window(ev, opts=o).count() == 3


def test_read_sessions_with_one_bound(spark):
    path = new_work_path(spark, "test-sessions")
    spark.createDataFrame([(dt.date(2024, 1, d), f"s{d}") for d in (1, 2, 3)],
                          "session_date date, unique_session_id string").write.partitionBy("session_date").parquet(path)
    ids = lambda **b: sorted(r.unique_session_id for r in X.read_sessions(spark, path, **b).collect())
    assert ids(start="2024-01-02") == ["s2", "s3"]
    assert ids(end="2024-01-02") == ["s1", "s2"]
    assert ids() == ["s1", "s2", "s3"]
