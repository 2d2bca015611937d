"""Upsert invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hitsessions.operators import commit as C
from hitsessions.operators import id_index as I
from hitsessions.operators import upsert as U
from hitsessions.operators.first_touch import first_touch_sessions
from hitsessions.operators.session_start import session_start_sessions
from hitsessions.options import SessionOptions
from hitsessions.session import new_work_path
from hitsessions.sources import export as X
from hitsessions.sources.lens import lens_export
from hitsessions.streaming import upsert_window
from tests.conftest import SF_SMALL, make_events, p

LOAD = ("2024-01-01", "2024-01-16")
WIN = ("2024-01-15", "2024-01-31")


def table(spark, path, cols):
    return sorted((tuple(r) for r in spark.read.parquet(path).select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def ev(spark):
    return lens_export(spark, SF_SMALL)


def _load(spark, ev, opts, build=first_touch_sessions, spec=U.MODEL1_SPEC):
    path = new_work_path(spark, "test-upsert")
    U.upsert_sessions(spark, path, build(ev, *LOAD, opts, run_ts="2024-01-17 06:00:00"), *LOAD, spec,
                      "2024-01-17 06:00:00", opts)
    return path


def test_upsert_twice_changes_nothing(spark, ev):
    o = SessionOptions()
    path = _load(spark, ev, o)
    src = first_touch_sessions(ev, *WIN, o, run_ts="2024-02-01 06:00:00")
    U.upsert_sessions(spark, path, src, *WIN, U.MODEL1_SPEC, "2024-02-01 06:00:00", o)
    once = table(spark, path, U.MODEL1_SPEC.columns)
    U.upsert_sessions(spark, path, src, *WIN, U.MODEL1_SPEC, "2024-02-02 06:00:00", o)
    assert table(spark, path, U.MODEL1_SPEC.columns) == once


def test_null_id_reinserted_as_written(spark, ev):
    o = SessionOptions(mode="as_written")
    path = _load(spark, ev, o)
    src = first_touch_sessions(ev, *WIN, o, run_ts="2024-02-01 06:00:00")
    for _ in range(2):
        U.upsert_sessions(spark, path, src, *WIN, U.MODEL1_SPEC, "2024-02-01 06:00:00", o)
    nulls = spark.read.parquet(path).where(F.col("unique_session_id").isNull()).count()
    assert nulls == 3   # first load + one per run


def test_rows_outside_window_untouched(spark, ev):
    o = SessionOptions()
    path = _load(spark, ev, o)
    before = spark.read.parquet(path).where(F.col("session_date") < F.lit(dt.date(2024, 1, 15)))
    before_rows = sorted(map(tuple, before.collect()), key=repr)
    src = first_touch_sessions(ev, *WIN, o, run_ts="2024-02-01 06:00:00")
    U.upsert_sessions(spark, path, src, *WIN, U.MODEL1_SPEC, "2024-02-01 06:00:00", o)
    after = spark.read.parquet(path).where(F.col("session_date") < F.lit(dt.date(2024, 1, 15)))
    assert sorted(map(tuple, after.collect()), key=repr) == before_rows


def test_update_touches_only_update_columns(spark):
    o = SessionOptions()
    cols = U.MODEL1_SPEC.columns
    t0 = dt.datetime(2024, 1, 1, 6)
    tgt = spark.createDataFrame(
        [(dt.date(2024, 1, 10), "a", "e0", "a0", "s", "m", "c", "n", "t", t0, t0),
         (dt.date(2024, 1, 10), "b", "e0", "a0", "s", "m", "c", "n", "t", t0, t0),
         (dt.date(2024, 1, 5), "c", "e0", "a0", "s", "m", "c", "n", "t", t0, t0)],
        "session_date date, unique_session_id string, event_timestamp string, actual_timestamp string, "
        "session_source string, session_medium string, session_campaign string, session_content string, "
        "session_term string, export_timestamp timestamp, last_update_timestamp timestamp")
    t1 = dt.datetime(2024, 2, 1, 6)
    src = spark.createDataFrame(
        [(dt.date(2024, 1, 11), "a", "e1", "a1", "S", "m", "c", "n", "t", t1, t1),   # changed
         (dt.date(2024, 1, 11), "b", "e1", "a1", "s", "m", "c", "n", "t", t1, t1),   # same
         (dt.date(2024, 1, 11), "c", "e1", "a1", "s", "m", "c", "n", "t", t1, t1),   # target outside window
         (dt.date(2024, 1, 5), "d", "e1", "a1", "s", "m", "c", "n", "t", t1, t1)],   # new, older date
        tgt.schema)
    path = new_work_path(spark, "test-upsert")
    U.create_sessions(tgt, path)
    U.upsert_sessions(spark, path, src, "2024-01-10", "2024-01-11", U.MODEL1_SPEC, F.lit(t1), o)
    got = {(r.unique_session_id, r.session_date.day): r for r in spark.read.parquet(path).collect()}
    a = got[("a", 10)]
    assert (a.session_source, a.event_timestamp, a.export_timestamp, a.last_update_timestamp) == ("S", "e0", t0, t1)
    b = got[("b", 10)]
    assert (b.session_source, b.last_update_timestamp) == ("s", t0)
    assert ("c", 5) in got and ("c", 11) in got       # second row for the same id (Q15)
    assert ("d", 5) in got
    assert len(got) == 5


def _crossing(suffix, hour, source, sid):
    """One event of user u on a day of January 2024, with a source."""
    us = (dt.datetime(2024, 1, int(suffix[-2:]), hour) - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    return {"event_date": suffix, "event_timestamp": us, "event_bundle_sequence_id": us, "user_pseudo_id": "u",
            "event_name": "page_view", "suffix": suffix, "event_params": [p("ga_session_id", i=sid), p("source", s=source)]}


@pytest.mark.parametrize("days,rows", [(0, [(14, "newsletter"), (15, "google")]), (1, [(14, "newsletter")])])
def test_session_across_midnight(spark, days, rows):
    """A session that began the day before the window: one row and its first touch with a lookback, two without (Q15)."""
    ev = make_events(spark, [_crossing("20240114", 23, "newsletter", 1), _crossing("20240115", 0, "google", 1)])
    root, path = new_work_path(spark, "crossing-export"), new_work_path(spark, "crossing")
    X.write_export(ev, root)
    o = SessionOptions(target_lookback_days=days)
    upsert_window(spark, root, path, "2024-01-14", "2024-01-14", run_ts="2024-01-15 06:00:00")
    upsert_window(spark, root, path, "2024-01-15", "2024-01-16", opts=o, run_ts="2024-01-17 06:00:00")
    got = sorted((r.session_date.day, r.session_source) for r in spark.read.parquet(path).collect())
    assert got == rows


def _shards_of(spark, name, *events):
    root, path = new_work_path(spark, name + "-export"), new_work_path(spark, name)
    X.write_export(make_events(spark, list(events)), root)
    return root, path


def test_lookback_inserts_no_partial_session(spark):
    """A session from before the scanned days is seen in part only; its row stays the one it had."""
    root, path = _shards_of(spark, "partial", _crossing("20240113", 23, "newsletter", 1), _crossing("20240114", 1, "google", 1),
                            _crossing("20240115", 1, "bing", 1), _crossing("20240115", 2, "new", 2))
    upsert_window(spark, root, path, "2024-01-13", "2024-01-14", run_ts="2024-01-15 06:00:00")
    upsert_window(spark, root, path, "2024-01-15", "2024-01-16", opts=SessionOptions(target_lookback_days=1),
                  run_ts="2024-01-17 06:00:00")
    got = sorted((r.session_date.day, r.session_source) for r in spark.read.parquet(path).collect())
    assert got == [(13, "newsletter"), (15, "new")]


@pytest.mark.parametrize("days", [0, 1, 2])
def test_lookback_loses_no_session(spark, days):
    """A session with an event before the window that no run has stored is inserted, whatever the lookback."""
    root, path = _shards_of(spark, "late", _crossing("20240113", 3, "old", 1), _crossing("20240114", 5, "mid", 2),
                            _crossing("20240115", 1, "mid", 2), _crossing("20240115", 2, "new", 3))
    upsert_window(spark, root, path, "2024-01-13", "2024-01-13", run_ts="2024-01-14 06:00:00")
    upsert_window(spark, root, path, "2024-01-15", "2024-01-15", opts=SessionOptions(target_lookback_days=days),
                  run_ts="2024-01-16 06:00:00")
    got = sorted((r.unique_session_id, r.session_date.day) for r in spark.read.parquet(path).collect())
    assert got == [("u-1", 13), ("u-2", 14 if days else 15), ("u-3", 15)]


def test_lookback_leaves_out_what_only_the_days_before_hold(spark):
    """A first load: sessions of the lookback's days alone belong to another run."""
    root, path = _shards_of(spark, "before", _crossing("20240114", 5, "before", 1), _crossing("20240115", 2, "in", 2))
    upsert_window(spark, root, path, "2024-01-15", "2024-01-15", opts=SessionOptions(target_lookback_days=1))
    assert [r.unique_session_id for r in spark.read.parquet(path).collect()] == ["u-2"]


def test_one_row_per_id_over_runs(spark):
    """Runs far apart see parts of one session: the index finds its row under any date."""
    root, path = _shards_of(spark, "indexed", _crossing("20240103", 3, "first", 1), _crossing("20240110", 5, "again", 1),
                            _crossing("20240120", 1, "later", 1), _crossing("20240120", 2, "new", 2))
    o = SessionOptions(one_row_per_id=True, id_buckets=4)
    for day in ("2024-01-03", "2024-01-10", "2024-01-20"):
        upsert_window(spark, root, path, day, day, opts=o, run_ts="2024-01-21 06:00:00")
    got = sorted((r.unique_session_id, r.session_date.day, r.session_source) for r in spark.read.parquet(path).collect())
    assert got == [("u-1", 3, "first"), ("u-2", 20, "new")]
    assert sorted(r.unique_session_id for r in I.read_ids(spark, path).collect()) == ["u-1", "u-2"]


def test_index_is_made_for_a_table_without_one(spark, ev):
    path = new_work_path(spark, "no-index")
    U.create_sessions(first_touch_sessions(ev, *LOAD, SessionOptions(), run_ts="2024-01-17 06:00:00"), path)
    o = SessionOptions(one_row_per_id=True, id_buckets=4)
    src = first_touch_sessions(ev, *WIN, o, run_ts="2024-02-01 06:00:00")
    U.upsert_sessions(spark, path, src, *WIN, U.MODEL1_SPEC, "2024-02-01 06:00:00", o)
    t = spark.read.parquet(path)
    assert t.count() == t.select("unique_session_id").distinct().count() == I.read_ids(spark, path).count()
    # A later run without the option keeps the index up to date all the same.
    more = src.withColumn("unique_session_id", F.concat("unique_session_id", F.lit("x")))
    U.upsert_sessions(spark, path, more, *WIN, U.MODEL1_SPEC, "2024-02-01 06:00:00", SessionOptions())
    assert I.read_ids(spark, path).where("unique_session_id LIKE '%x'").count() == src.count()


def test_index_is_not_shuffled(spark, ev):
    """The join with the index has an exchange above the source only."""
    path = new_work_path(spark, "index-plan")
    o = SessionOptions(one_row_per_id=True, id_buckets=16)
    src = first_touch_sessions(ev, *LOAD, o, run_ts="2024-01-17 06:00:00")
    U.upsert_sessions(spark, path, src, *LOAD, U.MODEL1_SPEC, "2024-01-17 06:00:00", o)
    staged = new_work_path(spark, "index-plan-source")
    src.write.parquet(staged)
    with_conf = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in with_conf.items():
        spark.conf.set(k, v)
    try:
        joined = I.held(spark.read.parquet(staged), I.read_ids(spark, path), 16)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in with_conf:
            spark.conf.unset(k)
    assert plan.count("Exchange") == 1 and plan.count("SelectedBucketsCount: 16 out of 16") == 1


def _sorted(spark, path, *cols):
    t = spark.read.parquet(path)
    return sorted(map(tuple, t.select(*(cols or sorted(t.columns))).collect()), key=repr)


class Killed(Exception):
    pass


def killed_after(n):
    """A progress callback that stops the run after ``n`` partitions."""
    done = []

    def progress(name):
        done.append(name)
        if len(done) == n:
            raise Killed(name)

    return progress


@pytest.mark.parametrize("one_row", [False, True])
@pytest.mark.parametrize("n", [1, 2])
def test_next_run_finishes_an_interrupted_commit(spark, ev, n, one_row):
    o = SessionOptions(one_row_per_id=one_row, id_buckets=4)
    path, other = (_load(spark, ev, o, first_touch_sessions, U.MODEL1_SPEC) for _ in range(2))
    src = first_touch_sessions(ev, *WIN, o, run_ts="2024-02-01 06:00:00")
    with pytest.raises(Killed):
        U.upsert_sessions(spark, path, src, *WIN, U.MODEL1_SPEC, "2024-02-01 06:00:00", o, progress=killed_after(n))
    U.upsert_sessions(spark, other, src, *WIN, U.MODEL1_SPEC, "2024-02-01 06:00:00", o)
    files = C._Files(spark, path)
    assert files.exists(f"{path}/{C.JOURNAL}")
    assert C.recover(spark, path) is not None and C.recover(spark, path) is None
    assert _sorted(spark, path) == _sorted(spark, other)
    assert not [x for x in files.names(path) if x.startswith((C.STAGED, C.OLD, C.JOURNAL))]
    if one_row:
        assert sorted(I.read_ids(spark, path).collect()) == sorted(I.read_ids(spark, other).collect())
    # A whole further run on the interrupted table gives what it gives on the other.
    again = U.upsert_sessions(spark, path, src, *WIN, U.MODEL1_SPEC, "2024-02-01 06:00:00", o)
    assert again["finished"] is None and _sorted(spark, path) == _sorted(spark, other)


@pytest.mark.parametrize("between", ["out", "in"])
def test_recovery_between_the_renames_of_a_partition(spark, tmp_path, between):
    """The old partition is out of the way and the new one isn't in place yet; or the journal has nothing left to do."""
    path, run = str(tmp_path / "t"), "r1"
    for where, v in ((f"{path}/session_date=2024-01-01", "old"), (f"{C.staged_path(path, run)}/session_date=2024-01-01", "new")):
        spark.createDataFrame([(v,)], "v string").write.parquet(where)
    real = C._Files.move

    def move(self, a, b):
        if between == "out" and C.STAGED in a:
            raise Killed(a)
        real(self, a, b)
        if between == "in" and C.STAGED in a:
            raise Killed(a)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(C._Files, "move", move)
        with pytest.raises(Killed):
            C.commit_staged(spark, path, run)
    assert C.recover(spark, path) == run
    assert [r.v for r in spark.read.parquet(path).collect()] == ["new"]


def test_failed_run_leaves_the_table_and_nothing_else(spark, ev, monkeypatch):
    o = SessionOptions()
    path = _load(spark, ev, o)
    before = _sorted(spark, path)
    src = first_touch_sessions(ev, *WIN, o, run_ts="2024-02-01 06:00:00")
    with monkeypatch.context() as m:
        m.setattr(U, "commit_staged", lambda *a, **k: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            U.upsert_sessions(spark, path, src, *WIN, U.MODEL1_SPEC, "2024-02-01 06:00:00", o)
    assert _sorted(spark, path) == before
    assert any(n.startswith(C.STAGED) for n in C._Files(spark, path).names(path))
    assert C.recover(spark, path) is None
    assert not any(n.startswith(C.STAGED) for n in C._Files(spark, path).names(path))


def test_replace_moves_a_session_to_another_day(spark):
    """An earlier event came late: the row goes to the earlier day, its old partition goes with its last row."""
    o = SessionOptions(id_buckets=4)
    root, path = _shards_of(spark, "moved", _crossing("20240115", 1, "bing", 1), _crossing("20240116", 2, "x", 2))
    late, _ = _shards_of(spark, "moved-late", _crossing("20240113", 1, "first", 1), _crossing("20240115", 1, "bing", 1))
    one = first_touch_sessions(X.read_export(spark, root), "2024-01-01", "2024-01-31", o, run_ts="2024-01-17 06:00:00")
    U.replace_sessions(spark, path, one, U.MODEL1_SPEC, "2024-01-17 06:00:00", o)
    two = first_touch_sessions(X.read_export(spark, late), "2024-01-01", "2024-01-31", o, run_ts="2024-01-18 06:00:00")
    for _ in range(2):
        U.replace_sessions(spark, path, two, U.MODEL1_SPEC, "2024-01-18 06:00:00", o)
        rows = {r.unique_session_id: r for r in spark.read.parquet(path).collect()}
        assert [(i, r.session_date.day, r.session_source) for i, r in sorted(rows.items())] == [("u-1", 13, "first"), ("u-2", 16, "x")]
        assert (rows["u-1"].export_timestamp.day, rows["u-1"].last_update_timestamp.day) == (17, 18)
        assert rows["u-2"].last_update_timestamp.day == 17
        assert "session_date=2024-01-15" not in C._Files(spark, path).names(path)


def test_upsert_reads_and_lists_only_what_it_may_rewrite(spark, ev):
    o = SessionOptions()
    path = _load(spark, ev, o, first_touch_sessions, U.MODEL1_SPEC)
    src = first_touch_sessions(ev, *WIN, o, run_ts="2024-02-01 06:00:00")
    target = U._read_target(spark, path, src.limit(0), *WIN, U.MODEL1_SPEC, o)
    assert {f.split("session_date=")[1][:10] for f in target.inputFiles()} == {"2024-01-15", "2024-01-16"}


def test_model2_insert_columns_by_mode(spark, ev):
    for mode, expect_null in (("as_written", True), ("intended", False)):
        o = SessionOptions(mode=mode)
        spec = U.model2_spec(o)
        path = _load(spark, ev, o, session_start_sessions, spec)
        src = session_start_sessions(ev, *WIN, o, run_ts="2024-02-01 06:00:00")
        U.upsert_sessions(spark, path, src, *WIN, spec, "2024-02-01 06:00:00", o)
        df = spark.read.parquet(path).where(F.col("export_timestamp") > F.lit(dt.datetime(2024, 1, 20)))
        assert df.count() > 0
        nulls = df.where(F.col("gclid_url").isNull() & F.col("ga_session_number").isNull()).count()
        assert (nulls == df.count()) if expect_null else nulls == 0


def test_first_run_without_events(spark, ev):
    o = SessionOptions()
    path = new_work_path(spark, "test-upsert-empty")
    empty = first_touch_sessions(ev, "2023-06-01", "2023-06-02", o, run_ts="2024-01-17 06:00:00")
    U.upsert_sessions(spark, path, empty, "2023-06-01", "2023-06-02", U.MODEL1_SPEC, "2024-01-17 06:00:00", o)
    src = first_touch_sessions(ev, *WIN, o, run_ts="2024-02-01 06:00:00")
    U.upsert_sessions(spark, path, src, *WIN, U.MODEL1_SPEC, "2024-02-01 06:00:00", o)
    assert spark.read.parquet(path).count() == src.count()
