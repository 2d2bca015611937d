"""Session states, the shard ledger, the stateful stream and the bucketed target."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hitsessions.functions import params as P
from hitsessions.operators import bucketed as B
from hitsessions.operators import commit as C
from hitsessions.operators import compare as CMP
from hitsessions.operators import rollup as R
from hitsessions.operators import states as S
from hitsessions.operators import upsert as U
from hitsessions.operators.first_touch import first_touch_sessions
from hitsessions.operators.incremental import refresh
from hitsessions.operators.session_start import session_start_sessions
from hitsessions.options import SessionOptions
from hitsessions.session import new_work_path
from hitsessions.sources import export as X
from hitsessions.sources.ledger import NEW, REMOVED, REPLACED, Ledger
from hitsessions.sources.lens import lens_events, lens_export
from hitsessions.streaming import start_stateful
from hitsessions.streaming.stateful import stream_parts
from tests.conftest import SF_SMALL, make_events, p

RUN = "2024-02-01 06:00:00"
ALL = ("2024-01-01", "2024-12-31")


def rows(df):
    return sorted(map(tuple, df.drop("export_timestamp", "last_update_timestamp").collect()), key=repr)


def event(day, hour, sid, source=None, name="page_view", suffix=None, bundle=None):
    us = (dt.datetime(2024, 1, day, hour) - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    shard = f"202401{day:02d}"
    return {"event_date": shard, "event_timestamp": us, "event_bundle_sequence_id": bundle or us, "user_pseudo_id": "u",
            "event_name": name, "suffix": suffix or shard,
            "event_params": [p("ga_session_id", i=sid)] + ([p("source", s=source)] if source else [])}


@pytest.fixture(scope="module")
def ev(spark):
    return lens_export(spark, SF_SMALL)


# ------------------------------------------------------------------ states

@pytest.mark.parametrize("mode", ["intended", "as_written"])
def test_states_merge_to_the_batch_result(spark, ev, mode):
    """Shards in any order, some of them twice: the merged states are the sessions of a scan."""
    o = SessionOptions(mode=mode)
    path = new_work_path(spark, "states-any-order")
    days = sorted(r.suffix for r in ev.select("suffix").distinct().collect())
    rng = random.Random(4)
    for _ in range(3):
        some = rng.sample(days, len(days) // 2)
        assert S.update_states(spark, ev, path, some, o) == sorted(some)
    S.update_states(spark, ev, path, days, o)
    for window in (ALL, ("2024-01-05", "2024-01-12"), ("2023-01-01", "2023-01-02")):
        m1, m2 = S.sessions_from_states(spark, path, *window, o, run_ts=RUN)
        assert rows(m1) == rows(first_touch_sessions(ev, *window, o, run_ts=RUN))
        assert rows(m2) == rows(session_start_sessions(ev, *window, o, run_ts=RUN))


def test_a_window_lists_its_own_folders_only(spark, ev):
    path = new_work_path(spark, "states-folders")
    S.update_states(spark, ev, path, ["20240105", "20240106", "20240107"])
    files = S.read_states(spark, path, lambda s: X.shard_matches(s, "2024-01-06", "2024-01-06")).inputFiles()
    assert {f.split("suffix=")[1][:8] for f in files} == {"20240106"}


def test_a_shard_that_lost_its_sessions_loses_its_states(spark):
    path = new_work_path(spark, "states-empty")
    first = make_events(spark, [event(5, 1, 1, "a"), event(6, 1, 2, "b")])
    S.update_states(spark, first, path, ["20240105", "20240106"])
    nobody = first.withColumn("user_pseudo_id", F.lit(None).cast("string"))
    assert S.update_states(spark, nobody, path, ["20240105"]) == []
    assert {r.suffix for r in S.read_states(spark, path).collect()} == {"20240106"}
    S.update_states(spark, first, path, [], removed=["20240106"])
    assert S.read_states(spark, path).count() == 0 and S.sessions_from_states(spark, path, *ALL)[0].count() == 0


def test_touched_sessions_reach_back_any_time(spark):
    """A session touched today has its first touch weeks ago: nothing between is read from the export."""
    path = new_work_path(spark, "states-history")
    evs = make_events(spark, [event(1, 1, 1, "first"), event(3, 1, 2, "other"), event(25, 1, 1, "late", "session_start")])
    S.update_states(spark, evs, path, ["20240101", "20240103"])
    S.update_states(spark, evs, path, ["20240125"])
    m1, m2 = S.touched_sessions(spark, path, ["20240125"])
    assert [(r.session_date.day, r.session_source) for r in m1.collect()] == [(1, "first")]
    assert [(r.session_date.day, r.session_source) for r in m2.collect()] == [(25, "late")]


def test_an_interrupted_state_update_is_finished_by_the_next_reader(spark, monkeypatch):
    path = new_work_path(spark, "states-killed")
    evs = make_events(spark, [event(d, 1, d, "a") for d in (5, 6, 7)])
    real, done = C._Files.move, []

    def move(self, a, b):
        if "suffix=" in a:
            if done:
                raise KeyboardInterrupt
            done.append(a)
        real(self, a, b)

    with monkeypatch.context() as m:
        m.setattr(C._Files, "move", move)
        with pytest.raises(KeyboardInterrupt):
            S.update_states(spark, evs, path, ["20240105", "20240106", "20240107"])
    assert S.read_states(spark, path).count() == 3


# ------------------------------------------------------------------ ledger

@pytest.mark.parametrize("layout", ["partitioned", "folders"])
def test_ledger_tells_what_changed(spark, layout):
    root, at = new_work_path(spark, "ledger-export"), new_work_path(spark, "ledger")

    def write(*events, mode="overwrite"):
        df = make_events(spark, list(events))
        for shard in {e["suffix"] for e in events}:
            folder = f"suffix={shard}" if layout == "partitioned" else f"events_{shard}"
            df.where(F.col("suffix") == shard).drop("suffix").coalesce(1).write.mode(mode).parquet(f"{root}/{folder}")

    book = Ledger(spark, root, at, layout)
    write(event(5, 1, 1), event(6, 1, 2), event(7, 1, 3, suffix="intraday_20240107"), event(8, 1, 3, suffix="odd name_8"))
    assert book.pending() == {"20240105": NEW, "20240106": NEW, "intraday_20240107": NEW, "odd name_8": NEW}
    # Not worked in: the next reading tells the same.
    assert Ledger(spark, root, at, layout).pending().keys() == {"20240105", "20240106", "intraday_20240107", "odd name_8"}
    book = Ledger(spark, root, at, layout)
    book.pending()
    book.done()
    assert book.pending() == {}
    book.done()
    write(event(5, 1, 1), event(5, 2, 1))                 # written again
    write(event(6, 2, 2), mode="append")                   # one more file
    write(event(7, 1, 3), event(9, 1, 1))                  # the daily shard, and a new one
    assert book.pending() == {"20240105": REPLACED, "20240106": REPLACED, "20240107": NEW, "20240109": NEW,
                              "intraday_20240107": REMOVED}
    book.done()
    assert Ledger(spark, root, at, layout).pending() == {}
    with pytest.raises(ValueError):
        Ledger(spark, root, at, layout).done()


def test_ledger_opens_no_data_file(spark):
    """Files that hold no Parquet at all are told as well."""
    root, at = new_work_path(spark, "ledger-odd"), new_work_path(spark, "ledger")
    X.write_export(make_events(spark, [event(5, 1, 1)]), root)
    spark.createDataFrame([("no parquet",)], "v string").coalesce(1).write.text(f"{root}/suffix=20240106")
    files = C._Files(spark, root)
    text = next(n for n in files.names(f"{root}/suffix=20240106") if n.endswith(".txt"))
    files.move(f"{root}/suffix=20240106/{text}", f"{root}/suffix=20240106/part-0.parquet")
    assert Ledger(spark, root, at).pending() == {"20240105": NEW, "20240106": NEW}


# ------------------------------------------------------------------ stream

def run_stream(spark, root, table, states, ckpt, **options):
    q = start_stateful(spark, root, table, states, checkpoint=ckpt, run_ts=RUN, **options)
    q.awaitTermination()
    return q


def test_stateful_stream_lets_go_of_old_days(spark):
    """Days older than the watermark leave the store; the session table keeps their sessions."""
    root, table, states, ckpt = (new_work_path(spark, n) for n in ("sf-export", "sf-table", "sf-states", "sf-ckpt"))
    parts = [[event(1, h, h, "a") for h in range(1, 6)], [event(10, 1, 50, "b")], [event(20, 1, 60, "c")]]
    kept = []
    for i, part in enumerate(parts):
        X.write_export(make_events(spark, part), root, mode="append" if i else "overwrite")
        q = run_stream(spark, root, table, states, ckpt, late="1 day")
        kept.append([x["stateOperators"][0]["numRowsTotal"] for x in q.recentProgress if x["stateOperators"]][-1])
    assert kept[0] == 5 and kept[-1] <= 2
    want = first_touch_sessions(X.read_export(spark, root), *ALL, SessionOptions(), run_ts=RUN)
    assert rows(spark.read.parquet(table).select(*U.MODEL1_SPEC.columns)) == rows(want)
    # An event of a day that the stream has let go of is dropped there, and comes in by its shard's states.
    X.write_export(make_events(spark, [event(1, 0, 3, "earlier")]), root, mode="append")
    run_stream(spark, root, table, states, ckpt, late="1 day")
    S.update_states(spark, X.read_export(spark, root), states, ["20240101"])
    U.replace_sessions(spark, table, S.touched_sessions(spark, states, ["20240101"])[0], U.MODEL1_SPEC, RUN)
    want = first_touch_sessions(X.read_export(spark, root), *ALL, SessionOptions(), run_ts=RUN)
    got = rows(spark.read.parquet(table).select(*U.MODEL1_SPEC.columns))
    assert got == rows(want) and any("earlier" in r for r in got)


def test_stateful_stream_in_small_batches_and_compacted(spark, ev):
    root, table, states, ckpt = (new_work_path(spark, n) for n in ("sb-export", "sb-table", "sb-states", "sb-ckpt"))
    X.write_export(lens_events(spark, SF_SMALL).where("suffix < '20240108'"), root)
    q = run_stream(spark, root, table, states, ckpt, late="60 days", files_per_batch=3, compact_every=2)
    assert len([x for x in q.recentProgress if x["numInputRows"]]) > 1
    want = first_touch_sessions(X.read_export(spark, root), *ALL, SessionOptions(), run_ts=RUN)
    assert rows(spark.read.parquet(table).select(*U.MODEL1_SPEC.columns)) == rows(want)
    assert "suffix=stream-0-merged" in stream_parts(spark, states) and len(stream_parts(spark, states)) <= 2


# ---------------------------------------------------------------- bucketed

def test_bucketed_upsert_shuffles_its_source_only(spark, ev):
    o = SessionOptions(table_buckets=8)
    path = new_work_path(spark, "bucketed")
    load, win = ("2024-01-01", "2024-01-16"), ("2024-01-15", "2024-01-31")
    U.upsert_sessions(spark, path, first_touch_sessions(ev, *load, o, run_ts=RUN), *load, U.MODEL1_SPEC, RUN, o)
    assert B.buckets_of(spark, path) == 8
    staged = new_work_path(spark, "bucketed-source")
    first_touch_sessions(ev, *win, o, run_ts=RUN).write.parquet(staged)
    src, names = spark.read.parquet(staged), []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = U._read_target(spark, path, src, *win, U.MODEL1_SPEC, o, names=names)
        new = U.merge_partitions(target, src, *win, U.MODEL1_SPEC, RUN, 0, 8)
        plan = new._jdf.queryExecution().executedPlan().toString()
        merged = plan[:plan.index("BroadcastExchange")]
        # The full outer join: one exchange, above the source; the target's scan is read by bucket.
        assert merged.count("Exchange hashpartitioning") == 1 and "SelectedBucketsCount: 8 out of 8" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for n in names:
            B.drop(spark, n)


def test_bucketed_table_takes_every_kind_of_run(spark, ev):
    """Ids under any date, replacement, another id column: the rows are those of a plain table."""
    load, win = ("2024-01-01", "2024-01-16"), ("2024-01-14", "2024-01-31")
    got = []
    for buckets in (0, 4):
        o = SessionOptions(table_buckets=buckets, one_row_per_id=True, id_buckets=4, id_column="key")
        path = new_work_path(spark, "bucketed-runs")
        for i, w in enumerate((load, win)):
            U.upsert_sessions(spark, path, first_touch_sessions(ev, *w, o, run_ts=RUN), *w, U.MODEL1_SPEC, RUN, o)
        moved = first_touch_sessions(ev, *load, o, run_ts=RUN).withColumn("session_date", F.date_sub("session_date", 3))
        U.replace_sessions(spark, path, moved, U.MODEL1_SPEC, RUN, o)
        got.append(rows(spark.read.parquet(path).select("session_date", "key", "session_source")))
        assert B.buckets_of(spark, path) == buckets
    assert got[0] == got[1]


# ------------------------------------------------------------------ counts

def test_duplicate_counts(spark):
    one, two = [p("a", s="x")], [p("a", s="x"), p("a", s="y"), p("b", i=1)]
    df = make_events(spark, [{"event_params": one}, {"event_params": two}, {"event_params": None}, {"event_params": []}])
    got = {r.key: (r.n_events, r.n_duplicated) for r in P.duplicate_counts(df, ["a", "b", "c"]).collect()}
    assert got == {"a": (2, 1), "b": (1, 0), "c": (0, 0)}


# ---------------------------------------------------------- incremental run

def test_refresh_follows_the_export(spark):
    """New, late, replaced and superseded shards: after each run the tables equal a batch over the export."""
    root, states, ledger, t1, t2 = (new_work_path(spark, n) for n in ("rf-export", "rf-states", "rf-ledger", "rf-1", "rf-2"))
    deliveries = [
        [event(5, 1, 1, "a", "session_start"), event(6, 1, 1, "b"), event(7, 1, 2, "c", "session_start", "intraday_20240107")],
        [],
        [event(4, 1, 1, "earlier", "session_start"), event(8, 1, 3, "d")],
        [event(7, 1, 2, "c", "session_start"), event(7, 2, 4, "e", "session_start")],
    ]
    for i, part in enumerate(deliveries):
        if part:
            X.write_export(make_events(spark, part), root, mode="append" if i else "overwrite")
        changed = refresh(spark, root, states, ledger, t1, t2, run_ts=RUN)
        assert set(changed) == {e["suffix"] for e in part} | ({"intraday_20240107"} if i == 3 else set())
        ev = X.read_export(spark, root)
        ev = ev.where("suffix <> 'intraday_20240107'") if i == 3 else ev
        assert rows(spark.read.parquet(t1).select(*U.MODEL1_SPEC.columns)) == rows(first_touch_sessions(ev, *ALL, run_ts=RUN))
        m2 = U.model2_spec()
        assert rows(spark.read.parquet(t2).select(*m2.columns)) == rows(session_start_sessions(ev, *ALL, run_ts=RUN))


def test_refresh_that_failed_is_done_again(spark, monkeypatch):
    root, states, ledger, t1 = (new_work_path(spark, n) for n in ("rd-export", "rd-states", "rd-ledger", "rd-1"))
    X.write_export(make_events(spark, [event(5, 1, 1, "a"), event(6, 1, 2, "b")]), root)
    with monkeypatch.context() as m:
        m.setattr(U, "replace_sessions", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh(spark, root, states, ledger, t1, run_ts=RUN)
    assert refresh(spark, root, states, ledger, t1, run_ts=RUN) == {"20240105": NEW, "20240106": NEW}
    assert spark.read.parquet(t1).count() == 2
    assert refresh(spark, root, states, ledger, t1, run_ts=RUN) == {}


def test_refresh_from_the_command_line(spark, capsys):
    from hitsessions.cli import main
    root, states, ledger, t1 = (new_work_path(spark, n) for n in ("rc-export", "rc-states", "rc-ledger", "rc-1"))
    X.write_shard_folders(make_events(spark, [event(5, 1, 1, "a"), event(6, 1, 2, "b")]), root)
    args = ["refresh", "--export", root, "--states", states, "--ledger", ledger, "--table", t1, "--layout", "folders"]
    assert main(args) == 0 and '"changed_shards": 2' in capsys.readouterr().out
    assert main(args) == 0 and '"changed_shards": 0' in capsys.readouterr().out
    assert spark.read.parquet(t1).count() == 2


# ------------------------------------------------------------------ rollup

def rolled(spark, evs, shards, o=SessionOptions()):
    book = R.Rollup(spark, new_work_path(spark, "rollup"), o, buckets=3)
    book.add_model2(evs, shards)
    return book


@pytest.mark.parametrize("seed", [1, 2])
def test_rollup_counts_what_a_scan_counts(spark, seed):
    """Sessions over several days, several starts a day, channels that change: every window's counts."""
    rng = random.Random(seed)
    evs = [event(d, rng.randint(0, 23), rng.randint(1, 12), rng.choice(["a", "b", None]), "session_start", bundle=i + 1)
           for i, d in enumerate(rng.choices(range(1, 8), k=90))]
    df = make_events(spark, evs).cache()
    shards = sorted({e["suffix"] for e in evs})
    book = rolled(spark, df, shards[:4])
    book.add_model2(df, shards[2:])
    sessions = first_touch_sessions(df, *ALL)
    book.add_model1(sessions, *ALL)
    for a, b in ((1, 7), (2, 5), (4, 4), (6, 9)):
        window = (f"2024-01-{a:02d}", f"2024-01-{b:02d}")
        for by_channel in (False, True):
            want = CMP.compare_models(sessions, df, *window, by_channel=by_channel).collect()
            assert book.report(*window, by_channel=by_channel).collect() == want
        assert sorted(book.model1_counts(*window).collect()) == sorted(CMP.model1_channel_counts(sessions, *window).collect())
    assert book.numbers().count() == 12 == book.numbers().select("n").distinct().count()


def test_rollup_days_are_replaced(spark):
    df = make_events(spark, [event(5, 1, 1, "a", "session_start"), event(5, 2, 2, "a", "session_start")])
    book = rolled(spark, df, ["20240105"])
    sessions = first_touch_sessions(df, *ALL)
    book.add_model1(sessions, *ALL)
    book.add_model1(sessions.where("unique_session_id = 'u-1'"), *ALL)
    assert [r.cnt_sessions_fev for r in book.model1_counts(*ALL).collect()] == [1]
    book.add_model2(df.where("event_timestamp < 0"), ["20240105"])
    assert book.report(*ALL).collect() == []


def test_rollup_of_shards_that_overlap_in_time(spark):
    """A late event in a later shard: the earlier start is in the later shard, so the events decide."""
    evs = make_events(spark, [event(5, 9, 1, "a", "session_start"), event(5, 3, 1, "b", "session_start", "20240106"),
                              event(5, 1, 2, "c", "session_start")])
    book = rolled(spark, evs, ["20240105", "20240106"])
    assert not book.follow_one_another(*ALL) and book.follow_one_another("2024-01-05", "2024-01-05")
    with pytest.raises(ValueError, match="overlap"):
        book.report(*ALL)
    got = book.report(*ALL, by_channel=True, events=evs).collect()
    assert [(r.session_source, r.cnt_sessions_model2_session_start) for r in got] == [("b", 1), ("c", 1)]
    with pytest.raises(ValueError, match="intended"):
        R.Rollup(spark, "x", SessionOptions(mode="as_written"))
