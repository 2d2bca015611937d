"""The stream-triggered upsert equals the same runs done in batch."""

from pyspark.sql import functions as F

from hitsessions.operators import upsert as U
from hitsessions.operators.first_touch import first_touch_sessions
from hitsessions.options import SessionOptions
from hitsessions.session import new_work_path
from hitsessions.sources.export import write_export
from hitsessions.sources.lens import lens_events
from hitsessions.streaming import start_incremental, upsert_window
from tests.conftest import SF_SMALL

RUN = "2024-02-01 06:00:00"
COLS = [c for c in U.MODEL1_SPEC.columns if c not in ("export_timestamp", "last_update_timestamp")]


def _rows(spark, path):
    return sorted((tuple(r) for r in spark.read.parquet(path).select(*COLS).collect()), key=repr)


def test_stream_equals_batch_runs(spark):
    ev = lens_events(spark, SF_SMALL)
    root = new_work_path(spark, "stream-export")
    part_a = ev.where(F.col("suffix") <= "20240115")
    part_b = ev.where(F.col("suffix") > "20240115")
    write_export(part_a, root)

    table = new_work_path(spark, "stream-sessions")
    ckpt = new_work_path(spark, "stream-ckpt")
    q = start_incremental(spark, root, table, checkpoint=ckpt, run_ts=RUN)
    q.awaitTermination(300)
    write_export(part_b, root, mode="append")
    q = start_incremental(spark, root, table, checkpoint=ckpt, run_ts=RUN)
    q.awaitTermination(300)

    # The same two runs in batch: window of each arrival, one day back.
    ref = new_work_path(spark, "batch-sessions")
    upsert_window(spark, root, ref, "2023-12-31", "2024-01-15", run_ts=RUN)
    last = part_b.select(F.max("event_date")).first()[0]
    end = f"{last[:4]}-{last[4:6]}-{last[6:]}"
    upsert_window(spark, root, ref, "2024-01-15", end, run_ts=RUN)
    assert _rows(spark, table) == _rows(spark, ref)
    # Every session of the fixture ends up in the table.
    want = first_touch_sessions(ev, "2023-12-31", end, SessionOptions()).select("unique_session_id").distinct()
    got = spark.read.parquet(table).select("unique_session_id").distinct()
    assert want.join(got, "unique_session_id", "left_anti").count() == 0


def test_batch_windows_split_runs(spark):
    from hitsessions.streaming import batch_windows
    import datetime as dt
    b = spark.createDataFrame([("20240110",), ("20240111",), ("20240111",), ("20240120",), ("20240201",),
                               ("intraday_20240202",), ("other",), (None,)], "suffix string")
    assert batch_windows(b, 1) == [(dt.date(2024, 1, 9), dt.date(2024, 1, 11)),
                                   (dt.date(2024, 1, 19), dt.date(2024, 1, 20)),
                                   (dt.date(2024, 1, 31), dt.date(2024, 2, 2))]
    assert batch_windows(b.where("suffix IS NULL"), 1) == []


def test_stream_and_batch_agree_on_every_shard_name():
    """A shard's window takes it in, and no smaller one does; a name in no window is in none in batch either."""
    import datetime as dt
    import random
    from hitsessions.sources.export import shard_matches
    from hitsessions.streaming import shard_days
    rng = random.Random(1)
    names = ["20240107", "2024010712", "intraday_20240122", "fresh_2024", "20249999", "20240230", "99991231", "999912311",
             "0", "other", "", None, "x2024-01-07"]
    names += ["2024" * rng.randint(0, 1) + "".join(rng.choices("0123456789", k=rng.randint(1, 12))) for _ in range(5000)]
    for name in names:
        w = shard_days(name)
        if w is None:
            assert not shard_matches(name or "", dt.date.min, dt.date.max), name
        else:
            assert shard_matches(name, *w) and (w[1] - w[0]).days <= 1, name
            assert w[0] == w[1] or not any(shard_matches(name, d, d) for d in w), name


def test_hourly_shard_is_rebuilt(spark):
    """An hourly shard alone: the stream runs the window that a batch run needs for it."""
    ev = lens_events(spark, SF_SMALL).where("suffix = '20240107'").withColumn("suffix", F.lit("2024010712"))
    root, table = new_work_path(spark, "hourly-export"), new_work_path(spark, "hourly-sessions")
    write_export(ev, root)
    start_incremental(spark, root, table, checkpoint=new_work_path(spark, "hourly-ckpt"), run_ts=RUN).awaitTermination(300)
    want = first_touch_sessions(ev, "2024-01-07", "2024-01-08", SessionOptions())
    assert spark.read.parquet(table).count() == want.count() > 0
