"""Incremental session load driven by Structured Streaming.

The original job is a scheduled batch that rescans a two-day window so
sessions crossing midnight and late hits are re-attributed (L1, L2).
Here a file stream over the export tree replaces the scheduler: each
micro-batch only tells *which days* received new hits. The batch
function then recomputes the sessions of those days from the export
(all their events, not only the new rows, since a session needs all of
them) and upserts them into the session table.

The micro-batch is reduced to its distinct dates (one row per calendar
day) before anything reaches the driver. Progress is kept in the stream checkpoint
under the shared work folder, so a restarted query resumes after the
last committed batch; the upsert itself is idempotent for a fixed run.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession

from hitsessions.operators import upsert as U
from hitsessions.operators.extract import seen_in_window
from hitsessions.operators.first_touch import first_touch_sessions
from hitsessions.operators.session_start import session_start_sessions
from hitsessions.options import SessionOptions
from hitsessions.session import new_work_path
from hitsessions.sources.export import event_schema, read_window

MODELS = {"model1": (first_touch_sessions, lambda o: U.MODEL1_SPEC),
          "model2": (session_start_sessions, U.model2_spec)}


def _day_at(n: int, after: bool = False) -> dt.date | None:
    """The last date whose digits ``yyyymmdd`` are at most ``n``; ``after``: the first one at least ``n``."""
    y, m, d = n // 10000, min(n // 100 % 100, 13), n % 100
    if not 1 <= y <= 9999:
        return None
    if m == 13 or m == 0:
        day = dt.date(y, 12, 31) if m else dt.date(y, 1, 1) - dt.timedelta(days=1) if y > 1 else None
    else:
        first = dt.date(y, m, 1)
        last = (first.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1) if (y, m) != (9999, 12) \
            else dt.date(9999, 12, 31)
        day = dt.date(y, m, min(d, last.day)) if d else first - dt.timedelta(days=1) if first > dt.date.min else None
    if not after or (day is not None and int(day.isoformat().replace("-", "")) == n):
        return day
    if day is None:
        return dt.date.min
    return day + dt.timedelta(days=1) if day < dt.date.max else None


def shard_days(shard: str | None) -> tuple[dt.date, dt.date] | None:
    """The smallest window of days that takes a shard in, None where no window does.

    Windows compare the first digit run of the name as text. A plain date
    is its own window; ``2024010712`` lies between the texts of the 7th and
    the 8th, ``202401`` between those of New Year's Eve and New Year. A name
    without digits is in no window, in a batch run as here.
    """
    digits = re.search("[0-9]+", shard or "")
    if digits is None:
        return None
    r, n = digits[0], int(digits[0][:8].ljust(8, "0"))
    lo = _day_at(n if len(r) >= 8 else n - 1)
    hi = _day_at(n, after=True) if len(r) <= 8 else _day_at(n + 1, after=True)
    return None if lo is None or hi is None else (lo, hi)


def batch_windows(batch: DataFrame, lookback_days: int = 1) -> list[tuple[dt.date, dt.date]]:
    """Windows to rebuild for a micro-batch: the days of its shards (one
    row per shard reaches the driver) grouped into runs of consecutive
    days, each widened back by ``lookback_days``. A late shard from weeks
    ago then rebuilds its own days, not every day since.

    The day is the shard's, as in the window filter of the reload; an
    event's own date may differ. It comes from the path, so no data
    column is read."""
    found = {shard_days(r.suffix) for r in batch.select("suffix").distinct().collect()}
    out: list[list[dt.date]] = []
    for first, last in sorted(w for w in found if w):
        lo = first - dt.timedelta(days=min(lookback_days, (first - dt.date.min).days))
        if out and lo <= out[-1][1] + dt.timedelta(days=1):
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([lo, last])
    return [(a, b) for a, b in out]


def upsert_window(spark: SparkSession, export_root: str, table_path: str, start, end,
                  model: str = "model1", opts: SessionOptions | None = None, run_ts=None) -> dict:
    """One scheduled run: sessions of [start, end] from the export, upserted."""
    opts = opts or SessionOptions()
    build, spec = MODELS[model]
    scan_from = U.scan_start(start, opts)
    events = read_window(spark, export_root, scan_from, end, opts.include_intraday)
    sessions = build(events, scan_from, end, opts, run_ts=run_ts)
    if scan_from != U._as_date(start):
        sessions = seen_in_window(sessions, events, start, end, opts, only_starts=model == "model2")
    return U.upsert_sessions(spark, table_path, sessions, start, end, spec(opts), run_ts, opts)


def start_incremental(spark: SparkSession, export_root: str, table_path: str, model: str = "model1",
                      opts: SessionOptions | None = None, checkpoint: str | None = None,
                      lookback_days: int = 1, available_now: bool = True, run_ts=None):
    """Start the stream; returns the StreamingQuery.

    ``available_now`` processes what has arrived and stops (a scheduled
    run); otherwise the query keeps running and picks up new shards.
    """
    opts = opts or SessionOptions()
    checkpoint = checkpoint or new_work_path(spark, "stream-checkpoint")
    stream = (spark.readStream.schema(event_schema(narrow=True))
              .option("basePath", export_root).parquet(export_root)
              .select("suffix"))

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        for window in batch_windows(batch, lookback_days):
            upsert_window(spark, export_root, table_path, *window, model=model, opts=opts, run_ts=run_ts)

    w = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 minutes")
    return w.start()
