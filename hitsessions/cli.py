"""Command line for the scheduled runs.

    python -m hitsessions.cli model1  --export ROOT --table PATH [--start D --end D] [--mode as_written]
    python -m hitsessions.cli model2  --export ROOT --table PATH [--start D --end D]
    python -m hitsessions.cli both    --export ROOT --table PATH --table2 PATH [--start D --end D]
    python -m hitsessions.cli compare --export ROOT --table PATH --start D --end D [--out PATH]
    python -m hitsessions.cli refresh --export ROOT --states PATH --ledger PATH [--table PATH] [--table2 PATH]
    python -m hitsessions.cli session-ids --export ROOT --shard 20240121 --out PATH

A date that isn't given takes its default: the day before yesterday to
yesterday (UTC), like the original scheduled scripts. ``--layout folders`` reads an
export stored as ``events_YYYYMMDD/`` folders. Results are written to
the given paths; nothing but a summary line reaches the driver.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from hitsessions.functions.params import unique_session_id
from hitsessions.operators import upsert as U
from hitsessions.operators.both_models import both_models
from hitsessions.operators.compare import compare_models
from hitsessions.operators.extract import seen_in_window
from hitsessions.operators.first_touch import first_touch_sessions
from hitsessions.operators.incremental import refresh
from hitsessions.operators.session_start import session_start_sessions
from hitsessions.options import SessionOptions
from hitsessions.session import build_session, new_work_path, remove_path
from hitsessions.sources import export as X


def _events(spark, a, start, end):
    read = X.read_shard_folders if a.layout == "folders" else X.read_window
    return read(spark, a.export, start, end, include_intraday=_intraday(a))


def _intraday(a):
    return False if a.daily_only else X.UNLESS_DAILY if a.intraday_unless_daily else True


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="hitsessions")
    ap.add_argument("job", choices=["model1", "model2", "both", "compare", "session-ids", "refresh"])
    ap.add_argument("--export", required=True)
    ap.add_argument("--table", help="session table (Model 1 for 'both' and 'compare')")
    ap.add_argument("--table2", help="Model 2 session table for 'both'")
    ap.add_argument("--states", help="state table for 'refresh'")
    ap.add_argument("--ledger", help="shard ledger for 'refresh'")
    ap.add_argument("--out", help="output path for 'compare' and 'session-ids'")
    ap.add_argument("--start")
    ap.add_argument("--end")
    ap.add_argument("--shard")
    ap.add_argument("--mode", default="intended", choices=["intended", "as_written"])
    ap.add_argument("--layout", default="partitioned", choices=["partitioned", "folders"])
    ap.add_argument("--daily-only", action="store_true", help="ignore intraday shards")
    ap.add_argument("--intraday-unless-daily", action="store_true",
                    help="ignore an intraday shard whose daily shard is there")
    ap.add_argument("--lookback-days", type=int, default=0)
    ap.add_argument("--one-row-per-id", action="store_true", help="insert only sessions that no date of the table holds")
    ap.add_argument("--by-channel", action="store_true", help="compare per source, medium and campaign")
    ap.add_argument("--master", default=None, help="only without a submitter that sets it")
    a = ap.parse_args(argv)
    needs = {"model1": ["table"], "model2": ["table"], "both": ["table", "table2"],
             "compare": ["table", "out"], "session-ids": ["out", "shard"], "refresh": ["states", "ledger"]}
    missing = [f"--{n}" for n in needs[a.job] if not getattr(a, n)]
    if missing:
        ap.error(f"{a.job} needs {', '.join(missing)}")

    spark = SparkSession.getActiveSession() if not a.master else None
    spark = spark or build_session(a.master)
    opts = SessionOptions(mode=a.mode, include_intraday=_intraday(a), target_lookback_days=a.lookback_days,
                          one_row_per_id=a.one_row_per_id)
    start, end = X.window_bounds(a.start, a.end)
    # Session jobs scan the days that a widened match needs as well.
    scan = U.scan_start(start, opts) if a.job in ("model1", "model2", "both") else start
    events = None if a.job in ("session-ids", "refresh") else _events(spark, a, scan, end)
    summary = {"job": a.job, "start": str(start), "end": str(end), "mode": a.mode}

    def seen(sessions, only_starts=False):
        """What the window itself touches, where more days were scanned."""
        return sessions if scan == start else seen_in_window(sessions, events, start, end, opts, only_starts)

    if a.job == "model1":
        U.upsert_sessions(spark, a.table, seen(first_touch_sessions(events, scan, end, opts)), start, end,
                          U.MODEL1_SPEC, None, opts)
    elif a.job == "model2":
        U.upsert_sessions(spark, a.table, seen(session_start_sessions(events, scan, end, opts), True), start, end,
                          U.model2_spec(opts), None, opts)
    elif a.job == "both":
        staged = new_work_path(spark, "both-models")
        m1, m2 = both_models(spark, events, scan, end, opts, staged=staged)
        m1, m2 = seen(m1), seen(m2, True)
        U.upsert_sessions(spark, a.table, m1, start, end, U.MODEL1_SPEC, None, opts, source_staged=True)
        U.upsert_sessions(spark, a.table2, m2, start, end, U.model2_spec(opts), None, opts, source_staged=True)
        remove_path(spark, staged)
    elif a.job == "compare":
        fe = X.read_sessions(spark, a.table, start, end)
        report = compare_models(fe, events, start, end, opts, by_channel=a.by_channel)
        report.coalesce(1).write.mode("overwrite").option("header", True).csv(a.out)
    elif a.job == "refresh":
        changed = refresh(spark, a.export, a.states, a.ledger, a.table, a.table2, opts, a.layout)
        summary = {"job": a.job, "mode": a.mode, "changed_shards": len(changed)}
    elif a.job == "session-ids":
        shard = X.read_single_shard(spark, a.export, a.shard, a.layout)
        shard.select(unique_session_id().alias("unique_session_id")).write.mode("overwrite").parquet(a.out)
    print(json.dumps(summary))
    return 0


if __name__ == "__main__":
    sys.exit(main())
