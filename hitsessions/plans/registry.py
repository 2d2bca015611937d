"""Registered queries: one per operator group of the blueprint.

Each callable takes ``(spark, sf_dir)``, derives export-shaped events
from ``<sf_dir>/events.parquet`` through the fixture lens and returns a
DataFrame. Every query reads the whole table. Date and timestamp columns
are rendered as text so that results compare exactly with the oracle;
run timestamps are fixed literals so upsert results are deterministic.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitsessions.functions import clock as C
from hitsessions.functions import params as P
from hitsessions.functions import sql_tables as T_
from hitsessions.operators import attribution as A
from hitsessions.operators.both_models import both_models
from hitsessions.operators import compare as CMP
from hitsessions.operators import rollup as R
from hitsessions.operators import states as S
from hitsessions.operators import upsert as U
from hitsessions.operators.extract import seen_in_window
from hitsessions.operators.first_touch import first_touch_sessions, first_value_window
from hitsessions.operators.session_start import (first_session_start, session_start_events,
                                                 session_start_sessions)
from hitsessions.options import AS_WRITTEN, INTENDED, SessionOptions
from hitsessions.plans import oracle as O
from hitsessions.session import new_work_path, remove_path
from hitsessions.sources import export as X
from hitsessions.sources.ledger import REMOVED, Ledger
from hitsessions.sources.lens import lens_events, lens_export, lens_flat

FULL = (O.FULL_START, O.FULL_END)
WINDOW = (O.WINDOW_START, O.WINDOW_END)


def comparable(df: DataFrame) -> DataFrame:
    """Dates as ``yyyy-MM-dd`` and timestamps as ``yyyy-MM-dd HH:mm:ss`` text."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DateType):
            out.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def _opts(mode: str, **kw) -> SessionOptions:
    return SessionOptions(mode=mode, **kw)


def _events(spark, sf_dir):
    return lens_export(spark, sf_dir)


# ------------------------------------------------------------- single ops

def q_unique_session_id(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return ev.select("event_id", P.unique_session_id().alias("unique_session_id"))


def q_events_in_window(spark, sf_dir):
    """Sharded export written by Spark, read back with a shard window."""
    root = new_work_path(spark, "export")
    X.write_export(lens_events(spark, sf_dir), root)
    ev = X.read_export(spark, root, extra=(T.StructField("event_id", T.LongType()),))
    win = X.events_in_window(ev, *WINDOW, SessionOptions())
    return win.select("event_id", "suffix", "event_date", "user_pseudo_id")


def q_event_params_extract(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return ev.select("event_id",
                     *[P.int_param(k).alias(k) for k in ("ga_session_id", "ga_session_number", "actual_timestamp")],
                     *[P.string_param(k).alias(k) for k in ("page_location", "source", "medium", "campaign",
                                                            "content", "term")])


def q_event_params_hard_cases(spark, sf_dir):
    """Parameter arrays that are NULL, empty, or hold every key twice (the first one counts)."""
    again = F.transform("event_params", lambda p: F.struct(p["key"].alias("key"), F.struct(
        F.lit("second").alias("string_value"), F.lit(-7).cast("long").alias("int_value"),
        F.lit(None).cast("float").alias("float_value"), F.lit(None).cast("double").alias("double_value")).alias("value")))
    kind = F.col("event_id") % 7
    params = (F.when(kind == 0, F.lit(None)).when(kind == 1, F.slice("event_params", 1, 0))
              .otherwise(F.concat("event_params", again)))
    ev = _events(spark, sf_dir).withColumn("event_params", params)
    return ev.select("event_id", *[P.int_param(k).alias(k) for k in ("ga_session_id", "ga_session_number")],
                     *[P.string_param(k).alias(k) for k in ("page_location", "source", "campaign")])


def q_model2_ties_as_written(spark, sf_dir):
    """Events that share clock, bundle id, server time and name: the row's content settles the tie (Q17)."""
    day_us = 86_400_000_000
    ev = _events(spark, sf_dir).withColumns({
        "event_timestamp": F.call_function("div", F.col("event_timestamp"), F.lit(day_us)) * day_us,
        "event_bundle_sequence_id": F.lit(1).cast("long"),
        "event_params": F.filter("event_params", lambda p: p["key"] != "actual_timestamp")})
    df = session_start_sessions(ev, *FULL, _opts(AS_WRITTEN))
    return comparable(df.drop("export_timestamp", "last_update_timestamp"))


def q_safe_actual_ts(spark, sf_dir):
    ev = _events(spark, sf_dir)
    p = P.int_param("actual_timestamp")
    return ev.select("event_id", "event_timestamp", p.alias("param_actual_ts_ms"),
                     C.safe_actual_ts_ms(p, F.col("event_timestamp")).alias("safe_actual_ts_ms"))


def q_safe_actual_ts_sql_function(spark, sf_dir):
    C.register_sql_functions(spark)
    flat = lens_flat(spark, sf_dir)
    return flat.selectExpr("event_id", "event_timestamp", "p_actual_timestamp AS param_actual_ts_ms",
                           "safe_actual_ts_ms(p_actual_timestamp, event_timestamp) AS safe_actual_ts_ms")


def q_prague_timestamps(spark, sf_dir):
    ev = _events(spark, sf_dir)
    safe = C.safe_actual_ts_ms(P.int_param("actual_timestamp"), F.col("event_timestamp"))
    return ev.select("event_id",
                     C.format_micros(F.col("event_timestamp")).alias("event_timestamp_local"),
                     C.format_micros(safe * F.lit(1000)).alias("actual_timestamp_local"),
                     C.format_micros(safe).alias("actual_timestamp_as_written"))


def q_attribution_concat_split(spark, sf_dir):
    ev = _events(spark, sf_dir)
    x = ev.select("event_id", A.concat_attribution([P.string_param(k) for k in A.M1_KEYS]).alias("t"))
    parts = A.split_attribution(F.col("t"))
    return x.select("event_id", F.col("t").alias("event_traffic_sources"),
                    *[A.default_if_empty(c, A.M1_DEFAULTS[k]).alias(f"session_{k}")
                      for c, k in zip(parts, A.M1_KEYS)])


def q_events_in_window_folders(spark, sf_dir):
    """A folder-per-shard export with daily, intraday and otherwise named shards."""
    root = new_work_path(spark, "folders")
    named = F.when(F.col("suffix") == O.INTRADAY_SHARD, F.concat(F.lit("intraday_"), "suffix")) \
        .when(F.col("suffix") == O.FRESH_SHARD, F.concat(F.lit("fresh_"), "suffix")).otherwise(F.col("suffix"))
    X.write_shard_folders(lens_events(spark, sf_dir).withColumn("suffix", named), root)
    ev = X.read_shard_folders(spark, root, *WINDOW, extra=(T.StructField("event_id", T.LongType()),))
    return X.events_in_window(ev, *WINDOW).select("event_id", "suffix", "event_date", "user_pseudo_id")


def q_intraday_unless_daily(spark, sf_dir):
    """Every second day of the window has an intraday shard too: it counts only where its daily shard is missing."""
    ev = lens_events(spark, sf_dir)
    day = F.col("suffix").substr(7, 2).cast("int")
    intraday = F.concat(F.lit("intraday_"), "suffix")
    ev = ev.where(day % 4 != 0).unionByName(ev.where((day % 2 == 0) & (F.col("event_id") % 3 > 0)).withColumn("suffix", intraday))
    root = new_work_path(spark, "intraday")
    X.write_export(ev, root)
    win = X.read_window(spark, root, *WINDOW, include_intraday=X.UNLESS_DAILY, extra=(T.StructField("event_id", T.LongType()),))
    return X.events_in_window(win, *WINDOW).select("event_id", "suffix", "event_date", "user_pseudo_id")


def q_single_shard(spark, sf_dir):
    """One shard's ids, read from both layouts."""
    root, folders = new_work_path(spark, "export"), new_work_path(spark, "folders")
    X.write_export(lens_events(spark, sf_dir), root)
    X.write_shard_folders(lens_events(spark, sf_dir), folders)
    out = None
    for layout, at in (("partitioned", root), ("folders", folders)):
        one = X.read_single_shard(spark, at, O.SINGLE_SHARD, layout, extra=(T.StructField("event_id", T.LongType()),))
        one = one.select(F.lit(layout).alias("layout"), "event_id", P.unique_session_id().alias("unique_session_id"))
        out = one if out is None else out.unionByName(one)
    return out


def q_default_window_sessions(spark, sf_dir):
    """Model 1 for the default window of a fixed day, and with one bound given."""
    ev, o = _events(spark, sf_dir), SessionOptions(today=dt.date.fromisoformat(O.TODAY))
    runs = {"neither": {}, "start": {"start": O.ONE_START}, "end": {"end": O.ONE_END}}
    out = None
    for given, bounds in runs.items():
        one = comparable(first_touch_sessions(ev, opts=o, **bounds).drop("export_timestamp", "last_update_timestamp"))
        one = one.select(F.lit(given).alias("given"), *one.columns)
        out = one if out is None else out.unionByName(one)
    return out


# ------------------------------------------------------------- Model 1

def _m1(spark, sf_dir, mode, form="aggregate", window=FULL):
    df = first_touch_sessions(_events(spark, sf_dir), *window, _opts(mode, form=form))
    return comparable(df.drop("export_timestamp", "last_update_timestamp"))


def _one_pass(spark, sf_dir, which: int):
    m1, m2 = both_models(spark, _events(spark, sf_dir), *FULL, _opts(INTENDED))
    return comparable((m1 if which == 1 else m2).drop("export_timestamp", "last_update_timestamp"))


def q_model1_first_value_window(spark, sf_dir):
    df = first_value_window(_events(spark, sf_dir), *FULL, _opts(AS_WRITTEN))
    return df.select("unique_session_id", "event_bundle_sequence_id",
                     F.col("session_attr").alias("session_traffic_concat"), "is_first_event")


def q_model1_first_value_window_intended(spark, sf_dir):
    df = first_value_window(_events(spark, sf_dir), *FULL, _opts(INTENDED))
    return df.select("unique_session_id", "event_bundle_sequence_id",
                     *[F.col(f"session_attr.{k}").alias(k) for k in A.M1_KEYS], "is_first_event")


# ------------------------------------------------------------- Model 2

def q_model2_custom_rules(spark, sf_dir):
    """A user's source rule before the built-in ones and a medium rule after them."""
    rules = A.ChannelRules(
        source=(A.Rule(lambda c: c["page_location"].contains("utm_source=q"), "partner"), *A.SOURCE_RULES),
        medium=(*A.MEDIUM_RULES, A.Rule(lambda c: c["source"] == "newsletter", "mail")))
    df = session_start_sessions(_events(spark, sf_dir), *FULL, _opts(INTENDED), rules=rules)
    return comparable(df.select("session_date", "unique_session_id", "session_source", "session_medium",
                                "session_campaign"))


def _m2(spark, sf_dir, mode, form="aggregate"):
    df = session_start_sessions(_events(spark, sf_dir), *FULL, _opts(mode, form=form))
    return comparable(df.drop("export_timestamp", "last_update_timestamp"))


def q_model2_session_start_dedup(spark, sf_dir):
    o = _opts(INTENDED)
    first = first_session_start(session_start_events(_events(spark, sf_dir), *FULL, o), o)
    return comparable(first.select(
        "session_date", "unique_session_id", "event_timestamp_micros", "actual_timestamp_ms", "ga_session_number",
        F.col("p_page_location").alias("page_location"), F.col("p_source").alias("source"),
        F.col("p_medium").alias("medium"), F.col("p_campaign").alias("campaign"),
        F.col("p_term").alias("term"), F.col("p_content").alias("content")))


def q_model2_click_id_rules(spark, sf_dir):
    o = _opts(INTENDED)
    x = session_start_events(_events(spark, sf_dir), *FULL, o)
    ch = A.model2_channel({"page_location": F.col("p_page_location"), "source": F.col("p_source"),
                           "medium": F.col("p_medium"), "campaign": F.col("p_campaign")})
    return x.select("event_bundle_sequence_id", F.col("p_page_location").alias("page_location"),
                    F.col("p_source").alias("source"), F.col("p_medium").alias("medium"),
                    F.col("p_campaign").alias("campaign"), ch["session_source"].alias("session_source"),
                    ch["session_medium"].alias("session_medium"),
                    ch["session_campaign_step1"].alias("session_campaign"))


def q_model2_url_params(spark, sf_dir):
    o = _opts(INTENDED)
    x = session_start_events(_events(spark, sf_dir), *FULL, o)
    pl = F.col("p_page_location")
    return x.select("event_bundle_sequence_id", pl.alias("page_location"),
                    *[A.url_param(pl, n).alias(n) for n in ("utm_campaign_url", "gclid_url", "fbclid_url",
                                                           "msclid_url")])


# ------------------------------------------------------------- tables

def q_create_partitioned_sessions(spark, sf_dir):
    path = new_work_path(spark, "sessions-m1")
    U.create_sessions(first_touch_sessions(_events(spark, sf_dir), *FULL, _opts(INTENDED)), path)
    back = X.read_sessions(spark, path)
    return comparable(back.select(*[c for c in U.MODEL1_SPEC.columns
                                    if c not in ("export_timestamp", "last_update_timestamp")]))


def _merge(spark, sf_dir, model: int, mode: str, times: int = 1, **options):
    o = _opts(mode, **options)
    ev = _events(spark, sf_dir)
    build = first_touch_sessions if model == 1 else session_start_sessions
    spec = U.MODEL1_SPEC if model == 1 else U.model2_spec(o)
    path = new_work_path(spark, f"sessions-m{model}")
    first = build(ev, O.LOAD_START, O.LOAD_END, o, run_ts=O.RUN_TS_1)
    U.upsert_sessions(spark, path, first, O.LOAD_START, O.LOAD_END, spec, O.RUN_TS_1, o)
    for _ in range(times):
        src = build(ev, O.MERGE_START, O.MERGE_END, o, run_ts=O.RUN_TS_2)
        U.upsert_sessions(spark, path, src, O.MERGE_START, O.MERGE_END, spec, O.RUN_TS_2, o)
    return comparable(spark.read.parquet(path).select(*spec.columns))


def _merged_with(spark, sf_dir, change, back, o=SessionOptions(), load=(O.LOAD_START, O.LOAD_END),
                 window=(O.MERGE_START, O.MERGE_END)):
    """Model 1 upsert into a first load that ``change`` alters; ``back`` selects the result."""
    ev = _events(spark, sf_dir)
    path = new_work_path(spark, "sessions-changed")
    U.create_sessions(change(first_touch_sessions(ev, *load, SessionOptions(), run_ts=O.RUN_TS_1)), path)
    src = first_touch_sessions(ev, U.scan_start(window[0], o), window[1], o, run_ts=O.RUN_TS_2)
    if o.target_lookback_days:
        src = seen_in_window(src, ev, *window, o)
    U.upsert_sessions(spark, path, src, *window, U.MODEL1_SPEC, O.RUN_TS_2, o)
    return comparable(back(spark.read.parquet(path)))


def q_merge_keeps_unknown_columns(spark, sf_dir):
    return _merged_with(spark, sf_dir, lambda t: t.withColumn("note", F.concat(F.lit("kept "), "unique_session_id")),
                        lambda t: t.select(*U.MODEL1_SPEC.columns, "note"))


def q_merge_other_id_column(spark, sf_dir):
    return _merged_with(spark, sf_dir, lambda t: t.withColumnRenamed("unique_session_id", "session_key"),
                        lambda t: t.select(*["session_key" if c == "unique_session_id" else c
                                             for c in U.MODEL1_SPEC.columns]),
                        SessionOptions(id_column="session_key"))


def q_merge_null_dates(spark, sf_dir):
    """Rows without a date on both sides: the target's stay, the source's are inserted beside them."""
    undated = F.when(F.col("unique_session_id").endswith("7"), F.lit(None).cast("date")).otherwise(F.col("session_date"))
    ev, o = _events(spark, sf_dir), SessionOptions()
    path = new_work_path(spark, "sessions-undated")
    U.create_sessions(first_touch_sessions(ev, O.LOAD_START, O.LOAD_END, o, run_ts=O.RUN_TS_1)
                      .withColumn("session_date", undated), path)
    src = first_touch_sessions(ev, O.MERGE_START, O.MERGE_END, o, run_ts=O.RUN_TS_2).withColumn("session_date", undated)
    U.upsert_sessions(spark, path, src, O.MERGE_START, O.MERGE_END, U.MODEL1_SPEC, O.RUN_TS_2, o)
    return comparable(spark.read.parquet(path).select(*U.MODEL1_SPEC.columns))


def q_merge_lookback(spark, sf_dir):
    """Sessions that cross midnight into the window keep their one row and its first touch."""
    return _merged_with(spark, sf_dir, lambda t: t, lambda t: t.select(*U.MODEL1_SPEC.columns),
                        SessionOptions(target_lookback_days=2))


def q_merge_late_crossing(spark, sf_dir):
    """The days before the window were never loaded: sessions that cross into it are inserted all the same."""
    return _merged_with(spark, sf_dir, lambda t: t, lambda t: t.select(*U.MODEL1_SPEC.columns),
                        SessionOptions(target_lookback_days=2), load=(O.LOAD_START, O.CROSSING_END))


def q_merge_id_index(spark, sf_dir):
    """Four runs whose windows share days and sessions: one row per id, without a lookback."""
    ev, o = _events(spark, sf_dir), SessionOptions(one_row_per_id=True)
    path = new_work_path(spark, "sessions-indexed")
    for i, window in enumerate(O.ID_WINDOWS):
        ts = O.RUN_TS_1 if i == 0 else O.RUN_TS_2
        U.upsert_sessions(spark, path, first_touch_sessions(ev, *window, o, run_ts=ts), *window, U.MODEL1_SPEC, ts, o)
    return comparable(spark.read.parquet(path).select(*U.MODEL1_SPEC.columns))


def q_merge_after_interrupted_commit(spark, sf_dir):
    """The run stops after its first replaced partition; the next run finishes its commit and then does its own."""
    ev, o = _events(spark, sf_dir), SessionOptions()
    path = new_work_path(spark, "sessions-interrupted")
    first = first_touch_sessions(ev, O.LOAD_START, O.LOAD_END, o, run_ts=O.RUN_TS_1)
    U.upsert_sessions(spark, path, first, O.LOAD_START, O.LOAD_END, U.MODEL1_SPEC, O.RUN_TS_1, o)

    def stop(partition):
        raise InterruptedError(partition)

    for progress in (stop, None):
        src = first_touch_sessions(ev, O.MERGE_START, O.MERGE_END, o, run_ts=O.RUN_TS_2)
        try:
            U.upsert_sessions(spark, path, src, O.MERGE_START, O.MERGE_END, U.MODEL1_SPEC, O.RUN_TS_2, o, progress=progress)
        except InterruptedError:
            pass
    return comparable(spark.read.parquet(path).select(*U.MODEL1_SPEC.columns))


def _doubled(spark, sf_dir):
    """Events of which every fourth has each parameter twice."""
    return _events(spark, sf_dir).withColumn("event_params", F.when(
        F.col("event_id") % 4 == 1, F.concat("event_params", "event_params")).otherwise(F.col("event_params")))


def q_strict_duplicate_keys(spark, sf_dir):
    """Per key: events that have it, events that repeat it, and whether the strict lookup raises on them."""
    ev = _doubled(spark, sf_dir)
    counts = P.duplicate_counts(ev, O.PARAM_KEYS)
    raises = []
    for k in O.PARAM_KEYS:
        kind = "int" if k in P.INT_KEYS else "string"
        try:
            ev.agg(F.count(P.event_param(k, kind, strict=True))).collect()
            raises.append((k, False))
        except Exception as e:  # the raise is the result
            if "occurs more than once" not in str(e):
                raise
            raises.append((k, True))
    return counts.join(spark.createDataFrame(raises, "key string, strict_raises boolean"), "key")


def _states(spark, sf_dir, each=lambda states, shards: None):
    """A state table after four deliveries: days out of order, a day in part and then as a whole, an intraday
    shard and then its daily one. ``each`` is called with every delivery's shards."""
    ev = lens_events(spark, sf_dir)
    root, states, ledger_at = (new_work_path(spark, n) for n in ("states-export", "states", "states-ledger"))
    half, late, intraday = O.LEDGER_AGAIN, (O.LEDGER_GONE, O.LEDGER_NEW), O.LEDGER_DAILY
    shard = F.when(F.col("suffix") == intraday, F.concat(F.lit("intraday_"), "suffix")).otherwise(F.col("suffix"))
    deliveries = [
        ev.where(~F.col("suffix").isin(*late) & ((F.col("suffix") != half) | (F.col("event_id") % 2 == 0))
                 & ((F.col("suffix") != intraday) | (F.col("event_id") % 3 == 0))).withColumn("suffix", shard),
        ev.where(F.col("suffix").isin(*late)),
        ev.where((F.col("suffix") == half) & (F.col("event_id") % 2 == 1)),
        ev.where(F.col("suffix") == intraday)]
    book = Ledger(spark, root, ledger_at)
    for i, part in enumerate(deliveries):
        if not part.isEmpty():
            X.write_export(part, root, mode="overwrite" if i == 0 else "append")
        changed = book.pending()
        gone = [s for s, c in changed.items() if c == REMOVED]
        there = [s for s in changed if s not in gone]
        S.update_states(spark, X.read_export(spark, root), states, there, removed=gone)
        each(states, there)
        book.done()
    return states


def q_model_from_states(spark, sf_dir, model: int = 1):
    """Sessions of the whole window from the stored states, after late, repeated and out-of-order shards."""
    sessions = S.sessions_from_states(spark, _states(spark, sf_dir), *FULL)[model - 1]
    return comparable(sessions.drop("export_timestamp", "last_update_timestamp"))


def q_sessions_replaced_from_states(spark, sf_dir):
    """After each delivery the touched sessions are replaced as a whole: the table equals one batch over all."""
    path = new_work_path(spark, "sessions-from-states")

    def replace(states, shards):
        U.replace_sessions(spark, path, S.touched_sessions(spark, states, shards)[0], U.MODEL1_SPEC, O.RUN_TS_2)

    _states(spark, sf_dir, replace)
    return comparable(spark.read.parquet(path).select(*U.MODEL1_SPEC.columns)
                      .drop("export_timestamp", "last_update_timestamp"))


def q_shard_ledger_changes(spark, sf_dir):
    """What the ledger tells of a new export, of a changed one, and of one that is as it was."""
    ev = lens_events(spark, sf_dir)
    root, at = new_work_path(spark, "ledger-export"), new_work_path(spark, "ledger")
    book, out = Ledger(spark, root, at), []
    shard = F.when(F.col("suffix") == O.LEDGER_DAILY, F.concat(F.lit("intraday_"), "suffix")).otherwise(F.col("suffix"))
    X.write_export(ev.where(F.col("suffix") != O.LEDGER_NEW).withColumn("suffix", shard), root)
    for reading in (1, 2, 3):
        if reading == 2:
            again = ev.where(F.col("suffix").isin(O.LEDGER_AGAIN, O.LEDGER_NEW, O.LEDGER_DAILY))
            X.write_export(again, root, mode="append")
            remove_path(spark, f"{root}/suffix={O.LEDGER_GONE}")
        out += [(reading, s, c) for s, c in book.pending().items()]
        book.done()
    return spark.createDataFrame(out, "reading int, shard string, change string")


def q_stream_stateful(spark, sf_dir, model: str = "model1"):
    """The stream keeps the states itself; the export arrives in two parts."""
    from hitsessions.streaming import start_stateful
    ev = lens_events(spark, sf_dir)
    root, table, states, ckpt = (new_work_path(spark, n) for n in (
        "stateful-export", "stateful-sessions", "stateful-states", "stateful-checkpoint"))
    for part, mode in ((F.col("suffix") <= O.STREAM_SPLIT, "overwrite"), (F.col("suffix") > O.STREAM_SPLIT, "append")):
        if ev.where(part).isEmpty():
            continue
        X.write_export(ev.where(part), root, mode=mode)
        start_stateful(spark, root, table, states, model, checkpoint=ckpt, run_ts=O.RUN_TS_2).awaitTermination()
    spec = U.MODEL1_SPEC if model == "model1" else U.model2_spec()
    return comparable(spark.read.parquet(table).select(*spec.columns).drop("export_timestamp", "last_update_timestamp"))


def _from_sql(spark, sf_dir, statement: str):
    """A query in SQL alone, over the table functions of the jobs; ``{days}`` stands for the whole range."""
    _events(spark, sf_dir).createOrReplaceTempView("export_events")
    T_.register_table_functions(spark, "export_events")
    days = f"DATE'{FULL[0]}', DATE'{FULL[1]}'"
    return spark.sql(" UNION ALL ".join(statement.format(days=days, mode=m) for m in (INTENDED, AS_WRITTEN)))


def q_sql_model1_sessions(spark, sf_dir):
    return comparable(_from_sql(spark, sf_dir, "SELECT '{mode}' AS mode, * FROM model1_sessions({days}, '{mode}')"))


def q_sql_model2_sessions(spark, sf_dir):
    return comparable(_from_sql(spark, sf_dir, "SELECT '{mode}' AS mode, * FROM model2_sessions({days}, '{mode}')"))


def q_sql_model_comparison(spark, sf_dir):
    return _from_sql(spark, sf_dir, "SELECT '{mode}' AS mode, * FROM model_comparison({days}, '{mode}')")


def q_compare_models_rollup(spark, sf_dir):
    """The report of three windows from stored partials, which came in two deliveries; the second repeats a shard."""
    ev, o = _events(spark, sf_dir), _opts(INTENDED)
    book = R.Rollup(spark, new_work_path(spark, "rollup"), o, buckets=8)
    sessions = first_touch_sessions(ev, *FULL, o)
    shards = sorted(r.suffix for r in ev.select("suffix").distinct().collect())  # one per calendar day
    half = len(shards) // 2
    for part in (shards[half:], shards[:half + 1]):
        book.add_model2(ev, part)
    for days in ((O.MERGE_START, O.FULL_END), (O.FULL_START, O.LOAD_END)):
        book.add_model1(sessions, *days)
    out = None
    for window in O.ROLLUP_WINDOWS:
        one = book.report(*window).select(F.lit(window[0]).alias("first_day"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def q_stream_odd_shards(spark, sf_dir):
    """Hourly, prefixed, short and intraday shard names: the stream rebuilds every day that a batch run would read."""
    from hitsessions.streaming import start_incremental
    day = F.col("suffix").substr(7, 2).cast("int")
    named = (F.when(day == 5, F.concat("suffix", F.lit("07"))).when(day == 6, F.concat(F.lit("fresh_"), "suffix"))
             .when(day == 7, F.concat(F.lit("intraday_"), "suffix")).when(day == 1, F.col("suffix").substr(1, 6))
             .otherwise(F.col("suffix")))
    root, table = new_work_path(spark, "odd-export"), new_work_path(spark, "odd-sessions")
    X.write_export(lens_events(spark, sf_dir).withColumn("suffix", named), root)
    start_incremental(spark, root, table, "model1", _opts(INTENDED),
                      checkpoint=new_work_path(spark, "stream-checkpoint"), run_ts=O.RUN_TS_2).awaitTermination()
    return comparable(spark.read.parquet(table).select(*U.MODEL1_SPEC.columns))


def q_merge_model2_extra_urls(spark, sf_dir):
    return _merge(spark, sf_dir, 2, INTENDED, extra_click_ids=True)


def q_stream_late_dates(spark, sf_dir):
    """Shards whose events carry a date three days earlier: the days to rebuild are the shards'."""
    from hitsessions.streaming import start_incremental
    late = F.date_format(F.date_sub(F.to_date("event_date", "yyyyMMdd"), 3), "yyyyMMdd")
    ev = lens_events(spark, sf_dir).withColumn("event_date", late)
    root, table = new_work_path(spark, "stream-export"), new_work_path(spark, "stream-late")
    X.write_export(ev, root)
    start_incremental(spark, root, table, "model1", _opts(INTENDED),
                      checkpoint=new_work_path(spark, "stream-checkpoint"), run_ts=O.RUN_TS_2).awaitTermination()
    return comparable(spark.read.parquet(table).select(*U.MODEL1_SPEC.columns))


def q_stream_incremental_model1(spark, sf_dir, model: str = "model1"):
    """The export arrives in two parts; the stream trigger (availableNow)
    runs after each and upserts the days that arrived."""
    from hitsessions.streaming import start_incremental
    ev = lens_events(spark, sf_dir)
    root = new_work_path(spark, "stream-export")
    table = new_work_path(spark, f"stream-sessions-{model}")
    ckpt = new_work_path(spark, "stream-checkpoint")
    X.write_export(ev.where(F.col("suffix") <= O.STREAM_SPLIT), root)
    for part in ("first", "second"):
        if part == "second":
            X.write_export(ev.where(F.col("suffix") > O.STREAM_SPLIT), root, mode="append")
        q = start_incremental(spark, root, table, model, _opts(INTENDED), checkpoint=ckpt, run_ts=O.RUN_TS_2)
        q.awaitTermination()
    spec = U.MODEL1_SPEC if model == "model1" else U.model2_spec(_opts(INTENDED))
    return comparable(spark.read.parquet(table).select(*spec.columns))


def q_model1_channel_counts(spark, sf_dir):
    path = new_work_path(spark, "sessions-m1")
    U.create_sessions(first_touch_sessions(_events(spark, sf_dir), *FULL, _opts(INTENDED)), path)
    fe = X.read_sessions(spark, path, *FULL)
    return comparable(CMP.model1_channel_counts(fe, *FULL))


def q_model2_channel_counts(spark, sf_dir):
    return comparable(CMP.model2_channel_counts(_events(spark, sf_dir), *FULL, _opts(INTENDED)))


def _compare(spark, sf_dir, mode):
    o = _opts(mode)
    ev = _events(spark, sf_dir)
    fe = first_touch_sessions(ev, *FULL, o)
    return CMP.compare_models(fe, ev, *FULL, o)


def q_compare_models_by_channel(spark, sf_dir):
    ev, o = _events(spark, sf_dir), _opts(INTENDED)
    return CMP.compare_models(first_touch_sessions(ev, *FULL, o), ev, *FULL, o, by_channel=True)


def q_compare_models_both_sides(spark, sf_dir):
    """The report with the days that only Model 1 has (here every fourth day has no session_start)."""
    ev, o = _events(spark, sf_dir), _opts(INTENDED)
    some = ev.where((F.col("event_name") != "session_start") | (F.col("suffix").substr(7, 2).cast("int") % 4 != 0))
    return CMP.compare_models(first_touch_sessions(some, *FULL, o), some, *FULL, o, both_sides=True)


def q_session_duplicates_report(spark, sf_dir):
    return CMP.session_duplicates(_events(spark, sf_dir), *FULL, _opts(INTENDED))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "unique_session_id": q_unique_session_id,
    "events_in_window": q_events_in_window,
    "event_params_extract": q_event_params_extract,
    "safe_actual_ts": q_safe_actual_ts,
    "safe_actual_ts_sql_function": q_safe_actual_ts_sql_function,
    "prague_timestamps": q_prague_timestamps,
    "attribution_concat_split": q_attribution_concat_split,
    "model1_sessions": lambda s, d: _m1(s, d, INTENDED),
    "model1_sessions_as_written": lambda s, d: _m1(s, d, AS_WRITTEN),
    "model1_sessions_window_form": lambda s, d: _m1(s, d, INTENDED, form="window"),
    "model1_first_value_window": q_model1_first_value_window,
    "model1_sessions_one_pass": lambda s, d: _one_pass(s, d, 1),
    "model2_sessions_one_pass": lambda s, d: _one_pass(s, d, 2),
    "model2_session_start_dedup": q_model2_session_start_dedup,
    "model2_click_id_rules": q_model2_click_id_rules,
    "model2_url_params": q_model2_url_params,
    "model2_sessions": lambda s, d: _m2(s, d, INTENDED),
    "model2_sessions_as_written": lambda s, d: _m2(s, d, AS_WRITTEN),
    "model2_sessions_window_form": lambda s, d: _m2(s, d, INTENDED, form="window"),
    "create_partitioned_sessions": q_create_partitioned_sessions,
    "merge_model1": lambda s, d: _merge(s, d, 1, INTENDED),
    "merge_model1_as_written": lambda s, d: _merge(s, d, 1, AS_WRITTEN),
    "merge_model2": lambda s, d: _merge(s, d, 2, INTENDED),
    "merge_model2_as_written": lambda s, d: _merge(s, d, 2, AS_WRITTEN),
    "merge_idempotent": lambda s, d: _merge(s, d, 1, INTENDED, times=2),
    "stream_incremental_model1": q_stream_incremental_model1,
    "stream_incremental_model2": lambda s, d: q_stream_incremental_model1(s, d, "model2"),
    "model1_channel_counts": q_model1_channel_counts,
    "model2_channel_counts": q_model2_channel_counts,
    "compare_models": lambda s, d: _compare(s, d, INTENDED),
    "compare_models_as_written": lambda s, d: _compare(s, d, AS_WRITTEN),
    "session_duplicates_report": q_session_duplicates_report,
    "events_in_window_folders": q_events_in_window_folders,
    "single_shard": q_single_shard,
    "default_window_sessions": q_default_window_sessions,
    "model1_first_value_window_intended": q_model1_first_value_window_intended,
    "model2_custom_rules": q_model2_custom_rules,
    "merge_keeps_unknown_columns": q_merge_keeps_unknown_columns,
    "merge_other_id_column": q_merge_other_id_column,
    "merge_null_dates": q_merge_null_dates,
    "merge_lookback": q_merge_lookback,
    "merge_model2_extra_urls": q_merge_model2_extra_urls,
    "stream_late_dates": q_stream_late_dates,
    "compare_models_by_channel": q_compare_models_by_channel,
    "event_params_hard_cases": q_event_params_hard_cases,
    "model2_ties_as_written": q_model2_ties_as_written,
    "merge_late_crossing": q_merge_late_crossing,
    "merge_id_index": q_merge_id_index,
    "merge_after_interrupted_commit": q_merge_after_interrupted_commit,
    "strict_duplicate_keys": q_strict_duplicate_keys,
    "model1_from_states": q_model_from_states,
    "model2_from_states": lambda s, d: q_model_from_states(s, d, 2),
    "sessions_replaced_from_states": q_sessions_replaced_from_states,
    "shard_ledger_changes": q_shard_ledger_changes,
    "stream_stateful_model1": q_stream_stateful,
    "stream_stateful_model2": lambda s, d: q_stream_stateful(s, d, "model2"),
    "stream_odd_shards": q_stream_odd_shards,
    "intraday_unless_daily": q_intraday_unless_daily,
    "compare_models_both_sides": q_compare_models_both_sides,
    "compare_models_rollup": q_compare_models_rollup,
    "merge_bucketed": lambda s, d: _merge(s, d, 1, INTENDED, table_buckets=16),
    "sql_model1_sessions": q_sql_model1_sessions,
    "sql_model2_sessions": q_sql_model2_sessions,
    "sql_model_comparison": q_sql_model_comparison,
}

ORACLES: dict[str, str] = {
    "unique_session_id": O.unique_session_id(),
    "events_in_window": O.events_in_window(),
    "event_params_extract": O.event_params_extract(),
    "safe_actual_ts": O.safe_actual_ts(),
    "safe_actual_ts_sql_function": O.safe_actual_ts(),
    "prague_timestamps": O.prague_timestamps(),
    "attribution_concat_split": O.attribution_concat_split(),
    "model1_sessions": O.model1_sessions(False),
    "model1_sessions_as_written": O.model1_sessions(True),
    "model1_sessions_window_form": O.model1_sessions(False),
    "model1_first_value_window": O.model1_first_value_window(),
    "model1_sessions_one_pass": O.model1_sessions(False),
    "model2_sessions_one_pass": O.model2_sessions(False),
    "model2_session_start_dedup": O.model2_session_start_dedup(),
    "model2_click_id_rules": O.model2_click_id_rules(),
    "model2_url_params": O.model2_url_params(),
    "model2_sessions": O.model2_sessions(False),
    "model2_sessions_as_written": O.model2_sessions(True),
    "model2_sessions_window_form": O.model2_sessions(False),
    "create_partitioned_sessions": O.model1_sessions(False),
    "merge_model1": O.merge(1, False),
    "merge_model1_as_written": O.merge(1, True),
    "merge_model2": O.merge(2, False),
    "merge_model2_as_written": O.merge(2, True),
    "merge_idempotent": O.merge_idempotent(),
    "stream_incremental_model1": O.stream_incremental_model1(),
    "stream_incremental_model2": O.stream_incremental_model2(),
    "model1_channel_counts": O.model1_channel_counts(),
    "model2_channel_counts": O.model2_channel_counts(),
    "compare_models": O.compare_models(False),
    "compare_models_as_written": O.compare_models(True),
    "session_duplicates_report": O.session_duplicates_report(),
    "events_in_window_folders": O.events_in_window_folders(),
    "single_shard": O.single_shard(),
    "default_window_sessions": O.default_window_sessions(),
    "model1_first_value_window_intended": O.model1_first_value_window_intended(),
    "model2_custom_rules": O.model2_custom_rules(),
    "merge_keeps_unknown_columns": O.merge_keeps_unknown_columns(),
    "merge_other_id_column": O.merge_other_id_column(),
    "merge_null_dates": O.merge_null_dates(),
    "merge_lookback": O.merge_lookback(),
    "merge_model2_extra_urls": O.merge_model2_extra_urls(),
    "stream_late_dates": O.stream_late_dates(),
    "compare_models_by_channel": O.compare_models_by_channel(),
    "event_params_hard_cases": O.event_params_hard_cases(),
    "model2_ties_as_written": O.model2_ties_as_written(),
    "merge_late_crossing": O.merge_late_crossing(),
    "merge_id_index": O.merge_id_index(),
    "merge_after_interrupted_commit": O.merge(1, False),
    "strict_duplicate_keys": O.strict_duplicate_keys(),
    "model1_from_states": O.sessions_without_run_times(1),
    "model2_from_states": O.sessions_without_run_times(2),
    "sessions_replaced_from_states": O.sessions_without_run_times(1),
    "shard_ledger_changes": O.shard_ledger_changes(),
    "stream_stateful_model1": O.sessions_without_run_times(1),
    "stream_stateful_model2": O.sessions_without_run_times(2),
    "stream_odd_shards": O.stream_odd_shards(),
    "intraday_unless_daily": O.intraday_unless_daily(),
    "compare_models_both_sides": O.compare_models_both_sides(),
    "compare_models_rollup": O.compare_models_rollup(),
    "merge_bucketed": O.merge(1, False),
    "sql_model1_sessions": O.in_both_modes(O.model1_sessions),
    "sql_model2_sessions": O.in_both_modes(O.model2_sessions),
    "sql_model_comparison": O.in_both_modes(O.compare_models),
}
