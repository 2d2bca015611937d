"""Model 1 sessions: attribution from the first event that carries any.

All five attribution values come from the *same* event: the first one,
in session order, with at least one non-empty value. Date and both
timestamps of the session come from its first event. Empty values get
their own defaults: ``(direct)``, ``(none)``, ``N/A``.

Two physical forms give the same rows:

* ``aggregate`` (default): ``min`` / ``min_by`` over structs whose leading
  fields are the order key. Partial aggregation runs before the shuffle,
  so each map task sends at most one row per session; a hot key (the
  NULL id of as-written mode) is combined map-side instead of being
  buffered in one task.
* ``window``: the script's two windows. ``first_value(attr IGNORE NULLS)``
  over the whole session equals the first row of the attributed events,
  so both are ``row_number() = 1`` windows, each of which Spark limits
  per map task before the shuffle (``WindowGroupLimit``); the two
  one-row-per-session results are joined on the id. A literal unbounded
  ``first_value`` frame would buffer a whole session in one task, which
  a hot key (a third of all rows) turns into one straggler.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitsessions.functions.clock import format_micros
from hitsessions.operators import attribution as A
from hitsessions.operators.extract import (attribution_params, base_columns, drop_null_ids,
                                           order_fields, with_row_hash)
from hitsessions.options import SessionOptions
from hitsessions.sources.export import events_in_window

MODEL1_COLUMNS = ("session_date", "unique_session_id", "event_timestamp", "actual_timestamp",
                  "session_source", "session_medium", "session_campaign", "session_content",
                  "session_term", "export_timestamp", "last_update_timestamp")


# Columns of an event row that the intended-mode tie-breaker hashes.
M1_HASH_COLS = ("event_timestamp_micros", "actual_timestamp_ms", "event_bundle_sequence_id",
                "event_name", "session_date", "attr")


def run_timestamp(run_ts=None) -> Column:
    if run_ts is None:
        return F.current_timestamp()
    if isinstance(run_ts, Column):
        return run_ts
    if isinstance(run_ts, str):
        # Parsed in the session time zone, like any timestamp literal.
        return F.to_timestamp(F.lit(run_ts))
    return F.lit(run_ts).cast("timestamp")


def model1_events(events: DataFrame, start=None, end=None,
                  opts: SessionOptions | None = None) -> DataFrame:
    """Per-event rows: order key parts, first-event payload, attribution."""
    opts = opts or SessionOptions()
    ev = events_in_window(events, start, end, opts)
    x = ev.select(*base_columns(opts), *attribution_params(A.M1_KEYS, strict=opts.strict_params))
    cols = [F.col(f"p_{k}") for k in A.M1_KEYS]
    if opts.concat_transport:
        attr = A.concat_attribution(cols)
    else:
        attr = A.struct_attribution(cols)
    x = x.select("session_date", "event_timestamp_micros", "actual_timestamp_ms",
                 "event_bundle_sequence_id", "unique_session_id", "event_name",
                 attr.alias("attr"))
    x = drop_null_ids(x, opts)
    return with_row_hash(x, list(M1_HASH_COLS), opts)


def _first_rows_aggregate(x: DataFrame, opts: SessionOptions) -> DataFrame:
    order = order_fields(opts)
    # The order key already holds both timestamps: o_event_us is the server
    # time, and o_ts = coalesce(clock, server) equals the corrected clock,
    # which is NULL only when both inputs are. Only the date rides along.
    first = F.min(F.struct(*order, F.col("session_date")))
    # Rows without attribution get a NULL order key, which min_by skips;
    # a session with no attribution at all yields NULL.
    attr = F.min_by(F.col("attr"), F.when(F.col("attr").isNotNull(), F.struct(*order)))
    g = x.groupBy("unique_session_id").agg(first.alias("first"), attr.alias("attr"))
    return g.select("unique_session_id",
                    F.col("first.session_date").alias("session_date"),
                    F.col("first.o_event_us").alias("event_timestamp_micros"),
                    F.col("first.o_ts").alias("actual_timestamp_ms"),
                    "attr")


def _same_id(a: Column, b: Column, opts: SessionOptions) -> Column:
    """Join condition on the session id. The NULL id of as-written mode is
    a session too, so there the equality is null-safe; otherwise a plain
    equality lets the join reuse the hash partitioning on the id that
    both sides already have (no further shuffle)."""
    return a.eqNullSafe(b) if opts.keep_null_session_ids else (a == b)


def _top1(x: DataFrame, opts: SessionOptions, cols) -> DataFrame:
    w = Window.partitionBy("unique_session_id").orderBy(*[c.asc_nulls_first() for c in order_fields(opts)])
    return x.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == 1).select(*cols)


def _first_rows_window(x: DataFrame, opts: SessionOptions) -> DataFrame:
    first = _top1(x, opts, ["unique_session_id", "session_date", "event_timestamp_micros",
                            "actual_timestamp_ms"]).alias("f")
    attr = _top1(x.where(F.col("attr").isNotNull()), opts, ["unique_session_id", "attr"]).alias("a")
    j = first.join(attr, _same_id(F.col("f.unique_session_id"), F.col("a.unique_session_id"), opts), "left")
    return j.select("f.unique_session_id", "f.session_date", "f.event_timestamp_micros",
                    "f.actual_timestamp_ms", "a.attr")


def first_touch_sessions(events: DataFrame, start=None, end=None,
                         opts: SessionOptions | None = None, run_ts=None) -> DataFrame:
    """One row per session id of the window, in the Model 1 table shape."""
    opts = opts or SessionOptions()
    x = model1_events(events, start, end, opts)
    first = _first_rows_window(x, opts) if opts.form == "window" else _first_rows_aggregate(x, opts)
    return finalize_model1(first, opts, run_ts)


def finalize_model1(first: DataFrame, opts: SessionOptions, run_ts=None) -> DataFrame:
    if opts.concat_transport:
        raw = A.split_attribution(F.col("attr"))
    else:
        raw = [F.col("attr")[k] for k in A.M1_KEYS]
    act = F.col("actual_timestamp_ms")
    # Q1: as written, milliseconds are formatted as microseconds.
    act_us = act if opts.actual_ts_in_millis_as_micros else F.try_multiply(act, F.lit(1000))
    ts = run_timestamp(run_ts)
    return first.select(
        F.col("session_date"),
        F.col("unique_session_id"),
        format_micros(F.col("event_timestamp_micros"), opts.zone).alias("event_timestamp"),
        format_micros(act_us, opts.zone).alias("actual_timestamp"),
        *[A.default_if_empty(c, A.M1_DEFAULTS[k]).alias(f"session_{k}") for c, k in zip(raw, A.M1_KEYS)],
        ts.alias("export_timestamp"),
        ts.alias("last_update_timestamp"),
    )


def first_value_window(events: DataFrame, start=None, end=None,
                       opts: SessionOptions | None = None) -> DataFrame:
    """W1 alone: every event with its session's first attribution, and
    whether it is the session's first event.

    The per-session values come from the aggregate form and are joined
    back to the events on the id. A hot session is then a skewed join
    key, which AQE splits across tasks, instead of one window partition
    buffered by one task. For that the join needs exchanges of its own on
    both sides: its key has the id's hash as a second column, so the
    partitioning of the aggregate is not reused. (The null-safe equality
    of as-written mode has such a key anyway.)
    """
    opts = opts or SessionOptions()
    x = model1_events(events, start, end, opts)
    order = order_fields(opts)
    per_session = x.groupBy("unique_session_id").agg(
        F.min(F.struct(*order)).alias("first_key"),
        F.min_by(F.col("attr"), F.when(F.col("attr").isNotNull(), F.struct(*order))).alias("session_attr"))
    e = x.select("unique_session_id", "event_timestamp_micros", "event_bundle_sequence_id",
                 F.struct(*order).alias("key")).alias("e")
    same = (_same_id(F.col("e.unique_session_id"), F.col("s.unique_session_id"), opts)
            & (F.xxhash64("e.unique_session_id") == F.xxhash64("s.unique_session_id")))
    j = e.join(per_session.alias("s"), same)
    return j.select("e.unique_session_id", "e.event_timestamp_micros", "e.event_bundle_sequence_id",
                    "s.session_attr", (F.col("e.key") == F.col("s.first_key")).alias("is_first_event"))
