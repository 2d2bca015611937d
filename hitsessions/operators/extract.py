"""Per-event extraction shared by the session models.

Every parameter is looked up once, right after the scan; the models use
the extracted columns from there on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitsessions.functions.clock import parse_yyyymmdd, safe_actual_ts_ms
from hitsessions.functions.params import int_param, string_param, unique_session_id
from hitsessions.options import SessionOptions
from hitsessions.sources.export import events_in_window

SESSION_START = "session_start"


def base_columns(opts: SessionOptions) -> list[Column]:
    """Columns of the extraction step; ``event_params`` is read here only."""
    strict = opts.strict_params
    return [
        parse_yyyymmdd("event_date").alias("session_date"),
        F.col("event_timestamp").alias("event_timestamp_micros"),
        # Any one match for the client clock (the script reads it with LIMIT 1).
        safe_actual_ts_ms(int_param("actual_timestamp"), F.col("event_timestamp"),
                          opts.tolerance_days).alias("actual_timestamp_ms"),
        F.col("event_bundle_sequence_id"),
        F.col("user_pseudo_id"),
        unique_session_id("user_pseudo_id", int_param("ga_session_id", strict=strict)
                          ).alias("unique_session_id"),
        F.col("event_name"),
    ]


def order_fields(opts: SessionOptions, clock: str = "safe", hash_col: str = "row_hash") -> list[Column]:
    """Chronological order of the events of a session, as struct fields.

    ``clock='safe'`` orders by the corrected client clock, falling back to
    the server time; ``clock='server'`` by the raw server time. Bundle id
    breaks ties; server time and event name follow so the order is total,
    and in intended mode a hash of the row settles complete ties.
    """
    if clock == "safe":
        first = F.coalesce(F.col("actual_timestamp_ms"), F.col("event_timestamp_micros"))
    else:
        first = F.col("event_timestamp_micros")
    fields = [first.alias("o_ts"), F.col("event_bundle_sequence_id").alias("o_bundle"),
              F.col("event_timestamp_micros").alias("o_event_us"), F.col("event_name").alias("o_name")]
    if opts.hash_tie_breaker:
        fields.append(F.col(hash_col).alias("o_hash"))
    return fields


def with_row_hash(df: DataFrame, cols: list[str], opts: SessionOptions) -> DataFrame:
    if not opts.hash_tie_breaker:
        return df
    return df.withColumn("row_hash", F.xxhash64(*[F.col(c) for c in cols]))


def drop_null_ids(df: DataFrame, opts: SessionOptions) -> DataFrame:
    """Intended mode leaves out events without a session id (Q14): they
    belong to no session. As written they form one NULL-keyed
    pseudo-session that never matches on upsert and is inserted again on
    every run; that mode keeps them, and the partial aggregation combines
    the NULL key map-side like any other heavy key."""
    if opts.keep_null_session_ids:
        return df
    return df.where(F.col("unique_session_id").isNotNull())


def seen_in_window(sessions: DataFrame, events: DataFrame, start, end, opts: SessionOptions,
                   only_starts: bool = False) -> DataFrame:
    """Sessions with an event in the shards of [start, end].

    A run with a lookback builds sessions from more days than its window;
    those that only the days before it hold are an earlier run's matter.
    ``only_starts`` counts ``session_start`` events alone (Model 2).
    """
    ev = events_in_window(events, start, end, opts)
    if only_starts:
        ev = ev.where(F.col("event_name") == F.lit(SESSION_START))
    # Any one match would do for the id; a strict run has raised on repeated keys already.
    ids = ev.select(unique_session_id("user_pseudo_id", int_param("ga_session_id")).alias("_seen")).distinct()
    same = F.col("unique_session_id").eqNullSafe(F.col("_seen")) if opts.keep_null_session_ids \
        else F.col("unique_session_id") == F.col("_seen")
    return sessions.join(ids, same, "left_semi")


def attribution_params(keys, default: str | None = None, strict: bool = False) -> list[Column]:
    """String parameters as ``p_<key>``; ``strict`` raises on a duplicated
    key, as a scalar sub-select without LIMIT would."""
    out = []
    for k in keys:
        v = string_param(k, strict=strict)
        out.append((F.coalesce(v, F.lit(default)) if default is not None else v).alias(f"p_{k}"))
    return out
