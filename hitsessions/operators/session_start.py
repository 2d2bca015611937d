"""Model 2 sessions: the first ``session_start`` event plus click-id and
URL rules (J4).

Only ``session_start`` events are read; the equality is pushed into the
Parquet scan. Duplicated session_start events of one id are reduced to
the first one by a top-1 aggregate (partial per map task, then final),
which Spark can combine before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitsessions.functions.clock import format_micros
from hitsessions.functions.params import int_param
from hitsessions.operators import attribution as A
from hitsessions.operators.extract import (SESSION_START, attribution_params, base_columns,
                                           drop_null_ids, order_fields, with_row_hash)
from hitsessions.operators.first_touch import run_timestamp
from hitsessions.options import SessionOptions
from hitsessions.sources.export import events_in_window

M2_PARAM_KEYS = ("page_location", "source", "medium", "campaign", "term", "content")
MODEL2_COLUMNS = ("session_date", "unique_session_id", "event_timestamp", "actual_timestamp",
                  "ga_session_number", "page_location", "session_source_orig", "session_source",
                  "session_medium_orig", "session_medium", "session_campaign_orig", "session_campaign",
                  "session_term", "session_content", "utm_campaign_url", "gclid_url",
                  "export_timestamp", "last_update_timestamp")
EXTRA_CLICK_COLUMNS = ("fbclid_url", "msclid_url")
_PAYLOAD = ("session_date", "event_timestamp_micros", "actual_timestamp_ms", "ga_session_number",
            "p_page_location", "p_source", "p_medium", "p_campaign", "p_term", "p_content")


def session_start_events(events: DataFrame, start=None, end=None,
                         opts: SessionOptions | None = None, keys: tuple = ()) -> DataFrame:
    """session_start rows of the window with ``N/A`` / ``-1`` sentinels, and the columns ``keys`` of the event."""
    opts = opts or SessionOptions()
    ev = events_in_window(events, start, end, opts).where(F.col("event_name") == F.lit(SESSION_START))
    x = ev.select(*keys, *base_columns(opts),
                  F.coalesce(int_param("ga_session_number", strict=opts.strict_params),
                             F.lit(-1).cast("long")).alias("ga_session_number"),
                  *attribution_params(M2_PARAM_KEYS, default=A.NA, strict=opts.strict_params))
    x = drop_null_ids(x, opts)
    return with_row_hash(x, list(_PAYLOAD), opts)


def first_session_start(x: DataFrame, opts: SessionOptions, clock: str = "safe",
                        payload=_PAYLOAD, keys: tuple = ()) -> DataFrame:
    """Top-1 row per session id (and ``keys``) in session order (W3 + F5 + O3)."""
    order = order_fields(opts, clock)
    if opts.form == "window":
        w = Window.partitionBy(*keys, "unique_session_id").orderBy(*[c.asc_nulls_first() for c in order])
        return (x.withColumn("session_rank", F.row_number().over(w))
                .where(F.col("session_rank") == 1).select(*keys, "unique_session_id", *payload))
    # The payload follows the order key inside the struct, so complete
    # ties are settled by the row content: deterministic in both modes.
    # Columns the order key already carries are not shipped twice.
    in_key = {"event_timestamp_micros": "o_event_us"}
    if clock == "safe":
        in_key["actual_timestamp_ms"] = "o_ts"
    carried = [c for c in payload if c not in in_key]
    first = F.min(F.struct(*order, *[F.col(c) for c in carried])).alias("first")
    g = x.groupBy(*keys, "unique_session_id").agg(first)
    return g.select(*keys, "unique_session_id",
                    *[F.col(f"first.{in_key.get(c, c)}").alias(c) for c in payload])


def apply_rules(first: DataFrame, opts: SessionOptions, rules: A.ChannelRules = A.ChannelRules()) -> DataFrame:
    cols = {"page_location": F.col("p_page_location"), "source": F.col("p_source"),
            "medium": F.col("p_medium"), "campaign": F.col("p_campaign")}
    ch = A.model2_channel(cols, rules.source, rules.medium, rules.campaign)
    extra = []
    if opts.extra_click_ids:
        extra = [A.url_param(F.col("p_page_location"), n).alias(n) for n in EXTRA_CLICK_COLUMNS]
    return first.select(
        "session_date", "unique_session_id", "event_timestamp_micros", "actual_timestamp_ms",
        "ga_session_number", F.col("p_page_location").alias("page_location"),
        F.col("p_source").alias("session_source_orig"), ch["session_source"].alias("session_source"),
        F.col("p_medium").alias("session_medium_orig"), ch["session_medium"].alias("session_medium"),
        F.col("p_campaign").alias("session_campaign_orig"),
        ch["session_campaign_step1"].alias("session_campaign_step1"),
        ch["session_campaign"].alias("session_campaign"),
        F.col("p_term").alias("session_term"), F.col("p_content").alias("session_content"),
        ch["utm_campaign_url"].alias("utm_campaign_url"),
        A.url_param(F.col("p_page_location"), "gclid_url").alias("gclid_url"),
        *extra,
    )


def session_start_sessions(events: DataFrame, start=None, end=None,
                           opts: SessionOptions | None = None, run_ts=None,
                           rules: A.ChannelRules = A.ChannelRules()) -> DataFrame:
    """One row per session id of the window, in the Model 2 table shape.

    ``rules`` replaces or extends the built-in channel rules.
    """
    opts = opts or SessionOptions()
    x = session_start_events(events, start, end, opts)
    return finish_model2(apply_rules(first_session_start(x, opts), opts, rules), opts, run_ts)


def finish_model2(ruled: DataFrame, opts: SessionOptions, run_ts=None) -> DataFrame:
    """Timestamps formatted, columns in the Model 2 table order."""
    act = F.col("actual_timestamp_ms")
    act_us = act if opts.actual_ts_in_millis_as_micros else F.try_multiply(act, F.lit(1000))
    ts = run_timestamp(run_ts)
    extra = list(EXTRA_CLICK_COLUMNS) if opts.extra_click_ids else []
    return ruled.select(
        "session_date", "unique_session_id",
        format_micros(F.col("event_timestamp_micros"), opts.zone).alias("event_timestamp"),
        format_micros(act_us, opts.zone).alias("actual_timestamp"),
        "ga_session_number", "page_location",
        "session_source_orig", "session_source", "session_medium_orig", "session_medium",
        "session_campaign_orig", "session_campaign", "session_term", "session_content",
        "utm_campaign_url", "gclid_url", *extra,
        ts.alias("export_timestamp"), ts.alias("last_update_timestamp"),
    )
