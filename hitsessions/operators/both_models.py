"""Model 1 and Model 2 from one scan and one shuffle.

A daily run that maintains both session tables would otherwise read the
window's events twice and shuffle twice. Here one aggregation per
session id computes the three top-1 values at once: the first event
(Model 1 date and timestamps), the first attributed event (Model 1
values) and the first ``session_start`` event (Model 2 row; a ``min``
over a struct that is NULL for other events). The per-session result is
staged once in the shared folder and both tables are derived from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitsessions.functions.params import int_param
from hitsessions.operators import attribution as A
from hitsessions.operators.extract import (SESSION_START, attribution_params, base_columns,
                                           order_fields)
from hitsessions.operators.first_touch import M1_HASH_COLS, finalize_model1
from hitsessions.operators.session_start import M2_PARAM_KEYS, _PAYLOAD, apply_rules, finish_model2
from hitsessions.options import SessionOptions
from hitsessions.session import new_work_path
from hitsessions.sources.export import events_in_window

#: Payload columns that the order key carries.
IN_KEY = {"event_timestamp_micros": "o_event_us", "actual_timestamp_ms": "o_ts"}


def model_rows(ev: DataFrame, opts: SessionOptions, *more: str) -> DataFrame:
    """Per-event rows with what both models need, and the columns ``more`` of the event."""
    x = ev.select(*more, *base_columns(opts),
                  F.coalesce(int_param("ga_session_number", strict=opts.strict_params),
                             F.lit(-1).cast("long")).alias("ga_session_number"),
                  *attribution_params(A.M1_KEYS, strict=opts.strict_params),
                  *[c.alias(f"n_{k}") for c, k in zip(
                      attribution_params(M2_PARAM_KEYS, default=A.NA, strict=opts.strict_params), M2_PARAM_KEYS)])
    cols = [F.col(f"p_{k}") for k in A.M1_KEYS]
    attr = A.concat_attribution(cols) if opts.concat_transport else A.struct_attribution(cols)
    x = x.withColumn("attr", attr)
    if not opts.keep_null_session_ids:
        x = x.where(F.col("unique_session_id").isNotNull())
    if opts.hash_tie_breaker:
        # The hashes each model would use on its own rows.
        m1_cols = list(M1_HASH_COLS)
        m2_cols = [c if not c.startswith("p_") else f"n_{c[2:]}" for c in _PAYLOAD]
        x = (x.withColumn("h1", F.xxhash64(*[F.col(c) for c in m1_cols]))
              .withColumn("h2", F.xxhash64(*[F.col(c) for c in m2_cols])))
    return x


def state_structs(opts: SessionOptions) -> tuple[Column, Column, Column]:
    """Of a row of :func:`model_rows`: first event, attributed event (else NULL) and ``session_start`` row (else NULL).

    Each is a struct that begins with the session order, so that the
    smallest one of a session is the one that counts.
    """
    o1 = order_fields(opts, hash_col="h1")
    o2 = order_fields(opts, hash_col="h2")
    # Timestamps travel in the order key (o_event_us, o_ts), not twice.
    m2_payload = [F.col(c if not c.startswith("p_") else f"n_{c[2:]}").alias(c)
                  for c in _PAYLOAD if c not in IN_KEY]
    is_ss = F.col("event_name") == F.lit(SESSION_START)
    return (F.struct(*o1, F.col("session_date")),
            F.when(F.col("attr").isNotNull(), F.struct(*o1, F.col("attr"))),
            F.when(is_ss, F.struct(*o2, *m2_payload)))


def models_of(g: DataFrame, opts: SessionOptions, run_ts=None,
              rules: A.ChannelRules = A.ChannelRules()) -> tuple[DataFrame, DataFrame]:
    """(Model 1 sessions, Model 2 sessions) of per-session ``first``, ``attr`` and ``ss``."""
    m1 = finalize_model1(g.select(
        "unique_session_id", F.col("first.session_date").alias("session_date"),
        F.col("first.o_event_us").alias("event_timestamp_micros"),
        F.col("first.o_ts").alias("actual_timestamp_ms"), "attr"), opts, run_ts)
    first_ss = g.where(F.col("ss").isNotNull()).select(
        "unique_session_id", *[F.col(f"ss.{IN_KEY.get(c, c)}").alias(c) for c in _PAYLOAD])
    m2 = finish_model2(apply_rules(first_ss, opts, rules), opts, run_ts)
    return m1, m2


def both_models(spark: SparkSession, events: DataFrame, start=None, end=None,
                opts: SessionOptions | None = None, run_ts=None, rules: A.ChannelRules = A.ChannelRules(),
                staged: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(Model 1 sessions, Model 2 sessions) of the window, one pass.

    Both results read the table written to ``staged`` (a fresh work path
    by default); remove it when they are no longer needed.
    """
    opts = opts or SessionOptions()
    x = model_rows(events_in_window(events, start, end, opts), opts)
    first, _, ss = state_structs(opts)
    o1 = order_fields(opts, hash_col="h1")
    g = x.groupBy("unique_session_id").agg(
        F.min(first).alias("first"),
        F.min_by(F.col("attr"), F.when(F.col("attr").isNotNull(), F.struct(*o1))).alias("attr"),
        F.min(ss).alias("ss"))
    staged = staged or new_work_path(spark, "both-models")
    g.write.mode("overwrite").parquet(staged)
    return models_of(spark.read.parquet(staged), opts, run_ts, rules)
