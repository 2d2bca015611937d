"""Model comparison report (J7) and per-channel session counts (A1-A4).

Model 1 counts come from an existing session table (or any DataFrame of
Model 1 sessions); Model 2 counts are computed from session_start events,
ordered by the raw server time as the original report does (Q6).

The original joins per-channel rows of both sides on the date alone,
which multiplies every row (Q4). The as-written mode keeps that result
without building the product: per date, the summed Model 2 counts equal
``sum_ss * rows_fe`` and the summed Model 1 counts ``sum_fe * rows_ss``,
so both sides are reduced to one row per date before a 1:1 join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitsessions.functions.clock import iso_date
from hitsessions.operators import attribution as A
from hitsessions.operators.extract import drop_null_ids
from hitsessions.operators.session_start import first_session_start, session_start_events
from hitsessions.options import SessionOptions
from hitsessions.sources.export import date_range, window_bounds

CHANNEL = ("session_date", "session_source", "session_medium", "session_campaign")


def model1_channel_counts(fe_sessions: DataFrame, start=None, end=None,
                          id_column: str = "unique_session_id") -> DataFrame:
    """Distinct Model 1 sessions per date and channel."""
    cond = date_range("session_date", start, end)
    df = fe_sessions if cond is None else fe_sessions.where(cond)
    return df.groupBy(*CHANNEL).agg(F.countDistinct(id_column).alias("cnt_sessions_fev"))


def model2_channel_rows(events: DataFrame, start=None, end=None,
                        opts: SessionOptions | None = None, clock: str = "server",
                        rules: A.ChannelRules = A.ChannelRules(), keys: tuple = ()) -> DataFrame:
    """First session_start per id (and ``keys``, columns of the events) with its channel.

    ``clock='server'`` orders by the raw server time, as the report does
    (Q6); ``clock='safe'`` uses Model 2's own order (corrected client
    clock), so the report counts exactly Model 2's sessions.
    """
    opts = opts or SessionOptions()
    x = session_start_events(events, start, end, opts, keys)
    payload = ("session_date", "event_timestamp_micros", "p_page_location", "p_source", "p_medium", "p_campaign")
    first = first_session_start(x, opts, clock=clock, payload=payload, keys=keys)
    ch = A.model2_channel({"page_location": F.col("p_page_location"), "source": F.col("p_source"),
                           "medium": F.col("p_medium"), "campaign": F.col("p_campaign")},
                          rules.source, rules.medium, rules.campaign)
    more = (*keys, "event_timestamp_micros") if keys else ()
    return first.select(*more, "session_date", "unique_session_id",
                        ch["session_source"].alias("session_source"),
                        ch["session_medium"].alias("session_medium"),
                        ch["session_campaign"].alias("session_campaign"))


def model2_channel_counts(events: DataFrame, start=None, end=None,
                          opts: SessionOptions | None = None, clock: str = "server",
                          rules: A.ChannelRules = A.ChannelRules()) -> DataFrame:
    """Distinct Model 2 sessions per date and channel (A2, A4)."""
    rows = model2_channel_rows(events, start, end, opts, clock, rules)
    return rows.groupBy(*CHANNEL).agg(F.countDistinct("unique_session_id").alias("cnt_sessions_ss"))


def _per_date(counts: DataFrame, cnt: str, prefix: str) -> DataFrame:
    return counts.groupBy("session_date").agg(
        F.sum(cnt).alias(f"{prefix}_sum"), F.count(F.lit(1)).alias(f"{prefix}_rows"))


def compare_counts(ss_counts: DataFrame, fe_counts: DataFrame,
                   opts: SessionOptions | None = None, both_sides: bool = False) -> DataFrame:
    """Daily totals of both models and their relative difference in %.

    Days only in Model 1 drop out, as in the original report (a left join
    from Model 2), unless ``both_sides`` asks for them: their Model 2 count
    is 0 then, and the difference -100 %.
    """
    opts = opts or SessionOptions()
    if both_sides and opts.comparison_fan_out:
        raise ValueError("days of both sides are for the intended mode")
    ss = _per_date(ss_counts, "cnt_sessions_ss", "ss")
    fe = _per_date(fe_counts, "cnt_sessions_fev", "fe")
    j = ss.join(fe, on="session_date", how="full" if both_sides else "left")
    if opts.comparison_fan_out:
        m2 = F.when(F.col("fe_rows").isNull(), F.col("ss_sum")).otherwise(F.col("ss_sum") * F.col("fe_rows"))
        m1 = F.col("fe_sum") * F.col("ss_rows")
        ratio = m2 / m1
    else:
        m2, m1 = F.col("ss_sum"), F.col("fe_sum")
        m2 = F.coalesce(m2, F.lit(0)) if both_sides else m2
        ratio = F.try_divide(m2, m1)
    return (j.select(iso_date("session_date").alias("date"),
                     m2.cast("long").alias("cnt_sessions_model2_session_start"),
                     m1.cast("long").alias("cnt_sessions_model1_first_event"),
                     F.round((ratio - F.lit(1)) * F.lit(100), 2).alias("diff_pct"))
            .orderBy("date"))


def compare_channels(ss_counts: DataFrame, fe_counts: DataFrame) -> DataFrame:
    """Totals of both models per date and channel, and their relative difference in %.

    Channels only in Model 1 drop out, like days in the daily report; a
    channel only in Model 2 has no Model 1 count.
    """
    ss, fe = ss_counts.alias("ss"), fe_counts.alias("fe")
    same = reduce(lambda a, b: a & b, [F.col(f"ss.{c}").eqNullSafe(F.col(f"fe.{c}")) for c in CHANNEL])
    j = ss.join(fe, same, "left")
    m2, m1 = F.col("cnt_sessions_ss"), F.col("cnt_sessions_fev")
    return (j.select(iso_date("ss.session_date").alias("date"), *[F.col(f"ss.{c}") for c in CHANNEL[1:]],
                     m2.alias("cnt_sessions_model2_session_start"), m1.alias("cnt_sessions_model1_first_event"),
                     F.round((F.try_divide(m2, m1) - F.lit(1)) * F.lit(100), 2).alias("diff_pct"))
            .orderBy("date", *CHANNEL[1:]))


def compare_models(fe_sessions: DataFrame, events: DataFrame, start=None, end=None,
                   opts: SessionOptions | None = None, clock: str = "server", by_channel: bool = False,
                   rules: A.ChannelRules = A.ChannelRules(), both_sides: bool = False) -> DataFrame:
    """The comparison report for [start, end] (J7), daily or per channel.

    A date that isn't given takes the default of the scheduled runs.
    ``both_sides`` keeps days that only Model 1 has in the daily report.
    """
    opts = opts or SessionOptions()
    start, end = window_bounds(start, end, opts.today)
    fe = model1_channel_counts(fe_sessions, start, end, opts.id_column)
    ss = model2_channel_counts(events, start, end, opts, clock, rules)
    return compare_channels(ss, fe) if by_channel else compare_counts(ss, fe, opts, both_sides)


def session_duplicates(events: DataFrame, start=None, end=None,
                       opts: SessionOptions | None = None) -> DataFrame:
    """Session ids with more than one session_start event in the window."""
    opts = opts or SessionOptions()
    x = drop_null_ids(session_start_events(events, start, end, opts.with_(mode="intended")), opts.with_(mode="intended"))
    return (x.groupBy("unique_session_id")
            .agg(F.count(F.lit(1)).alias("n_session_start"),
                 F.countDistinct("session_date").alias("n_dates"))
            .where(F.col("n_session_start") > 1))
