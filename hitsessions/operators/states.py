"""Mergeable session states: late data without a rescan of the window (L1, L2).

A scheduled run of the original scans all events of its window again,
since a session needs all of its events. Here every export shard is
reduced once to one small row per session: its first event, its first
attributed event and its first ``session_start`` event, each as a struct
that begins with the session order. The smallest of several such structs
is the session's, so states merge by ``min`` in any order, any number of
times, and a shard that is delivered again replaces its own rows.

The state table is Parquet in one folder per shard (``suffix=...``), replaced
under the journal of ``commit``. A window reads the folders of its shards;
:func:`touched_sessions` merges all states of the sessions that some shards
touch, whatever their dates, which gives a session's true first touch even
where its events are weeks apart.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitsessions.operators import attribution as A
from hitsessions.operators.both_models import model_rows, models_of, state_structs
from hitsessions.operators.commit import commit_staged, new_run, recover, staged_path
from hitsessions.options import SessionOptions
from hitsessions.session import new_work_path
from hitsessions.sources.export import event_schema, shard_matches, subfolders, window_bounds

KEY = "unique_session_id"
_PREFIX = "suffix="


def session_states(events: DataFrame, opts: SessionOptions | None = None, *keys: str) -> DataFrame:
    """States of the sessions of ``events``, per session id and ``keys`` (columns of the events)."""
    opts = opts or SessionOptions()
    x = model_rows(events.where(F.col("user_pseudo_id").isNotNull()), opts, *keys)
    first, touch, ss = state_structs(opts)
    return x.groupBy(*keys, KEY).agg(F.min(first).alias("first"), F.min(touch).alias("touch"), F.min(ss).alias("ss"))


def merged(states: DataFrame, *keys: str) -> DataFrame:
    """States merged per session id (and ``keys``)."""
    return states.groupBy(*keys, KEY).agg(*[F.min(c).alias(c) for c in ("first", "touch", "ss")])


def models(states: DataFrame, opts: SessionOptions | None = None, run_ts=None,
           rules: A.ChannelRules = A.ChannelRules()) -> tuple[DataFrame, DataFrame]:
    """(Model 1, Model 2) sessions of states, merged here."""
    g = merged(states).select(KEY, "first", F.col("touch.attr").alias("attr"), "ss")
    return models_of(g, opts or SessionOptions(), run_ts, rules)


def update_states(spark: SparkSession, events: DataFrame, path: str, shards: list[str],
                  opts: SessionOptions | None = None, removed: tuple | list = ()) -> list[str]:
    """Replace the states of ``shards`` by those of ``events`` (all their events, with ``suffix``); drop ``removed``.

    A shard without sessions has no folder. Returns the shards with states.
    """
    opts = opts or SessionOptions()
    recover(spark, path)
    run = new_run()
    states = session_states(events.where(F.col("suffix").isin(list(shards))), opts, "suffix")
    # A heavy shard is split over several files, small ones are merged.
    (states.hint("rebalance", "suffix")
     .write.mode("overwrite").partitionBy("suffix").parquet(staged_path(path, run)))
    planned = {n for n in subfolders(spark, path) if n.startswith(_PREFIX)
               and unquote(n[len(_PREFIX):]) in {*shards, *removed}}
    done = commit_staged(spark, path, run, planned=planned)
    return [unquote(n[len(_PREFIX):]) for n in done]


def _schema(spark: SparkSession, opts: SessionOptions) -> T.StructType:
    return session_states(spark.createDataFrame([], event_schema(narrow=True)), opts, "suffix").schema


def read_states(spark: SparkSession, path: str, shards=None, opts: SessionOptions | None = None) -> DataFrame:
    """States of some shards (a list, or a test of the name; default all); only their folders are listed.

    The schema is given, so that shard names stay text.
    """
    recover(spark, path)
    schema = _schema(spark, opts or SessionOptions())
    wanted = shards if callable(shards) or shards is None else set(shards).__contains__
    use = sorted(p for n, p in subfolders(spark, path).items() if n.startswith(_PREFIX)
                 and (wanted is None or wanted(unquote(n[len(_PREFIX):]))))
    if not use:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*use)


def sessions_from_states(spark: SparkSession, path: str, start=None, end=None, opts: SessionOptions | None = None,
                         run_ts=None, rules: A.ChannelRules = A.ChannelRules()) -> tuple[DataFrame, DataFrame]:
    """(Model 1, Model 2) sessions of a window, from the states of its shards: what a scan of their events gives."""
    opts = opts or SessionOptions()
    start, end = window_bounds(start, end, opts.today)
    states = read_states(spark, path, lambda s: shard_matches(s, start, end, opts.include_intraday), opts)
    return models(states, opts, run_ts, rules)


def states_of(spark: SparkSession, path: str, ids: DataFrame, opts: SessionOptions | None = None) -> DataFrame:
    """All states of some sessions, whatever shard they are from.

    The ids go first to a table of their own: with as many ids as a day
    has, the join shuffles ids and states once; with few, it broadcasts
    them.
    """
    ids_path = new_work_path(spark, "touched-ids")
    ids.select(KEY).distinct().write.parquet(ids_path)
    return read_states(spark, path, None, opts).join(spark.read.schema(f"{KEY} string").parquet(ids_path), KEY, "left_semi")


def touched_sessions(spark: SparkSession, path: str, shards: list[str], opts: SessionOptions | None = None,
                     run_ts=None, rules: A.ChannelRules = A.ChannelRules()) -> tuple[DataFrame, DataFrame]:
    """(Model 1, Model 2) rows of the sessions that ``shards`` touch, from their whole history."""
    ids = read_states(spark, path, shards, opts).select(KEY)
    return models(states_of(spark, path, ids, opts), opts, run_ts, rules)

