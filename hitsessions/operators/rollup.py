"""The comparison report from stored partials.

The report counts distinct sessions per day and channel, and each run of
the original scans the events of its whole window. Here the sessions of a
day (Model 1) and of a shard (Model 2) are reduced once to bitmaps, one
per channel and block of ids, over numbers that a dictionary gives to the
session ids. A report of any window adds bitmaps up: counts stay exact
distinct counts, and neither events nor sessions are read.

Model 1 rows are of one day each, so their bitmaps are counted as they
are. A Model 2 session counts where its first ``session_start`` *of the
window* is: on the first shard of the window that has it. What a shard
adds is its bitmap with those of the earlier shards of the window, less
those alone. That holds where the shards follow one another in time; the
partials keep their time ranges, and :meth:`Rollup.report` takes the
events for the Model 2 side where ranges overlap (late events in a later
shard).

Intended mode only: the fan-out of the as-written report depends on which
channel rows a scan of the window gives.
"""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitsessions.operators import compare as CMP
from hitsessions.operators.commit import commit_staged, new_run, recover, staged_path
from hitsessions.operators.upsert import table_exists
from hitsessions.options import SessionOptions
from hitsessions.session import new_work_path, remove_path
from hitsessions.sources.export import date_range, shard_matches, subfolders, window_bounds

ID = "unique_session_id"
_CHANNEL = "session_source string, session_medium string, session_campaign string, block long, bits binary"
_M1 = f"{_CHANNEL}, session_date date"
_M2 = f"session_date date, {_CHANNEL}, first_us long, last_us long, suffix string"


class Rollup:
    """Partials and the dictionary of ids under ``path``."""

    def __init__(self, spark: SparkSession, path: str, opts: SessionOptions | None = None, buckets: int = 64):
        self.spark, self.path, self.opts, self.buckets = spark, path, opts or SessionOptions(), buckets
        if self.opts.as_written:
            raise ValueError("the rollup is for the intended mode")
        self.ids, self.model1, self.model2 = (f"{path}/{n}" for n in ("ids", "model1", "model2"))

    # ------------------------------------------------------------- storing

    def numbers(self) -> DataFrame:
        """The dictionary: id, n."""
        if not table_exists(self.spark, self.ids):
            return self.spark.createDataFrame([], f"{ID} string, n long")
        recover(self.spark, self.ids)
        return self.spark.read.schema(f"{ID} string, n long").parquet(self.ids)

    def _numbered(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the number of their id; new ids come into the dictionary first.

        New numbers are dense but for the unequal sizes of the buckets that
        are numbered side by side.
        """
        known = self.numbers()
        new = rows.select(ID).where(F.col(ID).isNotNull()).distinct().join(known, ID, "left_anti")
        start = known.agg(F.max("n")).first()[0]
        bucket = F.pmod(F.xxhash64(ID), F.lit(self.buckets))
        place = F.row_number().over(Window.partitionBy("bucket").orderBy(ID)) - 1
        new = (new.withColumn("bucket", bucket).withColumn("place", place)
               .select(ID, (F.lit(0 if start is None else start + 1) + F.col("place") * self.buckets + F.col("bucket"))
                       .cast("long").alias("n")))
        run = new_run()
        new.write.parquet(f"{staged_path(self.ids, run)}/part={run}")
        commit_staged(self.spark, self.ids, run)
        return rows.join(self.numbers(), ID)

    def _store(self, table: str, partials: DataFrame, by: str, values: set[str]) -> None:
        """Replace the folders of ``values``; those without rows go."""
        recover(self.spark, table) if table_exists(self.spark, table) else None
        run = new_run()
        partials.write.mode("overwrite").partitionBy(by).parquet(staged_path(table, run))
        old = {n for n in subfolders(self.spark, table) if unquote(n.partition("=")[2]) in values}
        commit_staged(self.spark, table, run, planned=old)

    def add_model1(self, sessions: DataFrame, start, end) -> None:
        """Partials of the days [start, end] of a session table, replaced as a whole."""
        rows = sessions.where(date_range("session_date", start, end)).select(*CMP.CHANNEL, F.col(self.opts.id_column).alias(ID))
        days = self._days(start, end)
        staged = new_work_path(self.spark, "rollup-rows")
        rows.write.parquet(staged)
        rows = self.spark.read.parquet(staged)
        self._store(self.model1, _bitmaps(self._numbered(rows), *CMP.CHANNEL), "session_date", days)
        remove_path(self.spark, staged)

    def _days(self, start, end) -> set[str]:
        """Values of the folders in the range (and of the range's days, where it is short)."""
        lo, hi = str(start), str(end)
        have = {unquote(n.partition("=")[2]) for n in subfolders(self.spark, self.model1)}
        return {d for d in have if lo <= d <= hi}

    def add_model2(self, events: DataFrame, shards: list[str], rules=CMP.A.ChannelRules()) -> None:
        """Partials of some shards, replaced as a whole; ``events`` holds all their events."""
        some = events.where(F.col("suffix").isin(list(shards)))
        rows = CMP.model2_channel_rows(some, dt.date.min, dt.date.max, self.opts, "server", rules, ("suffix",))
        staged = new_work_path(self.spark, "rollup-rows")
        rows.write.parquet(staged)
        rows = self.spark.read.schema(rows.schema).parquet(staged)
        partials = _bitmaps(self._numbered(rows), "suffix", *CMP.CHANNEL, extra=[
            F.min("event_timestamp_micros").alias("first_us"), F.max("event_timestamp_micros").alias("last_us")])
        self._store(self.model2, partials, "suffix", set(shards))
        remove_path(self.spark, staged)

    # ------------------------------------------------------------- reading

    def model1_counts(self, start, end) -> DataFrame:
        """Distinct Model 1 sessions per day and channel, as ``compare.model1_channel_counts``."""
        if not table_exists(self.spark, self.model1):
            return self.spark.createDataFrame([], _M1).groupBy(*CMP.CHANNEL).agg(F.sum("block").alias("cnt_sessions_fev"))
        recover(self.spark, self.model1)
        rows = self.spark.read.schema(_M1).parquet(self.model1).where(date_range("session_date", start, end))
        return rows.groupBy(*CMP.CHANNEL).agg(F.sum(F.bitmap_count("bits")).alias("cnt_sessions_fev"))

    def _shards(self, start, end) -> DataFrame:
        recover(self.spark, self.model2) if table_exists(self.spark, self.model2) else None
        use = [p for n, p in subfolders(self.spark, self.model2).items()
               if n.startswith("suffix=") and shard_matches(unquote(n[len("suffix="):]), start, end, self.opts.include_intraday)]
        if not use:
            return self.spark.createDataFrame([], _M2)
        return self.spark.read.schema(_M2).option("basePath", self.model2).parquet(*sorted(use))

    def follow_one_another(self, start, end) -> bool:
        """Whether the window's shards follow one another in time (one row per shard is compared)."""
        spans = self._shards(start, end).groupBy("suffix").agg(F.min("first_us").alias("a"), F.max("last_us").alias("b"))
        last = None
        for r in spans.orderBy("a", "b").collect():
            if last is not None and r.a <= last:
                return False
            last = r.b
        return True

    def model2_counts(self, start, end) -> DataFrame:
        """Distinct Model 2 sessions of a window per day and channel, as ``compare.model2_channel_counts``."""
        rows = self._shards(start, end)
        began = rows.groupBy("suffix").agg(F.min("first_us").alias("at"))  # one row per shard
        rows = rows.join(F.broadcast(began), "suffix")
        per_shard = rows.groupBy("at", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
        earlier = Window.partitionBy("block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        # One bitmap per shard and block; a window per block holds one small row per shard.
        seen = (per_shard.withColumn("seen", F.bitmap_or_agg("bits").over(earlier))
                .select("at", "block", F.col("seen").alias("bits")))
        keys = ["at", "block", *CMP.CHANNEL]
        own = rows.select(*keys, "bits", F.lit(0).alias("before"))
        # What was there before the shard, once alone and once with the shard's sessions.
        before = rows.select(*keys).join(seen, ["at", "block"]).where(F.col("bits").isNotNull())
        grown = (own.drop("before").unionByName(before).groupBy(*keys).agg(F.bitmap_or_agg("bits").alias("bits")))
        n = grown.select(*CMP.CHANNEL, F.bitmap_count("bits").alias("n")).unionByName(
            before.select(*CMP.CHANNEL, (-F.bitmap_count("bits")).alias("n")))
        return (n.groupBy(*CMP.CHANNEL).agg(F.sum("n").alias("cnt_sessions_ss")).where(F.col("cnt_sessions_ss") > 0))

    def report(self, start=None, end=None, by_channel: bool = False, events: DataFrame | None = None) -> DataFrame:
        """The comparison report of [start, end], as ``compare.compare_models`` gives it.

        ``events`` is only read where the window's shards overlap in time.
        """
        start, end = window_bounds(start, end, self.opts.today)
        if self.follow_one_another(start, end):
            ss = self.model2_counts(start, end)
        elif events is not None:
            ss = CMP.model2_channel_counts(events, start, end, self.opts)
        else:
            raise ValueError("shards of the window overlap in time: the report needs the events")
        fe = self.model1_counts(start, end)
        return CMP.compare_channels(ss, fe) if by_channel else CMP.compare_counts(ss, fe, self.opts)


def _bitmaps(rows: DataFrame, *keys: str, extra=()) -> DataFrame:
    """Bitmaps of the numbers per ``keys`` and block of numbers, built map-side first."""
    block = F.bitmap_bucket_number("n").alias("block")
    return rows.groupBy(*keys, block).agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits"), *extra)
