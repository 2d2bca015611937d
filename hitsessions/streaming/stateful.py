"""Session states kept by a stream (L1, L2, section 2.15).

The scheduled stream (``scheduled``) only uses arrivals as a trigger and
scans the export again. Here the stream itself aggregates: per session and
day of the server time it keeps the mergeable state of ``states`` in the
state store, and each micro-batch puts out the states that changed (update
mode). The batch function adds them to the state table, merges all states
of the sessions they belong to and replaces those sessions' rows.

The watermark lets go of a day's states ``late`` after the day has ended,
so the store holds a few days of sessions, not all of them; RocksDB keeps
it on disk. What arrives later still is left to a run over the export's
shards (``states.update_states`` with the ledger), whose states merge with
these: merging takes the smallest, so states that overlap, or that a
repeated batch adds again, change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitsessions.operators import upsert as U
from hitsessions.operators.both_models import model_rows, state_structs
from hitsessions.operators.commit import commit_staged, new_run, recover, staged_path
from hitsessions.operators.extract import drop_null_ids
from hitsessions.operators.states import KEY, merged, read_states, touched_sessions
from hitsessions.options import SessionOptions
from hitsessions.session import new_work_path
from hitsessions.sources.export import event_schema, subfolders

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def daily_states(events: DataFrame, late: str, opts: SessionOptions) -> DataFrame:
    """Streaming states per session and UTC day, let go of ``late`` after the day."""
    time = F.timestamp_micros("event_timestamp")
    ev = events.where(F.col("user_pseudo_id").isNotNull()).withColumn("_time", time).withWatermark("_time", late)
    x = drop_null_ids(model_rows(ev, opts, "_time"), opts)
    first, touch, ss = state_structs(opts)
    return (x.groupBy(F.window("_time", "1 day").alias("day"), KEY)
            .agg(F.min(first).alias("first"), F.min(touch).alias("touch"), F.min(ss).alias("ss"))
            .drop("day"))


def add_states(spark: SparkSession, path: str, states: DataFrame, part: str) -> None:
    """Add states to the state table as the part ``part``; a repeated batch replaces its part."""
    recover(spark, path)
    run = new_run()
    states.write.mode("overwrite").parquet(f"{staged_path(path, run)}/suffix={part}")
    commit_staged(spark, path, run)


def stream_parts(spark: SparkSession, path: str) -> list[str]:
    """Folders of the state table that streams have added."""
    return [n for n in subfolders(spark, path) if n.startswith("suffix=stream-")]


def compact_states(spark: SparkSession, path: str, opts: SessionOptions | None = None, name: str = "stream-0-merged") -> None:
    """Merge the parts that streams have added into one part, a row per session."""
    parts = stream_parts(spark, path)
    if len(parts) < 2:
        return
    run = new_run()
    old = read_states(spark, path, lambda s: s.startswith("stream-"), opts)
    merged(old).write.parquet(f"{staged_path(path, run)}/suffix={name}")
    commit_staged(spark, path, run, planned=set(parts))


def start_stateful(spark: SparkSession, export_root: str, table: str, states: str, model: str = "model1",
                   opts: SessionOptions | None = None, late: str = "3 days", checkpoint: str | None = None,
                   files_per_batch: int | None = None, available_now: bool = True, run_ts=None, compact_every: int = 50):
    """Start the stream over an export tree; returns the StreamingQuery.

    Sessions that a batch touches are replaced as a whole in ``table``.
    ``late`` is the watermark's delay; an event older than that is dropped
    by the stream once its day's state is gone. The parts that batches add
    to the state table are merged when there are more than ``compact_every``.
    """
    opts = opts or SessionOptions()
    checkpoint = checkpoint or new_work_path(spark, "stream-checkpoint")
    reader = spark.readStream.schema(event_schema(narrow=True)).option("basePath", export_root)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    out = daily_states(reader.parquet(export_root), late, opts)
    spec = U.MODEL1_SPEC if model == "model1" else U.model2_spec(opts)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        part = f"stream-{batch_id + 1:09d}"
        add_states(spark, states, batch, part)
        if not read_states(spark, states, [part], opts).isEmpty():
            sessions = touched_sessions(spark, states, [part], opts, run_ts)[0 if model == "model1" else 1]
            U.replace_sessions(spark, table, sessions, spec, run_ts, opts)
        if len(stream_parts(spark, states)) > compact_every:
            compact_states(spark, states, opts)

    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)  # a query takes its settings when it starts
    try:
        w = out.writeStream.outputMode("update").foreachBatch(each_batch).option("checkpointLocation", checkpoint)
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
        return w.start()
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)
