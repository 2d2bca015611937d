"""Session table creation (J6) and incremental upsert.

The table is Parquet partitioned by ``session_date``. An upsert is the
set algebra of the original ``MERGE``:

* match: same session id and the *target* row's date inside the window
  (widened by ``target_lookback_days``);
* matched and changed (``IS DISTINCT FROM`` on the compare columns):
  set the update columns and ``last_update_timestamp``;
* not matched: insert the insert columns, the others are NULL;
* no delete: rows never leave the table, those without a date included.

With ``SessionOptions.one_row_per_id`` (always with a lookback) a session
is inserted only if the table has no row of it under any date. An index of
the ids beside the partitions tells that (``id_index``); a row outside the
window stays as it is, since the run has seen its session only in part.

The target keeps its own schema: columns that the model doesn't know are
carried along (NULL in inserted rows), and the id column may have another
name (``SessionOptions.id_column``).

Only the partitions of the window and of the inserted dates are listed,
read and rewritten. They are staged inside the table first and then moved
into place under a journal (``commit``), so the next run finishes a commit
that was interrupted, and a run that fails earlier leaves the table as it
was.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitsessions.operators import bucketed, id_index
from hitsessions.operators.commit import commit_staged, new_run, recover, staged_path
from hitsessions.operators.first_touch import MODEL1_COLUMNS, run_timestamp
from hitsessions.operators.session_start import EXTRA_CLICK_COLUMNS, MODEL2_COLUMNS
from hitsessions.options import SessionOptions
from hitsessions.session import new_work_path, remove_path
from hitsessions.sources.export import date_range, subfolders

ID = "unique_session_id"
#: Folder value of the partition of rows without a date.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class UpsertSpec:
    columns: tuple          # target schema, in order
    compare: tuple          # changed when any IS DISTINCT FROM
    update: tuple           # set from the source on a changed match
    insert: tuple           # taken from the source on insert; others NULL
    touch: str = "last_update_timestamp"


MODEL1_SPEC = UpsertSpec(
    columns=MODEL1_COLUMNS,
    compare=("session_source", "session_medium", "session_campaign", "session_content", "session_term"),
    update=("session_source", "session_medium", "session_campaign", "session_content", "session_term"),
    insert=MODEL1_COLUMNS,
)

_M2_UPDATE = ("session_source", "session_source_orig", "session_medium", "session_medium_orig",
              "session_campaign", "session_campaign_orig")
# The original insert list leaves out ga_session_number, utm_campaign_url,
# gclid_url and last_update_timestamp (Q12).
_M2_INSERT_AS_WRITTEN = ("session_date", "event_timestamp", "actual_timestamp", "unique_session_id",
                         "page_location", "session_source_orig", "session_source", "session_medium_orig",
                         "session_medium", "session_campaign_orig", "session_campaign", "session_term",
                         "session_content", "export_timestamp")


def model2_spec(opts: SessionOptions | None = None) -> UpsertSpec:
    opts = opts or SessionOptions()
    columns = MODEL2_COLUMNS
    if opts.extra_click_ids:
        at = columns.index("gclid_url") + 1
        columns = (*columns[:at], *EXTRA_CLICK_COLUMNS, *columns[at:])
    return UpsertSpec(
        columns=columns,
        compare=("session_source", "session_medium", "session_campaign"),
        update=_M2_UPDATE,
        insert=columns if opts.model2_insert_all_columns else _M2_INSERT_AS_WRITTEN,
    )


def _as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def scan_start(start, opts: SessionOptions) -> dt.date:
    """First day a run has to scan: a widened match needs the events of the days it matches."""
    return _as_date(start) - dt.timedelta(days=int(opts.target_lookback_days))


def _changed(spec: UpsertSpec) -> Column:
    return reduce(lambda a, b: a | b,
                  [~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in spec.compare])


def merge_partitions(target: DataFrame, source: DataFrame, start, end, spec: UpsertSpec,
                     run_ts=None, target_lookback_days: int = 0, buckets: int = 0) -> DataFrame:
    """New content of every partition the upsert rewrites, in the target's columns.

    ``target`` holds the partitions of the window and of the source's
    dates; ``source`` has one row per session id. One full outer join of
    the window's target rows with the source gives both branches: rows
    with a target side are kept or updated, rows with only a source side
    are inserted. Target rows outside the window that share a date with
    the source (or have none, like a source row) are carried along
    unchanged, since their partitions are rewritten.

    A source with a column ``_held`` (``id_index.held``) inserts only the
    rows where it is false; without it every unmatched row is inserted.
    With a target in ``buckets`` the source is dealt out like it, and only
    the source is shuffled.
    """
    lo = _as_date(start) - dt.timedelta(days=int(target_lookback_days))
    in_window = F.coalesce(F.col("session_date").between(F.lit(lo), F.lit(_as_date(end))), F.lit(False))
    ts = run_timestamp(run_ts)
    cols = target.columns
    schema = {f.name: f.dataType for f in target.schema.fields}

    t = target.where(in_window).select(*[F.col(_q(c)) for c in cols], F.lit(True).alias("_t")).alias("t")
    fresh = ~F.col("_held") if "_held" in source.columns else F.lit(True)
    s = source.select(*[c for c in spec.columns if c in source.columns], F.lit(True).alias("_s"), fresh.alias("_new")).alias("s")
    if buckets:
        s = s.repartition(buckets, F.col(ID)).alias("s")
    # A NULL id matches nothing: such rows come out one-sided.
    j = t.join(s, F.col(f"t.{ID}") == F.col(f"s.{ID}"), "full_outer")
    has_t, has_s = F.col("t._t").isNotNull(), F.col("s._s").isNotNull()
    j = j.where(has_t | F.col("s._new"))
    hit = has_t & has_s & _changed(spec)
    out = []
    for c in cols:
        if c in spec.update:
            kept = F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        elif c == spec.touch:
            kept = F.when(hit, ts).otherwise(F.col(f"t.{c}"))
        else:
            kept = F.col(f"t.{_q(c)}")
        new = F.col(f"s.{c}") if (c in spec.insert and c in source.columns) else F.lit(None)
        out.append(F.when(has_t, kept).otherwise(new).cast(schema[c]).alias(c))
    merged = j.select(*out)

    # Partitions outside the window that inserted rows may land in: the
    # source's dates are a superset of the insert dates (a handful of
    # days), and rewriting an unchanged partition leaves it equal.
    source_dates = source.where(fresh).select(F.col("session_date").alias("_date")).distinct()
    # One row per calendar day: small whatever the data.
    carried = (target.where(~in_window)
               .join(F.broadcast(source_dates), F.col("session_date").eqNullSafe(F.col("_date")), "left_semi"))
    return merged.unionByName(carried)


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _write_partitioned(df: DataFrame, path: str, mode: str, overwrite: str = "dynamic", buckets: int = 0,
                       id_column: str = ID) -> None:
    if buckets:
        bucketed.write(df, path, buckets, id_column, by="session_date")
        return
    # Rebalance on the partition column: AQE splits a heavy day over
    # several tasks and merges small ones, so files stay few and sized.
    # The overwrite mode is set on the write, not on the session.
    (df.hint("rebalance", "session_date")
     .write.mode(mode).option("partitionOverwriteMode", overwrite)
     .partitionBy("session_date").parquet(path))


def create_sessions(df: DataFrame, path: str) -> None:
    """Create the partitioned session table from a first load (J6); an
    existing table at ``path`` is replaced as a whole, its id index included."""
    _write_partitioned(df, path, "overwrite", overwrite="static")


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p)


def _read_target(spark: SparkSession, path: str, source: DataFrame, start, end, spec: UpsertSpec,
                 opts: SessionOptions, also: set[str] = frozenset(), names: list[str] | None = None) -> DataFrame:
    """The target's partitions that the upsert may rewrite, in its own schema.

    They are those of the window (none without a ``start``), of the
    source's dates and of the dates ``also``. A bucketed table is read
    through the catalog; its name there is put into ``names``.

    One listing of the table's root; only these partitions go into the
    file index. The id column gets the models' name, columns of the spec
    that the table lacks are added as NULL.
    """
    folders = subfolders(spark, path)
    by_value = {unquote(n[len("session_date="):]): p for n, p in folders.items() if n.startswith("session_date=")}
    # One value per calendar day reaches the driver.
    new = source.where(~F.col("_held")) if "_held" in source.columns else source
    dates = {str(r[0]) if r[0] is not None else NO_DATE for r in new.select("session_date").distinct().collect()}
    dates |= also
    lo, hi = (str(scan_start(start, opts)), str(_as_date(end))) if start is not None else ("1", "0")
    needed = sorted(p for v, p in by_value.items() if v in dates or (v != NO_DATE and lo <= v <= hi))
    types = {f.name: f.dataType for f in source.schema.fields}
    some = needed or sorted(by_value.values())[-1:]
    if some:
        # The partitions' own columns: older ones may lack a newer column.
        table = (spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*some)
                 .withColumn("session_date", F.col("session_date").cast("date")))
        if not needed:
            table = table.limit(0)
        elif names is not None:
            folders = {(None if v == NO_DATE else v): p for v, p in by_value.items() if p in set(needed)}
            # Files of a bucketed table: the column that the buckets are of keeps its own name in the catalog.
            names.append(bucketed.register(spark, path, table.schema, bucketed.buckets_of(spark, path), opts.id_column,
                                           "session_date", folders))
            table = spark.table(names[-1])
    else:
        # A table created by a run without events has no partition to take columns from.
        table = spark.createDataFrame([], T.StructType([source.schema[c] for c in spec.columns]))
    if opts.id_column != ID:
        if opts.id_column not in table.columns and some:
            raise ValueError(f"{path} has no id column {opts.id_column!r}")
        table = table.withColumnRenamed(opts.id_column, ID)
    elif ID not in table.columns:
        raise ValueError(f"{path} has no id column {ID!r}; name it in SessionOptions.id_column")
    for c in spec.columns:
        if c not in table.columns:
            table = table.withColumn(c, F.lit(None).cast(types[c]))
        elif c in types and table.schema[c].dataType != types[c]:
            raise ValueError(f"column {c!r} is {table.schema[c].dataType.simpleString()} in {path}, "
                             f"{types[c].simpleString()} in the sessions")
    return table


def _indexed(spark: SparkSession, path: str, opts: SessionOptions) -> bool:
    """Whether the run looks ids up in the whole table; makes the index of a table that has none."""
    if not (opts.one_row_per_id or opts.target_lookback_days):
        return id_index.has_index(spark, path)
    if not id_index.has_index(spark, path):
        rows = spark.createDataFrame([], f"{ID} string, session_date date")
        if any(n.startswith("session_date=") for n in subfolders(spark, path)):
            rows = spark.read.parquet(path).select(F.col(opts.id_column).alias(ID), F.col("session_date").cast("date"))
        id_index.build(spark, path, rows, opts.id_buckets)
    return True


def upsert_sessions(spark: SparkSession, path: str, source: DataFrame, start, end,
                    spec: UpsertSpec = MODEL1_SPEC, run_ts=None,
                    opts: SessionOptions | None = None, source_staged: bool = False,
                    progress: Callable[[str], None] | None = None) -> dict:
    """Apply one upsert of ``source`` sessions for [start, end] to ``path``.

    Finishes an interrupted commit of an earlier run first, and creates
    the table when it does not exist. Concurrent writers to the same table
    are not supported. ``source_staged`` says that ``source`` reads a
    written table already, which spares a second copy. ``progress`` is
    called with each partition that was replaced. Returns what was done.
    """
    opts = opts or SessionOptions()
    created = not table_exists(spark, path)
    finished = None if created else recover(spark, path)
    indexed = (opts.one_row_per_id or opts.target_lookback_days) if created else _indexed(spark, path, opts)
    if created and indexed:
        _indexed(spark, path, opts)
    if created and opts.table_buckets:
        bucketed.mark(spark, path, opts.table_buckets)
    buckets, names = bucketed.buckets_of(spark, path), []
    # The source is read by several branches; stage it once in the shared
    # folder so the model is not computed twice and a lost executor
    # does not replay the whole lineage.
    src_path = None
    if indexed:
        source = id_index.held(source, id_index.read_ids(spark, path), id_index.buckets_of(spark, path))
    if indexed or not source_staged:
        src_path = new_work_path(spark, "upsert-source")
        source.write.mode("overwrite").parquet(src_path)
        source = spark.read.schema(source.schema).parquet(src_path)
    additions = source.where(~F.col("_held")) if indexed else None
    if indexed and not (opts.one_row_per_id or opts.target_lookback_days):
        # The index is kept, but this run matches the window only: an id may get a row under a second date.
        additions = source = source.drop("_held")
    if created:
        new = source.select(*[F.col(c) if c in spec.insert else F.lit(None).cast(source.schema[c].dataType).alias(c)
                              for c in spec.columns])
        new = new.repartition(buckets, ID) if buckets else new
    else:
        target = _read_target(spark, path, source, start, end, spec, opts, names=names if buckets else None)
        new = merge_partitions(target, source, start, end, spec, run_ts, opts.target_lookback_days, buckets)
    done = replace_partitions(spark, path, new, opts, additions, progress, buckets=buckets)
    for n in names:
        bucketed.drop(spark, n)
    if src_path:
        remove_path(spark, src_path)
    return {"created": created, "finished": finished, "partitions": done}


def replace_sessions(spark: SparkSession, path: str, source: DataFrame, spec: UpsertSpec = MODEL1_SPEC, run_ts=None,
                     opts: SessionOptions | None = None, progress: Callable[[str], None] | None = None) -> dict:
    """Put whole sessions into the table: each id of ``source`` has this one row afterwards, under its own date.

    For sessions built from their whole history (``states``), where an
    earlier event that came late may move a session to another day. The id
    index tells the dates of the rows to replace. The export timestamp and
    columns that the model doesn't know stay those of the first row;
    ``last_update_timestamp`` changes where another column of the model does.
    Rows without an id are left out.
    """
    opts = (opts or SessionOptions()).with_(one_row_per_id=True)
    created = not table_exists(spark, path)
    finished = None if created else recover(spark, path)
    _indexed(spark, path, opts)
    src_path = new_work_path(spark, "replace-source")
    found = id_index.read_ids(spark, path).groupBy(ID).agg(F.collect_set(F.coalesce(F.col("session_date").cast("string"),
                                                                                 F.lit(NO_DATE))).alias("_dates"))
    source = (source.where(F.col(ID).isNotNull()).select(*spec.columns)
              .repartition(id_index.buckets_of(spark, path), ID).join(found, ID, "left"))
    source.write.mode("overwrite").parquet(src_path)
    source = spark.read.parquet(src_path)
    # One value per calendar day: dates that rows leave, and dates that they come to.
    old = {r[0] for r in source.select(F.explode("_dates")).distinct().collect()}
    rows = source.drop("_dates")
    target = _read_target(spark, path, rows, None, None, spec, opts, also=old)
    cols, schema = target.columns, {f.name: f.dataType for f in target.schema.fields}
    key = rows.select(F.col(ID).alias("_id"))
    rest = target.join(key, F.col(ID) == F.col("_id"), "left_anti")
    # One row per id, should the table have several of one.
    before = (target.join(key, F.col(ID) == F.col("_id"), "left_semi").groupBy(F.col(ID).alias("_id"))
              .agg(F.min_by(F.struct(*[F.col(_q(c)) for c in cols]), "export_timestamp").alias("t")))
    j = rows.alias("s").join(before, F.col(f"s.{ID}") == F.col("_id"), "left")
    values = [c for c in spec.columns if c not in ("export_timestamp", spec.touch)]
    changed = reduce(lambda a, b: a | b, [~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in values])
    known = F.col("t").isNotNull()
    out = []
    for c in cols:
        if c in values:
            v = F.col(f"s.{c}")
        elif c == "export_timestamp":
            v = F.coalesce(f"t.{c}", f"s.{c}")
        elif c == spec.touch:
            v = F.when(known & ~changed, F.col(f"t.{c}")).otherwise(run_timestamp(run_ts))
        else:
            v = F.col("t." + _q(c))
        out.append(v.cast(schema[c]).alias(c))
    planned = {f"session_date={d}" for d in old}
    buckets, new = bucketed.buckets_of(spark, path), rest.unionByName(j.select(*out))
    new = new.repartition(buckets, ID) if buckets else new
    done = replace_partitions(spark, path, new, opts, rows, progress, planned, buckets)
    remove_path(spark, src_path)
    return {"created": created, "finished": finished, "partitions": done}


def replace_partitions(spark: SparkSession, path: str, new: DataFrame, opts: SessionOptions,
                       additions: DataFrame | None = None, progress: Callable[[str], None] | None = None,
                       planned: set[str] | None = None, buckets: int = 0) -> list[str]:
    """Replace the partitions that ``new`` has rows of, drop others in ``planned``; the ids of ``additions`` go into the index."""
    run = new_run()
    staged = staged_path(path, run)
    if opts.id_column != ID:
        new = new.withColumnRenamed(ID, opts.id_column)
    _write_partitioned(new, staged, "overwrite", "static", buckets, opts.id_column)
    added = {}
    if additions is not None:
        added[f"{staged}/{id_index.FOLDER}"] = id_index.index_path(path)
        id_index.write_ids(additions, f"{staged}/{id_index.FOLDER}", id_index.buckets_of(spark, path))
    return commit_staged(spark, path, run, added, planned, progress)


def merge_into_catalog_table(source: DataFrame, table: str, start, end, spec: UpsertSpec = MODEL1_SPEC,
                             run_ts=None, target_lookback_days: int = 0):
    """The same upsert as a native ``MERGE`` on a catalog table that
    supports row-level operations (``DataFrame.mergeInto``).

    Built-in Parquet tables do not; use :func:`upsert_sessions` for them.
    """
    lo = _as_date(start) - dt.timedelta(days=int(target_lookback_days))
    hi = _as_date(end)
    ts = run_timestamp(run_ts)
    t, s = F.col(f"{table}.{ID}"), F.col(f"source.{ID}")
    on = (t == s) & F.col(f"{table}.session_date").between(F.lit(lo), F.lit(hi))
    changed = reduce(lambda a, b: a | b,
                     [~F.col(f"{table}.{c}").eqNullSafe(F.col(f"source.{c}")) for c in spec.compare])
    update = {c: F.col(f"source.{c}") for c in spec.update}
    update[spec.touch] = ts
    insert = {c: F.col(f"source.{c}") for c in spec.insert}
    return (source.alias("source").mergeInto(table, on)
            .whenMatched(changed).update(update)
            .whenNotMatched().insert(insert)
            .merge())
