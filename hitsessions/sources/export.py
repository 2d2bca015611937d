"""Scans of the event export.

The export is one Parquet table per day. On Spark it is one directory
tree partitioned by the shard name, ``<root>/suffix=20240121/``,
``<root>/suffix=intraday_20240122/``; the shard name is the partition
column ``suffix``. A scan for a date window lists the root once and
opens only the window's folders (``read_window``); a scan of the whole
tree is pruned by a partition filter.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitsessions.options import SessionOptions

PARAM_VALUE_FULL = T.StructType([
    T.StructField("string_value", T.StringType()),
    T.StructField("int_value", T.LongType()),
    T.StructField("float_value", T.FloatType()),
    T.StructField("double_value", T.DoubleType()),
])
# Only the two members the models read: a narrow read schema makes the
# Parquet reader skip the other leaves of the nested column.
PARAM_VALUE_NARROW = T.StructType([
    T.StructField("string_value", T.StringType()),
    T.StructField("int_value", T.LongType()),
])


def params_type(narrow: bool = True) -> T.ArrayType:
    value = PARAM_VALUE_NARROW if narrow else PARAM_VALUE_FULL
    return T.ArrayType(T.StructType([T.StructField("key", T.StringType()),
                                     T.StructField("value", value)]))


def event_schema(narrow: bool = True, with_suffix: bool = True, extra=()) -> T.StructType:
    fields = [*extra,
        T.StructField("event_date", T.StringType()),
        T.StructField("event_timestamp", T.LongType()),
        T.StructField("event_bundle_sequence_id", T.LongType()),
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("event_params", params_type(narrow)),
    ]
    if with_suffix:
        fields.append(T.StructField("suffix", T.StringType()))
    return T.StructType(fields)


def _as_date(d) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d))


def _digits(d) -> str:
    """``yyyymmdd`` (``strftime`` would not pad a year below 1000)."""
    return _as_date(d).isoformat().replace("-", "")


def default_window(today: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """The scheduled run's window: the day before yesterday and yesterday
    (UTC), so sessions crossing midnight and late hits are rescanned."""
    today = today or dt.datetime.now(dt.timezone.utc).date()
    return today - dt.timedelta(days=2), today - dt.timedelta(days=1)


def window_bounds(start=None, end=None, today: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """First and last day of a window; each one not given takes its own default."""
    lo, hi = default_window(today)
    return (_as_date(start) if start is not None else lo), (_as_date(end) if end is not None else hi)


def shard_in_window(start, end, suffix: str = "suffix", include_intraday: bool = True) -> Column:
    """First digit run of the shard name, as text, inside [start, end].

    The digit run of ``intraday_20240122`` is ``20240122``, so intraday
    shards match as well unless ``include_intraday`` is off.
    """
    lo, hi = _digits(start), _digits(end)
    cond = F.regexp_extract(F.col(suffix), "[0-9]+", 0).between(F.lit(lo), F.lit(hi))
    if not include_intraday:
        cond = cond & F.col(suffix).rlike("^[0-9]+$")
    return cond


def read_export(spark: SparkSession, root: str, narrow: bool = True, extra=()) -> DataFrame:
    """The whole export tree (S1, S2); ``suffix`` is the partition column.

    The schema is given, so no footer is sampled for inference and the
    shard name stays text (``20240121`` would otherwise become an int).
    """
    return (spark.read.schema(event_schema(narrow, extra=extra))
            .option("basePath", root).parquet(root))


def subfolders(spark: SparkSession, root: str, required: bool = False) -> dict[str, str]:
    """Name and path of the folders right under ``root`` (one listing)."""
    base = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(base):
        if required:
            raise FileNotFoundError(root)
        return {}
    return {st.getPath().getName(): st.getPath().toString() for st in fs.listStatus(base) if st.isDirectory()}


def shard_matches(shard: str, start, end, include_intraday: bool = True) -> bool:
    """Driver-side form of :func:`shard_in_window` for one shard name."""
    lo, hi = _digits(start), _digits(end)
    if not include_intraday and not re.fullmatch("[0-9]+", shard):
        return False
    digits = re.search("[0-9]+", shard)
    return digits is not None and lo <= digits[0] <= hi


def read_window(spark: SparkSession, root: str, start=None, end=None, include_intraday: bool | str = True,
                narrow: bool = True, extra=(), today: dt.date | None = None) -> DataFrame:
    """The shards of a window from a partitioned export tree.

    A listing of the root gives one entry per shard; only the folders
    of the window go into the scan's file index. ``include_intraday`` may be
    ``UNLESS_DAILY``: an intraday shard whose daily shard is there is left out.
    """
    start, end = window_bounds(start, end, today)
    names = [unquote(n[len("suffix="):]) for n in subfolders(spark, root, required=True) if n.startswith("suffix=")]
    return read_shards_of(spark, root, _window_test(names, start, end, include_intraday), narrow, extra)


#: ``include_intraday``: an intraday shard counts only while its daily shard isn't there.
UNLESS_DAILY = "unless_daily"


def _window_test(names, start, end, include_intraday) -> Callable[[str], bool]:
    """Test of a shard name for a window, given all names of the export."""
    daily = {f"intraday_{n}" for n in names} if include_intraday == UNLESS_DAILY else set()
    return lambda s: s not in daily and shard_matches(s, start, end, bool(include_intraday))


def read_shards_of(spark: SparkSession, root: str, wanted, narrow: bool = True, extra=()) -> DataFrame:
    """The shards of a partitioned export tree whose name passes a test."""
    paths = [path for folder, path in subfolders(spark, root, required=True).items() if folder.startswith("suffix=")
             and wanted(unquote(folder[len("suffix="):]))]
    return _read_paths(spark, root, sorted(paths), event_schema(narrow, extra=extra))


def read_folders_of(spark: SparkSession, root: str, wanted, narrow: bool = True, prefix: str = "events_",
                    extra=()) -> DataFrame:
    """The shards of a folder-per-shard export whose name passes a test."""
    paths = [path for folder, path in subfolders(spark, root, required=True).items()
             if folder.startswith(prefix) and wanted(folder[len(prefix):])]
    return _read_folders(spark, sorted(paths), narrow, prefix, extra)


def _read_paths(spark: SparkSession, root: str, paths: list[str], schema: T.StructType) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths)


def shard_paths(spark: SparkSession, root: str, start, end, include_intraday: bool | str = True,
                prefix: str = "events_") -> list[str]:
    """Shard folders ``<root>/events_<shard>`` of the window, for exports
    stored one folder per shard rather than as ``suffix=`` partitions.

    Any shard name counts, as in the partitioned layout: its first digit
    run is compared. One listing of the root replaces a lookup per day.
    """
    folders = {n[len(prefix):]: p for n, p in subfolders(spark, root, required=True).items() if n.startswith(prefix)}
    test = _window_test(folders, start, end, include_intraday)
    return sorted(p for shard, p in folders.items() if test(shard))


def _read_folders(spark: SparkSession, paths: list[str], narrow: bool, prefix: str, extra=()) -> DataFrame:
    schema = event_schema(narrow, with_suffix=False, extra=extra)
    if not paths:
        return spark.createDataFrame([], event_schema(narrow, extra=extra))
    df = spark.read.schema(schema).parquet(*paths)
    suffix = F.regexp_extract(F.col("_metadata.file_path"), f"/{prefix}([^/]+)/[^/]*$", 1)
    return df.select(*schema.fieldNames(), suffix.alias("suffix"))


def read_shard_folders(spark: SparkSession, root: str, start=None, end=None, include_intraday: bool | str = True,
                       narrow: bool = True, prefix: str = "events_", extra=(),
                       today: dt.date | None = None) -> DataFrame:
    """Scan of a folder-per-shard export (S1, S2 without ``key=value``).

    The shard name becomes ``suffix``, taken from the file path through
    the ``_metadata`` column.
    """
    start, end = window_bounds(start, end, today)
    return _read_folders(spark, shard_paths(spark, root, start, end, include_intraday, prefix), narrow, prefix, extra)


def read_single_shard(spark: SparkSession, root: str, shard: str, layout: str = "partitioned",
                      narrow: bool = True, prefix: str = "events_", extra=()) -> DataFrame:
    """One shard by its name, in either layout (S4); an absent one has no rows."""
    folder = f"suffix={shard}" if layout == "partitioned" else f"{prefix}{shard}"
    paths = [p for n, p in subfolders(spark, root, required=True).items() if unquote(n) == folder]
    if layout == "partitioned":
        return _read_paths(spark, root, paths, event_schema(narrow, extra=extra))
    return _read_folders(spark, paths, narrow, prefix, extra)


def events_in_window(events: DataFrame, start=None, end=None,
                     opts: SessionOptions | None = None) -> DataFrame:
    """Shard range filter (S3) and the NULL-user filter (F1)."""
    opts = opts or SessionOptions()
    start, end = window_bounds(start, end, opts.today)
    return (events
            .where(shard_in_window(start, end, include_intraday=opts.include_intraday))
            .where(F.col("user_pseudo_id").isNotNull()))


def single_shard(events: DataFrame, suffix: str) -> DataFrame:
    """One shard, as the query over ``events_20240121`` reads it."""
    return events.where(F.col("suffix") == F.lit(suffix))


def write_export(events: DataFrame, root: str, mode: str = "overwrite") -> None:
    """Lay events out as the sharded export tree (one folder per shard).

    Range partitioning on (suffix, event_timestamp) keeps the files of a
    shard few, and splits a heavy day over several tasks instead of
    sending the whole day to one.
    """
    (events.repartitionByRange("suffix", "event_timestamp")
     .write.mode(mode).partitionBy("suffix").parquet(root))


def write_shard_folders(events: DataFrame, root: str, prefix: str = "events_") -> None:
    """Lay events out as one folder per shard (``<root>/events_<shard>``)."""
    for shard in sorted(r.suffix for r in events.select("suffix").distinct().collect()):  # one per calendar day
        events.where(F.col("suffix") == shard).drop("suffix").write.parquet(f"{root}/{prefix}{shard}")


def date_range(column: str, start=None, end=None) -> Column | None:
    """``column`` within the bounds that are given; None without any."""
    cond = None
    if start is not None:
        cond = F.col(column) >= F.lit(_as_date(start))
    if end is not None:
        upper = F.col(column) <= F.lit(_as_date(end))
        cond = upper if cond is None else cond & upper
    return cond


def read_sessions(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """An existing session table, pruned to a date range (S5); either bound may be left open."""
    df = spark.read.parquet(path)
    cond = date_range("session_date", start, end)
    return df if cond is None else df.where(cond)
