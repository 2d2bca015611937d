"""Ledger of shard files: what changed in an export since it was last read.

The original scans whatever its wildcard matches at the time. The ledger
is a stored list of the export's files (shard, file, size, modification
time). One listing of the tree, compared with it, tells which shards are
new, were replaced or are gone, without opening a file, so a run reads
only what changed and a run without changes reads nothing.

A daily shard supersedes the intraday shard of the same day: both hold the
day's events, and a wildcard would count them twice while both exist. A
superseded shard counts as gone as soon as its daily one is there.

Files are listed by Spark (the file source lists in parallel beyond a few
folders); of the file source only the path, size and time are selected, so
no content is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitsessions.operators.commit import commit_staged, new_run, recover, staged_path
from hitsessions.operators.upsert import table_exists
from hitsessions.sources.export import subfolders

SCHEMA = "shard string, file string, size long, changed timestamp"
#: Kinds of change.
NEW, REPLACED, REMOVED = "new", "replaced", "removed"
_FOLDER = {"partitioned": "suffix=", "folders": "events_"}


def list_files(spark: SparkSession, root: str, layout: str = "partitioned") -> DataFrame:
    """shard, file, size, changed of every data file of an export.

    Superseded intraday shards are left out.
    """
    prefix = _FOLDER[layout]
    folders = [p for n, p in subfolders(spark, root, required=True).items() if n.startswith(prefix)]
    if not folders:
        return spark.createDataFrame([], SCHEMA)
    path = F.regexp_extract(F.col("path"), f"/{prefix}([^/]+)/([^/]+)$", 1)
    # Names of partition folders are escaped like URLs; a plus sign is none of the escapes.
    shard = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))) if layout == "partitioned" else path
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folders)
             .select(shard.alias("shard"), F.regexp_extract("path", "([^/]+)$", 1).alias("file"),
                     F.col("length").alias("size"), F.col("modificationTime").alias("changed")))
    daily = files.where(F.col("shard").rlike("^[0-9]+$")).select(F.concat(F.lit("intraday_"), "shard").alias("_by")).distinct()
    return files.join(daily, F.col("shard") == F.col("_by"), "left_anti")


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The files the ledger knows (none without a ledger)."""
    if not table_exists(spark, ledger):
        return spark.createDataFrame([], SCHEMA)
    recover(spark, ledger)
    versions = sorted(n for n in subfolders(spark, ledger) if n.startswith("version="))
    if not versions:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(f"{ledger}/{versions[-1]}")


def changes(listing: DataFrame, known: DataFrame) -> DataFrame:
    """shard, change of the shards whose files differ between a listing and the ledger.

    A shard is new if the ledger had no file of it, removed if the listing
    has none, else replaced (a file came, went or was written again).
    """
    a, b = listing.alias("a"), known.alias("b")
    j = a.join(b, (F.col("a.shard") == F.col("b.shard")) & (F.col("a.file") == F.col("b.file")), "full_outer")
    same = (F.col("a.size") == F.col("b.size")) & (F.col("a.changed") == F.col("b.changed"))
    j = j.select(F.coalesce("a.shard", "b.shard").alias("shard"), F.col("a.file").isNotNull().alias("now"),
                 F.col("b.file").isNotNull().alias("before"), F.coalesce(same, F.lit(False)).alias("same"))
    g = j.groupBy("shard").agg(F.max("now").alias("now"), F.max("before").alias("before"), F.min("same").alias("same"))
    kind = F.when(~F.col("before"), F.lit(NEW)).when(~F.col("now"), F.lit(REMOVED)).otherwise(F.lit(REPLACED))
    return g.where(~F.col("same")).select("shard", kind.alias("change"))


class Ledger:
    """A ledger's folder and the export it follows."""

    def __init__(self, spark: SparkSession, root: str, path: str, layout: str = "partitioned"):
        self.spark, self.root, self.path, self.layout = spark, root, path, layout
        self.listing: DataFrame | None = None
        self.run: str | None = None

    def pending(self) -> dict[str, str]:
        """Changed shards and their kind of change (one entry per shard), by one listing.

        The listing is kept as the next version of the ledger; :meth:`done`
        makes it the current one. Files that change in between are found by
        the next run.
        """
        known = read_ledger(self.spark, self.path)
        versions = [n for n in subfolders(self.spark, self.path) if n.startswith("version=")] \
            if table_exists(self.spark, self.path) else []
        last = max((int(n[len("version="):]) for n in versions), default=0)
        self.run, self.old = new_run(), set(versions)
        staged = f"{staged_path(self.path, self.run)}/version={last + 1:09d}"
        list_files(self.spark, self.root, self.layout).write.parquet(staged)
        self.listing = self.spark.read.schema(SCHEMA).parquet(staged)
        return {r.shard: r.change for r in changes(self.listing, known).collect()}

    def done(self) -> None:
        """The changes that :meth:`pending` told have been worked in."""
        if self.run is None:
            raise ValueError("pending() comes first")
        commit_staged(self.spark, self.path, self.run, planned=self.old)
        self.run = None
