"""Index of the session ids of a table, for matches in any partition.

The original ``MERGE`` looks for a session in the window's dates only, so
a session that an earlier run stored under an older date is inserted once
more. The index tells which ids the table holds, and under which date,
without reading the table: (id, date) rows in ``<table>/_ids``, bucketed
by a hash of the id. A join of new sessions with it shuffles the new
sessions alone. Files of a run are added in the run's commit, so table
and index don't part when a run is interrupted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitsessions.operators import bucketed
from hitsessions.operators.commit import _Files

FOLDER = "_ids"
#: Buckets of a new index: ids of a bucket are joined by one task.
BUCKETS = 64
ID, DATE = "unique_session_id", "session_date"
_SCHEMA = T.StructType([T.StructField(ID, T.StringType()), T.StructField(DATE, T.DateType())])


def index_path(table: str) -> str:
    return f"{table}/{FOLDER}"


def has_index(spark: SparkSession, table: str) -> bool:
    return bucketed.buckets_of(spark, index_path(table)) > 0


def write_ids(rows: DataFrame, path: str, buckets: int) -> None:
    """(id, date) rows as bucketed files, one file per bucket."""
    rows = rows.where(F.col(ID).isNotNull()).select(ID, DATE).distinct().repartition(buckets, ID)
    bucketed.write(rows, path, buckets, ID)


def buckets_of(spark: SparkSession, table: str) -> int:
    return bucketed.buckets_of(spark, index_path(table))


def build(spark: SparkSession, table: str, rows: DataFrame, buckets: int = BUCKETS) -> None:
    """Index of the (id, date) rows of a table that has none yet."""
    path = index_path(table)
    _Files(spark, table).delete(path)
    write_ids(rows, path, buckets)
    bucketed.mark(spark, path, buckets)  # last: an index without it is built again


def read_ids(spark: SparkSession, table: str) -> DataFrame:
    """(id, date) of the table's index; a join on the id doesn't shuffle it."""
    name = bucketed.register(spark, index_path(table), _SCHEMA, buckets_of(spark, table), ID)
    out = spark.table(name)
    out.schema  # resolved while the name is there; the files of a table without partitions are listed by then
    bucketed.drop(spark, name)
    return out


def held(source: DataFrame, ids: DataFrame, buckets: int) -> DataFrame:
    """``source`` with ``_held``: whether the table has a row of the session.

    The source is dealt out as the index is, whatever the session's number
    of shuffle partitions; with another number both sides would be.
    """
    known = ids.groupBy(ID).agg(F.lit(True).alias("_held"))
    return (source.repartition(buckets, ID).join(known, ID, "left")
            .withColumn("_held", F.coalesce("_held", F.lit(False))))
