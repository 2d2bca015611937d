"""Bucketed Parquet folders without a lasting catalog entry (S6, JN2).

Only the session catalog knows that a table is bucketed; the files carry
their bucket in their names. A folder written here is registered under a
name of its own while it is read or written, so nothing has to outlast the
session, and a join on the bucketed column doesn't shuffle the folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hitsessions.operators.commit import _Files

#: File that says how many buckets a folder has.
SPEC = "_buckets"


def _name() -> str:
    return f"hitsessions_{uuid.uuid4().hex[:16]}"


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def buckets_of(spark: SparkSession, path: str) -> int:
    """Buckets of a folder, 0 of a plain one."""
    files = _Files(spark, path)
    return int(files.read(f"{path}/{SPEC}")) if files.exists(f"{path}/{SPEC}") else 0


def mark(spark: SparkSession, path: str, buckets: int) -> None:
    _Files(spark, path).write(f"{path}/{SPEC}", str(buckets))


def write(df: DataFrame, path: str, buckets: int, key: str, by: str | None = None) -> None:
    """``df`` as bucketed files, in folders by ``by`` if given.

    Rows should be dealt out by the key already (``repartition(buckets,
    key)`` or a join on it): a task then writes one file per folder.
    """
    name = _name()
    w = df.write.format("parquet").bucketBy(buckets, key).option("path", path)
    (w.partitionBy(by) if by else w).saveAsTable(name)
    drop(df.sparkSession, name)


def register(spark: SparkSession, path: str, schema: T.StructType, buckets: int, key: str, by: str | None = None,
             folders: dict[str | None, str] | None = None) -> str:
    """Name of the registered folder; :func:`drop` it after the last job on it.

    Of a partitioned folder only ``folders`` (value of ``by``, path) are
    known to the catalog, and listed.
    """
    name = _name()
    columns = ", ".join(f"{_q(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet " + (f"PARTITIONED BY ({_q(by)}) " if by else "")
              + f"CLUSTERED BY ({_q(key)}) INTO {buckets} BUCKETS LOCATION {_text(path)}")
    if folders:
        parts = " ".join(f"PARTITION ({_q(by)} = {'NULL' if v is None else _text(v)}) LOCATION {_text(p)}"
                         for v, p in folders.items())
        spark.sql(f"ALTER TABLE {name} ADD {parts}")
    return name


def drop(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: the files stay
