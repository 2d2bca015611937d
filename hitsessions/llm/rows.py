"""Column helpers shared by the operators.

Operators keep a document's own columns in one struct column ``row``, so
no column name of the input can clash with a working column. ``d`` is the
document's id as a long (null: the smallest long, an id of its own) and
``th`` a hash of the text: together they name a row, so rows that share
an id are worked on separately, and fully repeated rows get equal results.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_work_path, remove_path

NULL_ID = -(2**63)
#: Columns of ``row_key``, and their types in a schema string.
KEY, KEY_SCHEMA = ["d", "t", "u"], "d long, t long, u long"


def name(c: str) -> str:
    """A column name quoted for ``F.col``."""
    return "`" + c.replace("`", "``") + "`"


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row (all input columns), d, th."""
    return docs.select(F.struct(*[F.col(name(c)) for c in docs.columns]).alias("row"),
                       id_of(docs[name(id_col)]).alias("d"),
                       F.xxhash64(docs[name(text_col)]).alias("th"))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once (a one-element array binds it)."""
    return F.transform(F.array(value), body)[0]


def id_of(c: Column) -> Column:
    return F.coalesce(c.cast("long"), F.lit(NULL_ID))


def row_key(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column, Column]:
    """d, t and u: a row is named by its id and two 64-bit hashes of its text.

    Rows under one id (all null ids are one) meet in 128 bits only if their texts are equal.
    """
    return key_of(docs[name(id_col)], docs[name(text_col)])


def key_of(doc_id: Column, text: Column) -> tuple[Column, Column, Column]:
    """``row_key`` of an id and a text column."""
    # The constant comes first: it seeds the second hash (after the text it would only hash the first one again).
    return id_of(doc_id).alias("d"), F.xxhash64(text).alias("t"), F.xxhash64(F.lit(1), text).alias("u")


def unpacked(df: DataFrame, columns: list[str], replaced: dict[str, Column] | None = None) -> DataFrame:
    """The document columns out of ``row``, some of them replaced."""
    replaced = replaced or {}
    return df.select(*[replaced.get(c, F.col("row." + name(c))).alias(c) for c in columns])


def text_columns(columns: list[str], text: Column, text_col: str = "text", chars_col: str = "n_chars") -> dict[str, Column]:
    """Replacements for a new text: the text and, where there is one, its length column."""
    out = {text_col: text}
    if chars_col in columns:
        out[chars_col] = F.length(text).cast("long")
    return out


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_DEFAULT_BATCH = "67108864b"


def small_batches(spark: SparkSession, size: int = 1 << 18) -> None:
    """Bound the session's Arrow batches to ``size`` bytes, where they have Spark's default of 64 MB.

    Each task holds several copies of a batch, in the JVM and in its Python
    worker; the operators here cut batches into smaller pieces anyway.
    """
    if spark.conf.get(_BATCH) == _DEFAULT_BATCH:
        spark.conf.set(_BATCH, str(size))


def written(df: DataFrame, what: str, by: str | None = None) -> DataFrame:
    """``df`` written once to the shared work folder and read back (cuts the lineage).

    ``by`` is a column whose values get folders of their own.
    """
    spark: SparkSession = df.sparkSession
    path = new_work_path(spark, f"{what}-{uuid.uuid4().hex[:8]}")
    df.write.parquet(path, partitionBy=by)
    out = spark.read.schema(df.schema).parquet(path)
    out.work_path = path
    return out


def kept(df: DataFrame, table: DataFrame) -> DataFrame:
    """``df``, a view of the written ``table``, to be removed in its place."""
    df.work_path = table.work_path
    return df


def removed(*tables: DataFrame) -> None:
    """Delete tables of :func:`written` that nothing reads any more."""
    for t in tables:
        remove_path(t.sparkSession, t.work_path)
