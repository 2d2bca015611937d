"""Line deduplication: lines that many documents share stay in one document only.

DataFrame functions only. Lines are exploded with their position, hashed
by their normalised form, counted by distinct documents, and the lines to
drop come back to their document as a list of positions.

Defined cases
-------------
* Null or empty text: one empty line, kept.
* A line shorter than ``min_chars`` after normalising is never dropped.
* Repeated lines inside one document count as one document.
* Rows that share an id count as one document; each row keeps its own
  result. A null id is an id of its own, smaller than all others.
* All lines dropped: the kept text is empty.
* Other columns, whatever their names, are carried in ``row``.

Scale: two shuffles of (hash, id) rows, one of the text. A line that a
third of all documents hold is one row per map task in the count (partial
aggregation); in the join back it is a skewed key that Spark splits (the
join key has one more column than the aggregate's, so that a fresh
exchange feeds the join and adaptive execution can cut it). The join with
the texts is made alike, for rows that repeat an id and a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import id_of, let, name, packed

#: Stripped at both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, nothing else. ``lower`` does that for pure ASCII, and faster."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """Rows ``row, n_lines, n_dropped, kept`` of every input row.

    A normalised line (stripped of blanks, A-Z lower-cased) of at least
    ``min_chars`` characters found in ``min_docs`` documents or more stays
    only in the document with the smallest id.
    """
    line = docs.select(id_of(docs[name(id_col)]).alias("d"), F.xxhash64(docs[name(text_col)]).alias("th"),
                       F.posexplode(split_lines(docs[name(text_col)])).alias("pos", "line"))
    key = line.select("d", "th", "pos", lower_ascii(F.btrim("line", F.lit(BLANKS))).alias("key"))
    key = key.where(F.length("key") >= min_chars).select(
        "d", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))

    by_line = key.select("h1", "h2", "d")
    if min_docs > 2:
        by_line = by_line.distinct().groupBy("h1", "h2").agg(F.min("d").alias("keeper"), F.count("*").alias("n"))
        shared = by_line.where(F.col("n") >= min_docs)
    else:
        by_line = by_line.groupBy("h1", "h2").agg(F.min("d").alias("keeper"), F.max("d").alias("last"))
        shared = by_line.where(F.col("keeper") < F.col("last"))
    fresh = F.col("h1").bitwiseXOR(F.col("h2")).alias("h12")
    dropped = (key.select("*", fresh).join(shared.select("h1", "h2", "keeper", fresh), ["h12", "h1", "h2"])
               .where(F.col("d") != F.col("keeper"))
               .groupBy("d", "th").agg(F.collect_set("pos").alias("dropped")))

    # A third key here as well: rows that repeat one id and text are split like a hot line.
    row = F.col("d").bitwiseXOR(F.col("th")).alias("dth")
    out = packed(docs, id_col, text_col).select("*", row).join(dropped.select("*", row), ["dth", "d", "th"], "left")
    text = F.col("row." + name(text_col))
    n_lines = F.size(split_lines(text))
    keep = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.col("dropped"))
    kept = let(split_lines(text), lambda lines: F.array_join(F.transform(keep, lambda i: F.get(lines, i)), "\n"))
    return out.select("row", n_lines.cast("long").alias("n_lines"),
                      F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
                      F.when(F.col("dropped").isNull(), F.coalesce(text, F.lit(""))).otherwise(kept).alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH line AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line
), shared AS (
  SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), judged AS (
  SELECT k.doc_id, k.pos, k.line, s.keeper IS NOT NULL AND s.keeper <> k.doc_id AS dropped
  FROM keyed k LEFT JOIN shared s ON s.key = k.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
