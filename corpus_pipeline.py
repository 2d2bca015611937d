"""Corpus pipeline: raw documents to token ids in five stages.

Each stage reads the whole table its predecessor wrote. The order and
the operators: quality classifier (documents it rejects go), line
deduplication (dropped lines leave the texts), n-gram Jaccard join on
five-word shingles at a similarity of 0.8 (one document of each group
stays), benchmark decontamination (hit spans leave the texts; documents
that are mostly benchmark go), byte-level BPE (token ids, decoded back).

Stages but the last return the columns of the documents. Where a stage
changes a text, ``n_chars`` follows. A text that loses all its lines
stays as an empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitsessions.llm import bpe, decontaminate, line_dedup, ngram_join, quality_classifier
from hitsessions.llm.rows import removed, small_batches, text_columns, unpacked, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines are mostly good."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labels = labels.where(~quality_classifier.held_out(F.col("doc_id")))
    scored = quality_classifier.score(docs, quality_classifier.fit(docs, labels))
    return unpacked(scored.where("score >= 0.5"), docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that other documents have too."""
    small_batches(spark)
    out = line_dedup.dedup_lines(docs)
    return unpacked(out, docs.columns, text_columns(docs.columns, F.col("kept")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    small_batches(spark)
    return ngram_join.one_of_each(docs, shingle=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of the benchmark."""
    small_batches(spark)
    found = decontaminate.find(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    clean = decontaminate.remove(found)
    return unpacked(clean, docs.columns, text_columns(docs.columns, F.col("clean")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to it again."""
    small_batches(spark)
    out = bpe.encode(docs.select("doc_id", "text"), bpe.vocab_path(), decoded=True)
    return out.select("row.doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                      (F.col("decoded") == F.coalesce("row.text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("BPE encoding and decoding", tokens),
]

#: The classifier and the merges of the vocabulary have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each but the last is written and read again."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
        if before is not None:
            removed(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
