"""Quality classifier: a chain of lines, labelled good or bad.

A linear-chain conditional random field labels every line of a document
from measures of the line and of the lines beside it. Training lines take
the label of their document. The score of a document is the mean marginal
of "good" over its lines (forward-backward), weighted by line length.

Defined cases
-------------
* Null or empty text: one empty line, scored like any line.
* Labels: a document with contradicting label rows, or a null label, is
  left out of training; repeated label rows count once. Without labels of
  both kinds every line gets the smoothed share of good labels.
* Only the text is scored; label, language, source and id are no inputs.
* Rows are independent: repeated rows get equal results; other columns
  are carried in ``row``.

Scale: a map over the documents, no shuffle of them. Training takes at
most ``sample_rows`` labelled documents (the first by a hash of the id,
so any input has the same one); only line measures reach the driver, of
one row per document: rows that share an id are reduced to one on Spark.
Of a document with more than ``SAMPLE_LINES`` lines that many are taken,
in stretches chosen by a hash over the whole text, so the sample is
bounded in bytes too. Scoring reads whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import crf
from . import textkit as T
from .rows import name

#: Bound of the training sample, in documents.
SAMPLE_ROWS = 2000
#: Lines of a document in the sample, taken in stretches of STRETCH lines.
SAMPLE_LINES, STRETCH = 1000, 50
CHUNK = 4 << 20


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[list(chars)] = True
    return t


UPPER = _table(bytes(range(0x41, 0x5B)))
LETTER = _table(bytes([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)]))
DIGIT = _table(bytes(range(0x30, 0x3A)))
SYMBOL = _table(b"#*$%&|<>{}[]\\^~=_/@")
SHOUT = _table(b"!?")
STOP = _table(b".!?:;\"'")


def line_measures(text):
    """Measures [lines, features] of the lines of a batch, their byte lengths and the line offsets of its rows."""
    buf, off = T.text_bytes(text)
    n = len(off) - 1
    # A line ends at a line feed or at the end of its row; both bounds exclude the feed.
    feeds = np.flatnonzero(buf == 0x0A)
    row_of_feed = np.searchsorted(off, feeds, side="right") - 1
    starts = np.concatenate([off[:-1], feeds + 1])
    rows = np.concatenate([np.arange(n), row_of_feed])
    order = np.lexsort((np.concatenate([np.zeros(n, bool), np.ones(len(feeds), bool)]), starts, rows))
    starts, rows = starts[order], rows[order]
    first = np.searchsorted(rows, np.arange(n + 1))
    ends = np.empty(len(starts), dtype=np.int64)
    ends[:-1] = starts[1:] - 1
    ends[first[1:] - 1] = off[1:]

    def count(table):
        acc = np.zeros(len(buf) + 1, dtype=np.int32)
        np.cumsum(table[buf], out=acc[1:])
        return (acc[ends] - acc[starts]).astype(float)

    ws, we, _ = T.words(buf, off)
    wh = T.word_hashes(buf, ws, we)
    w0, w1 = np.searchsorted(ws, starts), np.searchsorted(ws, ends)
    words = (w1 - w0).astype(float)
    # A word equal to the one before it, in the same line.
    same = np.zeros(len(wh) + 1, dtype=np.int32)
    if len(wh):
        same[2:] = np.cumsum(wh[1:] == wh[:-1])
    again = np.where(w1 > w0, same[w1] - same[np.minimum(w0 + 1, len(wh))], 0).astype(float)
    size = (ends - starts).astype(float)
    per_word, per_byte = np.maximum(words, 1), np.maximum(size, 1)
    letters = count(LETTER)
    stop = np.zeros(len(starts))
    full = ends > starts
    stop[full] = STOP[buf[ends[full] - 1]]
    # Lines whose words some line of the same row has too.
    acc = np.zeros(len(wh) + 1, dtype=np.uint64)
    np.cumsum(wh, out=acc[1:])
    key = T.mix(acc[w1] - acc[w0]) + T.mix(rows.astype(np.uint64))
    _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
    x = np.stack([
        np.ones(len(starts)),
        words == 0,
        np.minimum(count(UPPER) / np.maximum(letters, 1), 1),
        np.minimum(count(SYMBOL) / per_word, 3) / 3,
        np.minimum(count(SYMBOL) / per_word, 0.3) / 0.3,
        np.minimum(count(SHOUT) / per_word, 2) / 2,
        count(DIGIT) / per_byte,
        letters / per_byte,
        np.minimum(again / per_word, 1),
        np.minimum(again / per_word, 0.2) / 0.2,
        np.log1p(words) / 8,
        np.minimum(size / per_word / 12, 2),
        stop,
        (times[inverse] > 1) & (words > 3),
    ], axis=1).astype(float)
    return x, size, first


def _model(sample: list):
    """Weights and moves from (label, measures) of the sampled documents."""
    labels = [r[0] for r in sample]
    bad, good = labels.count(0), labels.count(1)
    if not bad or not good:
        width = 3 * line_measures(pa.array([""]))[0].shape[1]
        w = np.zeros((width, 2))
        w[0] = [0.0, np.log((good + 1) / (bad + 1))]
        return w, np.zeros((2, 2))
    x = [np.frombuffer(r[1], dtype="<f4").reshape(r[2], -1).astype(float) for r in sample]
    lengths = np.array([len(a) for a in x])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    y = np.repeat(labels, lengths)
    return crf.train(crf.with_neighbours(np.concatenate(x), starts, lengths), y, starts, lengths, 2)


def _some_lines(x: np.ndarray) -> np.ndarray:
    """All measures of a document, or those of ``SAMPLE_LINES`` lines in stretches from anywhere in it."""
    if len(x) <= SAMPLE_LINES:
        return x
    stretches = np.arange(-(-len(x) // STRETCH), dtype=np.uint64)
    use = np.sort(np.argsort(T.mix(stretches, len(x)), kind="stable")[:SAMPLE_LINES // STRETCH])
    return np.concatenate([x[i * STRETCH:(i + 1) * STRETCH] for i in use.tolist()])


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
            rows: int) -> list:
    """(label, measures, lines) of the sampled labelled documents, in the order of their ids."""
    agreed = (labels.select(F.col(name(id_col)).cast("long").alias("d"), F.col(name(label_col)).cast("int").alias("y"))
              .where(F.col("d").isNotNull() & F.col("y").isin(0, 1)).groupBy("d")
              .agg(F.min("y").alias("y"), F.max("y").alias("y2")).where(F.col("y") == F.col("y2")))
    # The labels are bounded by ``rows``; an id may still have any number of rows.
    some = agreed.orderBy(F.xxhash64("d"), "d").limit(rows).select("d", "y")
    text = docs.select(F.col(name(id_col)).cast("long").alias("d"), F.col(name(text_col)).alias("text"))
    both = text.join(F.broadcast(some), "d").select("d", "y", "text")

    def run(batches):
        for b in batches:
            for part in T.chunks(b, "text", CHUNK):
                x, _, first = line_measures(part.column("text"))
                xs = [_some_lines(x[a:c]).astype("<f4") for a, c in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("d"), part.column("y"), pa.array([m.tobytes() for m in xs], type=pa.binary()),
                     pa.array([len(m) for m in xs], type=pa.int32())], names=["d", "y", "x", "n"])

    # One row per document, whatever the partitions: the least measures. Partial aggregation reduces a hot id's rows.
    one = (both.mapInArrow(run, "d long, y int, x binary, n int").groupBy("d")
           .agg(F.min("y").alias("y"), F.min(F.struct("x", "n")).alias("m")))
    return [(r.y, bytes(r.m.x), r.m.n) for r in sorted(one.collect(), key=lambda r: r.d)]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample_rows: int = SAMPLE_ROWS):
    """The model: weights and moves, learned from a bounded sample of the labelled documents."""
    return _model(_sample(docs, labels, id_col, text_col, label_col, sample_rows))


def score(docs: DataFrame, model, text_col: str = "text") -> DataFrame:
    """``row`` and ``score``, the length-weighted mean marginal of "good" over the lines."""
    docs = docs.select(F.struct(*[F.col(name(c)) for c in docs.columns]).alias("row"))
    weights, move = model

    def run(batches):
        for part, text in T.pieces(batches, text_col, CHUNK):
            x, size, first = line_measures(text)
            starts, lengths = first[:-1], np.diff(first)
            log_p = crf.forward_backward(crf.with_neighbours(x, starts, lengths) @ weights, move, starts, lengths)[0]
            weight = size + 1
            good = np.add.reduceat(np.exp(log_p[:, 1]) * weight, starts) / np.add.reduceat(weight, starts)
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(np.clip(good, 0, 1))],
                                             names=["row", "score"])

    return docs.mapInArrow(run, T.row_schema(docs, "score double"))


def held_out(c):
    """Rows kept for testing: crc32 of the id's text leaves 1 modulo 3 (a null id: no)."""
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out(F.col("doc_id")))
    out = score(docs, fit(docs, labels))
    return out.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
