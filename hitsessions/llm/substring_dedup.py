"""Substring deduplication by level-wise doubling.

A run of ``window`` words is repeated if the same words start anywhere
else, in this document or another. Such runs are found from short to
long: a run can only be repeated if the shorter runs inside it are. The
first level counts short runs, at places selected by content (the
smallest hash among the short runs of each window, so equal windows
select equal places); runs repeated at one length are extended to twice
that length on either side, and counted again, until the length reaches
the window. Whole windows are then counted exactly, by a 96-bit key.

Defined cases
-------------
* Null or empty text, or fewer words than a window: nothing is removed.
* All occurrences are removed, the first included; windows are judged on
  the input, not on what is left.
* A fully repeated row counts as another place. Rows that share an id are
  judged separately. A null id is an id of its own.
* Other columns, whatever their names, are carried in ``row``.

Scale: one scan and one small aggregation per level; what a level passes
to the next is a sieve (a bitmap of fixed size, see ``sieve``), so no
level joins. The last join brings back the exactly repeated windows; a
passage that a third of all documents share is a skewed key there, which
Spark splits. Only documents with a removal are shuffled with their text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sieve
from . import textkit as T
from .rows import KEY, KEY_SCHEMA, name, row_key, written

WINDOW = 35


def levels(window: int) -> list[int]:
    """Lengths of the runs counted before the window: a quarter, doubled while shorter."""
    out = [max(1, -(-window // 4))]
    while out[-1] * 2 < window:
        out.append(out[-1] * 2)
    return out


class Places:
    """Windows of a batch of texts, and the places they select."""

    def __init__(self, text, window: int, seed: int):
        self.buf, self.off = T.text_bytes(text)
        self.starts, self.ends, self.rows = T.words(self.buf, self.off)
        self.words = T.word_hashes(self.buf, self.starts, self.ends)
        self.window, self.seed = window, seed
        n = len(self.words)
        # Windows that lie inside one row.
        last = np.repeat(self.rows[1:], np.diff(self.rows))
        self.at = np.flatnonzero(np.arange(n) + window <= last)
        self._runs: dict[int, np.ndarray] = {}
        span = window - seed + 1
        self.pick = T._sliding_argmin(self.run(seed), span)[self.at] if len(self.at) else self.at

    def run(self, length: int) -> np.ndarray:
        """Hash of the run of ``length`` words at every place."""
        if length not in self._runs:
            self._runs[length] = T.window_hashes(self.words, length)
        return self._runs[length]

    def seeds(self) -> np.ndarray:
        return self.run(self.seed)[np.unique(self.pick)]

    def sides(self, length: int):
        """Per window: whether its place, extended right or left to ``length``, lies inside; where the left one starts."""
        before = self.pick - self.at  # words of the window before its place
        return before + length <= self.window, before >= length - self.seed, self.pick + self.seed - length

    def extended(self, length: int, alive: np.ndarray) -> np.ndarray:
        """Hashes of the runs of ``length`` words that the places of living windows extend to."""
        right, left, start = self.sides(length)
        places = np.unique(np.concatenate([self.pick[alive & right], start[alive & left]]))
        return self.run(length)[places]

    def alive(self, sieves: list[np.ndarray], lengths: list[int]) -> np.ndarray:
        """Windows all of whose counted runs may be repeated."""
        out = np.ones(len(self.at), dtype=bool)
        for s, length in zip(sieves, lengths):
            if not out.any():
                break
            right, left, start = self.sides(length)
            run = self.run(length)
            use = np.flatnonzero(out & right)
            out[use] = sieve.hit(s, run[self.pick[use]])
            use = np.flatnonzero(out & left) if length > self.seed else use[:0]
            out[use] = sieve.hit(s, run[start[use]])
        return out

    def keys(self, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place and 96-bit key of the living windows."""
        at = self.at[alive]
        if not len(at):
            return at, np.zeros(0, np.uint64), np.zeros(0, np.int32)
        second = T.window_hashes(self.words, self.window, T.WINDOW_BASES[1])
        return at, self.run(self.window)[at], (second[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """d, t, u (see ``row_key``) and text."""
    return docs.select(*row_key(docs, id_col, text_col), F.coalesce(docs[name(text_col)], F.lit("")).alias("text"))


def _parts(batches):
    for b in batches:
        if len(b):
            yield from T.chunks(b, "text")


def _counted(hashes: np.ndarray) -> pa.RecordBatch:
    key, n = np.unique(hashes, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(T.signed(key)), pa.array(n.astype(np.int64))], names=["key", "n"])


def find_levels(base: DataFrame, window: int, bits: int):
    """Broadcast sieves of the runs that are repeated at each length."""
    lengths, sieves = levels(window), []
    for k, length in enumerate(lengths):
        def count(batches, length=length, k=k, below=tuple(sieves)):
            for part in _parts(batches):
                p = Places(part.column("text"), window, lengths[0])
                if k == 0:
                    yield _counted(p.seeds())
                else:
                    yield _counted(p.extended(length, p.alive([s.value for s in below], lengths)))

        counts = base.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        sieves.append(sieve.build(counts.where("n > 1").select("key"), bits))
    return lengths, sieves


def repeated_windows(base: DataFrame, window: int, bits: int) -> DataFrame:
    """d, t, u, starts: the places in each text where a repeated window starts."""
    lengths, sieves = find_levels(base, window, bits)
    places = counted_windows(base, window, lengths[0], bits,
                             lambda p: p.alive([s.value for s in sieves], lengths))
    return places.groupBy(*KEY).agg(F.collect_set("at").alias("starts"))


def counted_windows(base: DataFrame, window: int, seed: int, bits: int, chosen) -> DataFrame:
    """d, t, u, at: the places of the windows that ``chosen`` marks and that start elsewhere too.

    ``chosen`` takes the ``Places`` of a batch; it must mark all
    occurrences of a window or none.
    """
    def count(batches):
        for part in _parts(batches):
            p = Places(part.column("text"), window, seed)
            _, k1, k2 = p.keys(chosen(p))
            both = np.zeros(len(k1), dtype=[("a", np.int64), ("b", np.int32)])
            both["a"], both["b"] = T.signed(k1), k2
            one, n = np.unique(both, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(one["a"])), pa.array(np.ascontiguousarray(one["b"])),
                 pa.array(n.astype(np.int64))], names=["k1", "k2", "n"])

    twice = written(base.select("text").mapInArrow(count, "k1 long, k2 int, n long").groupBy("k1", "k2")
                    .agg(F.sum("n").alias("n")).where("n > 1").select("k1", "k2"), "windows")
    whole = sieve.build(twice.select(F.col("k1").alias("key")), bits)

    def place(batches):
        for part in _parts(batches):
            p = Places(part.column("text"), window, seed)
            at, k1, k2 = p.keys(chosen(p))
            use = sieve.hit(whole.value, k1)
            at, k1, k2 = at[use], k1[use], k2[use]
            row = np.searchsorted(p.rows, at, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(T.signed(k1)), pa.array(k2), *(part.column(c).take(pa.array(row)) for c in KEY),
                 pa.array((at - p.rows[row]).astype(np.int32))],
                names=["k1", "k2", *KEY, "at"])

    return (base.mapInArrow(place, f"k1 long, k2 int, {KEY_SCHEMA}, at int").join(twice, ["k1", "k2"])
            .select(*KEY, "at"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   bits: int = sieve.SIEVE_BITS) -> DataFrame:
    """``row, n_words, n_removed, kept``: the words outside all repeated windows, joined by a space."""
    base = keyed(docs, id_col, text_col)
    return without(docs, repeated_windows(base, window, bits), id_col, text_col, window, bits)


def without(docs: DataFrame, found: DataFrame, id_col: str, text_col: str, window: int, bits: int) -> DataFrame:
    """``row, n_words, n_removed, kept`` of every row, given the starts of the windows to remove."""
    found = written(found, "starts")
    touched = sieve.build(found.select(F.col("d").alias("key")), bits)
    rows = docs.select(F.struct(*[F.col(name(c)) for c in docs.columns]).alias("row"),
                       *row_key(docs, id_col, text_col))

    # Clean rows are finished where they are read; only the others meet their windows in a shuffle.
    def finish_clean(batches):
        for b in batches:
            yield from _cut(b.filter(_hits(b, touched.value, False)), text_col, window)

    def pick_hits(batches):
        for b in batches:
            yield b.filter(_hits(b, touched.value, True))

    def finish(batches):
        for b in batches:
            yield from _cut(b, text_col, window)

    done = T.row_schema(rows, "n_words long, n_removed long, kept string")
    clean = rows.mapInArrow(finish_clean, done)
    hits = rows.mapInArrow(pick_hits, T.row_schema(rows, KEY_SCHEMA)).join(found, KEY, "left")
    return clean.unionByName(hits.select("row", "starts").mapInArrow(finish, done))


def _hits(batch, touched: np.ndarray, want: bool):
    return pa.array(sieve.hit(touched, np.array(batch.column("d"), dtype=np.int64)) == want)


def _cut(batch, text_col: str, window: int):
    """Finished rows of a batch; without a column of starts nothing is removed."""
    starts = batch.column("starts") if "starts" in batch.schema.names else pa.nulls(len(batch), pa.list_(pa.int32()))
    at = 0
    for part, text in T.pieces([batch], text_col):
        cut = cut_words(text, starts.slice(at, len(part)), window)
        at += len(part)
        yield pa.RecordBatch.from_arrays([part.column("row"), *cut], names=["row", "n_words", "n_removed", "kept"])


def cut_words(text, starts, window: int):
    """Word count, removed words and kept text of each row."""
    buf, off = T.text_bytes(text)
    data = buf.tobytes()
    n_words, n_removed, kept = [], [], []
    for a, b, s in zip(off[:-1].tolist(), off[1:].tolist(), starts):
        words = data[a:b].split()
        n_words.append(len(words))
        if s.is_valid and len(s):
            edge = np.zeros(len(words) + 1, dtype=np.int64)
            at = np.array(s.values)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + window, -1)
            keep = np.cumsum(edge[:-1]) == 0
            words = [w for w, k in zip(words, keep.tolist()) if k]
        n_removed.append(n_words[-1] - len(words))
        kept.append(b" ".join(words).decode("utf-8", "replace"))
    return pa.array(n_words, type=pa.int64()), pa.array(n_removed, type=pa.int64()), pa.array(kept, type=pa.string())


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = remove_repeats(docs)
    return out.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def oracle(window: int) -> str:
    """DuckDB: the words that no repeated window covers."""
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT r, p, array_to_string(list_slice(w, p, p + {window - 1}), ' ') AS words
  FROM (SELECT r, w, unnest(range(1, len(w) - {window - 2})) AS p FROM texts)
), repeated AS (
  SELECT r, p FROM windows SEMI JOIN (SELECT words FROM windows GROUP BY words HAVING count(*) > 1) USING (words)
), covered AS (
  SELECT DISTINCT r, unnest(range(p, p + {window})) AS pos FROM repeated
), places AS (
  SELECT r, generate_subscripts(w, 1) AS pos, unnest(w) AS word FROM texts
), kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS t FROM places ANTI JOIN covered USING (r, pos) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)
"""


ORACLE = oracle(WINDOW)
