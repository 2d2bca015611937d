"""Suffix-array deduplication on a sparse, distributed suffix array.

Passages of at least ``window`` words that stand in two places are
removed. Only suffixes at content-selected places are kept: in every
window of that many words, the place with the smallest hash of ``seed``
words, so two equal windows keep the same place. Suffixes are sorted by
ladders of hashes: of the words to the right (the seed, half a window, a
window), then of the words to the left. Neighbours in that order are
compared, and the match is extended right and left as far as their
ladders agree. What neighbours leave open (the ends of passages, where
the order of one side hides the other) is decided by an exact count of
the windows at those seeds.

Defined cases
-------------
* Null or empty text, or fewer words than a window: nothing is removed.
* All occurrences are removed, the first included, also within a document.
* A fully repeated row counts as another place. Rows that share an id are
  judged separately. A null id is an id of its own.
* Other columns, whatever their names, are carried in ``row``.

Scale: suffixes are range-partitioned by their whole sort key with the
place as its last part, so a passage that a third of all documents share
is cut across partitions like any other. A partition's first and last
suffix lack a neighbour; the exact count decides them. Seeds that occur
once never enter the sort (a sieve, see ``sieve``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sieve
from . import textkit as T
from .rows import KEY, KEY_SCHEMA, written
from .substring_dedup import Places, _counted, _parts, counted_windows, keyed, oracle, without

WINDOW, SEED = 50, 12
LADDER = ["h", "r1", "r2", "l1", "l2", "l3"]
SORTED = [*LADDER, *KEY, "at"]
SUFFIX = f"h long, r1 long, r2 long, l1 long, l2 long, l3 long, {KEY_SCHEMA}, at int, first int, last int"


def ladders(window: int, seed: int) -> tuple[list[int], list[int]]:
    """Lengths hashed to the right (beside the seed) and to the left of a place."""
    before = window - seed
    return [max(seed, window // 2), window], [max(1, before // 3), max(1, 2 * before // 3), max(1, before)]


def _suffixes(base: DataFrame, window: int, seed: int, seeds) -> DataFrame:
    """The kept suffixes: ladders, place, and the first and last window that select the place."""
    right, left = ladders(window, seed)

    def run(batches):
        for part in _parts(batches):
            p = Places(part.column("text"), window, seed)
            use = np.flatnonzero(sieve.hit(seeds.value, p.run(seed)[p.pick])) if len(p.at) else p.at
            at, pick = p.at[use], p.pick[use]
            begin = np.flatnonzero(np.concatenate([[True], pick[1:] != pick[:-1]])) if len(pick) else use
            end = np.concatenate([begin[1:], [len(pick)]]) - 1 if len(pick) else use
            place = pick[begin]
            row = np.searchsorted(p.rows, place, side="right") - 1
            lo, hi = p.rows[row], p.rows[row + 1]
            cols = [T.signed(p.run(seed)[place])] if len(place) else [np.zeros(0, np.int64)]
            for length in right:
                cols.append(_side(p, place, length, place + length <= hi))
            for length in left:
                cols.append(_side(p, place - length, length, place - length >= lo))
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, cols), *(part.column(c).take(pa.array(row)) for c in KEY),
                 *(pa.array((x - lo).astype(np.int32)) for x in (place, at[begin], at[end]))],
                names=[*SORTED, "first", "last"])

    return base.mapInArrow(run, SUFFIX)


def _side(p: Places, start: np.ndarray, length: int, inside: np.ndarray) -> np.ndarray:
    """Hashes of the words on one side, 0 where the text has fewer."""
    out = np.zeros(len(start), dtype=np.int64)
    if inside.any():
        out[inside] = T.signed(p.run(length)[start[inside]])
    return out


def _compare(window: int, seed: int):
    """Compares neighbours of a sorted partition: confirmed windows, and seeds with windows left open."""
    right, left = ladders(window, seed)

    def shared(x: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Words that each suffix and the next one share to the right (0: not even the seed) and to the left."""
        same = {c: (x[c][1:] == x[c][:-1]) & ((x[c][1:] != 0) | (c == "h")) for c in LADDER}
        r = np.where(same["h"], seed, 0)
        for c, length in zip(("r1", "r2"), right):
            r = np.where(same["h"] & same[c], length, r)
        to_left = np.zeros(len(r), dtype=np.int64)
        for c, length in zip(("l1", "l2", "l3"), left):
            to_left = np.where(same["h"] & same[c], length, to_left)
        return r, to_left

    def emit(x, lo, hi, open_):
        """One row per suffix: its confirmed windows lo..hi (empty if lo > hi), and its seed if some are open."""
        return pa.RecordBatch.from_arrays(
            [*(pa.array(x[c]) for c in KEY), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)),
             pa.array(x["h"], mask=~open_)], names=[*KEY, "lo", "hi", "open"])

    def run(batches):
        rest = None  # the last suffix so far, whose next neighbour is still to come
        for b in batches:
            if not len(b):
                continue
            x = {c: np.array(b.column(c)) for c in b.schema.names}
            x["lo"], x["hi"] = x["last"] + 1, x["first"] - 1
            if rest is not None:
                x = {c: np.concatenate([rest[c], x[c]]) for c in x}
            r, to_left = shared(x)
            for mine, pair in ((slice(0, -1), slice(None)), (slice(1, None), slice(None))):
                lo = np.maximum(x["first"][mine], x["at"][mine] - to_left[pair])
                hi = np.minimum(x["last"][mine], x["at"][mine] + r[pair] - window)
                found = (r[pair] > 0) & (lo <= hi)
                had = x["lo"][mine] <= x["hi"][mine]
                # Two neighbours' ranges both hold; where they meet, the union is one range.
                meet = found & had & (lo <= x["hi"][mine] + 1) & (hi >= x["lo"][mine] - 1)
                longer = found & had & ~meet & (hi - lo > x["hi"][mine] - x["lo"][mine])
                new = (found & ~had) | longer
                a = np.where(meet, np.minimum(lo, x["lo"][mine]), np.where(new, lo, x["lo"][mine]))
                z = np.where(meet, np.maximum(hi, x["hi"][mine]), np.where(new, hi, x["hi"][mine]))
                x["lo"][mine], x["hi"][mine] = a, z
            rest = {c: v[-1:] for c, v in x.items()}
            done = {c: v[:-1] for c, v in x.items()}
            if len(done["h"]):
                yield emit(done, done["lo"], done["hi"], (done["lo"] > done["first"]) | (done["hi"] < done["last"]))
        if rest is not None:
            yield emit(rest, rest["lo"], rest["hi"], (rest["lo"] > rest["first"]) | (rest["hi"] < rest["last"]))

    return run


def repeated_places(base: DataFrame, window: int, seed: int, bits: int) -> DataFrame:
    """d, t, u, starts: the places in each text where a repeated window starts."""
    def seeds(batches):
        for part in _parts(batches):
            yield _counted(Places(part.column("text"), window, seed).seeds())

    counts = base.select("text").mapInArrow(seeds, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    twice = sieve.build(counts.where("n > 1").select("key"), bits)
    order = _suffixes(base, window, seed, twice).repartitionByRange(*SORTED).sortWithinPartitions(*SORTED)
    matched = written(order.mapInArrow(_compare(window, seed), f"{KEY_SCHEMA}, lo int, hi int, open long"), "matched")
    left_open = sieve.build(matched.where("open is not null").select(F.col("open").alias("key")).distinct(), bits)

    def undecided(p: Places) -> np.ndarray:
        return sieve.hit(left_open.value, p.run(seed)[p.pick]) if len(p.at) else np.zeros(0, dtype=bool)

    counted = counted_windows(base, window, seed, bits, undecided)
    sure = matched.where("lo <= hi").select(*KEY, F.explode(F.sequence("lo", "hi")).alias("at"))
    return sure.union(counted).groupBy(*KEY).agg(F.collect_set("at").alias("starts"))


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    seed: int = SEED, bits: int = sieve.SIEVE_BITS) -> DataFrame:
    """``row, n_words, n_removed, kept``: the words outside all repeated passages, joined by a space."""
    base = keyed(docs, id_col, text_col)
    return without(docs, repeated_places(base, window, seed, bits), id_col, text_col, window, bits)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = remove_passages(docs)
    return out.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = oracle(WINDOW)
