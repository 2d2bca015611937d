"""Ranked lexical search: MaxScore with bounds for pairs of terms.

The index is made once from all documents: blocks of neighbouring
documents, each with the postings of its terms (positions and counts),
and the corpus statistics. Terms that many documents hold would keep
MaxScore from skipping: each is weak, but their independent maxima add up.
For the most frequent terms the index therefore also holds, per block, the
joint maximum impact of every pair: the most that any one document of the
block gets from both. A query's frequent terms are matched into pairs,
those that lower the bound most first, and a group of terms is bounded by
the sum over its pairs, not by the sum of its maxima.

Search keeps the best documents of each query while it goes from block to
block. A block whose bound is below the score of the last of them is
skipped; in the others only documents of the essential terms are looked
at, and the rest of the terms is added strongest first, for documents that
can still get into the list.

Scores are integers (``weight``, ``impacts``), so results don't depend on
any order of additions.

Defined cases
-------------
* Null text or a text without terms: not in N, never found. An item
  without terms, or without a document that scores above 0, has no rows.
* Every row is a document of its own: rows that share an id are ranked one
  by one, also equal ones. Items likewise; equal texts are searched once.
* A null id sorts before all others, and comes back as null.
* Empty tables: no rows. Only the id and the text are read.

Scale: the index is linear in the text, made in one pass without a
shuffle; the corpus statistics are partial sums. A search reads the
postings of its terms alone and deals them by block: a block holds a
bounded number of words (or one document), so a common term is spread like
the documents. Each task hands on ``k`` rows per query. Queries go out in
groups of bounded size.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textkit as T
from .rows import NULL_ID, id_of, name, removed, written

#: Documents listed per item.
K = 20
#: Terms, by the documents that hold them, whose pairs get joint maxima.
PAIR_TERMS = 96
#: Bytes of text in a block (one document at least).
BLOCK_BYTES = 1 << 20
#: Distinct terms of the queries that are searched together.
GROUP_TERMS = 200_000
#: Bytes that belong to terms: digits, letters and everything above ASCII.
TERM = np.zeros(256, dtype=bool)
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    TERM[_a:_b] = True
#: ``term`` of the rows that hold a block's documents and its pairs.
DOCS, PAIRS = "docs", "pairs"


def weight(n_docs: int, df: int) -> int:
    """Weight of a term that ``df`` of ``n_docs`` documents hold."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factor(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents with ``n`` terms, of a corpus of ``n_docs`` documents with ``n_terms`` terms."""
    return 100 - 25 + (25 * n * n_docs) // n_terms


def saturated(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def terms_of(text) -> tuple[np.ndarray, np.ndarray]:
    """Term hashes of a string column, and the term offsets of its rows."""
    buf, off = T.text_bytes(text)
    buf = T.lower_ascii(buf)
    starts, ends, rows = T.words(buf, off, TERM)
    return T.word_hashes(buf, starts, ends), rows


# ------------------------------------------------------------------ index

def _postings(batch: pa.RecordBatch):
    """Per term of a block: hash, and the positions and counts of its documents."""
    h, rows = terms_of(batch.column("text"))
    n = np.diff(rows)
    doc = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((doc, h))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    tf = np.diff(np.append(at, len(h)))
    h, doc = h[at], doc[at]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else at
    return n, h[first], np.append(first, len(h)), doc.astype(np.int32), tf.astype(np.int32)


def _slices(values: np.ndarray, off: np.ndarray) -> pa.Array:
    """A binary column of consecutive parts of an array."""
    off = (off * values.itemsize).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(off) - 1,
                                 [None, pa.py_buffer(off.tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())])


def _cast(column: pa.Array) -> pa.Array:
    return column.cast(pa.binary())


POSTINGS = "block long, kind string, term long, n long, terms long, places binary, counts binary"
_NAMES = ["block", "kind", "term", "n", "terms", "places", "counts"]


def postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of the index: per block its documents (``kind`` docs), and per block and term its postings.

    ``docs`` rows hold the ids and the numbers of terms of the block's
    documents, ``n`` those with a term and ``terms`` all terms. The others
    hold the places of the term's documents in the block, and its counts.
    """
    rows = docs.select(id_of(docs[name(id_col)]).alias("d"), docs[name(text_col)].alias("text"),
                       F.monotonically_increasing_id().alias("block"))

    def run(batches):
        for batch in batches:
            for part in T.chunks(batch, "text", BLOCK_BYTES) if len(batch) else ():
                block = part.column("block")[0].as_py()
                n, h, off, doc, tf = _postings(part)
                ids = np.asarray(part.column("d"), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), pa.array([DOCS]), pa.array([0], pa.int64()), pa.array([int((n > 0).sum())]),
                     pa.array([int(n.sum())]), pa.array([ids.tobytes()], pa.binary()),
                     pa.array([n.astype(np.int64).tobytes()], pa.binary())], names=_NAMES)
                for a in range(0, len(h), 20_000):
                    b = min(a + 20_000, len(h))
                    cut, lo = off[a:b + 1] - off[a], off[a]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(b - a, block)), pa.array(["term"] * (b - a)), pa.array(T.signed(h[a:b])),
                         pa.array(np.diff(cut).astype(np.int64)), pa.array([0] * (b - a), pa.int64()),
                         _cast(_slices(doc[lo:off[b]], cut)), _cast(_slices(tf[lo:off[b]], cut))], names=_NAMES)

    return rows.mapInArrow(run, POSTINGS)


class Index:
    """A written index: ``postings``, the number of documents and terms, and the pairs' joint maxima.

    ``frequent`` maps the terms with pairs to their place in a ``pairs``
    row, which holds one maximum per pair of places.
    """

    def __init__(self, table: DataFrame, pairs: DataFrame, n_docs: int, n_terms: int, frequent: dict[int, int]):
        self.table, self.pairs, self.n_docs, self.n_terms, self.frequent = table, pairs, n_docs, n_terms, frequent

    def remove(self) -> None:
        """Delete the written tables."""
        removed(self.table, self.pairs)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pair_terms: int = PAIR_TERMS) -> Index:
    """The index of all rows of ``docs``, in the shared work folder."""
    table = written(postings(docs, id_col, text_col), "postings")
    total = table.where(F.col("kind") == DOCS).agg(F.sum("n").alias("n"), F.sum("terms").alias("t")).first()
    n_docs, n_terms = int(total.n or 0), int(total.t or 0)
    # The most frequent terms: at most pair_terms rows.
    top = (table.where(F.col("kind") == "term").groupBy("term").agg(F.sum("n").alias("df"))
           .orderBy(F.desc("df"), "term").limit(pair_terms).collect())
    top = {r.term: (i, weight(n_docs, r.df)) for i, r in enumerate(top)}
    pairs = written(_pair_maxima(table, top, n_docs, n_terms), "pairs")
    return Index(table, pairs, n_docs, n_terms, {t: i for t, (i, _) in top.items()})


def _by_block(df: DataFrame, work, schema: str) -> DataFrame:
    """``work`` over the rows of whole blocks, a task's blocks one after the other."""
    def run(batches):
        state, now, rows = work(), None, []
        for b in batches:
            for r in b.to_pylist():
                if r["block"] != now and rows:
                    yield from state.block(rows)
                    rows = []
                now = r["block"]
                rows.append(r)
        if rows:
            yield from state.block(rows)
        yield from state.end()

    return df.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(run, schema)


class _Block:
    """Impacts of a block: per term the places of its documents and what the term adds to their scores."""

    def __init__(self, rows: list[dict], weights: dict[int, int], n_docs: int, n_terms: int):
        head = next(r for r in rows if r["kind"] == DOCS)
        self.ids = np.frombuffer(head["places"], dtype=np.int64)
        m = length_factor(np.frombuffer(head["counts"], dtype=np.int64), n_docs, max(n_terms, 1))
        self.places, self.impacts, self.most = {}, {}, {}
        for r in rows:
            if r["kind"] == "term" and r["term"] in weights:
                at = np.frombuffer(r["places"], dtype=np.int32)
                x = weights[r["term"]] * saturated(np.frombuffer(r["counts"], dtype=np.int32).astype(np.int64), m[at])
                self.places[r["term"]], self.impacts[r["term"]], self.most[r["term"]] = at, x, int(x.max())


def _pair_maxima(table: DataFrame, top: dict, n_docs: int, n_terms: int) -> DataFrame:
    """block, kind, and per pair of frequent terms the most that one document of the block gets from it."""
    weights = {t: w for t, (_, w) in top.items()}

    class Work:
        def block(self, rows):
            b = _Block(rows, weights, n_docs, n_terms)
            dense = np.zeros((len(top), len(b.ids)), dtype=np.int64)
            for t, at in b.places.items():
                dense[top[t][0], at] = b.impacts[t]
            joint = np.zeros((len(top), len(top)), dtype=np.int64)
            for i in range(len(top)):
                # One term alone is in the maximum too: a document may hold only one of the two.
                joint[i] = (dense + dense[i]).max(axis=1, initial=0)
            yield pa.RecordBatch.from_arrays([pa.array([rows[0]["block"]]), pa.array([PAIRS]),
                                              pa.array([joint.tobytes()], pa.binary())], names=["block", "kind", "places"])

        def end(self):
            return ()

    some = table.where((F.col("kind") == DOCS) | F.col("term").isin(list(top)))
    return _by_block(some, Work, "block long, kind string, places binary")


# ----------------------------------------------------------------- search

class Plan:
    """The terms of a query with their counts, as the search needs them."""

    def __init__(self, bag: tuple[tuple[int, int], ...], weights: dict[int, int], frequent: dict[int, int]):
        self.terms = [(t, q) for t, q in bag if weights.get(t)]
        self.frequent = {t: frequent[t] for t, _ in self.terms if t in frequent}

    def units(self, block: _Block, joint: np.ndarray | None) -> list[list[tuple[int, tuple]]]:
        """Ways to bound the query in a block: lists of (bound, terms), weakest first.

        One list has the terms one by one; another one, where pairs lower
        the bound, has some of them in pairs.
        """
        here = {t: q for t, q in self.terms if t in block.most}
        single = {t: (q * block.most[t], ((t, q),)) for t, q in here.items()}
        ways = [sorted(single.values())]
        both = [t for t in self.frequent if t in here] if joint is not None else []
        if len(both) < 2:
            return ways
        at = np.array([self.frequent[t] for t in both])
        most, q = np.array([block.most[t] for t in both]), np.array([here[t] for t in both])
        # q1 * x + q2 * y <= min(q1, q2) * joint + what is left of the other one alone.
        least = np.minimum.outer(q, q)
        bound = least * joint[np.ix_(at, at)] + (q[:, None] - least) * most[:, None] + (q[None, :] - least) * most[None, :]
        gain = np.triu((q * most)[:, None] + (q * most)[None, :] - bound, 1)
        i, j = np.nonzero(gain > 0)
        paired, pairs = set(), []
        for x in np.argsort(-gain[i, j], kind="stable").tolist():
            a, b = int(i[x]), int(j[x])
            if a not in paired and b not in paired:
                paired |= {a, b}
                pairs.append((int(bound[a, b]), ((both[a], int(q[a])), (both[b], int(q[b])))))
        if pairs:
            taken = {both[i] for i in paired}
            ways.append(sorted(pairs + [u for t, u in single.items() if t not in taken]))
        return ways


def _look_up(places: np.ndarray, impacts: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Impacts of a term in some documents (0 where it isn't)."""
    at = np.searchsorted(places, docs)
    at[at == len(places)] = 0
    return np.where(places[at] == docs, impacts[at], 0)


def _split(block: _Block, units: list, least: int) -> tuple[np.ndarray, int, int] | None:
    """Bounds of the units' prefixes, the first essential unit, and the postings from there on; None: no document can do it."""
    bounds = np.cumsum([0, *(u for u, _ in units)])
    if bounds[-1] < least:
        return None
    # The units before this one can't lift a document to the bound all together.
    essential = max(int(np.searchsorted(bounds, least, side="left")) - 1, 0)
    return bounds, essential, sum(len(block.places[t]) for _, terms in units[essential:] for t, _ in terms)


def candidates(block: _Block, ways: list, least: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents of the block that score ``least`` (1 at least) or more, their scores, and the postings looked at.

    Of the ways to bound the query the one with the fewest postings is
    taken; if one of them rules the block out, it is skipped.
    """
    none = np.zeros(0, dtype=np.int64)
    splits = [_split(block, units, least) for units in ways]
    if None in splits or not ways[0]:
        return none, none, 0
    units, (bounds, essential, looked) = min(zip(ways, splits), key=lambda w: w[1][2])
    score = np.zeros(len(block.ids), dtype=np.int64)
    for _, terms in units[essential:]:
        for t, q in terms:
            score[block.places[t]] += q * block.impacts[t]
    docs = np.flatnonzero(score)
    score = score[docs]
    for i in range(essential - 1, -1, -1):
        alive = score + bounds[i + 1] >= least
        docs, score = docs[alive], score[alive]
        if not len(docs):
            break
        for t, q in units[i][1]:
            score = score + q * _look_up(block.places[t], block.impacts[t], docs)
    keep = score >= least
    return docs[keep], score[keep], looked


def _best(score: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((d, -score))[:k]
    return score[order], d[order]


def search(index: Index, bags: list[tuple], k: int = K) -> DataFrame:
    """query (place in ``bags``), d, score: the ``k`` best documents of each bag of (term hash, count)."""
    table, n_docs, n_terms = index.table, index.n_docs, index.n_terms
    spark: SparkSession = table.sparkSession
    wanted = sorted({t for bag in bags for t, _ in bag})
    asked = spark.createDataFrame(pa.table({"term": pa.array(wanted, pa.int64())}))  # GROUP_TERMS of them at most
    mine = table.where(F.col("kind") == "term").join(F.broadcast(asked), "term", "left_semi")
    df = mine.groupBy("term").agg(F.sum("n").alias("df")).collect()
    weights = {r.term: weight(n_docs, r.df) for r in df}
    plans = [Plan(bag, weights, index.frequent) for bag in bags]
    shared = spark.sparkContext.broadcast((weights, plans))
    n_frequent = len(index.frequent)

    class Work:
        def __init__(self):
            self.weights, self.plans = shared.value
            self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in self.plans]

        def block(self, rows):
            b = _Block(rows, self.weights, n_docs, n_terms)
            joint = next((np.frombuffer(r["places"], dtype=np.int64).reshape(n_frequent, n_frequent)
                          for r in rows if r["kind"] == PAIRS), None)
            for i, plan in enumerate(self.plans):
                score, d = self.best[i]
                least = int(score[-1]) if len(score) == k else 1
                docs, found, _ = candidates(b, plan.units(b, joint), least)
                if len(docs):
                    self.best[i] = _best(np.concatenate([score, found]), np.concatenate([d, b.ids[docs]]), k)
            return ()

        def end(self):
            for i, (score, d) in enumerate(self.best):
                if len(score):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(d), i, dtype=np.int64)), pa.array(d),
                                                      pa.array(score)], names=["query", "d", "score"])

    cols = ["block", "kind", "term", "n", "places", "counts"]
    rows = (mine.select(*cols).union(table.where(F.col("kind") == DOCS).select(*cols))
            .unionByName(index.pairs, allowMissingColumns=True))
    found = _by_block(rows, Work, "query long, d long, score long")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "d"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _groups(items: DataFrame, id_col: str, text_col: str):
    """Items as {bag: [item ids]}, in groups of about ``GROUP_TERMS`` terms; one item at a time reaches the driver."""
    group, size = defaultdict(list), 0
    for r in items.select(F.col(name(id_col)).alias("i"), F.col(name(text_col)).alias("t")).toLocalIterator():
        h, _ = terms_of(pa.array([r.t], pa.string()))
        bag = tuple(sorted(Counter(T.signed(h).tolist()).items()))
        if not bag:
            continue
        size += 0 if bag in group else len(bag)
        group[bag].append(r.i)
        if size >= GROUP_TERMS:
            yield group
            group, size = defaultdict(list), 0
    if group:
        yield group


def rank_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_id_col: str = "item_id", item_text_col: str = "text", k: int = K,
                   index: Index | None = None) -> DataFrame:
    """item_id, rank, d, score: the ``k`` documents with the highest scores for every item.

    Equal scores are ranked by the id. ``index`` is an index of ``docs``
    (default: made here, removed with the results written).
    """
    spark = docs.sparkSession
    id_type = items.schema[item_id_col].dataType.simpleString()
    own = index is None
    index = build_index(docs, id_col, text_col) if own else index
    parts = []
    for group in _groups(items, item_id_col, item_text_col):
        bags = list(group)
        names = spark.createDataFrame([(n, i) for n, bag in enumerate(bags) for i in group[bag]],
                                      f"query long, item_id {id_type}")
        parts.append(written(search(index, bags, k).join(F.broadcast(names), "query")
                             .select("item_id", "rank", "d", "score"), "ranked"))
    if own:
        index.remove()
    out = spark.createDataFrame([], f"item_id {id_type}, rank int, d long, score long")
    for p in parts:
        out = out.union(p)
    return out


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    out = rank_documents(docs, items)
    return out.select("item_id", "rank", F.when(F.col("d") != NULL_ID, F.col("d")).alias("doc_id"), "score")


ORACLE = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), sized AS (SELECT doc_id, w, len(w)::BIGINT AS n FROM words WHERE len(w) > 0),
corpus AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM sized),
held AS (
  SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, n, unnest(w) AS t FROM sized) GROUP BY ALL
), weights AS (
  SELECT t, floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1)))::BIGINT AS wt
  FROM held, corpus GROUP BY t
), asked AS (
  SELECT item_id, t, count(*) AS q FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY ALL
), scored AS (
  SELECT item_id, doc_id, sum(q * wt * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll))))::BIGINT AS score
  FROM asked JOIN held USING (t) JOIN weights USING (t), corpus GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20
"""
