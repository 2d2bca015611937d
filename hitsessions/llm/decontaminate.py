"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of all test items go into one suffix automaton. A
document's words are streamed through it; the automaton keeps the length
of the longest suffix that some item contains. Where that length reaches
``window`` words, the last ``window`` words are a window of an item: they
are hit. An item shorter than the window counts as a whole.

Words are hashed in numpy; a word that no item contains ends every match,
so only runs of item words that could hold a window are streamed.

Defined cases
-------------
* Null or empty text: no words, nothing hit. An item without words never
  occurs. No items: nothing is hit.
* Items that share an id count as one; repeated item texts each count.
  A null item id is left out of the list of items but its words are hit.
* Rows are independent: repeated rows get equal results; other columns
  are carried in ``row``.

Scale: a map over the documents, no shuffle of them. Equal item texts are
one, with all their ids. Items are dealt to shards of ``shard_words`` words
by a hash of their text, long ones in pieces that overlap such that every
window lies in one; one automaton per shard is broadcast, so its size is
bounded whatever the length of an item. With several shards one scan of
the documents, against a sieve of the hashes of all windows, sets the rows
apart that may hold one; only these meet the shards, and their hit words
are joined per row by its id and text hashes. Bytes are looked up once
they are merged, so results don't depend on the number of shards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sieve
from . import textkit as T
from .rows import KEY, key_of, let, name, removed, written

#: Bytes of words after lower-casing: a-z, 0-9 and everything beyond ASCII.
WORD = np.zeros(256, dtype=bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True
WINDOW = 10
SHARD_WORDS = 200_000


def word_ids(text, vocab: np.ndarray):
    """Bounds of the words of a batch and their place in ``vocab`` (-1: absent)."""
    buf, off = T.text_bytes(text)
    buf = T.lower_ascii(buf)
    starts, ends, rows = T.words(buf, off, WORD)
    h = T.word_hashes(buf, starts, ends)
    if not len(vocab):
        return starts, ends, rows, off, np.full(len(h), -1)
    at = np.searchsorted(vocab, h)
    at[at == len(vocab)] = 0
    return starts, ends, rows, off, np.where(vocab[at] == h, at, -1)


class SuffixAutomaton:
    """Suffix automaton of several word sequences, with the items of each window."""

    def __init__(self, items: list[tuple[int, list[int]]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.length, self.link = [0], [-1]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        #: state -> items that contain the window the state stands for
        self.items: dict[int, set] = {}
        #: state -> [(words, items)] of whole items shorter than the window that are suffixes of it
        self.short: dict[int, list] = {}
        self.shortest = window
        ends: dict[int, dict[int, set]] = {}
        for item, words in items:
            state = 0
            for i, w in enumerate(words):
                state = self.next[state][w]
                if i + 1 >= window:
                    self.items.setdefault(self._holding(state, window), set()).add(item)
            if 0 < len(words) < window:
                self.shortest = min(self.shortest, len(words))
                ends.setdefault(self._holding(state, len(words)), {}).setdefault(len(words), set()).add(item)
        if ends:
            for v in range(len(self.length)):
                found, u = [], v
                while u > 0:
                    found += ends.get(u, {}).items()
                    u = self.link[u]
                if found:
                    self.short[v] = found

    def _extend(self, last: int, w: int) -> int:
        to, length, link = self.next, self.length, self.link
        if w in to[last]:
            q = to[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        new = len(length)
        length.append(length[last] + 1)
        to.append({})
        link.append(0)
        p = last
        while p >= 0 and w not in to[p]:
            to[p][w] = new
            p = link[p]
        if p >= 0:
            q = to[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return new

    def _clone(self, p: int, w: int, q: int) -> int:
        to, length, link = self.next, self.length, self.link
        c = len(length)
        length.append(length[p] + 1)
        to.append(dict(to[q]))
        link.append(link[q])
        link[q] = c
        while p >= 0 and to[p].get(w) == q:
            to[p][w] = c
            p = link[p]
        return c

    def _holding(self, state: int, n: int) -> int:
        """The state that stands for the last ``n`` words of a state's longest sequence."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def match(self, words: list[int], at: int, hits: list, found: set) -> None:
        """Stream words; append (first, last + 1) of every hit, counted from ``at``."""
        to, length, link, window = self.next, self.length, self.link, self.window
        state = n = 0
        for i, w in enumerate(words):
            while state and w not in to[state]:
                state = link[state]
                n = length[state]
            if w not in to[state]:
                continue
            state = to[state][w]
            n += 1
            if n >= window:
                hits.append((at + i + 1 - window, at + i + 1))
                found |= self.items[self._holding(state, window)]
            for size, items in self.short.get(state, ()):
                if size <= n:
                    hits.append((at + i + 1 - size, at + i + 1))
                    found |= items


def build(items: list[tuple[int, str]], window: int) -> tuple[np.ndarray, SuffixAutomaton]:
    """Sorted word hashes of the items and the automaton over their places."""
    text = pa.array([t for _, t in items], type=pa.string())
    buf, off = T.text_bytes(text)
    buf = T.lower_ascii(buf)
    starts, ends, rows = T.words(buf, off, WORD)
    vocab, ids = np.unique(T.word_hashes(buf, starts, ends), return_inverse=True)
    ids = ids.tolist()
    return vocab, SuffixAutomaton([(items[k][0], ids[rows[k]:rows[k + 1]]) for k in range(len(items))], window)


def _cut_items(items: DataFrame, window: int, most: int) -> DataFrame:
    """id, text of the items, those of more than ``most`` words in pieces that overlap by ``window - 1`` words."""
    def run(batches):
        for b in batches:
            for part in T.chunks(b, "text") if len(b) else ():
                buf, off = T.text_bytes(part.column("text"))
                starts, ends, rows = T.words(T.lower_ascii(buf), off, WORD)
                data, row, cut = buf.tobytes(), [], []
                for r, n in enumerate(np.diff(rows).tolist()):
                    if n <= most:
                        row.append(r)
                        cut.append(data[off[r]:off[r + 1]])
                        continue
                    # The last piece still holds a window: a shorter one would count as a whole short item.
                    for k in range(0, n - window + 1, most - window + 1):
                        row.append(r)
                        cut.append(data[starts[rows[r] + k]:ends[rows[r] + min(k + most, n) - 1]])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(row)), pa.array(cut, type=pa.binary()).cast(pa.string(), safe=False)],
                    names=["id", "text"])

    return items.mapInArrow(run, "id string, text string")


def _cut(items: DataFrame, id_col: str, text_col: str, shard_words: int, window: int) -> tuple[DataFrame, int]:
    """text, ids of the items (a written table), and the number of shards of about ``shard_words`` words at most.

    Items go to shards by a hash of their text, long ones in pieces of an
    eighth of a shard. A word takes two bytes at least, with the character
    after it; twice as many shards as that asks for keep an uneven one
    within the bound.
    """
    items = items.select(F.col(name(id_col)).cast("string").alias("id"),
                         F.coalesce(F.col(name(text_col)), F.lit("")).alias("text"))
    # Equal texts meet here, before they are dealt: copies take no room in a shard.
    items = written(_cut_items(items, window, max(2 * window, shard_words // 8)).groupBy("text")
                    .agg(F.collect_set("id").alias("ids")), "items")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return items, -(-total // shard_words) if total // 2 > shard_words else 1


def _shard(items: DataFrame, k: int, n: int) -> list:
    """(ids, text) of the items of shard ``k`` of ``n``."""
    part = items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k) if n > 1 else items
    return [(r.ids, r.text) for r in part.collect()]


def _window_keys(text, lengths) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of ``lengths`` words of a batch, and the row of each."""
    buf, off = T.text_bytes(text)
    buf = T.lower_ascii(buf)
    starts, ends, rows = T.words(buf, off, WORD)
    wh = T.word_hashes(buf, starts, ends)
    last = np.repeat(rows[1:], np.diff(rows))
    keys, of = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for n in lengths:
        at = np.flatnonzero(np.arange(len(wh)) + n <= last)
        if len(at):
            keys.append(T.window_hashes(wh, n)[at])
            of.append(np.searchsorted(rows, at, side="right") - 1)
    return np.concatenate(keys), np.concatenate(of)


def _item_windows(items: DataFrame, window: int) -> DataFrame:
    """key, size: hashes of all windows of the items, and their numbers of words."""
    def run(batches):
        for b in batches:
            for part in T.chunks(b, "text") if len(b) else ():
                buf, off = T.text_bytes(part.column("text"))
                count = np.diff(T.words(T.lower_ascii(buf), off, WORD)[2])
                for n in range(1, window + 1):
                    mine = np.flatnonzero(count == n if n < window else count >= window)
                    if len(mine):
                        keys = np.unique(_window_keys(part.column("text").take(pa.array(mine)), [n])[0])
                        yield pa.RecordBatch.from_arrays([pa.array(T.signed(keys)), pa.array(np.full(len(keys), n, np.int32))],
                                                         names=["key", "size"])

    return items.select("text").mapInArrow(run, "key long, size int")


def _screened(docs: DataFrame, items: DataFrame, text_col: str, window: int) -> DataFrame:
    """row, n_words, maybe: whether some window of the row may be an item's (false: none is)."""
    keys = written(_item_windows(items, window), "windows")
    lengths = [r.size for r in keys.select("size").distinct().collect()]  # window of them at most
    known = sieve.build(keys.select("key"), at_most=keys.count())
    removed(keys)

    def run(batches):
        for part, text in T.pieces(batches, text_col):
            buf, off = T.text_bytes(text)
            n = np.diff(T.words(T.lower_ascii(buf), off, WORD)[2])
            key, row = _window_keys(text, lengths)
            maybe = np.zeros(len(text), dtype=bool)
            maybe[row[sieve.hit(known.value, key)]] = True
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(n.astype(np.int64)), pa.array(maybe)],
                                             names=["row", "n_words", "maybe"])

    return docs.mapInArrow(run, T.row_schema(docs, "n_words long, maybe boolean"))


def _scan(docs: DataFrame, shard, text_col: str, window: int) -> DataFrame:
    """row, n_words, spans (flat first, last+1 word positions, merged), bytes (their byte bounds), items."""
    # The automaton knows an item by its place in the shard.
    shared = docs.sparkSession.sparkContext.broadcast(
        (*build([(k, text) for k, (_, text) in enumerate(shard)], window), [ids for ids, _ in shard]))

    def run(batches):
        vocab, auto, ids_of = shared.value
        least = auto.shortest
        for part, text in T.pieces(batches, text_col):
            starts, ends, rows, off, ids = word_ids(text, vocab)
            known = ids >= 0
            # Runs of item words inside one row, long enough to hold a window.
            cut = np.zeros(len(ids) + 1, dtype=bool)
            cut[rows] = True
            first = np.flatnonzero(known & (~np.concatenate([[False], known[:-1]]) | cut[:-1])) if len(ids) else []
            last = np.flatnonzero(known & (~np.concatenate([known[1:], [False]]) | cut[1:])) + 1 if len(ids) else []
            hits: dict[int, list] = {}
            found: dict[int, set] = {}
            for a, b in zip(np.asarray(first), np.asarray(last)):
                if b - a >= least:
                    r = int(np.searchsorted(rows, a, side="right")) - 1
                    got: list = []
                    auto.match(ids[a:b].tolist(), int(a - rows[r]), got, found.setdefault(r, set()))
                    if got:
                        hits.setdefault(r, []).extend(got)
            n = len(text)
            spans = [merged(hits.get(r, [])) for r in range(n)]
            chars = _byte_bounds(spans, starts, ends, rows, off)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(np.diff(rows).astype(np.int64)),
                 pa.array(spans, type=pa.list_(pa.int64())), pa.array(chars, type=pa.list_(pa.int64())),
                 pa.array([sorted({x for k in found.get(r, ()) for x in ids_of[k]}) for r in range(n)],
                          type=pa.list_(pa.string()))],
                names=["row", "n_words", "spans", "bytes", "items"])

    return docs.mapInArrow(run, T.row_schema(
        docs, "n_words long, spans array<long>, bytes array<long>, items array<string>"))


def _byte_bounds(spans, starts, ends, rows, off) -> list[list[int]]:
    """Flat byte bounds of the flat word spans of each row."""
    return [[int(starts[rows[r] + x] - off[r]) if k % 2 == 0 else int(ends[rows[r] + x - 1] - off[r])
             for k, x in enumerate(s)] for r, s in enumerate(spans)]


def _with_bytes(found: DataFrame, text_col: str) -> DataFrame:
    """``found`` (row, n_words, spans, items) with the byte bounds of its spans."""
    def run(batches):
        for part, text in T.pieces(batches, text_col):
            buf, off = T.text_bytes(text)
            starts, ends, rows = T.words(T.lower_ascii(buf), off, WORD)
            chars = _byte_bounds(part.column("spans").to_pylist(), starts, ends, rows, off)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("n_words"), part.column("spans"),
                 pa.array(chars, type=pa.list_(pa.int64())), part.column("items")],
                names=["row", "n_words", "spans", "bytes", "items"])

    return found.mapInArrow(run, T.row_schema(
        found, "n_words long, spans array<long>, bytes array<long>, items array<string>"))


def merged(spans: list[tuple[int, int]]) -> list[int]:
    """Disjoint spans, flat, from overlapping or touching ones."""
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def find(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
         item_text: str = "text", id_col: str = "doc_id", window: int = WINDOW,
         shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per row: ``row, n_words, spans, bytes, items``.

    ``spans`` are the hit words as flat (first, end) positions, ``bytes``
    the same places in the UTF-8 text, ``items`` the ids of the items that
    occur.
    """
    docs = docs.select(F.struct(*[F.col(name(c)) for c in docs.columns]).alias("row"))
    items, n = _cut(items, item_id, item_text, shard_words, window)
    if n == 1:
        return _scan(docs, _shard(items, 0, 1), text_col, window)
    # Several shards: one scan tells the rows that may hold a window of any item; only these meet the shards.
    marked = _screened(docs, items, text_col, window)
    none = {"spans": F.array().cast("array<long>"), "bytes": F.array().cast("array<long>"), "items": F.array().cast("array<string>")}
    clear = marked.where("not maybe").drop("maybe").withColumns(none)
    doubt = written(marked.where("maybe").drop("maybe"), "doubtful")
    parts = []
    for k in range(n):
        if shard := _shard(items, k, n):
            found = _scan(doubt.select("row"), shard, text_col, window).where(F.size("spans") > 0)
            key = key_of(F.col("row." + name(id_col)), F.col("row." + name(text_col)))
            parts.append(written(found.select(*key, "spans", "items"), "hits"))
    removed(items)
    hits = parts[0]
    for p in parts[1:]:
        hits = hits.unionByName(p)
    # Equal rows have equal hits, so these meet by the row key; the fourth key makes fresh exchanges, so that a row that
    # repeats a great many times is split.
    again = F.col("t").bitwiseXOR(F.col("u")).alias("tu")
    hit = (hits.groupBy(*KEY).agg(F.collect_set("spans").alias("s"),
                                  F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
           .select("*", again))
    key = key_of(F.col("row." + name(id_col)), F.col("row." + name(text_col)))
    both = doubt.select("row", "n_words", *key).select("*", again).join(hit, [*KEY, "tu"], "left")
    merged_spans = both.select("row", "n_words", F.coalesce(joined(F.col("s")), none["spans"]).alias("spans"),
                               F.coalesce("items", none["items"]).alias("items"))
    return _with_bytes(merged_spans, text_col).unionByName(clear)


def joined(lists):
    """Flat disjoint spans out of several lists of flat spans."""
    pairs = F.flatten(F.transform(lists, lambda s: F.transform(
        F.sequence(F.lit(0), F.shiftright(F.size(s), 1) - 1),
        lambda i: F.struct(F.get(s, 2 * i).alias("a"), F.get(s, 2 * i + 1).alias("b")))))

    def add(acc, p):
        end = F.element_at(acc, -1)
        return F.when((F.size(acc) > 0) & (p["a"] <= F.coalesce(end, F.lit(-1))),
                      F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.greatest(end, p["b"])))) \
            .otherwise(F.concat(acc, F.array(p["a"], p["b"])))

    return F.aggregate(F.array_sort(pairs), F.array().cast("array<long>"), add)


def n_hit(spans):
    """Words inside flat spans: last end minus last first, plus the same before it, by alternating signs."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: x - n)


def remove(found: DataFrame, text_col: str = "text", max_cover_percent: int = 50) -> DataFrame:
    """``row`` and ``clean``, the text without the hit spans; rows whose hit
    words make up ``max_cover_percent`` or more of their words are dropped."""
    keep = found.where((F.size("spans") == 0) | (100 * n_hit(F.col("spans")) < max_cover_percent * F.col("n_words")))
    text = F.coalesce(F.col("row." + name(text_col)), F.lit(""))
    bounds = F.concat(F.array(F.lit(0).cast("long")), F.col("bytes"), F.array(F.octet_length(text).cast("long")))

    def between(raw, at):
        """The parts of the text before, between and after the spans."""
        return F.array_join(F.transform(
            F.sequence(F.lit(0), F.shiftright(F.size(at), 1) - 1),
            lambda i: F.substring(raw, (F.get(at, 2 * i) + 1).cast("int"),
                                  (F.get(at, 2 * i + 1) - F.get(at, 2 * i)).cast("int")).cast("string")), "")

    left = let(text.cast("binary"), lambda raw: let(bounds, lambda at: between(raw, at)))
    return keep.select("row", F.when(F.size("bytes") == 0, text).otherwise(left).alias("clean"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = find(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = n_hit(F.col("spans"))
    return out.select("row.doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (hit > 0).alias("contaminated"))


ORACLE = r"""
WITH words AS (
  SELECT kind, r, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT 'doc' AS kind, row_number() OVER () AS r, doc_id::VARCHAR AS id, text FROM documents
        UNION ALL SELECT 'item', row_number() OVER (), item_id::VARCHAR, text FROM benchmark)
), sizes AS (
  SELECT DISTINCT least(len(w), 10) AS size FROM words WHERE kind = 'item' AND len(w) > 0
), windows AS (
  SELECT kind, r, id, p, size, array_to_string(list_slice(w, p, p + size - 1), ' ') AS words
  FROM (SELECT kind, r, id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM words, sizes
        WHERE len(w) >= size AND (kind = 'doc' OR size = least(len(w), 10)))
), hits AS (
  SELECT d.r, d.p, d.size, i.id AS item FROM windows d JOIN windows i USING (size, words)
  WHERE d.kind = 'doc' AND i.kind = 'item'
), places AS (
  SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(p, p + size)) AS pos FROM hits) GROUP BY r
), items AS (
  SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words JOIN (SELECT row_number() OVER () AS r, doc_id FROM documents) USING (r)
LEFT JOIN places USING (r) LEFT JOIN items USING (r) WHERE kind = 'doc'
"""
