"""N-gram Jaccard join by PartEnum signatures.

A document is the set of its word shingles. Sets are put into bands by
size, such that similar sets lie in one band or in two neighbouring ones.
Within a band pair, similar sets differ in at most ``k`` shingles. The
domain of shingles is cut into ``n1`` first-level parts of ``n2`` cells
each; by the pigeonhole principle two such sets differ in at most ``k2``
shingles in some part, so they agree on some ``n2 - k2`` of its cells:
each choice of cells is a signature, and similar sets share one. No
similar pair is missed; pairs that share a signature are verified.

A choice of cells that holds none of a set's shingles would be shared by
unrelated sets and is left out. Spare parts make up for it: with ``s``
parts more than needed, similar sets agree in ``s + 1`` parts at least,
so one of them is whole unless both sets have more than ``s`` parts with
an empty choice. Such sets take the signatures of further partitions of
the domain as well, where they meet.

Defined cases
-------------
* Null text or a text without words: the empty set, linked with nothing,
  a component of its own. Fewer words than a shingle: the whole sequence
  is the one shingle.
* Equal sets are one class. Rows that share an id are separate members
  of that id. A null id is smaller than all others.

Scale: equal sets meet first (pre-aggregated by a 128-bit set hash), so
copies cost one row each. Of the signatures only those that two classes
share go further (a sieve keeps the others out of the join). A class is
compared with the first class of each signature, then with other hubs,
then only across components that still share a signature. Links are
exact (shingle sets are compared), and components grow by rounds over
written tables; only links that components need are verified there, all of
them in :func:`link_counts`. No pair, link or component reaches the driver.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sieve
from . import textkit as T
from .components import components
from .rows import KEY, KEY_SCHEMA, NULL_ID, name, removed, row_key, small_batches, unpacked, written
from .substring_dedup import _parts, keyed

SHINGLE, PERCENT = 4, 85
#: Cells of a first-level part, and how many of them may differ.
CELLS, MAY_DIFFER = 2, 1
#: Rounds with other hubs before classes are compared across components.
TURNS = 2
#: Bits of the parity sketch that rules pairs out before their sets are compared.
PARITY = 1024
SKETCH = [f"p{i}" for i in range(PARITY // 64)]
#: Signatures that a task combines at a time.
COMBINE = 1 << 18
#: Partitions of the domain tried for sets with more empty choices than spare parts.
DEPTH = 6
_U = np.uint64


class Bands:
    """Size bands for a similarity of ``percent`` / 100, and the difference bound of each."""

    def __init__(self, percent: int, most: int):
        low, self.low, self.high = 1, [], []
        while low <= most:
            self.low.append(low)
            self.high.append(low * 100 // percent)
            low = self.high[-1] + 1
        # One band further: sets of the last band also join upwards.
        self.low.append(low)
        self.high.append(low * 100 // percent)
        self.starts = np.array(self.low)
        # An instance holds its own band and the one below. Pairs inside a band meet in the instance above it, so
        # |x ^ y| <= (1 - s) / (1 + s) * (|x| + |y|) has the ends of two neighbouring bands as the sizes.
        high = np.array(self.high)
        below = np.concatenate([high[:1], high[:-1]])
        self.differ = (100 - percent) * (high + below) // (100 + percent)
        self.spare = np.array([self._spare(int(k), low) for k, low in zip(self.differ, [1, *self.low])])

    @staticmethod
    def _spare(k: int, size: int) -> int:
        """Spare parts that make up for the empty choices of most sets of a size."""
        if not k:
            return 0
        spare = 1
        for _ in range(20):
            parts = k // (MAY_DIFFER + 1) + 1 + spare
            empty = math.exp(-size / (parts * CELLS))
            lacking = parts * (1 - (1 - empty) ** CELLS)
            spare = min(math.ceil(lacking + math.sqrt(lacking)), 1 + k // 4)
        return spare

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, size, side="right") - 1


class Sets:
    """Shingle sets of a batch of texts."""

    def __init__(self, text, n: int):
        buf, off = T.text_bytes(text)
        buf = T.lower_ascii(buf)
        starts, ends, rows = T.words(buf, off)
        wh = T.word_hashes(buf, starts, ends)
        count = np.diff(rows)
        last = np.repeat(rows[1:], count)
        at = np.flatnonzero(np.arange(len(wh)) + n <= last)
        h = T.window_hashes(wh, n)[at] if len(at) else np.zeros(0, _U)
        doc = np.searchsorted(rows, at, side="right") - 1
        short = np.flatnonzero((count > 0) & (count < n))
        whole = [T.window_hashes(wh[rows[r]:rows[r + 1]], int(count[r]))[0] for r in short.tolist()]
        h, doc = np.concatenate([h, np.array(whole, dtype=_U)]), np.concatenate([doc, short])
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        self.items, self.doc = h[new], doc[new]
        self.n = len(off) - 1
        self.off = np.searchsorted(self.doc, np.arange(self.n + 1))
        self.size = np.diff(self.off)
        self.c1, self.c2 = self._sums(T.mix(self.items, 1)), self._sums(T.mix(self.items, 2))

    def _sums(self, x: np.ndarray) -> np.ndarray:
        acc = np.zeros(len(x) + 1, dtype=_U)
        np.cumsum(x, out=acc[1:])
        return T.mix(acc[self.off[1:]] - acc[self.off[:-1]] + self.size.astype(_U), 3)

    def parity(self) -> list[np.ndarray]:
        """``PARITY`` bits per set, the parity of shingles at each: sets differ in at least as many shingles as in bits."""
        bits = np.bincount(self.doc * PARITY + (self.items & _U(PARITY - 1)).astype(np.int64),
                           minlength=self.n * PARITY).reshape(self.n, PARITY) & 1
        return list(np.packbits(bits.astype(np.uint8), axis=1).view(np.int64).T)

    def wide_parity(self) -> list[bytes | None]:
        """Parity bits of the sets with more than ``PARITY`` shingles, as many as shingles or more (a power of two)."""
        out: list[bytes | None] = [None] * self.n
        for r in np.flatnonzero(self.size > PARITY).tolist():
            items = self.items[self.off[r]:self.off[r + 1]]
            bits = 1 << (len(items) - 1).bit_length()
            place = (items & _U(bits - 1)).astype(np.int64)
            out[r] = np.packbits((np.bincount(place, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()
        return out

    def set_of(self, r: int) -> bytes:
        return self.items[self.off[r]:self.off[r + 1]].tobytes()

    def signatures(self, rows: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
        """(row, signature) of the sets of ``rows`` (none of them empty)."""
        out_row, out_sig = [], []
        band = bands.of(self.size)
        for up in (0, 1):
            todo = rows
            for depth in range(DEPTH):
                if not len(todo):
                    break
                row, sig, lacking = self._enumerate(todo, band + up, bands, depth)
                out_row.append(row)
                out_sig.append(sig)
                todo = lacking
        if not out_row:
            return np.zeros(0, np.int64), np.zeros(0, _U)
        return np.concatenate(out_row), np.concatenate(out_sig)

    def _enumerate(self, rows, instance, bands, depth):
        """Signatures of one partition of the domain; and the rows with more empty choices than spare parts."""
        k, spare = bands.differ[instance[rows]], bands.spare[instance[rows]]
        # At most k // (MAY_DIFFER + 1) parts differ too much.
        parts = np.where(k > 0, k // (MAY_DIFFER + 1) + 1 + spare, 1)
        begin = np.concatenate([[0], np.cumsum(parts)])
        place = np.full(self.n, -1)
        place[rows] = np.arange(len(rows))
        use = place[self.doc] >= 0
        items, who = self.items[use], place[self.doc[use]]
        h = T.mix(items, 10 + depth)
        n1 = parts[who].astype(_U)
        cell = (begin[who] + (h % n1).astype(np.int64)) * CELLS + ((h // n1) % _U(CELLS)).astype(np.int64)
        sums = np.zeros(begin[-1] * CELLS, dtype=_U)
        np.add.at(sums, cell, T.mix(items, 4))
        counts = np.bincount(cell, minlength=len(sums)).reshape(-1, CELLS)
        sums = sums.reshape(-1, CELLS)
        owner = np.repeat(np.arange(len(rows)), parts)
        part = np.arange(len(owner)) - begin[owner]
        tag = T.mix((instance[rows][owner] * DEPTH + depth).astype(_U)) + part.astype(_U) * _U(64)
        out_row, out_sig, lacking = [], [], np.zeros(len(owner), dtype=bool)
        exact = k[owner] == 0
        for choices, mine in ((list(combinations(range(CELLS), CELLS - MAY_DIFFER)), ~exact),
                              ([tuple(range(CELLS))], exact)):
            for i, cells in enumerate(choices):
                full = counts[:, cells].sum(1) > 0
                lacking |= mine & ~full
                take = mine & (full | (depth == DEPTH - 1))
                out_row.append(rows[owner[take]])
                out_sig.append(T.mix(sums[take][:, cells].sum(1, dtype=_U) + T.mix(tag[take] + _U(i))))
        short = np.bincount(owner[lacking], minlength=len(rows)) > spare
        return np.concatenate(out_row), np.concatenate(out_sig), rows[short]


def _classes(base: DataFrame, n: int) -> DataFrame:
    """d, t, u, n, c1, c2 and the parity bits of every row (``wide``: those of a large set)."""
    def run(batches):
        for part in _parts(batches):
            s = Sets(part.column("text"), n)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in KEY), pa.array(s.size.astype(np.int64)), pa.array(T.signed(s.c1)),
                 pa.array(T.signed(s.c2)), *map(pa.array, s.parity()), pa.array(s.wide_parity(), pa.binary())],
                names=[*KEY, "n", "c1", "c2", *SKETCH, "wide"])

    return base.mapInArrow(run, f"{KEY_SCHEMA}, n long, c1 long, c2 long, " + ", ".join(f"{p} long" for p in SKETCH)
                           + ", wide binary")


def _ends_of(sig: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
    """sig, c: of each signature the rows with its least and its greatest class."""
    order = np.lexsort((c, sig))
    sig, c = sig[order], c[order]
    edge = np.concatenate([[True], sig[1:] != sig[:-1], [True]])
    use = edge[:-1] | edge[1:]
    return pa.RecordBatch.from_arrays([pa.array(sig[use]), pa.array(c[use])], names=["sig", "c"])


def _signatures(base: DataFrame, n: int, percent: int, only=None) -> DataFrame:
    """sig, c (the class) of every class of a chunk; with a sieve, those that it lets through.

    Without one, rows of a signature that many classes of a task share are
    reduced to its least and its greatest class, COMBINE rows at a time.
    """
    def run(batches):
        sigs, classes, held = [], [], 0
        for part in _parts(batches):
            s = Sets(part.column("text"), n)
            full = np.flatnonzero(s.size > 0)
            one = full[np.unique(s.c1[full], return_index=True)[1]]
            row, sig = s.signatures(one, Bands(percent, int(s.size.max(initial=1))))
            sig, c = T.signed(sig), T.signed(s.c1[row])
            if only is not None:
                use = sieve.hit(only.value, sig)
                yield pa.RecordBatch.from_arrays([pa.array(sig[use]), pa.array(c[use])], names=["sig", "c"])
                continue
            sigs.append(sig)
            classes.append(c)
            held += len(sig)
            if held >= COMBINE:
                yield _ends_of(np.concatenate(sigs), np.concatenate(classes))
                sigs, classes, held = [], [], 0
        if held:
            yield _ends_of(np.concatenate(sigs), np.concatenate(classes))

    return base.select("text").mapInArrow(run, "sig long, c long")


def _hit(wanted):
    """A boolean column function: a sieve may hold the key."""
    @F.arrow_udf("boolean")
    def may(key: pa.Array) -> pa.Array:
        return pa.array(sieve.hit(wanted.value, np.array(key, dtype=np.int64)))

    return may


def _sets(base: DataFrame, n: int, classes: DataFrame, pairs: DataFrame, bits: int) -> DataFrame:
    """c, items: the shingle sets of the classes of some pairs, from one text of each class; a written table."""
    wanted, ends = _ends(pairs, bits)
    keys = _with_key_in(classes.select("c1", "k.*"), "c1", wanted).select(F.xxhash64(*KEY).alias("key"))
    texts = sieve.build(keys, bits, 2 * ends)

    def run(batches):
        # Most texts are left out by their key, before any of their words is looked at.
        some = (b.filter(pa.array(sieve.hit(texts.value, np.array(b.column("key"), dtype=np.int64)))) for b in batches)
        for part in _parts(some):
            s = Sets(part.column("text"), n)
            full = np.flatnonzero((s.size > 0) & sieve.hit(wanted.value, s.c1))
            one = full[np.unique(s.c1[full], return_index=True)[1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(T.signed(s.c1[one])), pa.array([s.set_of(r) for r in one.tolist()], type=pa.binary())],
                names=["c", "items"])

    keyed_texts = base.select(F.xxhash64(*KEY).alias("key"), "text")
    out = written(keyed_texts.mapInArrow(run, "c long, items binary").groupBy("c").agg(F.first("items").alias("items")), "sets")
    wanted.destroy()
    texts.destroy()
    return out


def _with_key_in(df: DataFrame, key: str, wanted) -> DataFrame:
    """Rows whose key a sieve lets through."""
    def run(batches):
        for b in batches:
            if len(b):
                yield b.filter(pa.array(sieve.hit(wanted.value, np.array(b.column(key), dtype=np.int64))))

    return df.mapInArrow(run, df.schema)


def _ends(pairs: DataFrame, bits: int):
    """Sieve of the classes of some pairs (a written table), and how many they are at most."""
    n = 2 * pairs.count()
    return sieve.build(pairs.select(F.col("a").alias("key")).union(pairs.select("b")), bits, n), n


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar, by their shingles."""
    both = (pairs.join(sets.withColumnRenamed("c", "a").withColumnRenamed("items", "x"), "a")
            .join(sets.withColumnRenamed("c", "b").withColumnRenamed("items", "y"), "b"))

    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column("x"), b.column("y")):
                x, y = np.frombuffer(x.as_buffer(), dtype=_U), np.frombuffer(y.as_buffer(), dtype=_U)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _sketches(classes: DataFrame, wanted, cols: list[str]) -> DataFrame:
    """c and ``cols`` of the classes in a sieve, which goes; a written table."""
    out = written(_with_key_in(classes.select("c1", *cols), "c1", wanted)
                  .groupBy(F.col("c1").alias("c")).agg(*[F.first(c).alias(c) for c in cols]), "sketches")
    wanted.destroy()
    return out


def _side(df: DataFrame, side: str) -> DataFrame:
    """Columns of one end of a pair, with the end's name in front."""
    return df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns])


def _may_link(percent: int):
    """Whether sizes and parity bits of the ends x and y allow the similarity (no similar pair fails)."""
    differ = sum((F.bit_count(F.col(f"x_{p}").bitwiseXOR(F.col(f"y_{p}"))) for p in SKETCH), F.lit(0))
    n, m = F.col("x_n"), F.col("y_n")
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * differ <= (100 - percent) * (n + m))


def _folded(x: np.ndarray, size: int) -> np.ndarray:
    """Parity bits of a set at fewer places: bytes that fall on one place are combined."""
    return np.bitwise_xor.reduce(x.reshape(-1, size), axis=0)


def _wide_may_link(pairs: DataFrame, percent: int) -> DataFrame:
    """a, b of the pairs whose wide parity bits, where both ends have some, allow the similarity."""
    def run(batches):
        for b in batches:
            ok = []
            for x, y, n, m in zip(b.column("x_wide"), b.column("y_wide"), b.column("x_n").to_pylist(), b.column("y_n").to_pylist()):
                if x.is_valid and y.is_valid:
                    x, y = np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8)
                    size = min(len(x), len(y))
                    differ = int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum())
                    ok.append((100 + percent) * differ <= (100 - percent) * (n + m))
                else:
                    ok.append(True)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.select("a", "b", "x_n", "y_n", "x_wide", "y_wide").mapInArrow(run, "a long, b long")


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int, bits: int) -> DataFrame:
    """Pairs whose sketches allow the similarity, as a written table; ``pairs`` is one too and goes.

    The short sketches come first. They say nothing of sets with far more
    shingles than bits; what is left of those is tested by the wide ones,
    which only few pairs need.
    """
    some = _sketches(classes, _ends(pairs, bits)[0], ["n", *SKETCH])
    x = _side(some, "x").withColumnRenamed("x_c", "a")
    y = _side(some, "y").withColumnRenamed("y_c", "b")
    near = written(pairs.join(x, "a").join(y, "b").where(_may_link(percent)).select("a", "b"), "near")
    removed(pairs, some)
    return _widely(near, classes, percent, bits)


def _widely(pairs: DataFrame, classes: DataFrame, percent: int, bits: int) -> DataFrame:
    """Pairs whose wide sketches allow the similarity, as a written table; ``pairs`` is one too and goes."""
    some = _sketches(classes, _ends(pairs, bits)[0], ["n", "wide"])
    x = _side(some, "x").withColumnRenamed("x_c", "a")
    y = _side(some, "y").withColumnRenamed("y_c", "b")
    out = written(_wide_may_link(pairs.join(x, "a").join(y, "b"), percent), "plausible")
    removed(pairs, some)
    return out


def _held(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, bits: int):
    """Texts by row, and the written tables of rows, of classes (equal sets), and of the signatures that classes share."""
    small_batches(docs.sparkSession)
    base = keyed(docs, id_col, text_col)
    rows = written(_classes(base, shingle), "rows")
    classes = written(rows.where("n > 0").groupBy("c1", "c2").agg(
        F.min("d").alias("least"), F.min(F.struct(*KEY)).alias("k"), F.count("*").alias("members"),
        *[F.first(c).alias(c) for c in ("n", *SKETCH, "wide")]), "classes")

    # Nearly all signatures are of one class, so a partial aggregate would keep them all for nothing: they are combined
    # in the tasks above, and grouped behind the exchange, in more partitions than usual.
    parts = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared = written(_signatures(base, shingle, percent).repartition(parts, "sig").groupBy("sig")
                     .agg(F.min("c").alias("hub"), F.max("c").alias("last")).where("hub < last")
                     .select("sig", "hub"), "signatures")
    passing = sieve.build(shared.select(F.col("sig").alias("key")), bits, shared.count())
    # Repeats go before the join: an aggregate on top of it would keep Spark from splitting a skewed signature.
    held = written(_signatures(base, shingle, percent, passing).distinct().join(shared, "sig"), "holders")
    removed(shared)
    passing.destroy()
    return base, rows, classes, held


def _by_signature(rows: DataFrame, few: DataFrame) -> DataFrame:
    """``rows`` joined with an aggregate per signature.

    The second key makes fresh exchanges on both sides, so that a signature
    that many classes share is split.
    """
    again = F.bitwise_not("sig").alias("sig2")
    return rows.select("*", again).join(few.select("*", again), ["sig", "sig2"]).drop("sig2")


def link_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                percent: int = PERCENT, bits: int = sieve.SIEVE_BITS) -> DataFrame:
    """d, t, u, n_shingles and n_links (other rows whose set is similar or equal) of every row.

    Every link is verified, not only as many as the components need
    (:func:`members`), between classes of equal sets; a class counts with
    all its rows.
    """
    base, rows, classes, held = _held(docs, id_col, text_col, shingle, percent, bits)
    some = written(held.join(classes.select(F.col("c1").alias("c"), "n", *SKETCH), "c"), "open")
    pairs = _side(some, "x").join(_side(some, "y"), (F.col("x_sig") == F.col("y_sig")) & (F.col("x_c") < F.col("y_c"))
                                  & _may_link(percent))
    pairs = written(pairs.select(F.col("x_c").alias("a"), F.col("y_c").alias("b")).distinct(), "pairs")
    removed(some, held)
    pairs = _widely(pairs, classes, percent, bits)
    sets = _sets(base, shingle, classes, pairs, bits)
    links = written(_linked(pairs, sets, percent), "links")
    removed(pairs, sets)
    both = links.union(links.select("b", "a"))
    size = classes.select(F.col("c1").alias("b"), "members")
    linked = both.join(size, "b").groupBy(F.col("a").alias("c1")).agg(F.sum("members").alias("others"))
    found = written(classes.join(linked, "c1", "left").select(
        "c1", "c2", (F.col("members") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")), "link-counts")
    removed(classes, links)
    return rows.join(found, ["c1", "c2"], "left").select(
        *KEY, F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def members(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
            percent: int = PERCENT, bits: int = sieve.SIEVE_BITS) -> DataFrame:
    """d, t, u, n_shingles, component (smallest id of the linked documents) and label of every row.

    ``label`` names the component itself (null for empty sets): rows that
    share an id but not a component differ in it.
    """
    base, rows, classes, held = _held(docs, id_col, text_col, shingle, percent, bits)

    star = written(held.where("c != hub").select(F.col("c").alias("a"), F.col("hub").alias("b")).distinct(), "candidates")
    star = _plausible(star, classes, percent, bits)
    sets = _sets(base, shingle, classes, star, bits)
    # One comparison per class first; what it links needs no other.
    first = star.groupBy("a").agg(F.min("b").alias("b"))
    links = written(_linked(first, sets, percent), "links")
    labels = components(links)
    rest = written(_apart(star.join(first, ["a", "b"], "left_anti"), labels), "rest")
    if not rest.isEmpty():
        links, labels = _joined_by(links, labels, _linked(rest, sets, percent))
    removed(star, sets, rest)

    # Signatures whose classes are still in different components. A few rounds with another class of each signature
    # as its hub join most of them, one comparison per class and round.
    for turn in range(TURNS):
        named = written(_open(held, labels), "open")
        if named.isEmpty():
            removed(named)
            break
        rank = F.xxhash64(F.lit(turn), "c")
        hubs = named.groupBy("sig").agg(F.min_by("c", rank).alias("hub"), F.min_by("label", rank).alias("hub_label"))
        pairs = _by_signature(named, hubs).where(F.col("label") != F.col("hub_label")).select(
            F.col("c").alias("a"), F.col("hub").alias("b")).distinct()
        near = _plausible(written(pairs, "candidates"), classes, percent, bits)
        pairs = written(near.groupBy("a").agg(F.min("b").alias("b")), "pairs")
        removed(named, near)
        if not pairs.isEmpty():
            sets = _sets(base, shingle, classes, pairs, bits)
            links, labels = _joined_by(links, labels, _linked(pairs, sets, percent))
            removed(sets)
        removed(pairs)

    # What is left is compared across components; the sketches go along, so that the join itself lets only
    # plausible pairs through.
    named = written(_open(held, labels), "open")
    if not named.isEmpty():
        open_classes = sieve.build(named.select(F.col("c").alias("key")).distinct(), bits, named.count())
        some = _sketches(classes, open_classes, ["n", *SKETCH])
        wide = written(named.join(some, "c"), "open")
        cross = _side(wide, "x").join(
            _side(wide, "y"), (F.col("x_sig") == F.col("y_sig")) & (F.col("x_c") < F.col("y_c"))
            & (F.col("x_label") != F.col("y_label")) & _may_link(percent))
        cross = written(cross.select(F.col("x_c").alias("a"), F.col("y_c").alias("b")).distinct(), "cross")
        cross = _widely(cross, classes, percent, bits)
        sets = _sets(base, shingle, classes, cross, bits)
        links, labels = _joined_by(links, labels, _linked(cross, sets, percent))
        removed(some, wide, cross, sets)
    removed(named, held, links)

    whole = classes.join(labels, classes.c1 == labels.node, "left").select(
        "c1", "c2", "least", F.coalesce("label", "c1").alias("label"))
    smallest = whole.groupBy("label").agg(F.min("least").alias("component"))
    named = written(whole.join(smallest, "label").select("c1", "c2", "component", "label"), "components")
    removed(classes, labels)
    return (rows.join(named, ["c1", "c2"], "left")
            .select(*KEY, F.col("n").alias("n_shingles"), F.coalesce("component", "d").alias("component"), "label"))


def _joined_by(links: DataFrame, labels: DataFrame, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links with ``more`` of them, and the components; the old tables go."""
    both = written(links.union(more), "links")
    removed(links, labels)
    return both, components(both)


def _open(held: DataFrame, labels: DataFrame) -> DataFrame:
    """sig, c, label of the signatures whose classes are in different components."""
    named = held.join(labels, held.c == labels.node, "left").select("sig", "c", F.coalesce("label", "c").alias("label"))
    apart = named.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("sig")
    return _by_signature(named, apart)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                percent: int = 80, bits: int = sieve.SIEVE_BITS) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the smallest id stays.

    Of rows that share this id, one stays. Documents without words all stay.
    """
    found = written(members(docs, id_col, text_col, shingle, percent, bits), "members")
    named = found.where("label is not null")
    keeper = named.groupBy("label").agg(F.min(F.struct(*KEY)).alias("k")).select("k.*", F.lit(True).alias("keeper"))
    keys = named.groupBy(*KEY).agg(F.count("*").alias("n"))  # rows with words, so that each has one label
    keys = keys.join(keeper, KEY, "left").select(*KEY, "n", F.coalesce("keeper", F.lit(False)).alias("keeper"))
    # Most rows stay, and are alone under their key: they pass without a shuffle. A sieve of the others' keys tells.
    other = written(keys.where("not keeper or n > 1"), "others")
    hashed = F.xxhash64(*KEY)
    may = _hit(sieve.build(other.select(hashed.alias("key")), bits, other.count()))
    rows = docs.select(F.struct(*[F.col(name(c)) for c in docs.columns]).alias("row"), *row_key(docs, id_col, text_col))
    rows = rows.withColumn("may", may(hashed))
    clear = rows.where("not may").select("row")
    # The doubtful rows that stay; those that repeat a row are reduced to one, map-side first.
    doubt = written(rows.where("may").join(other, KEY, "left").where("coalesce(keeper, true)")
                    .select("row", *KEY, "n"), "doubtful")
    removed(found, other)
    once = doubt.where("n is null").select("row")
    again = doubt.where("n is not null").groupBy(*KEY).agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row")
    return unpacked(clear.union(once).union(again), docs.columns)


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components."""
    x = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    y = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    return (pairs.join(x, "a", "left").join(y, "b", "left")
            .where(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b"))


def query(spark, sf_dir: str) -> DataFrame:
    out = members(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    real = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return out.select(real("d").alias("doc_id"), "n_shingles", real("component").alias("component_id"))


ORACLE = r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT r, array_to_string(list_slice(w, p, p + 3), ' ') AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, 2))) AS p FROM texts WHERE len(w) > 0)
), sized AS (SELECT r, count(*) AS n FROM shingles GROUP BY r
), links AS (
  SELECT a, b FROM (SELECT x.r AS a, y.r AS b, count(*) AS common FROM shingles x JOIN shingles y USING (s) WHERE x.r <> y.r GROUP BY ALL)
  JOIN sized na ON na.r = a JOIN sized nb ON nb.r = b WHERE 100 * common >= 85 * (na.n + nb.n - common)
), reached(a, b) AS (
  SELECT r, r FROM texts UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
)
SELECT t.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM texts t JOIN reached ON a = t.r JOIN texts o ON o.r = b LEFT JOIN sized ON sized.r = t.r GROUP BY t.r, t.doc_id
"""
