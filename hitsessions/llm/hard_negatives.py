"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Vectors are laid out along a Hilbert curve through all their dimensions
and cut into blocks, one Parquet folder each. A zone map keeps, per block
and label, the least and the greatest value of every dimension. For an
anchor, interval arithmetic over a zone gives bounds of its inner product
with any row of the zone:

    sum(min(a * lo, a * hi)) <= a . x <= sum(max(a * lo, a * hi))

An anchor's first window is "at least as good as the positives known so
far, of its label"; once its positives are known, each positive's score p
gives the window [low % of p, high % of p] of other labels. A pass reads
only the blocks with a zone that may hold a row of some anchor's window;
within a block the same bounds choose the anchors that look into it.

Defined cases
-------------
* Rows with a null label, a null vector or a null component take no part;
  neither do empty vectors. Vectors of unequal length: missing components
  are 0.
* Every row counts on its own, repeated rows too: a copy of an anchor's
  row is a positive of it, and each copy of an anchor is an anchor.
* Higher scores come first, ties by the smaller id, equal ids by the
  label. A null id sorts before all others and is never an anchor.
* An anchor without positives, or a positive without negatives, has no
  rows. A negative positive-score has an empty window.
* Scores are exact: products that might not fit 53 bits are summed as
  integers of any size, and a score beyond a long raises.
* Empty tables: no rows. Only the id, the label and the vector are read.

Scale: exact mining compares every anchor with every row of the blocks
its windows need, so it grows with anchors times rows where bounds don't
prune; that is the feature. Anchors go out in groups of ``group`` rows
(bounded bytes), each group in two passes. Equal rows are one row with a
count. The curve is dealt by range with the id as a second key, so equal
vectors spread. There are at most ``max_blocks`` blocks: their numbers
are all that the driver holds of the zones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import NULL_ID, id_of, let, name, removed, written

#: Positives per anchor, negatives per positive, window in percent of the positive's score.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 5, 80, 100
#: Cells of a dimension on the curve: 2 to this power.
CURVE_BITS = 2
#: Rows of a block, as long as there are no more than MAX_BLOCKS.
BLOCK_ROWS, MAX_BLOCKS = 1024, 4096
#: Anchors that one pass serves, and rows and anchors multiplied at once.
GROUP, TILE = 8192, 512
_NEVER = np.iinfo(np.int64).max


# ------------------------------------------------------------------ layout

def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Order keys along a Hilbert curve of cells (rows of numbers below ``2 ** bits``).

    Gray-code walk of the axes from the highest bit down (reflect the lower
    bits of the first axis where an axis has the bit, else swap them with
    that axis), then the bits of all axes are interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        low = q - 1
        for i in range(n):
            has = (x[i] & q) != 0
            swap = np.where(has, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(has, x[0] ^ low, x[0]) ^ swap
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], dtype=np.int64)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn = np.where((x[n - 1] & q) != 0, turn ^ (q - 1), turn)
    x ^= turn
    planes = [(x[i] >> b) & 1 for b in range(bits - 1, -1, -1) for i in range(n)]
    return [r.tobytes() for r in np.packbits(np.array(planes, dtype=np.uint8).T, axis=1)]


def _matrix(column, dim: int) -> np.ndarray:
    """Rows of a list column as a matrix (missing components: 0)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    off = np.asarray(column.offsets, dtype=np.int64)
    flat = np.asarray(column.values, dtype=np.int64)
    n = np.diff(off)
    out = np.zeros((len(n), dim), dtype=np.int64)
    if len(n) and (n == dim).all():
        return flat[off[0]:off[-1]].reshape(-1, dim)
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(off[0], off[-1]) - np.repeat(off[:-1], n)] = flat[off[0]:off[-1]]
    return out


def _usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """d, label, x and the number of equal rows, of the rows that take part."""
    x = rows[name(vector_col)].cast("array<long>")
    out = rows.select(id_of(rows[name(id_col)]).alias("d"), rows[name(label_col)].cast("long").alias("label"), x.alias("x"))
    out = out.where(F.col("label").isNotNull() & (F.size("x") > 0) & ~F.exists("x", lambda c: c.isNull()))
    return out.groupBy("d", "label", "x").agg(F.count("*").alias("copies"))


class Blocks:
    """The written layout: ``rows`` (d, label, x, copies) in folders by block, ``zones`` per block and label."""

    def __init__(self, rows: DataFrame, zones: DataFrame, dim: int, n: int, largest: int):
        self.rows, self.zones, self.dim, self.n = rows, zones, dim, n
        #: Whether inner products of two rows are exact in doubles.
        self.small = largest * largest * max(dim, 1) < 2**53

    def remove(self) -> None:
        removed(self.rows, self.zones)


def lay_out(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
            block_rows: int = BLOCK_ROWS, max_blocks: int = MAX_BLOCKS, bits: int = CURVE_BITS) -> Blocks:
    """Vectors (integer components) in Hilbert order, with their zone maps, in the shared work folder."""
    base = written(_usable(vectors, id_col, vector_col, label_col), "vectors")
    spread = base.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(
        F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.min("v").alias("lo"), F.max("v").alias("hi"),
        F.count("*").alias("n"))
    spread = sorted(spread.collect())  # one row per dimension
    dim, n = len(spread), int(max((r.n for r in spread), default=0))
    largest = max((max(abs(r.lo), abs(r.hi)) for r in spread), default=0)
    mean, std = (np.array([float(r[k]) for r in spread]) for k in ("mean", "std"))
    cells = 1 << bits

    def run(batches):
        for b in batches:
            if not len(b):
                continue
            x = _matrix(b.column("x"), dim)
            # Two standard deviations to both sides of the mean are cut into equal cells, the outer ones are open.
            at = np.floor(((x - mean) / np.where(std > 0, std, 1) + 2) / 4 * cells).clip(0, cells - 1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(hilbert_keys(at, bits), pa.binary())],
                                             names=[*b.schema.names, "key"])

    n_blocks = int(min(max_blocks, max(1, -(-n // block_rows))))
    keyed = base.mapInArrow(run, "d long, label long, x array<long>, copies long, key binary")
    # One range of the curve per block; the id splits equal keys.
    dealt = keyed.repartitionByRange(n_blocks, "key", "d", "label").withColumn("block", F.spark_partition_id())
    dealt = dealt.sortWithinPartitions("block", "key", "d", "label").drop("key")
    rows = written(dealt, "blocks", by="block")
    # One zone map row per block and label: a few dimensions wide arrays of the least and greatest values.
    ends = (rows.select("block", "label", F.posexplode("x").alias("i", "v")).groupBy("block", "label", "i")
            .agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n")))
    size = rows.groupBy("block", "label").agg(F.count("*").alias("rows"), F.min("d").alias("least"))
    # Rows without a component count as 0 there.
    ends = ends.join(size, ["block", "label"]).withColumns({
        "lo": F.when(F.col("n") < F.col("rows"), F.least("lo", F.lit(0))).otherwise(F.col("lo")),
        "hi": F.when(F.col("n") < F.col("rows"), F.greatest("hi", F.lit(0))).otherwise(F.col("hi"))})
    zones = ends.groupBy("block", "label").agg(
        F.sort_array(F.collect_list(F.struct("i", "lo", "hi"))).alias("e"))  # one entry per dimension
    zones = written(zones.select("block", "label", F.col("e.lo").alias("lo"), F.col("e.hi").alias("hi")), "zones")
    removed(base)
    return Blocks(rows, zones, dim, n, largest)


# ------------------------------------------------------------------ passes

class Anchors:
    """A group of anchors: ids, labels, vectors, and windows [lo, hi] of scores (``of`` names a window's anchor)."""

    def __init__(self, d, label, x, copies, dim: int, small: bool):
        self.d, self.label, self.copies, self.dim, self.small = d, label, copies, dim, small
        self.x = x if small else x.astype(object)

    def __len__(self) -> int:
        return len(self.d)

    def products(self, which: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Inner products of some anchors with some rows, exact."""
        if self.small:
            return (self.x[which].astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
        out = self.x[which] @ x.astype(object).T
        if len(out) and out.size and max(out.max(), -out.min()) >= 2**63:
            raise OverflowError("an inner product is beyond a long")
        return out.astype(np.int64)

    def bounds(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of every anchor with anything between two corners (exact where small)."""
        up, down = np.maximum(self.x, 0), np.minimum(self.x, 0)
        if self.small:
            up, down, lo, hi = (v.astype(np.float64) for v in (up, down, lo, hi))
        else:
            lo, hi = lo.astype(object), hi.astype(object)
        return up @ lo + down @ hi, up @ hi + down @ lo


class Windows:
    """Score windows of anchors, each with the best ``k`` rows found so far.

    A window takes rows of its anchor's label (``same``) or of the others,
    with scores in [lo, hi].
    """

    def __init__(self, anchors: Anchors, of, lo, hi, same: bool, k: int):
        self.anchors, self.of, self.same, self.k = anchors, of, same, k
        self.lo, self.hi = np.array(lo, dtype=np.int64), np.array(hi, dtype=np.int64)
        self.found = tuple(np.zeros(0, dtype=np.int64) for _ in range(5))  # window, score, d, label, copies

    def need(self, block_labels, lows, highs) -> np.ndarray:
        """(window, zone) flags: the zone may hold a row of the window."""
        out = np.zeros((len(self.of), len(block_labels)), dtype=bool)
        for z, label in enumerate(block_labels):
            least, most = self.anchors.bounds(lows[z], highs[z])
            fits = (self.anchors.label == label) == self.same
            out[:, z] = fits[self.of] & (most[self.of] >= self.lo) & (least[self.of] <= self.hi)
        return out

    def look(self, d, label, x, copies) -> None:
        """Rows of one block, in tiles; the windows whose bounds let them look."""
        labels = np.unique(label)
        lows = [x[label == v].min(0) for v in labels]
        highs = [x[label == v].max(0) for v in labels]
        which = np.flatnonzero(self.need(labels, lows, highs).any(1))
        for a in range(0, len(which), TILE):
            w = which[a:a + TILE]
            anchors, at = np.unique(self.of[w], return_inverse=True)
            score = self.anchors.products(anchors, x)[at]
            fits = (self.anchors.label[self.of[w]][:, None] == label[None, :]) == self.same
            fits &= (score >= self.lo[w][:, None]) & (score <= self.hi[w][:, None])
            i, j = np.nonzero(fits)
            mine = self.anchors.d[self.of[w[i]]] == d[j] if self.same else np.zeros(len(i), dtype=bool)
            n = copies[j]
            if mine.any():
                # The anchor's own row is no positive of it; its copies are.
                own = mine & (self.anchors.x[self.of[w[i]]] == x[j]).all(1)
                n = n - own
            keep = n > 0
            new = (w[i], score[i, j], d[j], label[j], np.minimum(n, self.k))
            self.found = tuple(np.concatenate([old, v[keep]]) for old, v in zip(self.found, new))
            self._trim()

    def _trim(self) -> None:
        w, score, d, label, n = self.found
        order = np.lexsort((label, d, -score, w))
        w, score, d, label, n = (v[order] for v in self.found)
        first = np.searchsorted(w, w, side="left")
        done = np.cumsum(n) - n
        before = done - done[first] if len(w) else done
        keep = before < self.k
        self.found = tuple(v[keep] for v in (w, score, d, label, n))
        # A window with k rows takes only scores from its last one up.
        w, score, n = self.found[0], self.found[1], self.found[4]
        total = np.bincount(w, weights=n, minlength=len(self.of))
        last = np.full(len(self.of), np.iinfo(np.int64).min)
        last[w] = score  # sorted: the last one of a window stays
        full = total >= self.k
        self.lo[full] = np.maximum(self.lo[full], last[full])


_FOUND = "w long, score long, d long, label long, n long"


def _pass(blocks: Blocks, windows: Windows) -> DataFrame:
    """w, score, d, label, n: the best rows of every window, from the blocks that the zone maps leave."""
    spark, dim = blocks.rows.sparkSession, blocks.dim
    shared = spark.sparkContext.broadcast(windows)

    def choose(batches):
        w = shared.value
        for b in batches:
            if len(b):
                need = w.need(b.column("label").to_pylist(), _matrix(b.column("lo"), dim), _matrix(b.column("hi"), dim))
                yield pa.RecordBatch.from_arrays([b.column("block").filter(pa.array(need.any(0)))], names=["block"])

    chosen = blocks.zones.mapInArrow(choose, "block int").distinct().collect()  # MAX_BLOCKS of them at most
    rows = blocks.rows.where(F.col("block").isin([r.block for r in chosen]))

    def run(batches):
        from copy import copy
        w = copy(shared.value)
        w.lo = w.lo.copy()
        for b in batches:
            for a in range(0, len(b), TILE):
                part = b.slice(a, TILE)
                w.look(*(np.asarray(part.column(c), dtype=np.int64) for c in ("d", "label")),
                       _matrix(part.column("x"), dim), np.asarray(part.column("copies"), dtype=np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(v.astype(np.int64)) for v in w.found], names=["w", "score", "d", "label", "n"])

    found = rows.select("d", "label", "x", "copies").mapInArrow(run, _FOUND)
    order = Window.partitionBy("w").orderBy(F.desc("score"), "d", "label")
    top = found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= windows.k)
    before = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return (top.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < windows.k)
            .select("w", "score", "d", "label", F.least("n", windows.k - F.col("before")).alias("n")))


def _group(rows: list, blocks: Blocks) -> Anchors:
    x = np.zeros((len(rows), blocks.dim), dtype=np.int64)
    for i, r in enumerate(rows):
        x[i, :len(r.x)] = r.x
    return Anchors(*(np.array([r[c] for r in rows], dtype=np.int64) for c in ("d", "label")), x,
                   np.array([r.copies for r in rows]), blocks.dim, blocks.small)


def _groups(anchors: DataFrame, group: int):
    """Anchors in the order of the curve, ``group`` at a time."""
    rows = []
    for r in anchors.toLocalIterator():
        rows.append(r)
        if len(rows) == group:
            yield rows
            rows = []
    if rows:
        yield rows


def mine(vectors: DataFrame, is_anchor, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         block_rows: int = BLOCK_ROWS, max_blocks: int = MAX_BLOCKS, group: int = GROUP) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has integer components; ``is_anchor`` is a condition over
    the id, as a function of its column.
    """
    spark = vectors.sparkSession
    blocks = lay_out(vectors, id_col, vector_col, label_col, block_rows, max_blocks)
    marked = blocks.rows.where((F.col("d") != NULL_ID) & is_anchor(F.col("d")))
    parts = []
    for rows in _groups(marked.orderBy("block", "d"), group):
        anchors = _group(rows, blocks)
        everything = np.full(len(anchors), -_NEVER)
        seeds = Windows(anchors, np.arange(len(anchors)), everything, np.full(len(anchors), _NEVER), True, positives)
        # The group itself gives first thresholds: rows of one label that are anchors are positives of each other.
        for a in range(0, len(anchors), TILE):
            b = slice(a, a + TILE)
            seeds.look(anchors.d[b], anchors.label[b], anchors.x[b].astype(np.int64), anchors.copies[b])
        first = Windows(anchors, np.arange(len(anchors)), seeds.lo, np.full(len(anchors), _NEVER), True, positives)
        good = written(_pass(blocks, first), "positives")
        # positives * len(anchors) rows at most: the scores that open the windows.
        p = np.array(good.select("w", "score").distinct().orderBy("w", "score").collect(), dtype=np.int64).reshape(-1, 2)
        of, p = p[:, 0], p[:, 1]
        bound = [(-((-low * int(s)) // 100), (high * int(s)) // 100) for s in p.tolist()]
        lo, hi = np.array([b[0] for b in bound], dtype=np.int64), np.array([b[1] for b in bound], dtype=np.int64)
        second = Windows(anchors, of, lo, hi, False, negatives)
        bad = written(_pass(blocks, second), "negatives")
        ids = spark.createDataFrame(pa.table({
            "w": np.arange(len(of)), "a": of, "anchor_id": anchors.d[of], "positive_score": p,
            "times": anchors.copies[of].astype(np.int64)}))
        parts.append(written(_rows(good, bad, ids), "mined"))
        removed(good, bad)
    blocks.remove()
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                    "positive_score long, negative_score long")
    for part in parts:
        out = out.union(part)
    return out


def _repeat(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(1), n.cast("int")))


def _rows(good: DataFrame, bad: DataFrame, ids: DataFrame) -> DataFrame:
    """A group's positives, each with the negatives of its score's window."""
    ids = F.broadcast(ids)  # positives * group rows at most
    first = good.select(F.col("w").alias("a"), F.col("score").alias("positive_score"), F.col("d").alias("positive_id"),
                        "n").join(ids, ["a", "positive_score"])
    # Copies of an anchor and of a positive repeat the rows of both.
    first = first.withColumn("copy", _repeat(F.col("n") * F.col("times"))).drop("n")
    last = bad.select("w", F.col("score").alias("negative_score"), F.col("d").alias("negative_id"),
                      F.col("label").alias("negative_label"), _repeat(F.col("n")).alias("again"))
    rank = F.row_number().over(Window.partitionBy("w").orderBy(F.desc("negative_score"), "negative_id", "negative_label", "again"))
    last = last.withColumn("rank", rank)
    real = lambda c: F.when(F.col(c) != NULL_ID, F.col(c)).alias(c)
    return first.join(last, "w").select("anchor_id", real("positive_id"), "rank", real("negative_id"),
                                        "positive_score", "negative_score")


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component; null where a component is null or not finite."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return F.when(~bad, F.transform(vector, lambda c: F.floor(F.lit(scale) * c.cast("double"))))


def query(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", whole_numbers(F.col("embedding")).alias("embedding"), label.alias("label"))
    return mine(rows, lambda d: d % 100 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT::DOUBLE) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pair AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), good AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM pair WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER w::INT AS rank, other AS negative_id, positive_score, score AS negative_score
FROM good JOIN pair USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY rank <= 5
"""
