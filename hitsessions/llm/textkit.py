"""Array helpers for text: words, hashes and windows of a batch in numpy.

The operators that are not native work on Arrow batches of documents.
Every helper here takes the UTF-8 bytes of a whole batch at once and
returns arrays, so no Python object is made per word.

Hashes are 64-bit. A word's hash is a polynomial over its bytes modulo
2**64, mixed by a finaliser. Windows combine word hashes by a second
polynomial; keys that are compared across the corpus use two such
polynomials (128 bits).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; a longer document is one chunk of its own.
CHUNK_BYTES = 1 << 18

#: White space of the word contracts: space and \t \n \v \f \r.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
#: Odd multipliers of the window polynomials (two, for 128-bit keys).
WINDOW_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x + _U((seed * 0x9E3779B97F4A7C15 + 0x1234567) % 2**64)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0xA24BAED4963EE407)
    return x ^ (x >> _U(32))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inv = base % 2**64, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, dtype=_U)

    def upto(self, n: int):
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up = _cumprod(self.base, size)
            self.down = _cumprod(self.inv, size)
        return self.up[:n], self.down[:n]


def _cumprod(base: int, n: int) -> np.ndarray:
    a = np.full(n, base, dtype=_U)
    a[0] = 1
    return np.cumprod(a, dtype=_U)


_POWERS: dict[int, _Powers] = {}


def _powers(base: int, n: int):
    return _POWERS.setdefault(base, _Powers(base)).upto(n)


def chunks(batch: pa.RecordBatch, column: str, size: int = CHUNK_BYTES):
    """Slices of a batch holding about ``size`` bytes of text each (one row at least)."""
    off = _offsets(batch.column(column))
    start, n = 0, len(batch)
    while start < n:
        end = int(np.searchsorted(off, off[start] + size, side="right")) - 1
        end = min(max(end, start + 1), n)
        yield batch.slice(start, end - start)
        start = end


def _offsets(col) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    return np.frombuffer(col.buffers()[1], dtype=kind, count=len(col) + 1 + col.offset)[col.offset:].astype(np.int64)


def text_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n+1 offsets of its rows (null: empty)."""
    if pa.types.is_null(col.type):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(col) + 1, dtype=np.int64)
    if col.null_count:
        col = col.fill_null("")
    if not len(col):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    off = _offsets(col)
    data = col.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def words(buf: np.ndarray, off: np.ndarray, inside: np.ndarray | None = None):
    """Starts and ends of the words of a batch, and the word offsets of its rows.

    ``inside`` is a table of 256 flags: bytes that belong to words
    (default: all but white space).
    """
    inside = ~SPACE if inside is None else inside
    m = inside[buf] if len(buf) else np.zeros(0, dtype=bool)
    edge = np.zeros(len(buf) + 1, dtype=bool)
    edge[off] = True
    prev = np.concatenate([[False], m[:-1]]) if len(m) else m
    starts = np.flatnonzero(m & (~prev | edge[:-1]))
    nxt = np.concatenate([m[1:], [False]]) if len(m) else m
    ends = np.flatnonzero(m & (~nxt | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word."""
    if not len(starts):
        return np.zeros(0, dtype=_U)
    up, down = _powers(_BASE, len(buf) + 1)
    acc = np.zeros(len(buf) + 1, dtype=_U)
    np.cumsum((buf.astype(_U) + _U(1)) * up[:len(buf)], out=acc[1:])
    h = (acc[ends] - acc[starts]) * down[starts]
    return mix(h + (ends - starts).astype(_U) * _U(0xC2B2AE3D27D4EB4F))


def window_hashes(wh: np.ndarray, length: int, base: int = WINDOW_BASES[0]) -> np.ndarray:
    """Hash of the ``length`` words that start at each position of ``wh``."""
    n = len(wh) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=_U)
    up, down = _powers(base, len(wh) + 1)
    acc = np.zeros(len(wh) + 1, dtype=_U)
    np.cumsum(wh * up[:len(wh)], out=acc[1:])
    return mix((acc[length:] - acc[:-length]) * down[:n], length)


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    up = (buf >= 0x41) & (buf <= 0x5A)
    return buf + (up.astype(np.uint8) << 5)


def minimisers(h: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Selected positions, and for each the number of windows that select it.

    ``h`` holds the seed hash of each position. A window is ``span``
    consecutive positions; it selects its smallest hash (the first of
    equals). Equal texts thus select equal places. Windows that select
    one position are consecutive; the second array gives, per selected
    position, the index of its first window.
    """
    n = len(h) - span + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    pick = _sliding_argmin(h, span)
    first = np.flatnonzero(np.concatenate([[True], pick[1:] != pick[:-1]]))
    return pick[first], first


def _sliding_argmin(h: np.ndarray, span: int) -> np.ndarray:
    """Position of the leftmost minimum of each window, by doubling."""
    best, width = np.arange(len(h)), 1
    while width * 2 <= span:
        a, b = best[:-width], best[width:]
        best = np.where(h[b] < h[a], b, a)
        width *= 2
    if width < span:
        a, b = best[:len(h) - span + 1], best[span - width:span - width + len(h) - span + 1]
        best = np.where(h[b] < h[a], b, a)
    return best


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit hashes as the long values of a Spark column."""
    return np.ascontiguousarray(x).view(np.int64)


def pieces(batches, text_col: str, size: int = CHUNK_BYTES):
    """(sub-batch, text column) of about ``size`` bytes each, from batches with a ``row`` struct."""
    for batch in batches:
        row = batch.column("row")
        text = row.field(row.type.get_field_index(text_col))
        if pa.types.is_null(text.type) or not len(batch):
            if len(batch):
                yield batch, text
            continue
        for part in chunks(pa.RecordBatch.from_arrays([row, text], names=["row", "text"]), "text", size):
            yield batch.slice(_start(part, row), len(part)), part.column("text")


def _start(part, row) -> int:
    return part.column("row").offset - row.offset


def strings(text) -> list[str]:
    """The texts as Python strings (null: empty; broken UTF-8: replaced)."""
    buf, off = text_bytes(text)
    data = buf.tobytes()
    return [data[a:b].decode("utf-8", "replace") for a, b in zip(off[:-1].tolist(), off[1:].tolist())]


def row_schema(docs, extra: str):
    """Schema string of a mapInArrow result: the ``row`` struct and more columns."""
    return f"row {docs.schema['row'].dataType.simpleString()}, {extra}"
