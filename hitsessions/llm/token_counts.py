"""Token counts by a linear longest-match automaton.

Greedy word pieces take the longest piece that fits, then the longest
that fits the rest. The automaton reads a word once, byte by byte: a trie
of the vocabulary, where each node has a failure link to the node to go
on from when the next byte doesn't fit, and the number of pieces that are
complete by then. Counting needs no piece to be built.

Defined cases
-------------
* Null or empty text: 0 words, 0 tokens.
* Words are runs without white space (``[^\\x20\\x09-\\x0D]+``). A word that
  the vocabulary can't cover counts as one unknown token.
* Rows are independent: repeated rows get equal results; other columns
  are carried in ``row``.

Scale: a map over the scan, no shuffle; the vocabulary (size checked) is
broadcast. A word of any length takes time linear in its bytes.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as T
from .bpe import byte_letters, read_vocab, vocab_path
from .rows import name

#: Counts of words kept per worker, and the longest word that is kept.
KEPT_WORDS, KEPT_BYTES = 500_000, 64


class LongestMatch:
    """Counts of greedy longest-match pieces.

    ``first`` are the pieces that can begin a word, ``inner`` those that
    can continue it.
    """

    ROOT, INNER = 0, 1

    def __init__(self, first: Iterable[bytes], inner: Iterable[bytes]):
        self.child: dict[int, int] = {}  # node * 256 + byte -> node
        ends = set()
        size = 2
        parent, byte = [-1, -1], [-1, -1]
        for root, group in ((self.ROOT, first), (self.INNER, inner)):
            for piece in group:
                node = root
                for b in piece:
                    key = node * 256 + b
                    if key not in self.child:
                        self.child[key] = size
                        parent.append(node)
                        byte.append(b)
                        size += 1
                    node = self.child[key]
                if piece:
                    ends.add(node)
        self._links(size, ends, parent, byte)

    def _links(self, size: int, ends: set[int], parent: list[int], byte: list[int]) -> None:
        # A node's link needs those of shorter nodes only: go by depth.
        depth = [0] * size
        for v in range(2, size):
            depth[v] = depth[parent[v]] + 1
        self.link, self.popped = [-1] * size, [0] * size
        for v in sorted(range(2, size), key=depth.__getitem__):
            if v in ends:
                self.link[v], self.popped[v] = self.INNER, 1
                continue
            at, count = self.link[parent[v]], self.popped[parent[v]]
            while at >= 0 and at * 256 + byte[v] not in self.child:
                count += self.popped[at]
                at = self.link[at]
            if at >= 0:
                self.link[v], self.popped[v] = self.child[at * 256 + byte[v]], count

    def count(self, word: bytes) -> int:
        """Pieces of a word; 1 if it can't be covered (unknown)."""
        child, link, popped = self.child, self.link, self.popped
        node = total = 0
        for b in word:
            while (to := child.get(node * 256 + b)) is None:
                total += popped[node]
                node = link[node]
                if node < 0:
                    return 1
            node = to
        while node > 1:
            total += popped[node]
            node = link[node]
        return total if node >= 0 else 1


class _Kept(dict):
    def __init__(self, automaton: LongestMatch, mark: bytes):
        super().__init__()
        self.automaton, self.mark = automaton, mark

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(self.mark + word)
        if len(word) <= KEPT_BYTES:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = n
        return n


def byte_pieces(data: bytes) -> tuple[list[bytes], list[bytes]]:
    """Pieces of a byte-level vocabulary: those that begin with the space of a word's start, and the others."""
    as_byte = {c: i for i, c in enumerate(byte_letters())}
    tokens = [bytes(as_byte[c] for c in t) for t in json.loads(data)["model"]["vocab"]]
    return [t for t in tokens if t[:1] == b" "], [t for t in tokens if t[:1] != b" "]


_COUNTERS: dict[int, _Kept] = {}


def _counter(shared) -> _Kept:
    data = shared.value
    key = hash(data)
    if key not in _COUNTERS:
        _COUNTERS[key] = _Kept(LongestMatch(*byte_pieces(data)), b" ")
    return _COUNTERS[key]


def count_tokens(docs: DataFrame, vocab_file: str, text_col: str = "text") -> DataFrame:
    """``row``, ``n_words`` and ``n_tokens`` (greedy word pieces) of every row."""
    docs = docs.select(F.struct(*[F.col(name(c)) for c in docs.columns]).alias("row"))
    shared = docs.sparkSession.sparkContext.broadcast(read_vocab(vocab_file))

    def run(batches):
        kept = _counter(shared)
        for part, text in T.pieces(batches, text_col):
            buf, off = T.text_bytes(text)
            data = buf.tobytes()
            n_words, n_tokens = [], []
            for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
                words = data[a:b].split()  # bytes split at exactly the blanks of the contract
                n_words.append(len(words))
                n_tokens.append(sum(map(kept.__getitem__, words)))
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(np.array(n_words, dtype=np.int64)),
                 pa.array(np.array(n_tokens, dtype=np.int64))], names=["row", "n_words", "n_tokens"])

    return docs.mapInArrow(run, T.row_schema(docs, "n_words long, n_tokens long"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_tokens(docs, vocab_path()).select("row.doc_id", "n_words", "n_tokens")
