"""Byte-level BPE: encoding and decoding with a public vocabulary.

A text is cut by the vocabulary's pattern; each word is merged on two
contiguous arrays, the ids of its parts and the ranks of neighbouring
parts. The smallest rank is found by a scan, that boundary is deleted,
and the two ranks beside it are looked up again. Words are short, so a
scan beats a queue; a word of more than ``SCAN_PARTS`` parts (a long run
without white space) keeps its ranks in a heap instead, so that its cost
stays near-linear. Encoded words are kept in a bounded table per worker.

Defined cases
-------------
* Null or empty text: no tokens, decoded to the empty text.
* The text of an added token (such as an end mark) becomes that token.
* Decoding skips ids that the vocabulary lacks; bytes that aren't UTF-8
  become U+FFFD.
* Rows are independent: repeated rows get equal results; other columns
  are carried in ``row``.

Scale: a map over the scan, no shuffle. The vocabulary file (its size is
checked) is the only thing broadcast.
"""

from __future__ import annotations

import heapq
import json
import os

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as T
from .rows import name

#: Largest vocabulary file that is broadcast.
MAX_VOCAB_BYTES = 64 << 20
#: Parts of a word up to which the smallest rank is found by a scan.
SCAN_PARTS = 128
#: Encoded words kept per worker, and the longest that is kept.
KEPT_WORDS, KEPT_CHARS = 100_000, 48
#: Pattern that cuts a text into words (a fixed value of the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Rank of two parts that don't merge.
NO_RANK = 1 << 60


def byte_letters() -> list[str]:
    """The visible character that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    rest = [b for b in range(256) if b not in letters]
    return [letters.get(b) or chr(256 + rest.index(b)) for b in range(256)]


def read_vocab(path: str) -> bytes:
    if os.path.getsize(path) > MAX_VOCAB_BYTES:
        raise ValueError(f"{path} is too large to broadcast")
    with open(path, "rb") as f:
        return f.read()


class Encoder:
    """Encoding and decoding with one vocabulary file (tokenizers JSON)."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        as_byte = {c: i for i, c in enumerate(letters)}
        self.byte_id = [vocab[c] for c in letters]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.rank, self.merged = {}, []
        for r, (a, b) in enumerate(pairs):
            self.rank[vocab[a], vocab[b]] = r
            self.merged.append(vocab[a + b])
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.added_cut = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))) \
            if self.added else None
        self.token_bytes = {i: bytes(as_byte[c] for c in t) for t, i in vocab.items()}
        self.token_bytes.update({i: t.encode() for t, i in self.added.items()})
        self.words = regex.compile(PATTERN)
        self.kept = _Kept(self)

    def merge(self, word: bytes) -> list[int]:
        """Token ids of one word."""
        ids = [self.byte_id[b] for b in word]
        if len(ids) > SCAN_PARTS:
            return self._merge_long(ids)
        get = self.rank.get
        ranks = [get(p, NO_RANK) for p in zip(ids, ids[1:])]
        while ranks:
            least = min(ranks)
            if least == NO_RANK:
                break
            i = ranks.index(least)
            ids[i] = self.merged[least]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), NO_RANK)
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), NO_RANK)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        n, get = len(ids), self.rank.get
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i) for i in range(n - 1) if (r := get((ids[i], ids[i + 1]), NO_RANK)) != NO_RANK]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or get((ids[i], ids[j]), NO_RANK) != r:
                continue
            ids[i], ids[j], after[i] = self.merged[r], -1, after[j]
            if after[j] < n:
                before[after[j]] = i
                if (s := get((ids[i], ids[after[j]]), NO_RANK)) != NO_RANK:
                    heapq.heappush(heap, (s, i))
            if before[i] >= 0 and (s := get((ids[before[i]], ids[i]), NO_RANK)) != NO_RANK:
                heapq.heappush(heap, (s, before[i]))
        return [x for x in ids if x >= 0]

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        if self.added_cut is None:
            return b"".join(map(self.kept.__getitem__, self.words.findall(text)))
        out, at = [], 0
        for m in self.added_cut.finditer(text):
            out += map(self.kept.__getitem__, self.words.findall(text[at:m.start()]))
            out.append(self.added[m[0]].to_bytes(4, "little"))
            at = m.end()
        out += map(self.kept.__getitem__, self.words.findall(text[at:] if at else text))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        get, none = self.token_bytes.get, b""
        return b"".join([get(i, none) for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")


class _Kept(dict):
    """Encoded words; emptied when full."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.encoder.merge(word.encode()), dtype="<u4").tobytes()
        if len(word) <= KEPT_CHARS:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = ids
        return ids


_ENCODERS: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder per worker process and vocabulary."""
    data = shared.value
    key = hash(data)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(data)
    return _ENCODERS[key]


def encode(docs: DataFrame, vocab_path: str, text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``row`` and ``ids``: the token ids as little-endian unsigned 32-bit integers (binary).

    With ``decoded`` the ids are decoded again in the same pass, into a
    column of that name: one Python worker per task instead of two.
    """
    docs = docs.select(F.struct(*[F.col(name(c)) for c in docs.columns]).alias("row"))
    shared = docs.sparkSession.sparkContext.broadcast(read_vocab(vocab_path))

    def run(batches):
        e = _encoder(shared)
        for part, text in T.pieces(batches, text_col):
            ids = [e.encode(t) for t in T.strings(text)]
            cols = {"row": part.column("row"), "ids": pa.array(ids, type=pa.binary())}
            if decoded:
                cols["decoded"] = pa.array([e.decode(x) for x in ids], type=pa.string())
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return docs.mapInArrow(run, T.row_schema(docs, "ids binary" + ", decoded string" * decoded))


def decode(encoded: DataFrame, vocab_path: str) -> DataFrame:
    """``row``, ``ids`` and ``decoded``, the text of the ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_vocab(vocab_path))

    def run(batches):
        e = _encoder(shared)
        for b in batches:
            out = pa.array([e.decode(x or b"") for x in b.column("ids").to_pylist()], type=pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, out], names=[*b.schema.names, "decoded"])

    return encoded.mapInArrow(run, T.row_schema(encoded, "ids binary, decoded string"))


def vocab_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = encode(docs, vocab_path(), decoded=True)
    return out.select("row.doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
