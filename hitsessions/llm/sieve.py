"""A bitmap of fixed size that tells which keys may be in a set.

Used before a shuffle: rows whose key is certainly not in the set stay
out of it. A bit may be set by another key, so a hit proves nothing and
an exact count or join follows every sieve; results never depend on it.
Its size is a parameter, not the data's: 2**27 bits are 16 MB to
broadcast. With more keys than bits it lets more rows through.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a sieve: 2 ** this.
SIEVE_BITS = 27
_BLOCK = 15  # bits of a block's index space: bitmap_construct_agg makes blocks of 32768 bits


def build(keys: DataFrame, bits: int = SIEVE_BITS, at_most: int | None = None):
    """Broadcast bytes of the sieve over the long column ``key``.

    Where the number of keys is known to be ``at_most`` so many, the sieve
    is no larger than they need (16 to 32 bits a key). Destroy the
    broadcast once nothing uses it any more.
    """
    if at_most is not None:
        bits = min(bits, max(_BLOCK, (16 * at_most).bit_length()))
    place = F.pmod(F.col("key"), F.lit(1 << bits))
    blocks = (keys.select(F.shiftright(place, _BLOCK).alias("block"),
                          place.bitwiseAND((1 << _BLOCK) - 1).alias("bit"))
              .repartition(16, "block").groupBy("block").agg(F.bitmap_construct_agg("bit").alias("set")))
    out = np.zeros(1 << (bits - 3), dtype=np.uint8)
    size = 1 << (_BLOCK - 3)
    for r in blocks.collect():  # at most 2 ** (bits - 15) blocks of 4 KB: the size of the sieve
        out[r.block * size:(r.block + 1) * size] = np.frombuffer(r.set, dtype=np.uint8)
    return keys.sparkSession.sparkContext.broadcast(out)


def hit(sieve: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """True where a key may be in the set."""
    place = np.mod(np.ascontiguousarray(keys).view(np.int64), len(sieve) * 8)
    return (sieve[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
