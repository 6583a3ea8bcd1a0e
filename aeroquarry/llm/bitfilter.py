"""A bit array of hashed keys, of bounded size: spares most rows a shuffle, never loses one."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits for each key, and the least and the most bits in all (128 kB and 32 MB). With more keys than
#: the most bits serve, more rows pass and nothing else changes; in the end all rows do.
KEY_BITS, LEAST_BITS, MOST_BITS = 32, 1 << 20, 1 << 28


def bits_for(n_keys: int) -> int:
    """A power of two."""
    return min(max(LEAST_BITS, 1 << (max(1, KEY_BITS * n_keys) - 1).bit_length()), MOST_BITS)


def build(keys: DataFrame, name: str, n_keys: int) -> np.ndarray:
    """Bytes of the array for a column of at most ``n_keys`` different longs. A bounded number of 64-bit words comes back to the driver."""
    size = bits_for(n_keys)
    # pmod of a signed long agrees with the unsigned remainder, as the modulus is a power of two.
    bit = F.pmod(F.col(name), F.lit(size))
    words = keys.select(F.shiftright(bit, 6).alias("w"), F.expr(f"shiftleft(1L, cast(pmod({name}, 64) as int))").alias("b"))
    rows = words.groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    out = np.zeros(size // 64, np.int64)
    out[rows["w"].to_numpy(np.int64)] = rows["b"].to_numpy(np.int64)
    return out.view(np.uint8)


def hits(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys.view(np.uint64) % np.uint64(8 * len(table))
    return (table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
