"""A filter of hashes of fixed size: it lets too much pass, never too little.

Tasks leave out what cannot find a partner before it is shuffled. A set that outgrows the filter
fills it and more rows pass; results never depend on its size.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits that one of Spark's bitmaps holds, as a power of two.
_BITMAP_BITS = 15


def fixed_filter(rows: DataFrame, name: str, bits: int) -> np.ndarray:
    """2 ** ``bits`` bits, set where a value of the bigint column falls by its low bits."""
    slot = F.col(name).bitwiseAND(F.lit((1 << bits) - 1))
    bitmap = rows.groupBy(F.shiftright(slot, _BITMAP_BITS).alias("at")).agg(
        F.bitmap_construct_agg(slot.bitwiseAND(F.lit((1 << _BITMAP_BITS) - 1))).alias("bits")
    )
    out = np.zeros(1 << (bits - 3), np.uint8)
    size = 1 << (_BITMAP_BITS - 3)
    for at, part in bitmap.collect():  # 4 kB a row, as many as the size needs
        out[at * size : (at + 1) * size] = np.frombuffer(part, np.uint8)
    return out


def passes(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the 64-bit hashes may be in the set."""
    slots = hashes.view(np.uint64) & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1 > 0
