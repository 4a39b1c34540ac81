"""Words and their hashes over whole Arrow text columns, without a Python loop over words.

Texts are handled as UTF-8 bytes, about ``PART_BYTES`` of neighbouring rows at a time, so that
memory does not follow the size of a batch; one text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from finetide.functions.memory import hand_back

PART_BYTES = 1 << 20
U64 = np.uint64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes of words: digits, letters and everything beyond ASCII.
WORD_BYTES = np.zeros(256, dtype=bool)
WORD_BYTES[48:58] = WORD_BYTES[65:91] = WORD_BYTES[97:123] = True
WORD_BYTES[128:] = True

#: Bytes that are no blank: everything but the space and U+0009 to U+000D.
INK_BYTES = np.ones(256, dtype=bool)
INK_BYTES[[32, 9, 10, 11, 12, 13]] = False

_STEP = U64(0xC2B2AE3D27D4EB4F)
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[int, np.ndarray] = {}


def lowered(data: np.ndarray) -> np.ndarray:
    """A to Z in lower case; other bytes as they are."""
    return _LOWER[data]


def text_parts(column: pa.Array, limit: int = PART_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets into them) of some rows at a time; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    n = len(column)
    if not n:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, values = column.buffers()
    off = np.frombuffer(places, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1))
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j
    hand_back()


def spans(data: np.ndarray, off: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``table``'s bytes inside each text, and each text's first run."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    mask = table[data]
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = mask[:-1]
    heads = off[:-1]
    before[heads[heads < n]] = False
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = mask[1:]
    tails = off[1:] - 1
    after[tails[tails >= 0]] = False
    starts = np.flatnonzero(mask & ~before)
    ends = np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers under which near inputs fall far apart."""
    h = h.astype(U64, copy=True)
    h ^= h >> U64(30)
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def _power(base: int, n: int) -> np.ndarray:
    """base to the 0, 1, ... n, modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        size = max(n + 1, PART_BYTES + 1)
        table = np.full(size, base, dtype=U64)
        table[0] = 1
        have = _powers[base] = np.multiply.accumulate(table)
    return have


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """A 64-bit hash of codes[start:end] for each span, from one running sum."""
    n = len(codes)
    up, down = _power(base, n), _power(pow(base, -1, 1 << 64), n)
    total = np.zeros(n + 1, dtype=U64)
    np.cumsum((codes.astype(U64) + U64(1)) * up[:n], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mixed(h + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def owner(first: np.ndarray) -> np.ndarray:
    """The text each run belongs to, from each text's first run."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    total = np.zeros(len(values) + 1, dtype=values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for each k neighbouring word hashes, never 0."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    total = np.zeros(n, U64)
    for j in range(k):
        total = total * _STEP + words[j : j + n]
    return mixed(total + U64(k)) | U64(1)


def winnowed(grams: np.ndarray, first: np.ndarray, k: int, window: int) -> np.ndarray:
    """Where a k-gram is the least of a whole window of its own text; ``first``: each text's first word.

    Every run of ``window`` k-grams inside a text has one.
    """
    span = window + k - 1
    n = len(grams) - window + 1
    if n <= 0:
        return np.zeros(len(grams), bool)
    low, width = grams, 1
    while 2 * width <= window:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = window - width
    low = np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
    of = owner(first)
    low = np.where(of[:n] == of[span - 1 : span - 1 + n], low, U64(0))
    pad = np.zeros(window - 1, U64)
    high, width = np.concatenate([pad, low, pad]), 1
    while 2 * width <= window:
        high = np.maximum(high[:-width], high[width:])
        width *= 2
    rest = window - width
    high = np.maximum(high[: len(high) - rest], high[rest:]) if rest else high
    return high == grams
