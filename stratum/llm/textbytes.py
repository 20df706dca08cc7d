"""Words and word hashes of whole Arrow text columns, with numpy over the UTF-8 bytes.

A column is taken in slices of whole documents of about half a megabyte, so memory is bounded by the
longest document and not by the batch. No Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE_VALUE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
IS_LETTER = np.zeros(256, bool)
IS_LETTER[65:91] = IS_LETTER[97:123] = IS_LETTER[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept for the slices to come."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size > 16 * SLICE_BYTES:
            return have  # of one huge document: not kept
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit word."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Slice(NamedTuple):
    first: int  # row of the batch
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, rows + 1


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Whole documents in slices of about ``limit`` bytes; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield Slice(lo, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    per_doc: np.ndarray  # index of the first word of each document, documents + 1


def words(part: Slice, is_word: np.ndarray) -> Words:
    """Maximal runs of the bytes marked in ``is_word``, never across documents."""
    inside = is_word[part.data]
    n = len(inside)
    cuts = part.offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[cuts] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[cuts - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(starts, ends, np.searchsorted(starts, part.offsets))


class Hashes:
    """Hashes of any byte range of a slice in constant time each; A-Z hash as a-z if ``fold``."""

    def __init__(self, data: np.ndarray, fold: bool = True):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((_BYTE_VALUE[LOWER] if fold else _BYTE_VALUE)[data] * powers(_BASE, n), out=self.sums[1:])
        self.back = powers(_INVERSE, n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        x = (self.sums[ends] - self.sums[starts]) * self.back[starts]
        x += (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return mix(x)
