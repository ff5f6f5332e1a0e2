"""Vectorised numpy work on the UTF-8 bytes of Arrow text columns.

Texts are looked at in blocks of a few MB, so memory does not grow with a batch;
one text longer than that is a block of its own. Words are maximal runs of bytes
outside a separator set; hashes have 64 bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 2 << 20
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True
#: Everything but ASCII letters, digits and bytes of longer characters.
NOT_LETTER = np.array([not (x >= 128 or chr(x).isalnum()) for x in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: A longer run of white space is more than the pattern of the fast byte-level encoder can go back over.
LONG_RUN = 200_000
_RUN = re.compile(rf"\s{{{LONG_RUN}}}")


def has_long_run(text: str) -> bool:
    return len(text) >= LONG_RUN and _RUN.search(text) is not None


@dataclass
class Block:
    """Rows first..first+n of a column: their bytes end to end, row i at offsets[i]:offsets[i+1]."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


def blocks(column: pa.Array, limit: int = BLOCK) -> Iterator[Block]:
    """Blocks of a string column; null counts as empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        end = min(end, n)
        yield Block(row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end


def lower(data: np.ndarray, latin: bool = False) -> np.ndarray:
    """A-Z in lower case; with `latin` the capitals of U+00C0..U+00DE as well."""
    out = _LOWER[data]
    if latin and len(out) > 1:
        capital = np.flatnonzero((out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)) + 1
        out[capital] += 0x20
    return out


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, rows) of all words; none crosses two rows."""
    inside = ~separators[data]
    if not len(inside):
        return (np.zeros(0, np.int64),) * 3
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.concatenate(([False], inside[:-1])) & ~cut[:-1]
    after = np.concatenate((inside[1:], [False])) & ~cut[1:]
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for p in (_P, _P_INV):
        x = np.full(n, p, np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


def finish(x: np.ndarray) -> np.ndarray:
    """Mix the bits of 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_MIXED = finish(np.arange(1, 257, dtype=np.uint64))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span; starts and ends ascend."""
    parts, at = [], 0
    while at < len(starts):
        # Spans are hashed by stretches, so tables and sums stay small beside a long text.
        low = starts[at]
        upto = max(at + 1, int(np.searchsorted(ends, low + BLOCK, "right")))
        parts.append(_stretch(data[low : ends[upto - 1]], starts[at:upto] - low, ends[at:upto] - low))
        at = upto
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _stretch(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, inverse = _powers(max(1 << int(len(data)).bit_length(), BLOCK))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_MIXED[data] * power[: len(data)], out=sums[1:])
    lengths = (ends - starts).astype(np.uint64)
    return finish((sums[ends] - sums[starts]) * inverse[starts] + lengths * np.uint64(0xD6E8FEB86659FD93))


def row_starts(rows: np.ndarray, n: int) -> np.ndarray:
    """Where the items of row i begin in `rows`, which is sorted; n + 1 values."""
    return np.searchsorted(rows, np.arange(n + 1))


def shingles(hashes: np.ndarray, rows: np.ndarray, n: int, width: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its `width`-word shingles; of all its words where it has fewer."""
    out = []
    rolled = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for j in range(width if len(rolled) else 0):
        rolled = rolled * np.uint64(_P) + hashes[j : len(hashes) - width + 1 + j]
    rolled = finish(rolled)
    at = row_starts(rows, n)
    for i in range(n):
        a, b = at[i], at[i + 1]
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            for x in hashes[a:b]:
                whole = np.uint64((int(whole) * _P + int(x)) & (1 << 64) - 1)
            out.append(finish(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
