"""Words of text columns as 64-bit hashes, whole Arrow batches at a time.

No Python string is made: words are runs of non-separator bytes in the column's
own buffer. A word's hash is its polynomial value modulo 2**64, taken from a
running sum, and mixed afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text that is looked at together; a longer row stands alone.
CHUNK_BYTES = 1 << 20
SHINGLE = 5

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)

_powers: dict[str, np.ndarray] = {}


def _table(separators: range | list[int]) -> np.ndarray:
    """Byte to digit: separators 0, other bytes 1 to 256 with A-Z as a-z."""
    digits = np.arange(1, 257, dtype=np.uint64)
    digits[65:91] += np.uint64(32)
    digits[list(separators)] = 0
    return digits


#: Words end at white space only.
SPACED = _table([0x20, *range(0x09, 0x0E)])
#: The same, but letters keep their case.
SPACED_CASED = np.arange(1, 257, dtype=np.uint64)
SPACED_CASED[[0x20, *range(0x09, 0x0E)]] = 0
#: Words are letters, digits and bytes beyond ASCII.
PLAIN = _table([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def _rising(base: int, size: int) -> np.ndarray:
    steps = np.full(size, base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers for n bytes; those beyond a chunk are not held on to."""
    if n > CHUNK_BYTES:
        return _rising(_BASE, n), _rising(_INVERSE, n)
    if not _powers:
        _powers.update(up=_rising(_BASE, CHUNK_BYTES), down=_rising(_INVERSE, CHUNK_BYTES))
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of consecutive rows; row r has the words first[r] to first[r + 1]."""

    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray  # byte positions in the chunk
    ends: np.ndarray
    data: np.ndarray  # the chunk's bytes
    offsets: np.ndarray  # of the rows in the chunk

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null reads as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data, offsets.astype(np.int64)


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer row stands alone."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + size, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


def words(data: np.ndarray, offsets: np.ndarray, digits: np.ndarray) -> Words:
    """Words of the rows between consecutive offsets."""
    at = offsets - offsets[0]
    data = data[offsets[0] : offsets[-1]]
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), np.zeros(len(at), np.int64), none, none, data, at)
    values = digits[data]
    inside = values != 0
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edges = at[:-1][at[:-1] < n]
    opens[edges] = inside[edges]
    edges = at[1:][at[1:] > 0] - 1
    closes[edges] = inside[edges]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    up, down = _power(n)
    values *= up
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts])
    return Words(hashes, np.searchsorted(starts, at), starts, ends, data, at)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words, rows ignored."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for i in range(1, k):
        out *= _STEP
        out += hashes[i : i + n]
    return mix(out)


def shingle_sets(w: Words, k: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each row its distinct k-word shingles, sorted.

    A row with fewer words has one: all its words; a row without words has none.
    """
    every = grams(w.hashes, k)
    for low, high in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        n = high - low
        if n >= k:
            yield np.unique(every[low : high - k + 1])
        elif n:
            yield mix(grams(w.hashes[low:high], n) + np.uint64(n))
        else:
            yield np.zeros(0, np.uint64)
