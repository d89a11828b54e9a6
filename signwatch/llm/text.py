"""Words of a column of texts as numpy arrays.

Tasks see texts as Arrow batches. The helpers here work on the UTF-8 bytes of a whole slice of documents at once:
find words, lower-case A-Z, hash words and word windows. Only ASCII bytes separate words, so bytes decide as code
points would. Hashes are 64 bits wide and equal in every process.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer document is a slice of its own.
SLICE_BYTES = 1 << 20

#: The two kinds of words that the queries speak of, as separators among the ASCII bytes.
SPACES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
SIGNS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


@cache
def word_bytes(separators: bytes) -> np.ndarray:
    """Which of the 256 byte values belong to words."""
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


@cache
def lowered() -> np.ndarray:
    """Byte values with A-Z mapped to a-z."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


_POWERS: list[np.ndarray] = []
_STEP = 1 << 18


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the multiplier and of its inverse; kept for the slices of a usual size."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = -(-n // _STEP) * _STEP
        powers = [np.cumprod(np.full(size, x, dtype=np.uint64)) for x in (_ODD, _INVERSE)]
        if n > 4 * SLICE_BYTES:
            return powers[0], powers[1]
        _POWERS[:] = powers
    return _POWERS[0], _POWERS[1]


@dataclass
class Words:
    """Words of consecutive documents: byte positions, and the first word of each document (one entry more)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    sums: np.ndarray | None = None

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def documents(self) -> np.ndarray:
        """For each word the number of its document."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return self.parts(self.starts, self.ends)

    def parts(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the bytes between each start and end."""
        if not len(starts):
            return np.zeros(0, dtype=np.uint64)
        up, down = _powers(len(self.data) + 1)
        if self.sums is None:
            self.sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum(_byte_values()[self.data] * up[: len(self.data)], out=self.sums[1:])
        return mix((self.sums[ends] - self.sums[starts]) * down[starts])

    def windows(self, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts (word numbers) of the windows of ``length`` words within one document, and their hashes."""
        left = np.repeat(self.first[1:], self.counts()) - np.arange(len(hashes))
        at = np.flatnonzero(left >= length)
        return at, window_hashes(hashes, length)[at] if len(at) else np.zeros(0, dtype=np.uint64)


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` values from each position on, by doubling; positions too near the end hold rubbish."""
    total, have, power, square, width = None, 0, np.uint64(1), hashes, 1
    factor = int(_ODD)
    out = np.zeros(len(hashes), dtype=np.uint64)
    while width <= length:
        if length & width:
            part = shifted(square, have)
            out += part * power
            power = np.uint64(int(power) * pow(int(_ODD), width, 1 << 64) % (1 << 64))
            have += width
        width *= 2
        if width <= length:
            square = square + shifted(square, width // 2) * np.uint64(factor)
            factor = factor * factor % (1 << 64)
    return mix(out)


def shifted(values: np.ndarray, by: int) -> np.ndarray:
    """Values ``by`` places further on, zero beyond the end."""
    if not by:
        return values
    out = np.zeros_like(values)
    out[:-by] = values[by:]
    return out


def texts_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, nulls as empty, and where each begins (one entry more)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, dtype=np.uint8), offsets - offsets[0]
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def find_words(data: np.ndarray, offsets: np.ndarray, separators: bytes = SPACES) -> Words:
    """The words of the documents that ``offsets`` cut out of ``data``."""
    inside = word_bytes(separators)[data]
    begin, last = inside.copy(), inside.copy()
    if len(data):
        begin[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        begin[cuts] = inside[cuts]
        last[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begin)
    return Words(data, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets))


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive rows with about ``most`` bytes of text."""
    if not len(column):
        return
    offsets = texts_bytes(column)[1]
    begin = 0
    while begin < len(column):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + most, side="right")) - 1)
        yield begin, end
        begin = end


def word_slices(
    column: pa.Array, separators: bytes = SPACES, lower: bool = True, most: int = SLICE_BYTES
) -> Iterator[tuple[int, int, Words]]:
    """The words of a column of texts, slice by slice: first row, row after the last, words."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    for begin, end in slices(column, most):
        data, offsets = texts_bytes(column.slice(begin, end - begin))
        yield begin, end, find_words(lowered()[data] if lower else data, offsets, separators)


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return x.view(np.int64)
