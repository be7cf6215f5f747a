"""Words of Arrow text columns as arrays: places and 64-bit hashes, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tesserae.llm.common import slices

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
BYTE_BASE = 0x9E3779B97F4A7C15
SLICE_BYTES = 1_000_000


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below 2**bits at least; of each base the longest table is kept."""
    if base not in _POWERS or len(_POWERS[base][0]) < 1 << bits:
        up, down = np.full(1 << bits, base, dtype=np.uint64), np.full(1 << bits, pow(base, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        _POWERS[base] = np.multiply.accumulate(up, out=up), np.multiply.accumulate(down, out=down)
    return _POWERS[base]


def sums(x: np.ndarray, base: int) -> np.ndarray:
    """Sums of x[i] * base**i over the first 0, 1, ... values of x, from which `parts_hash` hashes any part of x."""
    total = np.zeros(len(x) + 1, dtype=np.uint64)
    np.cumsum(x.astype(np.uint64) * _powers(base, max(12, int(len(x)).bit_length()))[0][: len(x)], out=total[1:])
    return total


def parts_hash(total: np.ndarray, first: np.ndarray, last: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of each x[first:last], whatever its place, out of total = sums(x, base)."""
    return (total[last] - total[first]) * _powers(base, max(12, int(len(total) - 1).bit_length()))[1][first]


def runs_hash(x: np.ndarray, first: np.ndarray, last: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of each x[first:last], whatever its place. x should hold no zero, which would not count at an end."""
    return parts_hash(sums(x, base), first, last, base)


def mixed(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser: every bit of the result depends on every bit of x."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of consecutive rows lo..hi of a text column. begin, end: byte places in data; of: row i has the words
    of[i] : of[i + 1]; hash: of each word's bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lo: int, hi: int):
        self.lo, self.hi, self.data = lo, hi, data
        edge = offsets - offsets[0]
        word = ~_SPACE[data]
        opens, closes = word.copy(), word.copy()
        opens[1:] &= ~word[:-1]
        closes[:-1] &= ~word[1:]
        inner = edge[(edge > 0) & (edge < len(data))]  # a row's first byte begins a word though the row before ended with one
        opens[inner] = word[inner]
        closes[inner - 1] = word[inner - 1]
        self.begin, self.end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.of = np.searchsorted(self.begin, edge)
        self.hash = mixed(runs_hash(data.astype(np.uint64) + np.uint64(1), self.begin, self.end, BYTE_BASE))

    def __len__(self) -> int:
        return len(self.begin)

    def taken(self, at: np.ndarray) -> pa.Array:
        """The bytes of the words at these positions."""
        size = self.end[at] - self.begin[at]
        edge = np.concatenate([[0], np.cumsum(size)])
        place = np.repeat(self.begin[at] - edge[:-1], size) + np.arange(edge[-1])
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(edge.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(self.data[place]))])


def words(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[Words]:
    """Words of a string column without nulls, in slices of rows with about `most` bytes."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    for lo, hi in slices(np.diff(at), most):
        yield Words(raw[at[lo] : at[hi]], at[lo : hi + 1], lo, hi)
