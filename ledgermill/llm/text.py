"""Array views of Arrow text columns: words, word hashes and shingles of many documents at once.

Everything works on the UTF-8 bytes of a slice of documents laid end to end, so a batch costs a few passes over its bytes
and memory follows the slice (``SLICE_BYTES``, or the longest single text where that is longer).
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are taken in slices of about this many bytes; a longer text makes a slice of its own.
SLICE_BYTES = 2 << 20
#: Words are hashed in runs of at most this many bytes (longer for a single longer word).
_RUN = 1 << 16

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finalizer)."""
    x = np.asarray(x, _U).copy()
    with np.errstate(over="ignore"):
        x ^= x >> _U(30)
        x *= _U(0xBF58476D1CE4E5B9)
        x ^= x >> _U(27)
        x *= _U(0x94D049BB133111EB)
        x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15 % (1 << 56)))
_BYTE_OF = {False: _BYTE, True: _BYTE[_LOWER]}
_BASE = 0x5851F42D4C957F2D
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 20) + 1
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, base, _U)
                steps[0] = 1
                _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def give_back() -> None:
    """At the end of a task: memory that is free, but still held by the worker, goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


class Texts:
    """Some documents' bytes end to end; ``offsets[i]:offsets[i + 1]`` are those of document ``i``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def take(self, rows: np.ndarray) -> Texts:
        """The texts of these rows, ascending."""
        if len(rows) == len(self):
            return self
        size = np.diff(self.offsets)
        parts = [self.data[self.offsets[i] : self.offsets[i + 1]] for i in rows.tolist()]
        return Texts(np.concatenate(parts) if parts else self.data[:0], np.concatenate(([0], np.cumsum(size[rows]))))

    def words(self, lower: bool = True) -> Words:
        return Words(self, lower)


class Words:
    """Words of some documents: byte ``start`` and ``end`` of each, and ``first[i]:first[i + 1]`` the words of document i."""

    def __init__(self, texts: Texts, lower: bool):
        data, offsets = texts.data, texts.offsets
        # space, tab, line feed, vertical tab, form feed and carriage return part words
        inside = (data != np.uint8(0x20)) & (data - np.uint8(9) > np.uint8(4))
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        begins, ends = inside.copy(), inside.copy()
        np.greater(inside[1:], inside[:-1], out=begins[1:])
        begins[edges] = inside[edges]
        np.greater(inside[:-1], inside[1:], out=ends[:-1])
        ends[edges - 1] = inside[edges - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self._data, self._lower = data, lower

    def hashes(self, which: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each word, or of these words (ascending)."""
        starts, ends = (self.start, self.end) if which is None else (self.start.take(which), self.end.take(which))
        out = np.empty(len(starts), _U)
        byte = _BYTE_OF[self._lower]
        values, sums = np.empty(0, _U), np.zeros(1, _U)
        at = 0
        while at < len(starts):
            lo = starts[at]
            to = max(at + 1, int(np.searchsorted(ends, lo + _RUN, "right")))
            data = self._data[lo : ends[to - 1]]
            n = len(data)
            up, down = _power_tables(n)
            if n > len(values):
                values, sums = np.empty(n, _U), np.zeros(n + 1, _U)
            with np.errstate(over="ignore"):
                np.take(byte, data, out=values[:n], mode="clip")
                np.multiply(values[:n], up[:n], out=values[:n])
                np.cumsum(values[:n], out=sums[1 : n + 1])
                s = starts[at:to] - lo
                out[at:to] = (sums.take(ends[at:to] - lo) - sums.take(s)) * down.take(s)
            at = to
        return mix(out)

    def owner(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def sequence_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive hashes (one per start; order matters)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, _U)
    with np.errstate(over="ignore"):
        out = np.full(n, k, _U)
        for i in range(k):
            out = mix(out * _U(0x9E3779B97F4A7C15) + hashes[i : i + n])
    return out


def shingle_sets(words: Words, k: int) -> Iterator[np.ndarray]:
    """Each document's sorted distinct shingles of ``k`` words; a shorter document has its whole sequence as one."""
    hashes = words.hashes()
    runs = sequence_hashes(hashes, k)
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= k:
            yield np.unique(runs[a : b - k + 1])
        elif b > a:
            yield sequence_hashes(hashes[a:b], int(b - a))
        else:
            yield np.empty(0, _U)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Data bytes and row offsets of a text or binary column; nulls count as empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(first row, last row + 1, texts) of runs of rows with about ``most`` bytes together."""
    data, offsets = bytes_of(column)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to, Texts(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to
