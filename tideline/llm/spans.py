"""Words of a batch of texts as numpy arrays: places, 64-bit hashes, owners.

Works on the UTF-8 bytes of many texts at once.  The hash of a byte range is
a difference of prefix sums of ``byte * P**place`` times a power of the
inverse of ``P``, all modulo 2**64, so a hash costs two look-ups whatever the
length of the word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are taken in groups of about this many bytes; a longer text is a group of its own.
GROUP_BYTES = 1 << 20

_P = 0x9E3779B97F4A7C15
_INVERSE = pow(_P, -1, 1 << 64)
_tables: dict[int, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64, kept and grown by doubling."""
    table = _tables.get(base, np.ones(1, dtype=np.uint64))
    while len(table) < n:
        table = np.concatenate([table, table * np.uint64(pow(base, len(table), 1 << 64))])
    _tables[base] = table
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits over all bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def chain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    return mix(a * np.uint64(0xA24BAED4963EE407) + b)


@dataclass
class Group:
    """A few texts: rows ``first .. last`` of the batch, their bytes and the bounds of each within them."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray


def groups(column: pa.Array) -> Iterator[Group]:
    """The texts of a column in bounded groups; null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + GROUP_BYTES, "right")) - 1)
        yield Group(first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


def whole(texts: list[str]) -> Group:
    """All texts as one group."""
    raw = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)
    return Group(0, len(raw), np.frombuffer(b"".join(raw), dtype=np.uint8), bounds)


class Spans:
    """Maximal runs of wanted bytes that do not cross from one text to the next."""

    def __init__(self, group: Group, wanted: np.ndarray, lower: bool = True):
        data = LOWER[group.data] if lower else group.data
        inside = wanted[data]
        begin, end = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        full = group.bounds[1:] > group.bounds[:-1]
        heads, tails = group.bounds[:-1][full], group.bounds[1:][full] - 1
        begin[heads], end[tails] = inside[heads], inside[tails]
        self.data = data
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(end) + 1
        #: Spans of text i are ``first[i] .. first[i + 1]``.
        self.first = np.searchsorted(self.start, group.bounds)
        self._sums: np.ndarray | None = None

    def hashes(self, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Hash of each span, or of the given byte ranges."""
        start = self.start if start is None else start
        end = self.end if end is None else end
        n = len(self.data)
        if self._sums is None:
            self._sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _powers(_P, n)[:n], out=self._sums[1:])
        value = (self._sums[end] - self._sums[start]) * _powers(_INVERSE, n + 1)[start]
        return mix(value + (end - start).astype(np.uint64) * np.uint64(0x8CB92BA72F3D8DD7))

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def byte_set(excluded: bytes) -> np.ndarray:
    wanted = np.ones(256, dtype=bool)
    wanted[list(excluded)] = False
    return wanted


#: Letters, digits and everything beyond ASCII: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing.
WORD = byte_set(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
#: Anything but ASCII white space: ``[^\\x20\\x09-\\x0D]``.
SOLID = byte_set(bytes([0x20, *range(0x09, 0x0E)]))
#: Anything but a line feed.
LINE = byte_set(b"\n")


def expand(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the ranges ``first[i] .. last[i]``, and the ``i`` each comes from."""
    sizes = np.maximum(last - first, 0)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    begins = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) - begins[owner] + first[owner], owner


def segment_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums over ``first[i] .. first[i + 1]``; empty segments give 0."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[first[1:]] - sums[first[:-1]]
