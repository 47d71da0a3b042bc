"""Ranked merges of byte-pair encoding for one word, and a bounded memory of words already done, kept by the Python worker."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable

import numpy as np

#: Words of one generation of a memory; two generations are kept.
MEMORY = 300_000
#: Longer words are merged with a heap instead of a scan for each merge.
SHORT = 64
#: Words that are merged side by side.
BLOCK = 4096
#: More than any rank: a pair that does not merge.
NONE = (1 << 31) - 1


class Memory(dict):
    """Values of words, computed on the first look-up.

    When a generation is full, it becomes the old one and that before it goes;
    a word found in the old one is taken over, so words that keep coming stay.
    """

    def __init__(self, make: Callable, fixed: dict | None = None):
        super().__init__(fixed or {})
        self.make, self.fixed, self.old = make, fixed or {}, {}

    def __missing__(self, word):
        if len(self) - len(self.fixed) >= MEMORY:
            self.old = dict(self)
            self.clear()
            self.update(self.fixed)
        value = self.old.get(word)
        if value is None:
            value = self.make(word)
        self[word] = value
        return value

    def learn(self, words: Iterable, make_all: Callable[[list], Iterable]) -> None:
        """Take in those of ``words`` that are not known yet, with values from one call of ``make_all``."""
        new = [w for w in set(words).difference(self) if w not in self.old]
        if new:
            if len(self) - len(self.fixed) >= MEMORY:
                self.old = dict(self)
                self.clear()
                self.update(self.fixed)
            self.update(zip(new, make_all(new)))


_kept: tuple[str, object] | None = None


def kept(key: str, build: Callable[[], object]) -> object:
    """What ``build`` makes, made once in a Python worker and shared by its tasks until another key comes."""
    global _kept
    if _kept is None or _kept[0] != key:
        _kept = None
        _kept = (key, build())
    return _kept[1]


def merge(parts: list, rank_of: Callable) -> list:
    """Join neighbours, always the leftmost pair of the lowest rank, until no pair has a rank.

    ``rank_of(a, b)`` is a number, or None where the pair does not merge.
    Parts must support ``+``.
    """
    if len(parts) > SHORT:
        return _merge_long(parts, rank_of)
    parts = list(parts)
    ranks = [rank_of(a, b) for a, b in zip(parts, parts[1:])]
    while True:
        best, at = None, -1
        for i, r in enumerate(ranks):
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            return parts
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
        del ranks[at]
        if at:
            ranks[at - 1] = rank_of(parts[at - 1], parts[at])
        if at < len(ranks):
            ranks[at] = rank_of(parts[at], parts[at + 1])


def _merge_long(parts: list, rank_of: Callable) -> list:
    """The same in n log n steps: a linked list of parts and a heap of pairs, with stale pairs skipped."""
    parts = list(parts)
    n = len(parts)
    following, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank_of(parts[i], parts[i + 1])) is not None]
    heapq.heapify(heap)

    def push(i: int) -> None:
        if i >= 0 and (j := following[i]) < n and (r := rank_of(parts[i], parts[j])) is not None:
            heapq.heappush(heap, (r, i, parts[i], parts[j]))

    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = following[i] if parts[i] is not None else n
        if j >= n or parts[i] != a or parts[j] != b:
            continue
        parts[i], parts[j] = a + b, None
        following[i] = following[j]
        if following[i] < n:
            before[following[i]] = i
        push(i)
        push(before[i])
    return [p for p in parts if p is not None]


class Pairs:
    """The pairs of pieces that merge, as sorted arrays, for words merged side by side.

    ``ranks`` gives a rank below 2**31 for each piece and holds every single byte.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        found = {}
        for piece, rank in ranks.items():
            for i in range(1, len(piece)):
                a, b = ranks.get(piece[:i]), ranks.get(piece[i:])
                if a is not None and b is not None:
                    found[a << 32 | b] = rank
        keys = np.fromiter(found, np.int64, len(found))
        order = keys.argsort()
        # A last key that no pair has keeps every place found below the length.
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.values = np.append(np.fromiter(found.values(), np.int32, len(found))[order], NONE).astype(np.int32)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.two = self.look(np.repeat(self.byte, 256), np.tile(self.byte, 256))

    def look(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ranks of the pairs, ``NONE`` where they do not merge."""
        key = a.astype(np.int64) << 32 | b
        at = self.keys.searchsorted(key)
        return np.where(self.keys[at] == key, self.values[at], NONE)

    def ids(self, raws: list[bytes]) -> list[bytes]:
        """For each word the ids of its pieces, as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(raws)
        open_ = []
        for k, raw in enumerate(raws):
            rank = self.ranks.get(raw)
            if rank is not None:
                out[k] = rank.to_bytes(4, "little")
            elif len(raw) > SHORT:
                parts = merge([raw[i:i + 1] for i in range(len(raw))], lambda a, b: self.ranks.get(a + b))
                out[k] = np.array([self.ranks[p] for p in parts], "<u4").tobytes()
            elif raw:
                open_.append(k)
        open_.sort(key=lambda k: len(raws[k]))
        for i in range(0, len(open_), BLOCK):
            self._block(raws, open_[i:i + BLOCK], out)
        return out

    def _block(self, raws: list[bytes], at: list[int], out: list[bytes]) -> None:
        """Merge the words ``at``: a round joins, in each word, the leftmost pair of its lowest rank."""
        which = np.array(at)
        size = np.array([len(raws[k]) for k in at])
        width = int(size.max())
        raw = np.frombuffer(b"".join([raws[k].ljust(width, b"\0") for k in at]), np.uint8).reshape(-1, width)
        ids = self.byte[raw]
        near = self.two[raw[:, :-1].astype(np.int32) << 8 | raw[:, 1:]]
        near[np.arange(width - 1) >= size[:, None] - 1] = NONE
        while len(which):
            if near.shape[1]:
                first = near.argmin(axis=1)
                best = near[np.arange(len(which)), first]
                done = best == NONE
            else:
                done = np.ones(len(which), bool)
            if done.any():
                for k, row, n in zip(which[done].tolist(), ids[done].astype("<u4"), size[done].tolist()):
                    out[k] = row[:n].tobytes()
                go = ~done
                which, size, ids, near = which[go], size[go], ids[go], near[go]
                if not len(which):
                    return
                first, best = first[go], best[go]
            rows, width = np.arange(len(which)), ids.shape[1]
            ids = ids[np.arange(width) != first[:, None] + 1].reshape(-1, width - 1)
            near = near[np.arange(width - 1) != first[:, None]].reshape(-1, width - 2)
            ids[rows, first] = best
            size = size - 1
            left = np.flatnonzero(first > 0)
            near[left, first[left] - 1] = self.look(ids[left, first[left] - 1], best[left])
            right = np.flatnonzero(first < size - 1)
            near[right, first[right]] = self.look(best[right], ids[right, first[right] + 1])
