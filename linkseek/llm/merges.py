"""Pair merging of many words at once: the agenda of byte-pair encodings, in numpy."""

from __future__ import annotations

from collections.abc import Callable
from heapq import heapify, heappop, heappush

import numpy as np

# Words up to this many symbols are merged side by side, longer ones one by one with a heap.
SIDE_BY_SIDE = 48
_WIDTHS = (3, 5, 8, 12, 18, 28, SIDE_BY_SIDE)
_NONE = np.int64(1 << 62)
_K = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

# Whether to skip merges: of which word, at which symbol, into which symbol.
Skip = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


class PairTable:
    """Rank and merged symbol of pairs of symbols; lower ranks merge first."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        self.bits = max(4, (4 * len(pairs)).bit_length())
        size = 1 << self.bits
        self.key = np.full(size, -1, np.int64)
        self.rank = np.full(size, _NONE, np.int64)
        self.merged = np.zeros(size, np.int32)
        ab = np.array(list(pairs), np.int64).reshape(-1, 2)
        values = np.array(list(pairs.values()), np.int64).reshape(-1, 2)
        for slot, a, b, rank, merged in zip(
            self._slot(ab[:, 0], ab[:, 1]).tolist(), *ab.T.tolist(), *values.T.tolist()
        ):
            while self.key[slot] >= 0:
                slot = (slot + 1) & (size - 1)
            self.key[slot], self.rank[slot], self.merged[slot] = a << 32 | b, rank, merged

    def _slot(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        h = (a.astype(np.uint64) * _K[0] + b.astype(np.uint64)) * _K[1]
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (a huge one if the pair never merges) and merged symbol of each pair."""
        slot = self._slot(a, b)
        wanted = a.astype(np.int64) << 32 | b
        found = self.key[slot]
        open_ = np.flatnonzero((found != wanted) & (found >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            found = self.key[slot[open_]]
            open_ = open_[(found != wanted[open_]) & (found >= 0)]
        return self.rank[slot], self.merged[slot]


def merge_words(
    symbols: np.ndarray, start: np.ndarray, table: PairTable, skip: Skip | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Merged symbols of all words, and where each word's start in them (one more than words).

    Word w is `symbols[start[w]:start[w + 1]]`. In each word the pair of the lowest rank, leftmost
    first, is taken from the agenda; it is merged unless `skip` says no, which takes it off
    for good, until one of its sides changes.
    """
    size = np.diff(start)
    kept = np.zeros(len(symbols), bool)
    out = symbols.astype(np.int32, copy=True)
    low = 0
    for width in _WIDTHS:
        which = np.flatnonzero((size > low) & (size <= width))
        if len(which):
            _side_by_side(out, kept, start, size, which, width, table, skip)
        low = width
    for w in np.flatnonzero(size > SIDE_BY_SIDE).tolist():
        _one_by_one(out, kept, int(start[w]), int(start[w + 1]), w, table, skip)
    ends = np.zeros(len(symbols) + 1, np.int64)
    np.cumsum(kept, out=ends[1:])
    return out[kept], ends[start]


def _side_by_side(out, kept, start, size, which, width, table, skip) -> None:
    n = len(which)
    place = np.arange(width)[:, None]
    inside = place < size[which]
    source = np.minimum(start[which] + place, len(out) - 1)
    symbol = np.where(inside, out[source], -1).ravel()
    after = np.repeat(np.arange(1, width + 1), n)
    before = np.repeat(np.arange(-1, width - 1), n)
    agenda = np.full(width * n, _NONE, np.int64)
    merged = np.zeros(width * n, np.int32)

    def put(at: np.ndarray, row: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        rank, into = table.find(a, b)
        agenda[at] = np.where(rank == _NONE, _NONE, rank << 8 | row)
        merged[at] = into

    first = np.flatnonzero(inside[1:].ravel())
    put(first, first // n, symbol[first], symbol[first + n])
    live = np.arange(n)
    while len(live):
        best = agenda.reshape(width, n)[:, live].min(axis=0) if len(live) < n else (
            agenda.reshape(width, n).min(axis=0))
        live, best = live[best < _NONE], best[best < _NONE]
        row = best & 255
        at = row * n + live
        agenda[at] = _NONE
        col = live
        if skip is not None:
            go = ~skip(which[col], row, merged[at])
            at, row, col = at[go], row[go], col[go]
        right = after[at] * n + col
        symbol[at] = merged[at]
        symbol[right] = -1
        agenda[right] = _NONE
        after[at] = after[right]
        more = after[at] * n + col < width * n
        more[more] = symbol[after[at[more]] * n + col[more]] >= 0
        a, nxt = at[more], after[at[more]] * n + col[more]
        before[nxt] = row[more]
        put(a, row[more], symbol[a], symbol[nxt])
        more = before[at] >= 0
        b, prev_row = at[more], before[at[more]]
        prev = prev_row * n + col[more]
        put(prev, prev_row, symbol[prev], symbol[b])
    alive = (symbol >= 0).reshape(width, n) & inside
    out[source[alive]] = symbol.reshape(width, n)[alive]
    kept[source[alive]] = True


def _one_by_one(out, kept, begin, end, word, table, skip) -> None:
    symbol = out[begin:end].tolist()
    n = len(symbol)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    rank, into = table.find(out[begin : end - 1], out[begin + 1 : end])
    heap = [
        (r, i, symbol[i], symbol[i + 1], m)
        for i, (r, m) in enumerate(zip(rank.tolist(), into.tolist())) if r < _NONE
    ]
    heapify(heap)
    # Merged pairs of a long word repeat; each is looked up once.
    seen: dict[tuple[int, int], tuple[int, int]] = {}

    def push(i: int, j: int) -> None:
        pair = symbol[i], symbol[j]
        if pair not in seen:
            r, m = table.find(np.array(pair[:1]), np.array(pair[1:]))
            seen[pair] = int(r[0]), int(m[0])
        r, m = seen[pair]
        if r < _NONE:
            heappush(heap, (r, i, *pair, m))

    while heap:
        _, i, a, b, m = heappop(heap)
        j = after[i]
        if j >= n or symbol[i] != a or symbol[j] != b:
            continue
        if skip is not None and skip(np.array([word]), np.array([i]), np.array([m]))[0]:
            continue
        symbol[i], symbol[j] = m, -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            push(i, after[i])
        if before[i] >= 0:
            push(before[i], i)
    left = np.array(symbol)
    out[begin:end] = left
    kept[begin:end] = left >= 0
