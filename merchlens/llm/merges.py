"""Pair ranks of the tokenizers, and the merging of one long word.

Words of common length go through whole-array rounds in the tokenizers; a word of n symbols would need up to n such rounds, so words
beyond LONG symbols are merged here by a linked list of symbols and a heap of pairs, one merge at a time, the least rank first and the leftmost of
equals, where a merge costs log n.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np

LONG = 512
NONE = np.iinfo(np.int32).max  # rank of a pair that never merges


class PairTable:
    """(left, right) -> (rank, merged id) by open addressing; lookups are vectorised."""

    def __init__(self, keys: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(2 * max(len(keys), 1)).bit_length() + 1)
        self.key = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.full(1 << self.bits, NONE, np.int32)
        self.merged = np.zeros(1 << self.bits, np.int32)
        left = np.arange(len(keys))
        at = self._slot(keys)
        while len(left):
            free = self.key[at] < 0
            _, first = np.unique(at, return_index=True)
            placed = np.zeros(len(left), bool)
            placed[first] = True
            placed &= free
            self.key[at[placed]] = keys[left[placed]]
            self.rank[at[placed]] = rank[left[placed]]
            self.merged[at[placed]] = merged[left[placed]]
            left, at = left[~placed], (at[~placed] + 1) & ((1 << self.bits) - 1)

        self._made = (keys, rank, merged)
        self._single: dict[int, tuple[int, int]] | None = None

    def one_by_one(self) -> dict[int, tuple[int, int]]:
        """The same pairs for single lookups; made when first asked for."""
        if self._single is None:
            keys, rank, merged = (x.tolist() for x in self._made)
            self._single = dict(zip(keys, zip(rank, merged)))
        return self._single

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self._slot(keys)
        todo = np.flatnonzero((self.key[at] != keys) & (self.key[at] >= 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            here = self.key[at[todo]]
            todo = todo[(here != keys[todo]) & (here >= 0)]
        hit = self.key[at] == keys
        return np.where(hit, self.rank[at], NONE), self.merged[at]


def merge_long(symbols: list[int], ranks: list[int], none: int, look_up: Callable[[int, int], tuple[int, int]]) -> list[int]:
    """The symbols that are left. ranks[i] is that of the pair (i, i + 1), `none` where there is no merge; look_up gives (rank, merged)."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    ranks = [*ranks[: n - 1], none]
    heap = sorted(r * n + i for i, r in enumerate(ranks) if r != none)
    while heap:
        rank, i = divmod(heapq.heappop(heap), n)
        if ranks[i] != rank:  # the pair has changed since
            continue
        j = after[i]
        symbols[i], k = look_up(symbols[i], symbols[j])[1], after[j]
        after[i], ranks[j] = k, none
        if k < n:
            before[k] = i
        for left, right in ((before[i], i), (i, k)):
            if left >= 0:
                ranks[left] = none
                if right < n and (r := look_up(symbols[left], symbols[right])[0]) != none:
                    ranks[left] = r
                    heapq.heappush(heap, r * n + left)
    out, i = [], 0
    while i < n:
        out.append(symbols[i])
        i = after[i]
    return out
