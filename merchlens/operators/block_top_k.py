"""Task-side top-k of a block of users against a block of items (numpy on Arrow batches).

Scores are made for a few users and a few items at a time, so a task's memory depends on neither the length of the item matrix nor how many users it gets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd

_ROWS_AT_ONCE, _ITEMS_AT_ONCE = 256, 4096
_KEPT_AT_ONCE = 1 << 17  # result rows of the users that are handled together; one user alone may have more


def _round(scores: np.ndarray) -> np.ndarray:
    # Equal scores must stay equal whatever order the products were summed in.
    return np.round(np.nan_to_num(scores, nan=0.0, posinf=0.0, neginf=0.0), 12)


def _slices(want: np.ndarray) -> Iterator[slice]:
    """Consecutive users, so few that what they want fits _KEPT_AT_ONCE."""
    start, held = 0, 0
    for i, n in enumerate(want):
        if i > start and (i - start >= _ROWS_AT_ONCE or held + n > _KEPT_AT_ONCE):
            yield slice(start, i)
            start, held = i, 0
        held += int(n)
    if len(want) > start:
        yield slice(start, len(want))


class _Best:
    """The best scores so far of some users: all that equal the last wanted one too, or with `ties` false the smallest ids of these."""

    def __init__(self, want: np.ndarray, floor: np.ndarray | None = None, ties: bool = True) -> None:
        n = len(want)
        self.want, self.limit, self.ties = want, np.full(n, -np.inf) if floor is None else floor.astype(float), ties
        self.lo, self.hi = np.full(n, np.inf), np.full(n, -np.inf)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held, self.room = 0, 2 * int(want.sum()) + _KEPT_AT_ONCE

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores (not rounded) of the users `rows` against the items `ids`. Only those that can matter are rounded: rounding keeps their order."""
        lo, hi = scores.min(axis=1), scores.max(axis=1)
        if not (np.isfinite(lo).all() and np.isfinite(hi).all()):
            scores = _round(scores)
            lo, hi = scores.min(axis=1), scores.max(axis=1)
        self.lo[rows] = np.minimum(self.lo[rows], _round(lo))
        self.hi[rows] = np.maximum(self.hi[rows], _round(hi))

        def least(limit: np.ndarray) -> np.ndarray:
            return limit - 1e-12 - 1e-15 * np.abs(np.where(np.isinf(limit), 0.0, limit))  # what rounds to the limit lies above this

        few, limit = scores.shape[1], self.limit[rows]
        high = scores >= least(limit)[:, None]
        for at in np.nonzero(high.sum(axis=1) > self.want[rows])[0]:
            m = self.want[rows[at]]
            if m:
                limit[at] = max(limit[at], _round(np.partition(scores[at], few - m)[few - m]))
                high[at] = scores[at] >= least(limit[at])
            else:
                limit[at], high[at] = np.inf, False
        row, item = np.nonzero(high)
        score = _round(scores[row, item])
        stay = score >= limit[row]
        self.limit[rows] = limit
        self.parts.append((rows[row[stay]], ids[item[stay]], score[stay]))
        self.held += len(self.parts[-1][0])
        if self.held > self.room:
            self.compact()

    def compact(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, item, score = (np.concatenate(x) for x in zip(*self.parts)) if self.parts else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        order = np.lexsort((-score, row) if self.ties else (item, -score, row))
        row, item, score = row[order], item[order], score[order]
        first = np.searchsorted(row, np.arange(len(self.want)))
        counts = np.bincount(row, minlength=len(self.want))
        full = np.nonzero((counts >= self.want) & (self.want > 0))[0]
        self.limit[full] = np.maximum(self.limit[full], score[first[full] + self.want[full] - 1])
        stay = score >= self.limit[row]
        if not self.ties and len(row):
            last = np.minimum(first + self.want, first + counts).clip(1) - 1  # repeated rows of the last id stay together
            stay &= (np.arange(len(row)) <= last[row]) | (score == score[last[row]]) & (item == item[last[row]])
            stay &= self.want[row] > 0
        self.parts = [(row[stay], item[stay], score[stay])]
        self.held = int(stay.sum())
        return self.parts[0]

    def frame(self, users: np.ndarray) -> pd.DataFrame:
        """A row per score, and one without product and score for a user whose limits only are known."""
        row, item, score = self.compact()
        bare = np.setdiff1d(np.nonzero(self.hi >= self.lo)[0], row)
        row = np.concatenate([row, bare])
        return pd.DataFrame({
            "user_id": users[row], "product_id": pd.array(np.concatenate([item, np.zeros(len(bare), item.dtype)])),
            "raw_score": np.concatenate([score, np.full(len(bare), np.nan)]), "lo": self.lo[row], "hi": self.hi[row],
        })


def best(ids: np.ndarray, matrix: np.ndarray, users: pd.DataFrame, k: int, ties: bool = True) -> Iterator[pd.DataFrame]:
    """Rows that can be among a user's top k unseen: the best k + seen scores of this item block.

    ties: with all that equal the last of them. Where equal scores stand by id, as in retrieve(), the smallest ids of these are enough, so a
    user for whom all items are equal does not return them all.
    """
    if not len(ids) or not len(users):
        return
    want = np.minimum(k + users["n_seen"].to_numpy(), len(ids)).astype(int)
    for part in _slices(want):
        vectors = np.stack(users["vector"].iloc[part].to_numpy())
        found, rows = _Best(want[part], ties=ties), np.arange(len(vectors))
        for at in range(0, len(ids), _ITEMS_AT_ONCE):
            found.add(rows, vectors @ matrix[at:at + _ITEMS_AT_ONCE].T, ids[at:at + _ITEMS_AT_ONCE])
        yield found.frame(users["user_id"].iloc[part].to_numpy())


def scan(ids, matrix, k: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Every batch of users against broadcast items."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield from best(ids.value, matrix.value, batch, k, ties=False)

    return run


def _empty() -> pd.DataFrame:
    return pd.DataFrame({"user_id": [], "product_id": [], "raw_score": [], "lo": [], "hi": []})


def pair(k: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """One user block against one item block."""
    def run(users: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        if len(users) == 0 or len(items) == 0:
            return _empty()
        return pd.concat(best(items["product_id"].to_numpy(), np.stack(items["vector"].to_numpy()), users, k, ties=False))

    return run


def listed(k: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """One user block against some lists of items: a user (with `lists` and a `floor`, below which no score matters) meets their own lists only."""
    def run(users: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        if len(users) == 0 or len(items) == 0:
            return _empty()
        number = items["list"].to_numpy()
        order = np.argsort(number, kind="stable")
        ids, matrix, number = items["product_id"].to_numpy()[order], np.stack(items["vector"].to_numpy()[order]), number[order]
        sizes = users["lists"].map(len).to_numpy()
        owner, asked = np.repeat(np.arange(len(users)), sizes), np.concatenate(users["lists"].to_numpy())
        by_list = np.argsort(asked, kind="stable")
        owner, asked = owner[by_list], asked[by_list]
        vectors = np.stack(users["vector"].to_numpy())
        found = _Best((k + users["n_seen"].to_numpy()).astype(int), users["floor"].to_numpy())
        for n in np.unique(asked):
            lo, hi = np.searchsorted(number, [n, n + 1])
            readers = owner[slice(*np.searchsorted(asked, [n, n + 1]))]
            for at in range(lo, hi, _ITEMS_AT_ONCE):
                to = min(hi, at + _ITEMS_AT_ONCE)
                few = max(1, _ROWS_AT_ONCE * _ITEMS_AT_ONCE // (to - at))
                for some in (readers[i:i + few] for i in range(0, len(readers), few)):
                    found.add(some, vectors[some] @ matrix[at:to].T, ids[at:to])
        return found.frame(users["user_id"].to_numpy())

    return run
