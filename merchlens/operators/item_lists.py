"""Task-side part of the item index (numpy): nearest centres, and the lists a user must read."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd

SLACK = 1e-9  # for the rounding of dot products
_ROWS_AT_ONCE = 1024


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for at in range(0, len(b), _ROWS_AT_ONCE):
            yield b.iloc[at:at + _ROWS_AT_ONCE]


def assign(centres: np.ndarray) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """(product_id, vector) -> the same with its nearest centre and the distance to it; vectors with odd numbers are at no distance (null)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _pieces(batches):
            x = np.stack(b["vector"].to_numpy())
            safe = np.nan_to_num(x, nan=0.0, posinf=0.0, neginf=0.0)
            near = ((centres**2).sum(axis=1)[None, :] - 2 * safe @ centres.T).argmin(axis=1)
            far = np.sqrt(((x - centres[near]) ** 2).sum(axis=1))
            yield b.assign(centre=near.astype(np.int32), far=np.where(np.isfinite(far), far, np.inf))

    return run


def wanted(lists: pd.DataFrame, k: int, second: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A user's lists by number, as one array for each block of lists (column ib), and the floor below which no score matters.

    First the lists of highest bound that hold k + seen items, and that of the lowest bound; second all others that may still hold a
    better, or a worse, item than those found (columns kth and least)."""
    centre, radius = np.stack(lists["centre"].to_numpy()), lists["radius"].to_numpy()
    size, block = lists["n"].to_numpy(), lists["ib"].to_numpy()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _pieces(batches):
            u = np.stack(b["vector"].to_numpy())
            middle, reach = u @ centre.T, np.linalg.norm(u, axis=1)[:, None] * radius[None, :]
            upper = np.nan_to_num(middle + reach, nan=np.inf)  # what cannot be bounded is read
            lower = np.nan_to_num(middle - reach, nan=-np.inf)
            order = np.argsort(-upper, axis=1, kind="stable")
            before = np.cumsum(size[order], axis=1) - size[order]
            first = np.zeros(upper.shape, bool)
            np.put_along_axis(first, order, before < (k + b["n_seen"].to_numpy())[:, None], axis=1)
            first[np.arange(len(b)), lower.argmin(axis=1)] = True
            if second:
                kth, least = b["kth"].to_numpy()[:, None], b["least"].to_numpy()[:, None]
                take = ~first & (~(upper < kth - SLACK) | ~(lower > least + SLACK))
            else:
                take = first
            floor = b["kth"].to_numpy() if second else np.full(len(b), -np.inf)
            for ib in np.unique(block):
                mine = np.nonzero(block == ib)[0].astype(np.int32)
                reads = np.nonzero(take[:, mine].any(axis=1))[0]
                if len(reads):
                    yield pd.DataFrame({
                        "user_id": b["user_id"].to_numpy()[reads], "ib": np.full(len(reads), ib, np.int32), "floor": floor[reads],
                        "lists": [mine[take[r, mine]] for r in reads]})

    return run
