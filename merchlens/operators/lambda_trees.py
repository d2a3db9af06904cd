"""Task-side part of the lambda ranker (numpy): pair gradients of a list, routing through trees, histograms of a task's lists."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

BINS = 32


def gradients(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the pair loss of one list: a pair weighs what swapping its rows changes in NDCG.

    Rows stand by falling score, equal ones in the order given. A list with one label only has no pairs.
    """
    g, h = np.zeros(len(y)), np.zeros(len(y))
    up, down = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(up) or not len(down):
        return g, h
    place = np.empty(len(y), np.int64)
    place[np.argsort(-score, kind="stable")] = np.arange(len(y))
    discount = 1 / np.log2(place + 2)
    ideal = (1 / np.log2(np.arange(len(up)) + 2)).sum()
    change = np.abs(discount[up][:, None] - discount[down][None, :]) / ideal
    wrong = 1 / (1 + np.exp(np.clip(score[up][:, None] - score[down][None, :], -50, 50)))
    pull, bend = wrong * change, wrong * (1 - wrong) * change
    g[up], g[down] = -pull.sum(axis=1), pull.sum(axis=0)
    h[up], h[down] = bend.sum(axis=1), bend.sum(axis=0)
    return g, h


def leaf_of(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """Number, among its level, of the node that each row reaches; a node without a feature sends all rows left."""
    node = np.zeros(len(x), np.int64)
    for level in range(levels):
        at = (1 << level) - 1 + node
        f = feature[at]
        node = 2 * node + ((f >= 0) & (x[np.arange(len(x)), np.maximum(f, 0)] > cut[at]))
    return node


def predict(x: np.ndarray, trees: list) -> np.ndarray:
    out = np.zeros(len(x))
    for feature, cut, value in trees:
        out += value[leaf_of(x, feature, cut, int(np.log2(len(value))))]
    return out


def binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, values[:, k], side="left") for k, e in enumerate(edges)], axis=1).astype(np.uint8)


def pack(edges: list[np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lists (x list of lists, y list) -> (x, y) as bytes, x as bin numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xs, ys = [], []
            for x, y in zip(b.column(0), b.column(1)):
                rows = len(y.values)
                values = x.values.flatten().to_numpy(zero_copy_only=False).reshape(rows, len(edges))
                xs.append(binned(values, edges).tobytes())
                ys.append(y.values.to_numpy(zero_copy_only=False).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.binary()), pa.array(ys, pa.binary())], ["x", "y"])

    return run


def histogram(trees: list, feature: np.ndarray, cut: np.ndarray, level: int, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(cell, g, h, n) of a task's rows, cell = (node of the level * features + feature) * BINS + bin."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = (1 << level) * width * BINS
        g, h, n = np.zeros(size), np.zeros(size), np.zeros(size)
        for b in batches:
            lists = [(np.frombuffer(x.as_py(), np.uint8).reshape(-1, width), np.frombuffer(y.as_py(), np.uint8)) for x, y in zip(b.column(0), b.column(1))]
            if not lists:
                continue
            x = np.concatenate([p[0] for p in lists])
            score = predict(x, trees)
            at, parts = 0, []
            for _, y in lists:
                parts.append(gradients(score[at : at + len(y)], y))
                at += len(y)
            first, second = (np.concatenate(p) for p in zip(*parts))
            cell = ((leaf_of(x, feature, cut, level)[:, None] * width + np.arange(width)) * BINS + x).ravel()
            g += np.bincount(cell, np.repeat(first, width), size)
            h += np.bincount(cell, np.repeat(second, width), size)
            n += np.bincount(cell, minlength=size)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(g[some]), pa.array(h[some]), pa.array(n[some].astype(np.int64))], ["cell", "g", "h", "n"])

    return run
