"""Embedding whitening by Chebyshev-filtered subspace iteration.

Vectors become whole numbers x = floor(scale * c) + shift and are written once as packed blocks. The covariance is never formed: every
step is a pass over the blocks in which each task multiplies its centred rows, X'(XQ), for a thin block Q of `components` and GUARD
further columns; the tasks' cells are summed by an aggregate, so the driver holds matrices of dimension x columns only, however many
vectors there are. One round is

1. Rayleigh-Ritz: the small matrix Q'VQ is solved and gives Ritz values, vectors and their residuals; the iteration ends when the
   residual of every wanted vector is below CERTIFIED of the largest eigenvalue (it bounds the error of the eigenvalues);
2. filter: a Chebyshev polynomial of V, scaled to stay small on [0, least Ritz value] where the unwanted spectrum lies, is applied to
   Q by its three-term recurrence, a pass for each degree;
3. QR of the filtered block.

Where the block would have as many columns as the vectors have entries, the first Rayleigh-Ritz step is exact.

Rows whose vector is null or has null or non-finite entries are dropped. All vectors must have one length to have one covariance: where
lengths differ, the most frequent one counts (of equals the longest) and rows of other lengths are dropped as well. Repeated rows and
rows that share an id each count and each are returned; ids may be null. Components without variance (below rounding) have no whitened
value and are left out, so one vector, or equal ones, give no rows. 64 * c is clamped to 2^53. A deviation beyond the range
of a long is null. Other columns are not read. Each eigenvector's largest entry is positive, so results don't depend on chance.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .text import prepare

SCALE, SHIFT = 64, 1_000_000
GUARD = 24  # columns beside the wanted ones
DEGREE, GROWTH = 12, 23.0  # of a filter: most passes, and the log of the most by which it may magnify
CERTIFIED, ACCEPTED = 2e-14, 1e-10  # residual over the largest eigenvalue: where to end, and the least if rounding allows no more
ROUNDS = 200
BLOCK = 1024  # vectors packed together
_CLAMP = float(1 << 53)


@dataclass
class Fit:
    n: int
    total: list[int]  # exact sums of each dimension
    value: np.ndarray  # eigenvalues, falling
    vector: np.ndarray  # columns
    trace: float
    passes: int
    residual: float

    @property
    def base(self) -> np.ndarray:
        return np.array([s // self.n for s in self.total], np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([s % self.n for s in self.total], np.int64)


def packed(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> tuple[DataFrame, int]:
    """Blocks (ids, x) of usable vectors, x as packed 64-bit numbers, written once; and the vectors' length (0: none)."""
    finite = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    usable = vectors.where(F.col(column).isNotNull() & finite).select(F.col(key).alias("key"), F.col(column).cast("array<double>").alias("entries"))
    common = usable.groupBy(F.size("entries").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = common["d"] if common else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                c = part.column("entries").flatten().to_numpy().reshape(part.num_rows, d)
                x = np.floor(np.clip(c * SCALE, -_CLAMP, _CLAMP)).astype(np.int64) + SHIFT
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("key"))
                yield pa.RecordBatch.from_arrays([ids, pa.array([x.tobytes()], pa.binary())], ["ids", "x"])

    kind = vectors.schema[key].dataType.simpleString()
    prepare(vectors.sparkSession)
    blocks = usable.where(F.size("entries") == max(d, 1)).mapInArrow(run, f"ids array<{kind}>, x binary")
    return stage(blocks, "whitening-blocks"), d


def _summed(blocks: DataFrame, cells: Callable[[Iterator[np.ndarray]], np.ndarray], d: int) -> np.ndarray:
    """Sum over all tasks of the flat array that `cells` makes of a task's matrices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = cells(np.frombuffer(x.as_buffer(), np.int64).reshape(-1, d) for b in batches for x in b.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(found)), pa.int32()), pa.array(found)], ["cell", "value"])

    rows = blocks.select("x").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    return np.array([r["value"] for r in sorted(rows)])


def _totals(blocks: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for b in batches:
            for value in b.column(0):
                x = np.frombuffer(value.as_buffer(), np.int64).reshape(-1, d)
                # Two halves, so that no sum of a block leaves 64 bits.
                high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
                n, total = n + len(x), [t + (h << 32) + s for t, h, s in zip(total, high.tolist(), low.tolist())]
        exact = [Decimal(v) for v in [n, *total]]
        yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()), pa.array(exact, pa.decimal128(38, 0))], ["cell", "value"])

    rows = blocks.select("x").mapInArrow(run, "cell int, value decimal(38,0)").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    values = [int(r["value"]) for r in sorted(rows)]
    return (values[0], values[1:]) if values else (0, [0] * d)


def fit(blocks: DataFrame, d: int, components: int = 32) -> Fit | None:
    """Leading eigenvalues and vectors of the covariance; None without vectors."""
    n, total = _totals(blocks, d) if d else (0, [])
    if not n:
        return None
    out = Fit(n, total, np.zeros(0), np.zeros((d, 0)), 0.0, 0, 0.0)
    base, rest = out.base, out.rest / n

    def product(q: np.ndarray) -> np.ndarray:
        """V @ q, in one pass."""
        def cells(parts: Iterator[np.ndarray]) -> np.ndarray:
            acc = np.zeros((d, q.shape[1]))
            for x in parts:
                c = (x - base) - rest
                acc += c.T @ (c @ q)
            return acc.ravel()

        out.passes += 1
        return _summed(blocks, cells, d).reshape(d, -1) / n

    def squares(parts: Iterator[np.ndarray]) -> np.ndarray:
        return np.array([sum((float((((x - base) - rest) ** 2).sum()) for x in parts), 0.0)])

    out.trace = float(_summed(blocks, squares, d)[0]) / n
    wanted = min(components, d)
    p = min(d, wanted + GUARD)
    q = np.linalg.qr(np.random.default_rng(20240601).standard_normal((d, p)))[0]
    best = np.inf
    for turn in range(ROUNDS if out.trace > 0 else 0):
        v = product(q)
        small = q.T @ v
        ritz, u = np.linalg.eigh((small + small.T) / 2)
        ritz, u = ritz[::-1], u[:, ::-1]
        q, v = q @ u, v @ u
        residual = float(np.linalg.norm((v - q * ritz)[:, :wanted], axis=0).max() / ritz[0])
        best, stalled = min(best, residual), residual > best / 2 and best < ACCEPTED
        if residual < CERTIFIED or stalled or p == d:
            out.value, out.vector, out.residual = ritz[:wanted], q[:, :wanted], residual
            break
        upper = max(ritz[-1], ritz[0] * 1e-12)
        per_degree = np.arccosh(2 * ritz[0] / upper - 1)
        degree = int(max(2, min(DEGREE, GROWTH / max(per_degree, 1e-9))))
        q = _filtered(product, q, degree, upper, ritz[0])
        q = np.linalg.qr(q / np.linalg.norm(q, axis=0))[0]
    else:
        if out.trace > 0:
            raise RuntimeError(f"not certified after {out.passes} passes: residual {best:.1e}")
    some = out.value > d * np.finfo(float).eps * max(out.trace, 0)
    out.value, out.vector = out.value[some], out.vector[:, some]
    if out.vector.size:
        top = np.abs(out.vector).argmax(axis=0)
        out.vector = out.vector * np.sign(out.vector[top, np.arange(len(top))])
    return out


def _filtered(product: Callable[[np.ndarray], np.ndarray], q: np.ndarray, degree: int, upper: float, largest: float) -> np.ndarray:
    """The Chebyshev polynomial that is small on [0, upper], scaled at `largest`, of the covariance times q."""
    half = upper / 2
    scale = first = half / (largest - half)
    last, now = q, (product(q) - half * q) * (first / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - scale)
        last, now = now, (product(now) - half * now) * (2 * following / half) - (scale * following) * last
        scale = following
    return now


def identity_error(blocks: DataFrame, model: Fit, d: int) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured in one pass."""
    k = len(model.value)
    if not k:
        return 0.0
    base, rest, to = model.base, model.rest / model.n, model.vector / np.sqrt(model.value)

    def cells(parts: Iterator[np.ndarray]) -> np.ndarray:
        acc = np.zeros((k, k))
        for x in parts:
            w = ((x - base) - rest) @ to
            acc += w.T @ w
        return acc.ravel()

    return float(np.abs(_summed(blocks, cells, d).reshape(k, k) / model.n - np.eye(k)).max())


def deviations(x: np.ndarray, model: Fit) -> pa.Array:
    """sum((n * x - S)^2) of each row, exact; null beyond 64 bits."""
    off = x - model.base
    if (float(np.abs(off).max(initial=0)) + 1) ** 2 * float(model.n) ** 2 * off.shape[1] < 2.0**62:
        return pa.array(((off * model.n - model.rest) ** 2).sum(axis=1))
    wide = off.astype(object) * model.n - model.rest.astype(object)
    return pa.array([s if s < 1 << 63 else None for s in (wide * wide).sum(axis=1).tolist()], pa.int64())


def whiten(vectors: DataFrame, components: int = 32, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): a row for each usable vector and component."""
    blocks, d = packed(vectors, key, column)
    model = fit(blocks, d, components)
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if model is None or not len(model.value):
        return vectors.sparkSession.createDataFrame([], schema)
    error, k = identity_error(blocks, model, d), len(model.value)
    base, rest, to, explained = model.base, model.rest / model.n, model.vector / np.sqrt(model.value), model.value / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, value in zip(b.column(0), b.column(1)):
                x = np.frombuffer(value.as_buffer(), np.int64).reshape(-1, d)
                m, each = len(x), pa.array(np.repeat(np.arange(len(x)), k))
                w = ((x - base) - rest) @ to
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)),
                        deviations(x, model).take(each), pa.array(w.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
                    ],
                    [key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return blocks.mapInArrow(run, schema)
