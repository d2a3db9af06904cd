"""Toxicity: a convolutional text classifier, trained in rounds over all labelled rows.

Words are runs of letters, lower-cased. A word's embedding is the mean of hashed rows: one for the word and one for each of its
beginnings of 2 to 8 bytes, so unseen words share rows with their relatives. Filters of width 1, 2 and 3 slide over the embeddings, are
rectified, and the largest value of each filter over the whole text goes into a logistic layer.

The model learns from every labelled row that is not held out, over its whole text. It starts from a fit on the driver to a bounded sample: at
most `per_label` rows of each label, in the order of a hash of their ids, among texts of at most `longest` characters. Where that sample
holds all labelled rows, it is the fit. Otherwise the model is sent to all written files of rows in rounds; each trains a copy
on its rows, and every parameter moves by the mean over the files that moved it. A fifth of the rows is not trained on, neither in the
sample; all of them, counted by score, set one threshold for each language, at the best F1. The language of a text is guessed from the
function words in it. A score of 0.5 is the threshold of the text's language. All rows are scored, over their whole texts.

Nulls: a null text is an empty text, which gets a score like any other. Rows with a null doc_id or label are never learned from. An id
with several labels counts as toxic if one of them says so. With no labelled rows, or rows of one label only, all scores are equal: the
share of toxic rows, smoothed, kept below 0.5 unless all rows are toxic. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from .text import SPOTS, Words, mix, perhaps, prepare, separators, slices, span_hash, words_of

LETTERS = separators((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
BEGINNINGS = (2, 3, 4, 5, 6, 7, 8)
BUCKETS, WIDE, FILTERS, WIDTHS = 1 << 16, 16, 16, (1, 2, 3)
PER_LABEL, LONGEST = 2000, 20_000
RATES = (0.005, 0.0025)  # of the rounds over all labelled rows
VISITS = 16 * PER_LABEL  # a round goes over fewer rows than these more than once, EPOCHS times at most
EPOCHS = 8
BATCH_WORDS = 1 << 19  # words of the texts that one step is made from; one text alone may have more
STEPS_PER_LOGIT = 256  # resolution of the counts that thresholds are set by
SCALE = 1 << 24  # of the moves that files send
_MOVES = [f"d{i}" for i in range(WIDE)]
# Frequent function words of the languages told apart.
LANGUAGES = {
    "en": "the of and to in is that for on was with are be it".split(),
    "de": "der die und den von zu das mit sich des auf nicht dem".split(),
    "fr": "le la les des et en du un une dans est pour".split(),
    "es": "el los que del las por con para una se su".split(),
}


@dataclass
class Model:
    table: np.ndarray  # BUCKETS x WIDE
    kernels: list[np.ndarray]  # for each width: width x WIDE x FILTERS
    bias: list[np.ndarray]
    weight: np.ndarray
    offset: float
    thresholds: np.ndarray  # of the logit, for each language and for unknown ones
    constant: float | None = None


def _words(column: pa.Array) -> Words:
    return words_of(column, between=LETTERS, fold=True)


def _features(w: Words, at: np.ndarray) -> np.ndarray:
    """Rows of the table for the words `at`: the word and its beginnings. A beginning longer than the word gives the word's own row."""
    start, end = w.start[at], w.end[at]
    out = np.empty((len(at), 1 + len(BEGINNINGS)), np.int32)
    out[:, 0] = (w.hash[at] >> np.uint64(20)) % np.uint64(BUCKETS)
    for i, n in enumerate(BEGINNINGS):
        cut = span_hash(w.data, start, np.minimum(end, start + n))
        h = np.where(end - start > n, mix(cut + np.uint64(n)), w.hash[at])
        out[:, i + 1] = (h >> np.uint64(20)) % np.uint64(BUCKETS)
    return out


def _language_table() -> tuple[np.ndarray, np.ndarray]:
    every = [(w, i) for i, ws in enumerate(LANGUAGES.values()) for w in ws]
    h = _words(pa.array([w for w, _ in every])).hash
    by = np.argsort(h)
    return h[by], np.array([i for _, i in every])[by]


def _language(w: Words) -> np.ndarray:
    """Index of the language of every text; the last index: unknown."""
    h, which = _language_table()
    at = np.minimum(np.searchsorted(h, w.hash), len(h) - 1)
    hit = h[at] == w.hash
    n = len(w.first) - 1
    votes = np.bincount(w.doc[hit] * len(LANGUAGES) + which[at[hit]], minlength=n * len(LANGUAGES)).reshape(n, -1)
    return np.where(votes.max(axis=1, initial=0) > 0, votes.argmax(axis=1), len(LANGUAGES))


def _pool(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Largest value of each text; 0 for a text without rows (values are rectified)."""
    out = np.zeros((len(first) - 1, values.shape[1]), np.float32)
    some = np.diff(first) > 0
    if some.any():
        out[some] = np.maximum.reduceat(values, first[:-1][some], axis=0)
    return out


def logits(model: Model, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(logit against the threshold of the text's language, language)."""
    w = _words(column)
    _, at, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
    pooled = []
    if len(at):
        unique = model.table[_features(w, at)].mean(axis=1)
    last = w.first[1:]
    for kernel, bias in zip(model.kernels, model.bias):
        if not len(at):
            pooled.append(np.zeros((len(w.first) - 1, FILTERS), np.float32))
            continue
        total = np.repeat(bias[None], len(inverse), axis=0)
        for k in range(len(kernel)):
            part = (unique @ kernel[k])[inverse]
            if k:
                part = np.concatenate([part[k:], np.zeros((min(k, len(part)), FILTERS), np.float32)])[: len(inverse)]
                for back in range(1, k + 1):  # the word k places on lies in the next text
                    part[np.maximum(last - back, 0)[np.diff(w.first) >= back]] = 0
            total += part
        pooled.append(_pool(np.maximum(total, 0, out=total), w.first))
    language = _language(w)
    raw = np.concatenate(pooled, axis=1) @ model.weight + model.offset
    return raw - model.thresholds[language], language


class _Learner:
    """Parameters in training, with their moments."""

    def __init__(self, table: np.ndarray, kernels: list[np.ndarray], bias: list[np.ndarray], weight: np.ndarray, offset: np.ndarray) -> None:
        self.table, self.kernels, self.bias, self.weight, self.offset = table, kernels, bias, weight, offset
        self.dense = [*kernels, *bias, weight, offset]
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in [*self.dense, table]]
        self.step = 0

    def model(self) -> Model:
        return Model(self.table, self.kernels, self.bias, self.weight, float(self.offset[0]), np.zeros(len(LANGUAGES) + 1, np.float32))


def _begin(rng: np.random.Generator) -> _Learner:
    table = rng.normal(0, 0.3, (BUCKETS, WIDE)).astype(np.float32)
    kernels = [rng.normal(0, 1 / np.sqrt(k * WIDE), (k, WIDE, FILTERS)).astype(np.float32) for k in WIDTHS]
    bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    return _Learner(table, kernels, bias, rng.normal(0, 0.1, FILTERS * len(WIDTHS)).astype(np.float32), np.zeros(1, np.float32))


def _resume(model: Model) -> _Learner:
    """A copy of the model to train further; its moments start at zero."""
    return _Learner(model.table.copy(), [k.copy() for k in model.kernels], [b.copy() for b in model.bias], model.weight.copy(), np.array([model.offset], np.float32))


def _train(texts: pa.Array, toxic: np.ndarray, epochs: int, seed: int) -> Model:
    rng = np.random.default_rng(seed)
    learner = _begin(rng)
    _learn(learner, texts, toxic, float(toxic.mean()), rng, [0.01 * min(1.0, 2 * (1 - epoch / epochs)) for epoch in range(epochs)])
    return learner.model()


def _mini_batches(order: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
    """Up to 32 texts, fewer where they are long."""
    start, held = 0, 0
    for i, d in enumerate(order):
        if i > start and (i - start == 32 or held + size[d] > BATCH_WORDS):
            yield order[start:i]
            start, held = i, 0
        held += size[d]
    if len(order) > start:
        yield order[start:]


def _learn(learner: _Learner, texts: pa.Array, toxic: np.ndarray, share: float, rng: np.random.Generator, rates: list[float]) -> None:
    """A pass over the texts for each rate. share: of toxic rows, among all that are learned from."""
    hashes, count, some, features = [], [0], [], []
    for low in range(0, len(texts), 64):  # in parts, for the driver's memory
        w = _words(texts.slice(low, 64))
        unique, at = np.unique(w.hash, return_index=True)
        hashes.append(w.hash)
        count += np.diff(w.first).tolist()
        some.append(unique)
        features.append(_features(w, at))
    unique, at = np.unique(np.concatenate(some), return_index=True)
    rows = np.concatenate(features)[at]
    inverse, place_of = np.searchsorted(unique, np.concatenate(hashes)).astype(np.int32), np.cumsum(count)
    del hashes, some, features
    cost = np.where(toxic == 1, 0.5 / share, 0.5 / (1 - share))
    table, kernels, bias, weight, offset = learner.table, learner.kernels, learner.bias, learner.weight, learner.offset
    for rate in rates:
        for docs in _mini_batches(rng.permutation(len(texts)), np.diff(place_of)):
            place = np.concatenate([inverse[place_of[d] : place_of[d + 1]] for d in docs])
            size = np.array([place_of[d + 1] - place_of[d] for d in docs])
            first = np.r_[0, np.cumsum(size + max(WIDTHS) - 1)]  # a gap behind each text
            x = np.zeros((first[-1], WIDE), np.float32)
            spot = np.repeat(first[:-1] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(len(place))
            used, back = np.unique(place, return_inverse=True)
            x[spot] = table[rows[used]].mean(axis=1)[back]
            owner = np.full(first[-1], -1, np.int64)
            owner[spot] = place
            picked, pooled = [], []
            for kernel, c in zip(kernels, bias):
                k = len(kernel)
                z = sum(x[i : len(x) - k + 1 + i] @ kernel[i] for i in range(k)) + c
                best = np.zeros((len(docs), FILTERS), np.int64)
                for j in range(len(docs)):
                    if size[j]:
                        best[j] = first[j] + z[first[j] : first[j] + size[j]].argmax(axis=0)
                picked.append(best)
                pooled.append(np.where(size[:, None] > 0, np.maximum(z[best, np.arange(FILTERS)], 0), 0))
            h = np.concatenate(pooled, axis=1).astype(np.float32)
            p = 1 / (1 + np.exp(-np.clip(h @ weight + offset[0], -30, 30)))
            target = 0.02 + 0.96 * toxic[docs]
            g = ((p - target) * cost[docs] / len(docs)).astype(np.float32)
            gw, go, gh = h.T @ g + 1e-4 * weight, np.array([g.sum()], np.float32), g[:, None] * weight * (h > 0)
            gk, gb, hits, parts = [], [], [], []
            for n, (kernel, best) in enumerate(zip(kernels, picked)):
                part = gh[:, n * FILTERS : (n + 1) * FILTERS]
                gb.append(part.sum(axis=0))
                one = np.zeros_like(kernel)
                for i in range(len(kernel)):
                    seen = np.minimum(best + i, len(x) - 1)
                    one[i] = np.einsum("df,dfe->ef", part, x[seen])
                    hits.append(owner[seen].ravel())
                    parts.append((part[:, :, None] * kernel[i].T[None]).reshape(-1, WIDE))
                gk.append(one)
            hit, part = np.concatenate(hits), np.concatenate(parts)
            keep = (hit >= 0) & (np.abs(part).max(axis=1) > 0)
            learner.step += 1
            _adam(learner.dense, [*gk, *gb, gw, go], learner.moments, learner.step, rate)
            if keep.any():
                touched = rows[hit[keep]].ravel()
                spread = np.repeat(part[keep] / rows.shape[1], rows.shape[1], axis=0)
                some, to = np.unique(touched, return_inverse=True)
                gt = np.zeros((len(some), WIDE), np.float32)
                np.add.at(gt, to, spread)
                m, v = learner.moments[-1]
                m[some] = 0.9 * m[some] + 0.1 * gt
                v[some] = 0.99 * v[some] + 0.01 * gt**2
                table[some] -= rate * 3 * m[some] / (np.sqrt(v[some]) + 1e-6)


def _adam(values: list[np.ndarray], gradients: list[np.ndarray], moments: list, step: int, rate: float) -> None:
    for p, g, (m, v) in zip(values, gradients, moments):
        m *= 0.9
        m += 0.1 * g
        v *= 0.99
        v += 0.01 * g**2
        p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)


def _best_threshold(logit: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> float:
    """Middle of the gap between scores at which F1 is largest; rows count by weight."""
    by = np.argsort(-logit, kind="stable")
    score, weight, toxic = logit[by], weight[by], toxic[by]
    f1 = 2 * np.cumsum(weight * toxic) / (np.cumsum(weight) + (weight * toxic).sum())
    ends = np.r_[score[1:] < score[:-1], True]
    at = int(np.where(ends, f1, -1).argmax())
    below = score[at + 1] if at + 1 < len(score) else score[at] - 2
    return float((score[at] + below) / 2)


def fit(texts: pa.Array, toxic: np.ndarray, weight: np.ndarray | None = None, epochs: int = EPOCHS, seed: int = 11) -> Model:
    """Train, then set the thresholds on every fifth text, which is not trained on. weight: labelled rows that a text stands for."""
    texts, toxic = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts, np.asarray(toxic, np.int64)
    weight = np.ones(len(toxic)) if weight is None else np.asarray(weight, float)
    if len(toxic) == 0 or toxic.min() == toxic.max():
        empty = np.zeros((1, WIDE), np.float32)
        share = 0.99 if len(toxic) and toxic.all() else 0.01
        return Model(empty, [], [], np.zeros(0, np.float32), 0.0, np.zeros(0, np.float32), share)
    apart = np.arange(len(texts)) % 5 == 4
    if min(np.bincount(toxic[apart], minlength=2)) < 5 or min(np.bincount(toxic[~apart], minlength=2)) < 1:
        apart = np.zeros(len(texts), bool)  # too few rows to set any aside: calibrate on all
    model = _train(texts.filter(pa.array(~apart)), toxic[~apart], epochs, seed)
    own = apart if apart.any() else ~apart
    truth, counts, scores, languages = toxic[own], weight[own], [], []
    chosen = texts.filter(pa.array(own))
    for at in range(0, len(chosen), 64):
        s, g = logits(model, chosen.slice(at, 64))
        scores.append(s)
        languages.append(g)
    score, language = np.concatenate(scores), np.concatenate(languages)
    model.thresholds[:] = _best_threshold(score, truth, counts)
    for i in range(len(LANGUAGES)):
        here = language == i
        if min(np.bincount(truth[here], minlength=2)) >= 20:
            model.thresholds[i] = _best_threshold(score[here], truth[here], counts[here])
    return model


def held_out(column: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 0, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, longest: int = LONGEST) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The bounded sample of labelled rows: texts, labels, and how many labelled rows each stands for."""
    marks = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    able = docs.where(~held_out() & (F.length(F.coalesce("text", F.lit(""))) <= longest)).select("doc_id").distinct().join(marks, "doc_id")
    spot = F.xxhash64("doc_id")
    chosen = [able.where(F.col("toxic") == y).orderBy(spot, "doc_id").limit(per_label) for y in (0, 1)]
    ids = chosen[0].union(chosen[1])  # at most 2 * per_label rows
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.length("text") <= longest)
    rows = texts.join(F.broadcast(ids), "doc_id").orderBy(spot, "doc_id", "text").limit(2 * per_label).select("text", "toxic").toArrow()
    toxic = rows.column("toxic").to_numpy().astype(np.int64)
    every = {r["toxic"]: r["n"] for r in able.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    taken = np.bincount(toxic, minlength=2)
    return rows.column("text").combine_chunks().cast(pa.large_string()), toxic, np.array([every[y] / taken[y] for y in toxic.tolist()])


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic, apart) of all labelled rows that are not held out, whole texts of any length. apart: the fifth that only sets thresholds."""
    marks = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(~held_out())
    rows = perhaps(own, marks, "doc_id", bits=SPOTS).join(marks, "doc_id")
    return rows.select("doc_id", "text", "toxic", _apart().alias("apart")).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "text").drop("doc_id")


def _apart() -> Column:
    return F.pmod(F.xxhash64(F.lit("apart"), "doc_id"), F.lit(5)) == 4


def _moves(model: Broadcast, share: float, rates: list[float], seed: int):
    """Every written file of rows trains a copy of the model and gives what it moved: a row of each part, weighed by its texts."""
    def moved(learner: _Learner, start: Model, n: int) -> pa.RecordBatch:
        before, after = _flat(start), _flat(learner.model())
        at = np.flatnonzero((before != after).any(axis=1))
        step = np.rint((after[at].astype(np.float64) - before[at]) * n * SCALE).astype(np.int64)  # whole numbers: their sum is the same in any order
        return pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.full(len(at), n)), *[pa.array(c) for c in np.ascontiguousarray(step.T)]], ["at", "n", *_MOVES])

    def run(batches):
        start, learner, n, file, rng = model.value, None, 0, None, None
        for part in slices(batches, "text"):
            names = part.column("file").to_numpy(zero_copy_only=False)
            cuts = np.r_[0, np.flatnonzero(names[1:] != names[:-1]) + 1, len(names)]
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if names[low] != file:
                    if n:
                        yield moved(learner, start, n)
                    learner, n, file, rng = _resume(start), 0, names[low], np.random.default_rng(seed)
                some = part.slice(low, high - low)
                _learn(learner, some.column("text").cast(pa.large_string()), some.column("toxic").to_numpy().astype(np.int64), share, rng, rates)
                n += high - low
        if n:
            yield moved(learner, start, n)

    return run


def _flat(model: Model) -> np.ndarray:
    """All parameters in rows of WIDE: the table, then the rest."""
    rest = np.concatenate([p.ravel() for p in [*model.kernels, *model.bias, model.weight, np.array([model.offset], np.float32)]])
    return np.concatenate([model.table, np.resize(np.r_[rest, np.zeros(-len(rest) % WIDE, np.float32)], (-(-len(rest) // WIDE), WIDE))])


def _unflat(flat: np.ndarray, like: Model) -> Model:
    rest, at, parts = flat[BUCKETS:].ravel(), 0, []
    for p in [*like.kernels, *like.bias, like.weight]:
        parts.append(rest[at : at + p.size].reshape(p.shape).copy())
        at += p.size
    k = len(like.kernels)
    return Model(flat[:BUCKETS].copy(), parts[:k], parts[k:-1], parts[-1], float(rest[at]), like.thresholds.copy())


def _round(rows: DataFrame, model: Model, share: float, rates: list[float], seed: int) -> Model:
    """Passes (of these rates) over all rows: files train apart from each other, then each part of the model moves by the mean over the files that moved it."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # of fixed size
    read = rows.select("text", "toxic", F.col("_metadata.file_path").alias("file"))
    moves = read.mapInArrow(_moves(shared, share, rates, seed), ", ".join(f"{c} bigint" for c in ["at", "n", *_MOVES]))
    # As many rows as the model has, whatever the number of texts.
    total = moves.groupBy("at").agg(*[F.sum(c).alias(c) for c in ["n", *_MOVES]]).toArrow()
    flat = _flat(model)
    at = total.column("at").to_numpy()
    step = np.stack([total.column(c).to_numpy() for c in _MOVES], axis=1) / (total.column("n").to_numpy()[:, None] * float(SCALE))
    flat[at] = (flat[at] + step).astype(np.float32)
    return _unflat(flat, model)


def _calibrate(rows: DataFrame, model: Model) -> None:
    """One threshold for each language from the scores of all rows: counts by language, score in steps, and label are all that the driver sees."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches):
        for part in slices(batches, "text"):
            score, language = logits(shared.value, part.column("text"))
            step = np.rint(np.clip(score.astype(np.float64), -64, 64) * STEPS_PER_LOGIT).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(language.astype(np.int64)), pa.array(step), part.column("toxic")], ["language", "step", "toxic"])

    counted = rows.select("text", "toxic").mapInArrow(run, "language bigint, step bigint, toxic int").groupBy("language", "step", "toxic").agg(F.count(F.lit(1)).alias("n"))
    language, step, truth, n = (c.to_numpy() for c in counted.orderBy("language", "step", "toxic").toArrow().columns)
    score = step / STEPS_PER_LOGIT
    model.thresholds[:] = _best_threshold(score, truth, n.astype(float))
    for i in range(len(LANGUAGES)):
        here = language == i
        if min(n[here & (truth == y)].sum() for y in (0, 1)) >= 20:
            model.thresholds[i] = _best_threshold(score[here], truth[here], n[here].astype(float))


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, longest: int = LONGEST, seed: int = 11) -> Model:
    """A model of all labelled rows that are not held out. The driver's sample is where it starts, and all there is if no row lies outside it."""
    prepare(docs.sparkSession)
    rows = stage(labelled(docs, labels), "toxicity-rows")
    size = rows.groupBy("apart", "toxic").agg(F.count(F.lit(1)).alias("n"), F.max(F.length("text")).alias("longest")).collect()
    count = {(a, y): sum(r.n for r in size if (r.apart, r.toxic) == (a, y)) for a in (False, True) for y in (0, 1)}
    every = [count[False, y] + count[True, y] for y in (0, 1)]
    if not all(every) or max(every) <= per_label and max(r.longest for r in size) <= longest:
        own = {y: n for y, n in enumerate(every) if n}
        if len(own) == 1:  # one label: the text plays no part
            return fit(pa.array([""], pa.large_string()), np.array([*own]))
        return fit(*sample(docs, labels, per_label, longest))
    whole = min(count[True, 0], count[True, 1]) < 5 or min(count[False, 0], count[False, 1]) < 1  # too few rows to set any aside
    learned, checked = (rows, rows) if whole else (rows.where(~F.col("apart")), rows.where("apart"))
    texts, toxic, _ = sample(docs if whole else docs.where(~_apart()), labels, per_label, longest)
    model = _train(texts, toxic, EPOCHS, seed) if len(toxic) and toxic.min() < toxic.max() else _begin(np.random.default_rng(seed)).model()
    own = every if whole else [count[False, 0], count[False, 1]]
    passes = min(EPOCHS, -(-VISITS // sum(own)))
    for turn, rate in enumerate(RATES):
        model = _round(learned, model, own[1] / sum(own), [rate] * passes, seed + turn)
    _calibrate(checked, model)
    return model


def score(docs: DataFrame, model: Model, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """docs with the score (double) and the prediction (int) behind its columns; columns that have these names already are replaced."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    docs = docs.select(*[c for c in docs.columns if c not in names])
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())])

    def run(batches):
        for part in slices(batches, "text"):
            known = shared.value
            if known.constant is not None:
                p = np.full(part.num_rows, known.constant)
            else:
                p = 1 / (1 + np.exp(-np.clip(logits(known, part.column("text"))[0].astype(np.float64), -30, 30)))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p), pa.array((p >= 0.5).astype(np.int32))], [*part.schema.names, *names])

    return docs.mapInArrow(run, schema)
