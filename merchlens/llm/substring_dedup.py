"""Substring dedup: every word that lies in a window of `window` words occurring more than once in the corpus is removed.

Super-k-mer partitioning: the minimiser of a window is the smallest hash of the groups of `GROUP` consecutive words in it. Consecutive
windows with the same minimiser travel to the minimiser's bucket as one packed string, which holds each of their words once. Equal windows
have equal minimisers, so they meet in one bucket, where sorting the windows counts them; equal hashes are compared word by word.

Load: buckets are as many as keep about `PER_BUCKET` strings each. Minimisers that are frequent for the corpus (`hot`) would fill a bucket; their
windows are counted by an aggregate instead, on 128-bit digests: first whole packed strings, so that copies count once, then the
windows of distinct strings. The list of hot minimisers is bounded (at most 2^18 of them, however large the corpus).
Packed strings of one task for one bucket are compressed together.

Windows are judged on the input, not on what is left. Nulls: a null text has no words; a row with a null doc_id is a document like others.
Repeated rows are documents that repeat each other. Texts with fewer words than the window stay whole. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .text import Words, mix, prepare, rolling, slices, words_of

GROUP = 4  # words of a group whose hash can be a minimiser
LONGEST_RUN = 64  # windows of one packed string
PER_BUCKET = 16_384
HOT, HOT_SHARE = 1024, 18  # a minimiser is hot above HOT strings and above 2^-HOT_SHARE of all strings
PACKED = 32 << 20  # bytes of strings that a task gathers before it sends them
_CODEC, _LEVEL = "zstd", 3
_BASES = (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Smallest of each n consecutive values."""
    width = 1
    while width * 2 <= n:
        x = np.minimum(x[:-width], x[width:]) if len(x) > width else x[:0]
        width *= 2
    rest = n - width
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest and len(x) > rest else x if not rest else x[:0]


def strings(w: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, windows, minimiser) of the packed strings; words are counted over the slice."""
    none = np.zeros(0, np.int64)
    group = rolling(w.hash, GROUP, 0x5851F42D4C957F2D)
    least = _sliding_min(group, window - GROUP + 1)
    count = np.maximum(np.diff(w.first) - window + 1, 0)
    if not count.sum():
        return none, none, none, none.astype(np.uint64)
    doc = np.repeat(np.arange(len(count)), count)
    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + w.first[:-1][doc]
    value = least[place]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])]
    run = np.flatnonzero(new)
    since = np.arange(len(new)) - np.repeat(run, np.diff(np.r_[run, len(new)]))
    start = np.flatnonzero(since % LONGEST_RUN == 0)
    return doc[start], place[start], np.diff(np.r_[start, len(new)]), value[start]


def _keyed(docs: DataFrame) -> DataFrame:
    """Two 64-bit keys of a row's id and text: rows that agree in both share their result."""
    return docs.select(F.xxhash64("doc_id", F.lit(1), "text").alias("k1"), F.xxhash64(F.lit(7), "text", F.lit(3), "doc_id").alias("k2"), "text")


def frequent(docs: DataFrame, window: int, hot: int = HOT) -> tuple[np.ndarray, int]:
    """(hot minimisers, number of packed strings). A minimiser that occurs once in a slice is not counted there: only balance depends on it."""
    prepare(docs.sparkSession)

    def run(batches):
        total = 0
        for part in slices(batches, "text"):
            value = strings(words_of(part.column("text")), window)[3]
            total += len(value)
            value, n = np.unique(value, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value[n > 1].view(np.int64)), pa.array(n[n > 1]), pa.array(np.zeros((n > 1).sum(), bool))], ["m", "n", "all"])
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([total], pa.int64()), pa.array([True])], ["m", "n", "all"])

    counts = stage(docs.select("text").mapInArrow(run, "m bigint, n bigint, all boolean").groupBy("all", "m").agg(F.sum("n").alias("n")), "minimisers")
    total = counts.where("all").agg(F.sum("n")).first()[0] or 0
    rows = counts.where(~F.col("all") & (F.col("n") > max(hot, total >> HOT_SHARE))).select("m").collect()  # at most 2^HOT_SHARE
    return np.sort(np.array([r["m"] for r in rows], np.int64)), total


def _in(values: np.ndarray, listed: np.ndarray) -> np.ndarray:
    if not len(listed):
        return np.zeros(len(values), bool)
    return listed[np.minimum(np.searchsorted(listed, values), len(listed) - 1)] == values


def _packed(keyed: DataFrame, window: int, hot, buckets: int) -> DataFrame:
    """(bucket, k1, k2, start, size, blob, bytes): lists over strings, and the strings' bytes."""
    def run(batches):
        held: list[tuple] = []
        weight = 0

        def send():
            bucket = np.concatenate([h[0] for h in held])
            columns = [np.concatenate([h[i] for h in held]) for i in (1, 2, 3)]
            texts = [t for h in held for t in h[4]]
            by = np.argsort(bucket, kind="stable")
            cut = np.r_[0, np.flatnonzero(np.diff(bucket[by])) + 1, len(by)]
            codec = pa.Codec(_CODEC, compression_level=_LEVEL)
            rows = []
            for a, b in zip(cut[:-1], cut[1:]):
                own = by[a:b]
                raw = b"".join(texts[i] for i in own)
                rows.append((int(bucket[own[0]]), *[c[own] for c in columns], np.array([len(texts[i]) for i in own], np.int32), codec.compress(raw).to_pybytes(), len(raw)))
            names = ["bucket", "k1", "k2", "start", "size", "blob", "bytes"]
            kinds = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.int32()]
            for low in range(0, len(rows), 64):
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows[low : low + 64]], k) for i, k in enumerate(kinds)], names)

        for part in slices(batches, "text"):
            w = words_of(part.column("text"))
            doc, first, n, value = strings(w, window)
            cold = ~_in(value.view(np.int64), hot.value)
            doc, first, n, value = doc[cold], first[cold], n[cold], value[cold]
            if not len(doc):
                continue
            data = w.data.tobytes()
            text = [data[a:b] for a, b in zip(w.start[first].tolist(), w.end[first + n + window - 2].tolist())]
            k1, k2 = (part.column(c).to_numpy()[doc] for c in ("k1", "k2"))
            held.append(((mix(value) % np.uint64(buckets)).astype(np.int32), k1, k2, (first - w.first[doc]).astype(np.int32), text))
            weight += sum(map(len, text))
            if weight >= PACKED:
                yield from send()
                held, weight = [], 0
        if held:
            yield from send()

    return keyed.mapInArrow(run, "bucket int, k1 array<bigint>, k2 array<bigint>, start array<int>, size array<int>, blob binary, bytes int")


def exact_ids(w: Words) -> np.ndarray:
    """The same number for equal words only: equal hashes are compared byte by byte."""
    _, at, number = np.unique(w.hash, return_index=True, return_inverse=True)
    size, like = w.end - w.start, at[number]
    if (size == size[like]).all():
        local = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        if (w.data[np.repeat(w.start, size) + local] == w.data[np.repeat(w.start[like], size) + local]).all():
            return number
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(bytes(w.data[a:b]), len(known)) for a, b in zip(w.start, w.end)], np.int64)


def repeated_windows(w: Words, window: int) -> np.ndarray:
    """First words of the windows (inside a document of w) that occur at least twice in w."""
    count = np.maximum(np.diff(w.first) - window + 1, 0)
    doc = np.repeat(np.arange(len(count)), count)
    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + w.first[:-1][doc]
    if not len(place):
        return place
    ids = exact_ids(w)
    h = rolling(ids.astype(np.uint64) + np.uint64(1), window, _BASES[0])[place]
    by = np.argsort(h, kind="stable")
    place, h = place[by], h[by]
    next_to = np.flatnonzero(h[1:] == h[:-1])
    same = np.ones(len(next_to), bool)
    for k in range(window):
        same &= ids[place[next_to] + k] == ids[place[next_to + 1] + k]
    hit = np.zeros(len(place), bool)
    hit[next_to[same]] = hit[next_to[same] + 1] = True
    for odd in np.unique(h[next_to[~same]]):  # different windows share a hash
        run = np.flatnonzero(h == odd)
        rows = [ids[p : p + window].tobytes() for p in place[run]]
        hit[run] = [rows.count(r) > 1 for r in rows]
    return np.sort(place[hit])


def _spans(start: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive windows as (index of the first, first word, end word)."""
    new = np.flatnonzero(np.r_[True, np.diff(start) != 1]) if len(start) else np.zeros(0, np.int64)
    last = np.r_[new[1:], len(start)] - 1 if len(start) else new
    return new, start[new], start[last] + window


def _from_buckets(packed: DataFrame, window: int) -> DataFrame:
    """(k1, k2, a, b): words a to b of a document are covered by repeated windows."""
    def run(table: pa.Table) -> pa.Table:
        codec = pa.Codec(_CODEC)
        blob = b"".join(codec.decompress(x.as_py(), n.as_py()).to_pybytes() for x, n in zip(table.column("blob"), table.column("bytes")))
        k1, k2, first, size = (np.concatenate([x.values.to_numpy() for x in table.column(c)]) for c in ("k1", "k2", "start", "size"))
        offsets = np.r_[0, np.cumsum(size.astype(np.int64))]
        text = pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(blob)])
        w = words_of(text)
        start = repeated_windows(w, window)
        doc = np.searchsorted(w.first, start, side="right") - 1
        apart = start + 2 * doc  # no run goes on from one string into the next
        new, _, _ = _spans(apart, window)
        last = np.r_[new[1:], len(start)] - 1 if len(start) else new
        own = doc[new]
        return pa.table({"k1": k1[own], "k2": k2[own], "a": first[own] + start[new] - w.first[own], "b": first[own] + start[last] - w.first[own] + window})

    return packed.groupBy("bucket").applyInArrow(run, "k1 bigint, k2 bigint, a bigint, b bigint")


def _from_hot(keyed: DataFrame, window: int, hot) -> DataFrame:
    """The same for windows with a hot minimiser, by aggregates over digests."""
    def run(batches):
        for part in slices(batches, "text"):
            w = words_of(part.column("text"))
            doc, first, n, value = strings(w, window)
            warm = _in(value.view(np.int64), hot.value)
            doc, first, n = doc[warm], first[warm], n[warm]
            if not len(doc):
                continue
            k1, k2 = (part.column(c).to_numpy()[doc] for c in ("k1", "k2"))
            cut = np.r_[0, np.cumsum(n)]
            place = np.arange(cut[-1]) - np.repeat(cut[:-1], n) + np.repeat(first, n)
            within = (np.arange(cut[-1]) - np.repeat(cut[:-1], n)).astype(np.uint64)
            both = [rolling(w.hash, window, base)[place] for base in _BASES]
            digest = [np.add.reduceat(mix(x + within * np.uint64(0xD1B54A32D192ED03)), cut[:-1]).view(np.int64) for x in both]
            lists = [pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(x.view(np.int64))) for x in both]
            yield pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2), pa.array(first - w.first[doc]), pa.array(digest[0]), pa.array(digest[1]), *lists], ["k1", "k2", "start", "d1", "d2", "w1", "w2"])

    rows = stage(keyed.mapInArrow(run, "k1 bigint, k2 bigint, start bigint, d1 bigint, d2 bigint, w1 array<bigint>, w2 array<bigint>"), "hot-strings")
    distinct = rows.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n"), F.first("w1").alias("w1"), F.first("w2").alias("w2"))
    windows = stage(distinct.select("d1", "d2", "n", F.posexplode(F.arrays_zip("w1", "w2")).alias("at", "w")).select("d1", "d2", "n", "at", "w.w1", "w.w2"), "hot-windows")
    again = windows.groupBy("w1", "w2").agg(F.sum("n").alias("n")).where("n > 1").select("w1", "w2")
    marked = windows.join(again, ["w1", "w2"]).groupBy("d1", "d2").agg(F.sort_array(F.collect_list("at")).alias("at"))  # at most LONGEST_RUN
    found = rows.select("k1", "k2", "start", "d1", "d2").join(marked, ["d1", "d2"])
    # Consecutive windows become one span.
    at = F.col("at")
    firsts = F.filter(at, lambda x: ~F.array_contains(at, x - 1))
    lasts = F.filter(at, lambda x: ~F.array_contains(at, x + 1))
    return found.select("k1", "k2", "start", F.explode(F.arrays_zip(firsts.alias("a"), lasts.alias("b"))).alias("s")).select(
        "k1", "k2", (F.col("start") + F.col("s.a")).alias("a"), (F.col("start") + F.col("s.b") + window).alias("b")
    )


def repeated(docs: DataFrame, window: int = 35, hot: int = HOT) -> DataFrame:
    """(k1, k2, spans): the covered words of every document that has some, as (a, b) word numbers, end exclusive; spans may overlap."""
    listed, total = frequent(docs, window, hot)
    shared = docs.sparkSession.sparkContext.broadcast(listed)  # at most 2^HOT_SHARE values
    keyed = _keyed(docs)
    spans = _from_buckets(_packed(keyed, window, shared, max(1, total // PER_BUCKET)), window)
    if len(listed):
        spans = spans.unionByName(_from_hot(keyed, window, shared))
    return spans.distinct().groupBy("k1", "k2").agg(F.collect_list(F.struct("a", "b")).alias("spans"))  # of one document


def dedup(docs: DataFrame, window: int = 35, hot: int = HOT) -> DataFrame:
    """A row for each row of docs: doc_id, n_words, n_removed, kept (the words that stay, joined by one space)."""
    spans = stage(repeated(docs, window, hot), "repeated-spans")
    codec_level = 3

    def pack(batches):
        codec = pa.Codec(_CODEC, compression_level=codec_level)
        for part in slices(batches, "text"):
            raw = [b"" if t is None else t.encode() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("k1"), part.column("k2"), pa.array([codec.compress(r).to_pybytes() for r in raw], pa.binary()), pa.array([len(r) for r in raw], pa.int64())], ["doc_id", "k1", "k2", "blob", "bytes"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", F.xxhash64("doc_id", F.lit(1), "text").alias("k1"), F.xxhash64(F.lit(7), "text", F.lit(3), "doc_id").alias("k2"), "text")
    small = keyed.mapInArrow(pack, f"doc_id {kind}, k1 bigint, k2 bigint, blob binary, bytes bigint")
    joined = small.join(spans, ["k1", "k2"], "left")

    def run(batches):
        codec = pa.Codec(_CODEC)
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                part = batch.slice(low, 64)
                raw = [codec.decompress(x.as_py(), n.as_py()).to_pybytes() if n.as_py() else b"" for x, n in zip(part.column("blob"), part.column("bytes"))]
                text = pa.Array.from_buffers(pa.large_string(), len(raw), [None, pa.py_buffer(np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int64)), pa.py_buffer(b"".join(raw))])
                w = words_of(text)
                cover = np.zeros(len(w.start) + 1, np.int64)
                for d, s in enumerate(part.column("spans")):
                    if s.is_valid:
                        a, b = (s.values.field(i).to_numpy() for i in (0, 1))
                        np.add.at(cover, w.first[d] + a, 1)
                        np.add.at(cover, w.first[d] + b, -1)
                gone = np.cumsum(cover[:-1]) > 0
                data, kept = w.data.tobytes(), []
                stay = np.flatnonzero(~gone)
                words = [data[a:b] for a, b in zip(w.start[stay].tolist(), w.end[stay].tolist())]
                cut = np.searchsorted(stay, w.first)
                kept = [b" ".join(words[a:b]).decode() for a, b in zip(cut[:-1], cut[1:])]
                n = np.diff(w.first)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n), pa.array(n - np.diff(cut)), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    return joined.select("doc_id", "blob", "bytes", "spans").mapInArrow(run, f"doc_id {kind}, n_words bigint, n_removed bigint, kept string")
