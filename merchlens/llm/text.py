"""Words of whole texts as numpy arrays, and Arrow batches cut to a bounded number of bytes.

The separators are `[\\x20\\x09-\\x0D]`; everything else belongs to words. A null text has no words. A word is identified by a 64-bit
hash of its bytes; callers that need certainty compare the bytes afterwards.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
ROWS_PER_BATCH, BYTES_PER_BATCH = 256, 16 << 20
SPOTS = 1 << 26  # most bits of the broadcast filter (8 MB), whatever the number of rows
SPOTS_PER_ROW = 64  # bits of a smaller filter for each wanted row

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_VALUE = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def prepare(spark: SparkSession) -> None:
    """Few rows for each Arrow batch, as texts may be long and a task holds one batch at a time; workers find this package."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in (paths := env.get("PYTHONPATH", "").split(os.pathsep)):
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))


def text_key(column: str = "text") -> Column:
    """Tells apart rows that share a doc_id; null and empty differ."""
    return F.xxhash64(F.lit(1), F.col(column))


def spots(n: int) -> int:
    """Bits of the filter for n rows: a power of 2, whole parts of 2^15 bits, at most SPOTS."""
    return min(SPOTS, 1 << max(15, (n * SPOTS_PER_ROW - 1).bit_length()))


def perhaps(rows: DataFrame, wanted: DataFrame, *keys: str, bits: int | None = None) -> DataFrame:
    """The rows whose keys may be among the wanted ones: none of these is lost, and few others are left for the join that follows to shuffle.

    wanted: a written table, as its rows are counted unless the filter's bits are given. Few rows make a small filter: the driver holds it several times over.
    """
    spot = F.pmod(F.xxhash64(*keys), F.lit(spots(wanted.count()) if bits is None else bits)) + 1
    marked = wanted.select(F.bitmap_bucket_number(spot).alias("_part"), F.bitmap_bit_position(spot).alias("_at")).repartition("_part")
    bits = marked.groupBy("_part").agg(F.bitmap_construct_agg("_at").alias("_bits"))
    at = F.bitmap_bit_position(spot)
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return rows.join(F.broadcast(bits), F.bitmap_bucket_number(spot) == F.col("_part")).where(F.getbit(byte, (at % 8).cast("int")) == 1).select(*rows.columns)


def fresh(df: DataFrame, name: str) -> str:
    """The name, or one like it, that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finishing step of splitmix)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    if n > 1:
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out


@dataclass
class Words:
    """Words of consecutive documents. `first[d]` to `first[d + 1]` are the words of document d."""

    data: np.ndarray  # bytes, lower-cased if asked for
    start: np.ndarray  # of each word in data
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    column = column if column.offset == 0 else pa.concat_arrays([column])
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if n and column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column without nulls."""
    return texts_of(column.cast(pa.large_binary()).view(pa.large_string()))


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of separating bytes from inclusive ranges."""
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


def words_of(column: pa.Array, lower: bool = False, between: np.ndarray = _SEPARATOR, fold: bool = False) -> Words:
    """lower: A-Z only; fold: also the accented capitals of Latin-1. between: the separating bytes."""
    data, offsets = texts_of(column)
    if lower or fold:
        data = _LOWER[data]
    if fold and len(data) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        data[1:][capital] += 0x20
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(offsets), np.int64), np.zeros(0, np.uint64))
    inside = ~between[data]
    cut = np.zeros(len(data) + 1, bool)  # where a document begins
    cut[offsets] = True
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | cut[1:-1]
    stop[:-1] &= ~inside[1:] | cut[1:-1]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return Words(data, start, end, np.searchsorted(start, offsets), span_hash(data, start, end))


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] for many spans; empty spans are not allowed."""
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    at = np.cumsum(length) - length
    local = np.arange(at[-1] + length[-1]) - np.repeat(at, length)
    value = _BYTE_VALUE[data[np.repeat(start, length) + local]]
    value *= powers(_BASE, int(length.max()))[local]
    return mix(np.add.reduceat(value, at) + length.astype(np.uint64))


def rolling(h: np.ndarray, n: int, base: int) -> np.ndarray:
    """Polynomial hash of each n consecutive values, by doubling: about 2 log n passes."""
    base_n, out, width, done = np.uint64(base), None, 1, 0
    block, shift = h, base_n
    with np.errstate(over="ignore"):
        result_shift = np.uint64(1)
        left = n
        while left:
            if left & 1:
                part = block[done : len(block)]
                part = part * result_shift
                out = part if out is None else out[: len(part)] + part
                done += width
                result_shift = result_shift * shift
            left >>= 1
            if left:
                block = block[: len(block) - width] + block[width:] * shift
                shift, width = shift * shift, width * 2
    return mix(out[: max(len(h) - n + 1, 0)])


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in slices of at most `limit` bytes of text, or of one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        at = 0
        while at < batch.num_rows:
            total, to = int(sizes[at]), at + 1
            while to < batch.num_rows and total + sizes[to] <= limit:
                total += int(sizes[to])
                to += 1
            yield batch.slice(at, to - at)
            at = to

