"""Byte-level BPE encoding and decoding with length-bucketed padded matrices.

A text is split by the vocabulary's pattern. New words of a slice of texts are dealt into buckets by length; a bucket is a matrix of
symbols, one word a row, padded on the right. Each round finds the leftmost pair of least rank in every row, merges it, and closes the
gap, so the matrix loses one column; rows without a pair leave the matrix. Pair ranks stand in a second matrix of which a merge changes
two cells, looked up in a hash table of (left, right). Encoded words are remembered in a table of bounded size.

A word that is a token itself is that token, as in the library. A word beyond merges.LONG bytes (text without spaces) would need as many
rounds as it has bytes, each over the whole row; it is merged by a heap, with the same order of merges.

A null text is an empty text and has no ids; null ids give no bytes. Rows that share a doc_id each keep their own ids. Other columns are
not read. The paths of the vocabulary and the pattern are parameters.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .merges import LONG, NONE, PairTable, merge_long
from .text import prepare, slices

WIDTHS = (4, 8, 16, 32, 64, 128, 256, LONG)
CELLS = 1 << 18  # of one matrix
REMEMBERED, REMEMBERED_BYTES = 200_000, 8 << 20  # words that a worker keeps encoded, and their bytes
WORDS_AT_ONCE = 1 << 18


class BytePairs:
    """Ranks of one vocabulary file and the encoder."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.token = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes = {i: t for t, i in self.token.items()}
        self.size = max(self.bytes) + 1
        self.pattern = regex.compile(pattern)
        self.byte = np.array([self.token[bytes([b])] for b in range(256)], np.int64)
        made = [(self.token[t[:k]] * self.size + self.token[t[k:]], i) for t, i in self.token.items() for k in range(1, len(t)) if t[:k] in self.token and t[k:] in self.token]
        keys, ids = (np.array(x, np.int64) for x in zip(*made)) if made else (np.zeros(0, np.int64),) * 2
        self.pairs = PairTable(keys, ids.astype(np.int32), ids.astype(np.int32))
        self.begin()

    def begin(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.at, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.held = 0

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; negative symbols are padding."""
        both = (left >= 0) & (right >= 0)
        out = np.full(left.shape, NONE, np.int32)
        out[both] = self.pairs.look_up(left[both].astype(np.int64) * self.size + right[both])[0]
        return out

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the words and their number for each word; no word is empty."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
        length = np.array([len(w) for w in words])
        bucket = np.searchsorted(WIDTHS, length)
        for b, width in enumerate(WIDTHS):
            mine = np.flatnonzero(bucket == b)
            for at in range(0, len(mine), max(1, CELLS // width)):
                self._rounds(words, mine[at : at + max(1, CELLS // width)], length, out)
        for w in np.flatnonzero(bucket == len(WIDTHS)).tolist():
            out[w] = self._long(words[w])
        return np.concatenate(out) if out else np.zeros(0, np.int32), np.array([len(o) for o in out], np.int64)

    def _rounds(self, words: list[bytes], chosen: np.ndarray, length: np.ndarray, out: list[np.ndarray]) -> None:
        size, row = length[chosen], chosen
        width = int(size.max())
        symbol = np.full((len(row), width), -1, np.int32)
        symbol[np.arange(width) < size[:, None]] = self.byte[np.frombuffer(b"".join(words[w] for w in row.tolist()), np.uint8)]
        rank = np.full((len(row), width), NONE, np.int32)  # of the pair that begins here
        rank[:, :-1] = self._ranks(symbol[:, :-1], symbol[:, 1:])
        while len(row):
            at = rank.argmin(axis=1)
            least = rank[np.arange(len(row)), at]
            over = least == NONE
            if over.any():
                for r in np.flatnonzero(over).tolist():
                    out[row[r]] = symbol[r, : size[r]].copy()
                stay = ~over
                symbol, rank, row, size, at, least = symbol[stay], rank[stay], row[stay], size[stay], at[stay], least[stay]
                if not len(row):
                    return
            here, width = np.arange(len(row)), int(size.max()) - 1
            source = np.arange(width) + (np.arange(width) > at[:, None])  # the right symbol of the pair goes
            symbol, rank = np.take_along_axis(symbol, source, 1), np.take_along_axis(rank, source, 1)
            size = size - 1
            symbol[here, at] = least
            rank[here, at] = self._ranks(symbol[here, at], np.where(at + 1 < size, symbol[here, np.minimum(at + 1, width - 1)], -1))
            some = at > 0
            before = at[some] - 1
            rank[here[some], before] = self._ranks(symbol[here[some], before], symbol[here[some], before + 1])

    def _long(self, word: bytes) -> np.ndarray:
        made, size, none = self.pairs.one_by_one(), self.size, (int(NONE), 0)

        def look_up(left: int, right: int) -> tuple[int, int]:
            return made.get(left * size + right, none)

        symbol = self.byte[np.frombuffer(word, np.uint8)]
        return np.array(merge_long(symbol.tolist(), self._ranks(symbol[:-1], symbol[1:]).tolist(), int(NONE), look_up), np.int32)

    def _learn(self, words: list[str]) -> None:
        raw = [w.encode() for w in words]
        whole = [self.token.get(r, -1) for r in raw]
        new = [r for r, i in zip(raw, whole) if i < 0]
        merged, times = self.merge(new)
        length = np.ones(len(words), np.int64)
        single = np.array(whole) >= 0
        length[~single] = times
        flat = np.empty(int(length.sum()), np.int32)
        of_single = np.repeat(single, length)
        flat[of_single], flat[~of_single] = np.array(whole, np.int32)[single], merged
        self.known.update(zip(words, range(len(self.length), len(self.length) + len(words))))
        self.at = np.r_[self.at, len(self.flat) + np.cumsum(length) - length]
        self.length, self.flat = np.r_[self.length, length], np.concatenate([self.flat, flat])
        self.held += sum(map(len, raw))

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the words in order, and how many each has."""
        if len(self.known) > REMEMBERED or self.held > REMEMBERED_BYTES:
            self.begin()
        if new := list(set(words).difference(self.known)):
            self._learn(new)
        index = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        length = self.length[index]
        to = np.cumsum(length)
        return self.flat[np.repeat(self.at[index] - to + length, length) + np.arange(to[-1] if len(to) else 0)], length

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts, and their offsets."""
        if len(texts) == 1 and len(texts[0] or "") > WORDS_AT_ONCE:  # one long text: some words at a time
            found, parts = (m.group() for m in self.pattern.finditer(texts[0])), []
            while words := list(islice(found, WORDS_AT_ONCE)):
                parts.append(self._ids(words)[0])
            ids = np.concatenate(parts)
            return ids, np.array([0, len(ids)])
        docs = [self.pattern.findall(t) if t else [] for t in texts]
        ids, length = self._ids(list(chain.from_iterable(docs)))
        to = np.r_[0, np.cumsum(length)]
        return ids, to[np.r_[0, np.cumsum([len(d) for d in docs], dtype=np.int64)]]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


@cache
def byte_pairs(path: str, pattern: str) -> BytePairs:
    return BytePairs(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>): the ids of every whole text."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_pairs(path, pattern)
        for part in slices(batches, "text"):
            ids, offsets = coder.encode(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, bytes) from (doc_id, ids)."""
    prepare(coded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_pairs(path, pattern)
        for part in batches:
            raw = [coder.decode(x.values.to_numpy().tolist() if x.is_valid else []) for x in part.column("ids")]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), pa.array(raw, pa.binary())], ["doc_id", "ids", "bytes"])

    return coded.select("doc_id", "ids").mapInArrow(run, f"doc_id {coded.schema['doc_id'].dataType.simpleString()}, ids array<int>, bytes binary")
