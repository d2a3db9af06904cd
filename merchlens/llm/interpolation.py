"""Language-model scores by deleted interpolation of bigram, unigram and uniform estimates.

P(w | h) = a * c(h, w) / c(h) + b * c(w) / N + c / (V + 1), where (a, b, c) depend on the bucket of c(h), by powers of two. The counts come
from all training documents. The weights come from expectation-maximisation on held-out counts: the training documents with
`HELD` as remainder are scored with their own counts deleted, and what EM needs of their tokens is gathered in a table of bounded size (bucket
x ratio of the bigram estimate x ratio of the unigram estimate).

How counts get to the texts: documents are packed into blocks of a few MB. A block asks for each of its distinct words and word pairs once:
it sends their sorted hashes with its own training counts, in compressed messages, to those partitions of the hash range that hold any of
them. So it sends at most as many messages as it has distinct words and pairs, however many partitions there are, and the messages grow
with the corpus, not with its square. A partition adds up the counts of all blocks and answers every block in the order of its question:
a frequent word costs one entry for each block, and no key is larger than the number of blocks. Words have 64-bit hashes, pairs 56-bit ones.

A document's tokens are its words, A-Z lower-cased, then one end; the first token's context is the beginning, which has as many
occurrences as there are ends. Nulls: a null text is empty and has the end only. A row with a null doc_id is scored and never
learned from. Without any training documents all estimates but the uniform one are 0. Extra columns are not read.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .text import mix, prepare, slices, words_of

BLOCK_BYTES = 4 << 20
PER_PARTITION = 1_500_000  # tokens for each partition of the hash range
HELD = 3  # remainder of the training documents that the weights are learned from
BUCKETS, BINS = 64, 96  # context frequencies by powers of two, up to the largest 64-bit count; ratios by half powers of two, bin 0: the estimate is 0
_END, _BEGIN = np.uint64(0x6A09E667F3BCC909), np.uint64(0xBB67AE8584CAA73B)
_CODEC = "zstd"


def remainder(column: str = "doc_id") -> Column:
    """crc32 of the id as text modulo 7; 2 (never learned from) where there is no id."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 7, F.lit(2)).cast("int")


def blocks(docs: DataFrame) -> DataFrame:
    """(block, held, n_tokens, doc_id list, part list, size list, blob): documents packed by the task that reads them."""
    prepare(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType

    def run(batches):
        codec = pa.Codec(_CODEC, compression_level=3)
        held: dict[bool, list] = {True: [], False: []}
        weight = {True: 0, False: 0}

        def send(flag: bool):
            rows = held[flag]
            blob = b"".join(t for _, _, t in rows)
            tokens = sum(len(t.split()) + 1 for _, _, t in rows)
            number = int.from_bytes(os.urandom(8), "little") >> 1
            columns = [[number], [flag], [tokens], [[i for i, _, _ in rows]], [[r for _, r, _ in rows]], [[len(t) for _, _, t in rows]], [codec.compress(blob).to_pybytes() if blob else b""]]
            held[flag], weight[flag] = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema.names)

        schema = pa.schema([("block", pa.int64()), ("held", pa.bool_()), ("n_tokens", pa.int64()), ("doc_id", pa.list_(id_type)), ("part", pa.list_(pa.int32())), ("size", pa.list_(pa.int64())), ("blob", pa.binary())])
        for part in slices(batches, "text"):
            for i, r, t in zip(part.column("doc_id").to_pylist(), part.column("part").to_pylist(), part.column("text").to_pylist()):
                flag, raw = r == HELD, (t or "").encode()
                if weight[flag] and weight[flag] + len(raw) > BLOCK_BYTES:
                    yield send(flag)
                held[flag].append((i, r, raw))
                weight[flag] += len(raw) + 64
        for flag in (True, False):
            if held[flag]:
                yield send(flag)

    id_type = pa.int64() if kind.typeName() == "long" else pa.int32() if kind.typeName() == "integer" else pa.string()
    columns = f"block bigint, held boolean, n_tokens bigint, doc_id array<{kind.simpleString()}>, part array<int>, size array<bigint>, blob binary"
    return docs.select("doc_id", remainder().alias("part"), "text").mapInArrow(run, columns)


@dataclass
class Tokens:
    """Tokens of a block: document, number among its distinct words, of its distinct pairs, of the context (-1: the beginning)."""

    doc: np.ndarray
    words: np.ndarray  # sorted hashes
    word: np.ndarray
    context: np.ndarray
    pairs: np.ndarray  # sorted hashes
    pair: np.ndarray
    end: int  # number of the end among words


def tokens_of(size: np.ndarray, blob: bytes) -> Tokens:
    raw = pa.Codec(_CODEC).decompress(blob, int(size.sum())) if size.sum() else pa.py_buffer(b"")
    text = pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(np.r_[0, np.cumsum(size)].astype(np.int64)), raw])
    w = words_of(text, lower=True)
    count = np.diff(w.first) + 1
    last = np.cumsum(count) - 1
    hashes = np.empty(count.sum(), np.uint64)
    inner = np.ones(len(hashes), bool)
    inner[last] = False
    hashes[inner], hashes[last] = w.hash, _END
    before = np.r_[_BEGIN, hashes[:-1]].astype(np.uint64)
    before[last[:-1] + 1] = _BEGIN
    words, word = np.unique(hashes, return_inverse=True)
    pairs, pair = np.unique(mix(before * np.uint64(0x9E3779B97F4A7C15) + hashes) >> np.uint64(8), return_inverse=True)
    context = np.r_[-1, word[:-1]]
    context[last[:-1] + 1] = -1
    return Tokens(np.repeat(np.arange(len(size)), count), words, word, context, pairs, pair, int(np.searchsorted(words, _END)))


def _pack(values: np.ndarray) -> bytes:
    """Non-negative integers, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T)
    return pa.Codec(_CODEC, compression_level=1).compress(planes.tobytes()).to_pybytes() if len(values) else b""


def _unpack(blob: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(pa.Codec(_CODEC).decompress(blob, n * 8), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()


def _cells(sorted_hashes: np.ndarray, bits: int, log_parts: int) -> np.ndarray:
    """Number of the partition of each hash."""
    return (sorted_hashes >> np.uint64(bits)).astype(np.int64) if log_parts else np.zeros(len(sorted_hashes), np.int64)


def questions(packed: DataFrame, log_parts: int) -> DataFrame:
    """(part, block, and for words and pairs: n, sorted hashes, training counts), for the parts that hold some of the block's hashes."""
    def run(batches):
        for batch in batches:
            for row in (batch.slice(at, 1).to_pylist()[0] for at in range(batch.num_rows)):
                size, remains = np.array(row["size"], np.int64), np.array(row["part"])
                t = tokens_of(size, row["blob"])
                learned = remains[t.doc] != 2
                cells = {"w": _cells(t.words, 64 - log_parts, log_parts), "p": _cells(t.pairs, 56 - log_parts, log_parts)}
                parts = np.union1d(cells["w"], cells["p"])
                out = {"part": parts, "block": np.full(len(parts), row["block"])}
                for name, hashes, number in (("w", t.words, t.word), ("p", t.pairs, t.pair)):
                    count = np.bincount(number[learned], minlength=len(hashes))
                    cut = np.r_[np.searchsorted(cells[name], parts), len(hashes)]
                    out[f"n{name}"] = np.diff(cut)
                    out[f"h{name}"] = [_pack(np.diff(hashes[a:b], prepend=np.uint64(0))) for a, b in zip(cut[:-1], cut[1:])]
                    out[f"c{name}"] = [_pack(count[a:b]) for a, b in zip(cut[:-1], cut[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(out[c]) for c in ("part", "block", "nw", "hw", "cw", "np", "hp", "cp")], ["part", "block", "nw", "hw", "cw", "np", "hp", "cp"])

    return packed.select("block", "part", "size", "blob").mapInArrow(run, "part bigint, block bigint, nw bigint, hw binary, cw binary, np bigint, hp binary, cp binary")


def answers(asked: DataFrame) -> DataFrame:
    """(part, block, nw, tw, np, tp): the totals in the order of each block's question; a row with a null block holds V and N as nw and np."""
    def run(table: pa.Table) -> pa.Table:
        out = {"tw": [], "tp": []}
        sizes = [0, 0]
        for name in ("w", "p"):
            n = table.column(f"n{name}").to_numpy()
            hashes = np.concatenate([np.cumsum(_unpack(x.as_py(), k), dtype=np.uint64) for x, k in zip(table.column(f"h{name}"), n)])
            counts = np.concatenate([_unpack(x.as_py(), k) for x, k in zip(table.column(f"c{name}"), n)]).astype(np.int64)
            every, number = np.unique(hashes, return_inverse=True)
            total = np.zeros(len(every), np.int64)
            np.add.at(total, number, counts)
            cut = np.r_[0, np.cumsum(n)]
            out[f"t{name}"] = [_pack(total[number[a:b]]) for a, b in zip(cut[:-1], cut[1:])]
            if name == "w":
                sizes = [int((total > 0).sum()), int(total.sum())]
        part = table.column("part")[0].as_py()
        rows = table.num_rows
        return pa.table({
            "part": pa.array([part] * (rows + 1), pa.int64()), "block": pa.array(table.column("block").to_pylist() + [None], pa.int64()),
            "nw": pa.array(table.column("nw").to_pylist() + [sizes[0]], pa.int64()), "tw": pa.array(out["tw"] + [b""], pa.binary()),
            "np": pa.array(table.column("np").to_pylist() + [sizes[1]], pa.int64()), "tp": pa.array(out["tp"] + [b""], pa.binary()),
        })

    return asked.groupBy("part").applyInArrow(run, "part bigint, block bigint, nw bigint, tw binary, np bigint, tp binary")


def _totals(row: dict) -> tuple[np.ndarray, np.ndarray]:
    got = sorted(row["answers"], key=lambda a: a["part"])
    return tuple(np.concatenate([_unpack(a[t], a[n]) for a in got]).astype(np.int64) for n, t in (("nw", "tw"), ("np", "tp")))  # type: ignore[return-value]


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.where(context > 0, np.minimum(1 + np.log2(np.maximum(context, 1)).astype(np.int64), BUCKETS - 1), 0)


def _bin(ratio: np.ndarray) -> np.ndarray:
    """0 for 0, else by half powers of two around 2^-16."""
    with np.errstate(divide="ignore"):
        level = np.rint(2 * np.log2(ratio)) + 33
    return np.where(ratio > 0, np.clip(level, 1, BINS - 1), 0).astype(np.int64)


def bin_value(level: np.ndarray) -> np.ndarray:
    return np.where(level > 0, 2.0 ** ((level - 33) / 2), 0.0)


def held_out_table(joined: DataFrame, types: int, total: int) -> DataFrame:
    """(bucket, pair, word, n): tokens of the held-out documents by context bucket and ratios to the uniform estimate, own counts deleted."""
    def run(batches):
        table = np.zeros(BUCKETS * BINS * BINS, np.int64)
        for batch in batches:
            for row in (batch.slice(at, 1).to_pylist()[0] for at in range(batch.num_rows)):
                t = tokens_of(np.array(row["size"], np.int64), row["blob"])
                words, pairs = _totals(row)

                def own(number: np.ndarray, n: int) -> np.ndarray:
                    _, at, count = np.unique(t.doc * n + number, return_inverse=True, return_counts=True)
                    return count[at]

                context = np.where(t.context < 0, t.end, t.context)
                lookup = t.doc * len(words) + context
                keys, count = np.unique(t.doc * len(words) + t.word, return_counts=True)
                spot = np.minimum(np.searchsorted(keys, lookup), len(keys) - 1)
                of_context = words[context] - np.where(keys[spot] == lookup, count[spot], 0)
                of_pair, of_word = pairs[t.pair] - own(t.pair, len(pairs)), words[t.word] - own(t.word, len(words))
                length = np.bincount(t.doc)[t.doc]
                second = np.where(of_context > 0, of_pair / np.maximum(of_context, 1), 0) * (types + 1)
                first = of_word / np.maximum(total - length, 1) * (types + 1)
                table += np.bincount((_bucket(of_context) * BINS + _bin(second)) * BINS + _bin(first), minlength=len(table))
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at // (BINS * BINS), at // BINS % BINS, at % BINS, table[at])], ["bucket", "pair", "word", "n"])

    rows = joined.mapInArrow(run, "bucket bigint, pair bigint, word bigint, n bigint")
    return rows.groupBy("bucket", "pair", "word").agg(F.sum("n").alias("n"))


def weigh(table: np.ndarray, rounds: int = 60) -> np.ndarray:
    """EM on rows (bucket, pair, word, n): weights (bigram, unigram, uniform) of every bucket; the uniform one never reaches 0."""
    out = np.tile([0.0, 0.5, 0.5], (BUCKETS, 1))
    out[1:] = 1 / 3
    for b in range(BUCKETS):
        own = table[table[:, 0] == b]
        if not len(own):
            continue
        n = own[:, 3].astype(float)
        p = np.stack([bin_value(own[:, 1]), bin_value(own[:, 2]), np.ones(len(own))], axis=1)
        if b == 0:
            p[:, 0] = 0
        for _ in range(rounds):
            share = p * out[b]
            share /= share.sum(axis=1, keepdims=True)
            out[b] = (n[:, None] * share).sum(axis=0) / n.sum()
            out[b] = np.maximum(out[b], [0, 0, 1e-6])
            out[b] /= out[b].sum()
    # A bucket without held-out tokens takes the weights of the next smaller one that has some.
    seen = {int(b) for b in table[:, 0]}
    for b in range(2, BUCKETS):
        if b not in seen:
            out[b] = out[b - 1]
    return out


def score(docs: DataFrame) -> DataFrame:
    """A row for each row of docs: doc_id, part (the remainder), n_tokens, n_known, train_tokens, base_score, score."""
    packed = stage(blocks(docs), "lm-blocks")
    total_tokens = packed.agg(F.sum("n_tokens")).first()[0] or 0
    log_parts = max(3, int(-(-total_tokens // PER_PARTITION)).bit_length())
    replied = stage(answers(questions(packed, log_parts)), "lm-answers")
    sizes = replied.where("block is null").agg(F.sum("nw"), F.sum("np")).first()
    types, total = int(sizes[0] or 0), int(sizes[1] or 0)
    by_block = replied.where("block is not null").groupBy(F.col("block").alias("_block")).agg(F.collect_list(F.struct("part", "nw", "tw", "np", "tp")).alias("answers"))  # of the block's own size

    def joined(which: DataFrame, *columns: str) -> DataFrame:
        return which.join(by_block, F.col("block") == F.col("_block")).select(*columns, "size", "blob", "answers")

    rows = held_out_table(joined(packed.where("held")), types, total).collect()  # at most BUCKETS * BINS * BINS
    weights = weigh(np.array([tuple(r) for r in rows], np.int64).reshape(-1, 4))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                part = batch.slice(at, 1)
                row = part.select(["size", "blob", "answers"]).to_pylist()[0]
                t = tokens_of(np.array(row["size"], np.int64), row["blob"])
                words, pairs = _totals(row)
                context = words[np.where(t.context < 0, t.end, t.context)]
                own = words[t.word]
                mixed = weights[_bucket(context)]
                second = np.where(context > 0, pairs[t.pair] / np.maximum(context, 1), 0)
                p = mixed[:, 0] * second + mixed[:, 1] * (own / max(total, 1)) + mixed[:, 2] / (types + 1)
                base = np.log10((own + 1) / (total + types + 1))
                n = len(row["size"])

                def add(x: np.ndarray) -> np.ndarray:
                    return np.bincount(t.doc, weights=x, minlength=n)

                ids, remains = part.column("doc_id")[0].values, part.column("part")[0].values
                yield pa.RecordBatch.from_arrays(
                    [ids, remains, pa.array(np.bincount(t.doc, minlength=n)), pa.array(add(own > 0).astype(np.int64)), pa.array(np.full(n, total)), pa.array(add(base)), pa.array(add(np.log10(p)))],
                    ["doc_id", "part", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return joined(packed, "doc_id", "part").mapInArrow(run, f"doc_id {kind}, part int, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
