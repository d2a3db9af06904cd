"""Exact dedup by composable polynomial fingerprints.

A text is cut into chunks of bytes. Each chunk has a polynomial hash h = sum of (byte + 1) * base^i; two neighbouring pieces combine as
(h_a + h_b * base^len_a, len_a + len_b), so the parts of a huge document are hashed by different tasks, each shifted with the
length before it, and summed by an aggregate; the chunks inside a part are combined in the same way. Two bases modulo 2^31 - 1 and the length form the fingerprint.

Equal fingerprints only propose a group: every other member is compared with the member that has the smallest doc_id, chunk by chunk,
without bringing two whole texts into one task. Members that differ (a fingerprint collision) are grouped by their digest instead.

Nulls: a null text is an empty text; a row with a null doc_id takes part, but stays only if no row of its group has an id. Repeated
rows (same id and text): one of them is kept. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .text import bytes_of, fresh, prepare, slices

CHUNK = 4096  # bytes hashed as one piece
PART = COMPARED = 1 << 20  # bytes of a text that are hashed, and compared, as one row
COPIES = 4096  # equal rows that are given out as one run
PRIME = (1 << 31) - 1
BASES = (1_000_003, 998_244_353)
BLANKS = r"[\x20\x09-\x0D]+"


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(column), F.lit("")), BLANKS, " ")


def combine(left: tuple[int, int], right: tuple[int, int], base: int, prime: int = PRIME) -> tuple[int, int]:
    """(hash, length) of two pieces that follow each other."""
    return (left[0] + right[0] * pow(base, left[1], prime)) % prime, left[1] + right[1]


def _powers(base: int, n: int, prime: int) -> np.ndarray:
    out = np.ones(max(n, 1), np.uint64)
    width = 1
    while width < n:  # doubling: base^(i + width) = base^i * base^width
        upto = min(width, n - width)
        out[width : width + upto] = out[:upto] * np.uint64(pow(base, width, prime)) % np.uint64(prime)
        width *= 2
    return out


def fingerprints(data: np.ndarray, offsets: np.ndarray, base: int, prime: int = PRIME, chunk: int = CHUNK) -> np.ndarray:
    """Polynomial hash of every data[offsets[i]:offsets[i + 1]]."""
    out, size = np.zeros(len(offsets) - 1, np.int64), np.diff(offsets)
    pieces = -(-size // chunk)
    if not pieces.sum():
        return out
    first = np.cumsum(pieces) - pieces
    number = np.arange(pieces.sum()) - np.repeat(first, pieces)
    start = np.repeat(offsets[:-1], pieces) + number * chunk
    length = np.minimum(chunk, np.repeat(offsets[1:], pieces) - start)
    local = np.arange(len(data)) - np.repeat(start, length)
    p = np.uint64(prime)
    each = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * _powers(base, chunk, prime)[local], start) % p
    shift = _powers(pow(base, chunk, prime), int(pieces.max()), prime)[number]  # of the bytes before the chunk
    some = pieces > 0
    out[some] = (np.add.reduceat(each * shift % p, first[some]) % p).astype(np.int64)
    return out


def fingerprinted(docs: DataFrame, prime: int = PRIME) -> DataFrame:
    """(doc_id, text_sha256, fp1, fp2, n_bytes, repeated): a row for each distinct (doc_id, text); repeated counts its rows.

    A text longer than PART bytes is cut into rows of its own, which are hashed by any task; each part's hash is shifted by the bytes
    before it, so the text's fingerprint is the sum of its parts' hashes.
    """
    prepare(docs.sparkSession)
    text = docs.select("doc_id", normalised().alias("text"))
    raw = F.encode("text", "UTF-8")
    text = text.select("doc_id", F.sha2("text", 256).alias("text_sha256"), raw.alias("bytes"), F.length(raw).alias("size"))
    last = F.greatest(F.lit(0), F.ceil(F.col("size") / PART) - 1).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(F.col("bytes"), i * PART + 1, F.lit(PART)))
    short, long = text.where(F.col("size") <= PART), text.where(F.col("size") > PART)
    long = long.select("doc_id", "text_sha256", F.posexplode(pieces).alias("part", "bytes")).repartition("doc_id", "text_sha256", "part")
    parts = short.select("doc_id", "text_sha256", F.lit(0).alias("part"), "bytes").unionByName(long)

    def run(batches):
        for part in slices(batches, "bytes"):
            data, offsets = bytes_of(part.column("bytes"))
            number = part.column("part").to_numpy()
            both = []
            for base in BASES:
                shift = np.array([pow(base, int(n) * PART, prime) for n in number], np.uint64) if number.any() else np.uint64(1)
                both.append(pa.array((fingerprints(data, offsets, base, prime).astype(np.uint64) * shift % np.uint64(prime)).astype(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_sha256"), part.column("part"), *both, pa.array(np.diff(offsets))],
                ["doc_id", "text_sha256", "part", "fp1", "fp2", "n_bytes"],
            )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_sha256 string, part int, fp1 bigint, fp2 bigint, n_bytes bigint"
    hashed = parts.mapInArrow(run, schema)
    # Parts of repeated rows are equal; they are counted first, so each part of a text is summed once.
    first = F.when(F.col("part") == 0, F.lit(1))
    once = hashed.groupBy("doc_id", "text_sha256", "part").agg(F.max("fp1").alias("fp1"), F.max("fp2").alias("fp2"), F.max("n_bytes").alias("n_bytes"), F.count(first).alias("repeated"))
    total = [(F.sum(c) % prime).alias(c) for c in ("fp1", "fp2")]
    return once.groupBy("doc_id", "text_sha256").agg(*total, F.sum("n_bytes").alias("n_bytes"), F.sum("repeated").alias("repeated"))


FP = ["fp1", "fp2", "n_bytes"]


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & left[c].eqNullSafe(right[c])
    return out


def groups(docs: DataFrame, prime: int = PRIME) -> DataFrame:
    """(doc_id, text_sha256, repeated, keep_id, group_size): a row for each distinct (doc_id, text); repeated counts its rows."""
    rows = stage(fingerprinted(docs, prime), "exact-rows")
    # The member to compare with has the smallest doc_id; of texts that share this id, that with the smallest digest.
    shared = (
        rows.groupBy(*FP)
        .agg(F.count(F.lit(1)).alias("members"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_sha256")).alias("first"))
        .where("members > 1")
        .select(*[F.col(c).alias(f"_{c}") for c in FP], F.col("first.doc_id").alias("first_id"), F.col("first.text_sha256").alias("first_sha"))
    )
    on = (F.col("fp1") == F.col("_fp1")) & (F.col("fp2") == F.col("_fp2")) & (F.col("n_bytes") == F.col("_n_bytes"))
    proposed = rows.join(shared, on).select("doc_id", "text_sha256", *FP, "first_id", "first_sha")
    proposed = stage(proposed.withColumn("is_first", F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_sha256") == F.col("first_sha"))), "exact-proposed")
    equal = _compared(docs, proposed)
    # Proved equal to the first: one class for the fingerprint. Else the digest separates.
    proved = equal.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    classed = rows.join(proved, rows["doc_id"].eqNullSafe(F.col("_id")) & (rows["text_sha256"] == F.col("_sha")), "left").withColumn(
        "class", F.when(F.col("_sha").isNotNull(), F.lit("")).otherwise(F.col("text_sha256"))
    ).drop("_id", "_sha")
    classed = stage(classed, "exact-classes")
    sizes = classed.groupBy(*FP, "class").agg(F.min("doc_id").alias("keep_id"), F.sum("repeated").alias("group_size"))
    return classed.join(sizes, [*FP, "class"]).select("doc_id", "text_sha256", "repeated", "keep_id", "group_size")


def _compared(docs: DataFrame, proposed: DataFrame) -> DataFrame:
    """Members (doc_id, text_sha256) of proposed groups whose text equals the first member's, the first included."""
    text = docs.select(F.col("doc_id").alias("_id"), normalised().alias("text"))
    text = text.select("_id", F.sha2("text", 256).alias("_sha"), F.encode("text", "UTF-8").alias("bytes"))
    wanted = proposed.select("doc_id", "text_sha256", *FP, "first_sha", "is_first")
    held = text.join(wanted, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_sha") == F.col("text_sha256")))
    last = F.greatest(F.lit(0), F.ceil(F.length("bytes") / COMPARED) - 1).cast("int")
    chunks = held.select(
        "doc_id", "text_sha256", *FP, "first_sha", "is_first", F.posexplode(F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(F.col("bytes"), i * COMPARED + 1, F.lit(COMPARED)))).alias("number", "chunk")
    )
    first = chunks.where("is_first").dropDuplicates([*FP, "number"]).select(*[F.col(c).alias(f"_{c}") for c in FP], F.col("number").alias("_number"), F.col("chunk").alias("_chunk"))
    on = (
        (F.col("fp1") == F.col("_fp1")) & (F.col("fp2") == F.col("_fp2")) & (F.col("n_bytes") == F.col("_n_bytes"))
        & (F.col("number") == F.col("_number"))
    )
    pairs = chunks.join(first, on).select("doc_id", "text_sha256", (F.col("chunk") == F.col("_chunk")).alias("same"))
    return pairs.groupBy("doc_id", "text_sha256").agg(F.min(F.col("same").cast("int")).alias("same")).where("same = 1")


def dedup(docs: DataFrame, prime: int = PRIME) -> DataFrame:
    """A row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256."""
    found = groups(docs, prime)
    # A row that is there very often is first cut into runs of COPIES, which are dealt out, and each run into its rows.
    run = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("repeated") - 1) / COPIES))).alias("run")
    few = found.where(F.col("repeated") <= COPIES).select("*", F.lit(0).cast("bigint").alias("run"))
    many = found.where(F.col("repeated") > COPIES).select("*", run).repartition("doc_id", "text_sha256", "run")
    upto = F.least(F.lit(COPIES), F.col("repeated") - F.col("run") * COPIES).cast("int")
    every = few.unionByName(many).withColumn("copy", F.explode(F.sequence(F.lit(1), upto)))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1) & (F.col("run") == 0)
    return every.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def keep_first(docs: DataFrame) -> DataFrame:
    """Rows of docs without the later copies; all columns stay."""
    kept = groups(docs).where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    digest = fresh(docs, "digest")
    marked = docs.withColumn(digest, F.sha2(normalised(), 256))
    stay = marked.join(kept, marked["doc_id"].eqNullSafe(kept["_id"]) & (marked[digest] == kept["_sha"]), "left_semi")
    return stay.dropDuplicates(["doc_id", digest]).select(*[stay[c] for c in docs.columns])
