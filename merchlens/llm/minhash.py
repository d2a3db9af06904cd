"""Near-duplicates: universal hash minima with banding, signature check, exact check on full sets, star components.

A document's set are its distinct shingles (`words` consecutive lower-cased words). Every shingle has a 64-bit hash; 200 universal hash
functions a * x + b over it give 200 minima, cut into 40 bands of 5. A pair at the threshold 0.8 shares no band with probability 1.3e-7.

Documents with equal sets form a class, represented by its smallest id, so copies never meet in a bucket. Classes are numbered in the order
of these ids and of their fingerprints; components join the numbers, as two texts of one id may belong to different classes. In a bucket (one value of one
band) no pairs of all members are made:
1. Every member is paired with the bucket's smallest id. Pairs whose signatures allow the threshold are checked on the full sets; the
   links give components.
2. Where a bucket still holds several components, its members are dealt to blocks of bounded size, and members outside the
   bucket's largest component meet every block. Members with a partner of another component whose signature allows the threshold, in the
   first band that both share, stay; these get their sets, and the pairs are checked on the full sets in the same blocks. Only links that join
   two components come out. So no link that matters is lost, whatever the bucket's size, and no pairs are written.
The signature check keeps pairs whose agreement is at least 0.66, five standard deviations below the threshold.

Nulls: a null text has no words. Documents without words are linked with nothing. A row without doc_id is linked with nothing and kept. Rows that share a
doc_id but not a text are each judged by their own text. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import number_rows
from ..session import stage
from .components import components
from .text import mix, perhaps, prepare, rolling, slices, text_key, words_of

ROWS, BANDS = 5, 40
HASHES = ROWS * BANDS
LIKELY = 0.66  # least agreement of signatures that goes to the exact check
BLOCK, BLOCK_BYTES = 4096, 16 << 20  # members of a bucket, and bytes of their sets, that are compared at once
_RULE = np.random.default_rng(97)
_A = (_RULE.integers(0, 1 << 31, HASHES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _RULE.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def shingle_sets(column: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; a shorter text is one shingle, an empty one none."""
    w = words_of(column, lower=True)
    every = rolling(w.hash, words, 0x2545F4914F6CDD1D)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        n = b - a
        if n >= words:
            out.append(np.unique(every[a : b - words + 1]))
        elif n:
            out.append(mix(rolling(w.hash[a:b], n, 0x2545F4914F6CDD1D) + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), 4096):
        np.minimum(out, (x[at : at + 4096, None] * _A + _B).min(axis=0), out=out)
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of a 2-d array as binary values."""
    width = rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer((np.arange(len(rows) + 1) * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(rows))])


def signed(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, fp1, fp2, sketch, bands): set size, set fingerprint, low bytes of the minima, a hash of every band."""
    prepare(docs.sparkSession)

    def run(batches):
        number = np.arange(1, BANDS + 1, dtype=np.uint64)
        for part in slices(batches, "text"):
            sets = shingle_sets(part.column("text"), words)
            sig = np.array([signature(s) for s in sets], np.uint32).reshape(len(sets), HASHES)
            band = np.broadcast_to(number, (len(sets), BANDS)).copy()
            for r in range(ROWS):
                band = mix(band * np.uint64(0x9E3779B97F4A7C15) + sig[:, r::ROWS].astype(np.uint64))
            size = np.array([len(s) for s in sets], np.int64)
            prints = [np.array([f(s) for s in sets], np.uint64).view(np.int64) for f in (lambda s: s.sum(dtype=np.uint64), lambda s: mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))]
            bands = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()), pa.array(band.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), pa.array(size), pa.array(prints[0]), pa.array(prints[1]), _binary((sig & np.uint32(255)).astype(np.uint8)), bands],
                ["doc_id", "text_key", "n_shingles", "fp1", "fp2", "sketch", "bands"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_key().alias("text_key"), "text").mapInArrow(run, f"doc_id {kind}, text_key bigint, n_shingles bigint, fp1 bigint, fp2 bigint, sketch binary, bands array<bigint>")


def _full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(id, shingles binary) of the wanted classes (id, doc_id, text_key)."""
    def run(batches):
        for part in slices(batches, "text"):
            sets = shingle_sets(part.column("text"), words)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "shingles"])

    keyed = docs.select("doc_id", text_key().alias("text_key"), "text")
    texts = perhaps(keyed, wanted, "doc_id", "text_key").join(wanted, ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"]).select("id", "text")
    return texts.mapInArrow(run, "id bigint, shingles binary")


def _sketches(column: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(x.as_buffer(), np.uint8) for x in column]).reshape(len(column), HASHES)


def _likely(pairs: DataFrame, sketches: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) whose set sizes and signatures allow the threshold."""
    left = sketches.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = sketches.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    sized = pairs.join(right, "b").join(left, "a").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * threshold)

    def run(batches):
        for part in batches:
            if part.num_rows:
                agree = (_sketches(part.column("sa")) == _sketches(part.column("sb"))).mean(axis=1)
                yield part.select(["a", "b"]).filter(pa.array(agree >= LIKELY))

    kind = pairs.schema["a"].dataType.simpleString()
    return sized.select("a", "b", "sa", "sb").mapInArrow(run, f"a {kind}, b {kind}")


def _linked(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) that reach the threshold on their full sets."""
    def run(batches):
        for part in batches:
            keep = []
            for a, b in zip(part.column("sa"), part.column("sb")):
                x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                keep.append(100 * common >= threshold * (len(x) + len(y) - common))
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    both = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b").join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
    return both.select("a", "b", "sa", "sb").mapInArrow(run, f"a {kind}, b {kind}")


def _root(parent: dict, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _crossing(buckets: DataFrame, sketches: DataFrame, sets: DataFrame, comps: DataFrame, threshold: int) -> DataFrame:
    """Links (a, b) between different components, found in the buckets; as many as join them, not all."""
    sized = sketches.select("id", F.col("n").alias("size"))
    member = buckets.join(comps.select(F.col("node").alias("id"), "component"), "id", "left").join(sized, "id").withColumn("component", F.coalesce("component", "id"))
    parts = member.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("size") * 8).alias("bytes"))

    def blocks(n, size):
        return F.greatest(F.ceil(n / BLOCK), F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("int")

    mixed = (
        parts.groupBy("bucket")
        .agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "component", "bytes")).alias("largest"))
        .where("parts > 1 and n > 2")  # two members have met in the first step
        .select("bucket", F.col("largest.component").alias("main"), blocks(F.col("n"), F.col("bytes")).alias("blocks"), blocks(F.col("n") - F.col("largest.n"), F.col("bytes") - F.col("largest.bytes")).alias("minor_blocks"))
    )
    sided = member.join(mixed, "bucket").withColumn("minor", F.col("component") != F.col("main")).withColumn("single", F.expr("blocks = 1 and minor_blocks = 1"))
    spot = F.xxhash64("id")
    home = sided.withColumn("j", F.pmod(spot, F.col("blocks")).cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("minor_blocks") - 1))).withColumn("asks", F.lit(False))
    asking = sided.where("minor").withColumn("i", F.pmod(spot, F.col("minor_blocks")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("asks", F.lit(True))
    columns = ["bucket", "i", "j", "single", "asks", "id", "component"]
    # In a bucket of a single block one row does for both sides.
    dealt = home.withColumn("asks", F.col("single") & F.col("minor")).select(*columns).unionByName(asking.where("not single").select(*columns))
    sketched = dealt.join(sketches.select("id", F.col("n").alias("size"), "sketch", "bands"), "id")
    likely = stage(sketched.groupBy("bucket", "i", "j").applyInArrow(_marked(threshold), sketched.schema), "minhash-likely")

    def run(table: pa.Table) -> pa.Table:
        block = _Block(table, threshold)
        ids, component = table.column("id").to_pylist(), table.column("component").to_pylist()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles")]
        size = block.size
        parent = {c: c for c in component}
        root = np.array(component)
        a, b = [], []
        for at in block.here.tolist():
            own = _root(parent, component[at])
            differ = block.likely(at, block.there[root[block.there] != own])
            for low in range(0, len(differ), 256):
                some = differ[low : low + 256]
                pool = np.concatenate([sets[x] for x in some])
                spot = np.minimum(np.searchsorted(sets[at], pool), size[at] - 1)
                common = np.add.reduceat((sets[at][spot] == pool).astype(np.int64), np.cumsum(size[some]) - size[some])
                for x in some[100 * common >= threshold * (size[some] + size[at] - common)].tolist():
                    p, q = _root(parent, component[at]), _root(parent, component[x])
                    if p != q:
                        parent[max(p, q)] = min(p, q)
                        root = np.where(root == max(p, q), min(p, q), root)
                        a.append(min(ids[at], ids[x]))
                        b.append(max(ids[at], ids[x]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    wanted = sets.join(likely.select("id").distinct(), "id", "left_semi")
    return likely.join(wanted, "id").groupBy("bucket", "i", "j").applyInArrow(run, "a bigint, b bigint").distinct()


class _Block:
    """The members of a block that ask (here) and that are asked (there), with what their signatures allow."""

    def __init__(self, table: pa.Table, threshold: int) -> None:
        asks = table.column("asks").to_numpy()
        self.here = np.flatnonzero(asks)
        self.there = np.arange(len(asks)) if table.column("single")[0].as_py() else np.flatnonzero(~asks)
        self.sketch = _sketches(table.column("sketch"))
        self.band = np.array([np.asarray(x.values) for x in table.column("bands")]).reshape(len(asks), BANDS)
        self.bucket, self.size, self.threshold = table.column("bucket")[0].as_py(), table.column("size").to_numpy(), threshold

    def likely(self, at: int, others: np.ndarray) -> np.ndarray:
        """Those that the sizes and signatures allow, in the first band that both share, and nowhere else."""
        small, large = np.minimum(self.size[others], self.size[at]), np.maximum(self.size[others], self.size[at])
        others = others[100 * small >= self.threshold * large]
        others = others[(self.sketch[others] == self.sketch[at]).mean(axis=1) >= LIKELY]
        shared = self.band[others] == self.band[at]
        return others[self.band[at][shared.argmax(axis=1)] == self.bucket]


def _marked(threshold: int):
    """The members of a block that have a likely partner of another component there; only these need their sets."""
    def run(table: pa.Table) -> pa.Table:
        block, component = _Block(table, threshold), table.column("component").to_numpy()
        keep = np.zeros(table.num_rows, bool)
        for at in block.here.tolist():
            found = block.likely(at, block.there[component[block.there] != component[at]])
            if len(found):
                keep[at] = keep[found] = True
        return table.filter(pa.array(keep))

    return run


def near_duplicates(docs: DataFrame, words: int = 5, threshold: int = 80) -> DataFrame:
    """A row for each row of docs: doc_id, n_shingles, component_id, kept. threshold: least similarity in percent."""
    return judged(docs, words, threshold).drop("text_key")


def judged(docs: DataFrame, words: int = 5, threshold: int = 80) -> DataFrame:
    """near_duplicates() with text_key, which tells apart rows that share a doc_id."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    prints = stage(signed(docs, words), "minhash")
    of_set = ["n_shingles", "fp1", "fp2"]
    named = prints.where("n_shingles > 0 and doc_id is not null").groupBy(*of_set).agg(F.min(F.struct("doc_id", "text_key")).alias("first")).select(*of_set, "first.doc_id", "first.text_key")
    classes = stage(number_rows(named, ["doc_id", *of_set], "id").withColumn("id", F.col("id").cast("bigint")), "minhash-classes")
    chosen = prints.join(classes.select("id", "doc_id", "text_key"), ["doc_id", "text_key"])
    members = chosen.select("id", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first <> last").select("bucket", "first")
    buckets = stage(members.join(shared, "bucket").distinct(), "minhash-buckets")  # a row may be there twice
    ids = stage(classes.select("id", "doc_id", "text_key").join(buckets.select("id").distinct(), "id", "left_semi"), "minhash-ids")
    met = perhaps(prints, ids, "doc_id", "text_key").join(ids, ["doc_id", "text_key"])
    sketches = stage(met.select("id", F.col("n_shingles").alias("n"), "sketch", "bands").dropDuplicates(["id"]), "minhash-sketches")
    sets = stage(_full_sets(docs, ids, words), "minhash-sets")
    pairs = buckets.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    links = stage(_linked(_likely(pairs, sketches, threshold), sets, threshold), "minhash-links")
    comps = components(links)
    found = stage(_crossing(buckets.select("bucket", "id"), sketches, sets, comps, threshold), "minhash-crossing")
    if not found.isEmpty():
        comps = components(links.union(found))
    placed = classes.join(comps, F.col("id") == F.col("node"), "left").select(*of_set, "id", F.coalesce("component", "id").alias("component"))
    heads = classes.select(F.col("id").alias("component"), F.col("doc_id").alias("component_id"))
    of_class = placed.join(heads, "component").select(*of_set, "component_id", (F.col("id") == F.col("component")).alias("first"))
    own = prints.select("doc_id", "text_key", *of_set).join(of_class, of_set, "left")
    out = own.select("doc_id", "text_key", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"), "first")
    return out.withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")) & F.coalesce("first", F.lit(True))).drop("first")
