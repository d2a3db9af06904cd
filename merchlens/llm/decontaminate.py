"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

A text becomes lower-cased tokens of letters and digits. A mask is laid over every position of both sides; the tokens under its ones
are hashed, those under its zeros are ignored, so a substituted token is harmless where some mask skips it. Equal hashes are hits. A hit
aligns a document with an item; hits of one alignment (document, item, shift) are put together on the map side. Every alignment is then
compared once, token by token over the whole item, and the window of `window` tokens of the item (the whole item if it is shorter) with
the most equal tokens is found by a running sum; it is a leak if at least `identity` percent of it agree.

Every way to replace a fifth of 11 to 20 tokens leaves a place for one of the masks (tests/llm tries all), so at the default window and
identity the result is that of comparing all windows of all alignments. Items of SHORT to 10 tokens are found where all their tokens
stand in a row (a mask of ones, only on lengths that occur); of fewer tokens, by no document: they would reject common phrases.

The scan of the corpus has no shuffle before its hits and carries numbers only: the benchmark's seeds are broadcast, in slices of at most
SEEDS_PER_SLICE seeds, as many slices as the benchmark needs. Alignments are written, so the documents' tokens are fetched by a join whose side
is broadcast only if the written table is small, and else shuffled.

Nulls: a null text (of a document or an item) has no tokens; items without an id are found by no document. Rows without a doc_id are
searched like others, each row by its own text. `leaks` takes rows that share a doc_id as one document: each (doc_id, item_id) once, in
the best of its texts. `clean` judges each row by its own text. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .text import text_key

# A fifth of 11 to 20 tokens may differ.
MASKS = (
    "11101100111", "11010111011", "11111010101", "11101111", "110111011", "11001010111", "1010011111", "1111111", "11110001011", "110110111", "1110101101",
)
SPAN = 11  # fewest tokens of an item that masks with zeros serve
SHORT = 5  # fewest tokens of an item
SEEDS_PER_SLICE = 500_000


def tokens(column: str = "text") -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(column), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _hashed(column: str = "text") -> Column:
    return F.transform(tokens(column), lambda t: F.xxhash64(t))


def _seeds(df: DataFrame, masks: list[str], *keep: str) -> DataFrame:
    """(keep, at, seed): the hash of every mask at every position of `tok` where it fits; at counts from 0. The token array stays behind.

    The tokens under the longest mask are columns of their own, read once for all masks; this also keeps the generated method short
    enough for the JVM to compile.
    """
    def one(mask: str) -> Column:
        number = MASKS.index(mask) if mask in MASKS else len(MASKS) + len(mask)
        return F.when(F.col(f"t{len(mask) - 1}").isNotNull(), F.xxhash64(F.lit(number), *[F.col(f"t{k}") for k, bit in enumerate(mask) if bit == "1"]))

    least, most = min(map(len, masks)), max(map(len, masks))
    places = df.select(*keep, "tok", F.explode(F.when(F.size("tok") >= least, F.sequence(F.lit(0), F.size("tok") - least))).alias("at"))
    read = places.select(*keep, "at", *[F.get("tok", F.col("at") + k).alias(f"t{k}") for k in range(most)])
    return read.select(*keep, "at", F.explode(F.array(*map(one, masks))).alias("seed")).where("seed is not null")


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = 20, identity: int = 80) -> DataFrame:
    """(doc_id, item_id, shift, start, matched, compared): the best alignment of every leaked item in a document.

    shift is the document token under the item's first token, start the first compared item token; of equal alignments the one with the
    least shift, then start.
    """
    return _best(_found(docs, benchmark, window, identity), ["doc_id"])


def _best(found: DataFrame, by: list[str]) -> DataFrame:
    order = F.struct((-F.col("matched")).alias("missed"), "shift", "start", "compared")
    return found.groupBy(*by, "item_id").agg(F.min(order).alias("b")).select(
        *by, "item_id", "b.shift", "b.start", (-F.col("b.missed")).alias("matched"), "b.compared"
    )


def _found(docs: DataFrame, benchmark: DataFrame, window: int = 20, identity: int = 80) -> DataFrame:
    """(doc_id, text_key, item_id, shift, start, matched, compared): every alignment with a leak."""
    items = benchmark.where("item_id is not null").select("item_id", _hashed().alias("tok")).where(F.size("tok") >= SHORT)
    lengths = [r["n"] for r in items.where(F.size("tok") < SPAN).select(F.size("tok").alias("n")).distinct().collect()]
    of_item = _seeds(items.where(F.size("tok") >= SPAN), list(MASKS), "item_id")
    for n in lengths:
        of_item = of_item.unionByName(_seeds(items.where(F.size("tok") == n), ["1" * n], "item_id"))
    of_item = stage(of_item.select("item_id", F.col("at").alias("item_at"), "seed"), "leak-seeds")
    by = ["doc_id", "text_key"]
    texts = docs.select("doc_id", text_key().alias("text_key"), _hashed().alias("tok"))
    scanned = _seeds(texts, list(dict.fromkeys([*MASKS, *("1" * n for n in lengths)])), *by)
    slices = max(1, -(-of_item.count() // SEEDS_PER_SLICE))
    aligned = None
    for k in range(slices):
        part = of_item if slices == 1 else of_item.where(F.pmod(F.xxhash64("seed"), F.lit(slices)) == k)
        hits = scanned.join(F.broadcast(part), "seed").select(*by, "item_id", (F.col("at") - F.col("item_at")).alias("shift"))
        aligned = hits if aligned is None else aligned.unionByName(hits)
    aligned = stage(aligned.distinct(), "leak-alignments")
    return _compared(aligned, texts, items, window, identity)


def _compared(aligned: DataFrame, texts: DataFrame, items: DataFrame, window: int, identity: int) -> DataFrame:
    """Alignments whose best window agrees well enough."""
    named = aligned.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_text"), "item_id", "shift")
    same = texts["doc_id"].eqNullSafe(F.col("_doc")) & (texts["text_key"] == F.col("_text"))
    both = texts.join(named, same).drop("_doc", "_text").join(items.select("item_id", F.col("tok").alias("item_tok")), "item_id")
    size = F.size("item_tok")
    compared = F.when(size < SPAN, size).otherwise(F.least(F.lit(window), size))
    equal = F.transform("item_tok", lambda t, j: F.coalesce((F.get("tok", F.col("shift") + j) == t).cast("int"), F.lit(0)))
    rows = both.select("doc_id", "text_key", "item_id", "shift", compared.alias("compared"), size.alias("size"), equal.alias("equal"))

    def slide(state: Column, j: Column) -> Column:
        """Sum of the window that ends at j, and the best so far; of equals the first."""
        now = state["now"] + F.get("equal", j) - F.coalesce(F.get("equal", j - F.col("compared")), F.lit(0))
        better = (j + 1 >= F.col("compared")) & (now > state["most"])
        return F.struct(now.alias("now"), F.when(better, now).otherwise(state["most"]).alias("most"), F.when(better, j + 1 - F.col("compared")).otherwise(state["start"]).alias("start"))

    nothing = F.struct(F.lit(0).alias("now"), F.lit(-1).alias("most"), F.lit(0).alias("start"))
    enough = F.col("matched") * 100 >= F.col("compared") * F.when(F.col("size") < SPAN, 100).otherwise(identity)
    best = rows.withColumn("best", F.aggregate(F.sequence(F.lit(0), F.col("size") - 1), nothing, slide))
    return best.select("doc_id", "text_key", "item_id", "shift", F.col("best.start").alias("start"), F.col("best.most").alias("matched"), "compared", "size").where(enough).drop("size")


def clean(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """Rows of docs in whose text no item leaked; all columns stay. Rows that share a doc_id, or have none, are judged each by its own text."""
    bad = _found(docs, benchmark, **how).select(F.col("doc_id").alias("_leaked"), F.col("text_key").alias("_leaked_text")).distinct()
    same = docs["doc_id"].eqNullSafe(bad["_leaked"]) & (text_key() == bad["_leaked_text"])
    return docs.join(bad, same, "left_anti")
