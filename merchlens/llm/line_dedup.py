"""Line dedup by a suffix array over line ids, in DataFrame operations only.

Documents are sequences of line ids (two 64-bit hashes of the line). The suffixes of all sequences are ranked by prefix doubling: a
position's first rank counts the lines with smaller ids; a round with step k splits every group of equal ranks by the rank of the position
k lines further on in the same document, so ranks then tell the first 2k lines apart. Positions that are alone in their group, or whose
document ends within the step, are settled and drop out, as do documents without open positions. Rounds end when nothing is open.

The array lists positions by rank. The longest common prefix of two neighbours is found by descent over the rounds' ranks. Neighbours
whose prefix has `min_lines` lines or more form an interval; it is one repeated run of lines. In each interval the earliest copy, by doc_id
and line number, stays, and the first `min_lines` lines of every other copy go. A longer run is covered by the intervals of all the
positions in it, so maximal runs go as a whole. Copies may overlap: of five equal lines only the first stays if runs of two count.

A run of fewer lines counts by its content: with `min_words`, a repeated line of that many words or more is a run on its own, also where
no neighbour is repeated, so all its later copies go. The first occurrence of a line stays under both rules.

Load: neither lines nor ranks are gathered by key. Groups are counted by aggregates, running counts inside a group are cut into blocks of
the rank range, and joins with a hot line are of a shape that adaptive execution can split. Only a document's own positions meet in one row.

Nulls: a null text has no lines; an empty text is one empty line. A row without a doc_id counts as the last. Rows with the same id and text
are one document. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import number_rows, running_total
from ..session import stage

_BLOCKS = 16  # bits of the hash range, or of ranks, that make a block of a running count
_PLACES = 14  # bits of places in the array that make a block
_LAST = (1 << 63) - 1
_DOC = ["o", "k"]


def _lines(column: str = "text") -> Column:
    return F.split(F.col(column), "\n", -1)


def _keyed(docs: DataFrame, *more: str) -> DataFrame:
    """o: the id by which documents are ordered; k tells apart rows that share an id."""
    order = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)).alias("o")
    return docs.select("doc_id", order, F.xxhash64(F.lit(1), "text").alias("k"), "text", *more)


def _first_ranks(docs: DataFrame) -> DataFrame:
    """(o, k, n, r, open) of all positions in documents that hold a repeated line."""
    lines = _keyed(docs).select(*_DOC, F.posexplode(_lines()).alias("n", "line"))
    lines = lines.select(*_DOC, "n", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(5), "line").alias("h2"))
    counted = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("c"))
    blocked = counted.withColumn("one", F.lit(1)).withColumn("block", F.shiftright("h1", 64 - _BLOCKS))
    ranked = running_total(blocked, ["one"], "block", ["h1", "h2"], F.col("c"), "upto")
    ranks = ranked.select("h1", "h2", (F.col("upto") - F.col("c")).alias("r"), (F.col("c") > 1).alias("open"))
    return _of_open_documents(lines.join(ranks, ["h1", "h2"]).select(*_DOC, "n", "r", "open"))


def _of_open_documents(positions: DataFrame) -> DataFrame:
    """(o, k, at): a row for each document with open positions; at lists its positions (n, r, open) by line number."""
    whole = positions.groupBy(*_DOC).agg(F.sort_array(F.collect_set(F.struct("n", "r", "open"))).alias("at"))
    return whole.where(F.exists("at", lambda p: p["open"]))


def _doubled(documents: DataFrame, step: int) -> DataFrame:
    """One round: groups of equal ranks are split by the rank `step` lines further on. `was` tells the positions that were open before it."""
    here = documents.select(*_DOC, "at", F.explode("at").alias("p"))
    after = F.get(F.col("at"), F.col("p.n") + step)["r"]
    pairs = here.select(*_DOC, "p.n", "p.r", "p.open", F.coalesce(after, F.lit(-1)).alias("s"))
    moving = pairs.where("open")
    counted = moving.groupBy("r", "s").agg(F.count(F.lit(1)).alias("c"))
    blocked = counted.withColumn("block", F.floor(F.col("s") / (1 << _BLOCKS)))
    ranked = running_total(blocked, ["r"], "block", ["s"], F.col("c"), "upto")
    ranks = ranked.select("r", "s", (F.col("r") + F.col("upto") - F.col("c")).alias("to"), ((F.col("c") > 1) & (F.col("s") >= 0)).alias("still"))
    moved = moving.join(ranks, ["r", "s"]).select(*_DOC, "n", F.col("to").alias("r"), F.col("still").alias("open"), F.lit(True).alias("was"))
    return moved.unionByName(pairs.where("not open").select(*_DOC, "n", "r", "open", F.lit(False).alias("was")))


def suffix_ranks(docs: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Final ranks (o, k, n, r) of the positions whose first line is repeated, and the ranks after each round, of the positions open in it."""
    documents = stage(_first_ranks(docs), "line-ranks")

    def opened(d: DataFrame) -> DataFrame:
        return d.select(*_DOC, F.explode(F.filter("at", lambda p: p["open"])).alias("p")).select(*_DOC, "p.n", "p.r")

    levels, final, step = [], None, 1
    while not documents.isEmpty():
        levels.append(opened(documents))
        moved = stage(_doubled(documents, step), "line-moved")
        # What was open before the round and is settled by it has its final rank; a position settles once. Told by a column, not by a join:
        # the joins of all rounds would run at once, with a job and a thread of the driver for each side.
        settled = moved.where("was and not open").select(*_DOC, "n", "r")
        final = settled if final is None else final.unionByName(settled)
        documents = stage(_of_open_documents(moved), "line-ranks")
        step *= 2
    return final, levels


def _common_prefix(neighbours: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """neighbours (at, o1, k1, n1, o2, k2, n2) with `lcp`: lines that both have in common, by descent over the rounds."""
    out = neighbours.withColumn("lcp", F.lit(0).cast("bigint"))
    for k in range(len(levels) - 1, -1, -1):
        for side in ("1", "2"):
            there = levels[k].select(F.col("o").alias("_o"), F.col("k").alias("_k"), F.col("n").alias("_n"), F.col("r").alias(f"r{side}"))
            on = (F.col(f"o{side}") == F.col("_o")) & (F.col(f"k{side}") == F.col("_k")) & (F.col(f"n{side}") + F.col("lcp") == F.col("_n"))
            out = out.join(there, on, "left").drop("_o", "_k", "_n")
        out = out.withColumn("lcp", F.when(F.col("r1") == F.col("r2"), F.col("lcp") + (1 << k)).otherwise(F.col("lcp"))).drop("r1", "r2")
        out = stage(out, "lcp")  # one plan for each round, not one of all rounds
    return out


def repeated_runs(docs: DataFrame, min_lines: int = 2, ranks: tuple | None = None) -> DataFrame:
    """(o, k, n): positions at which a later copy of a run of `min_lines` lines starts, with `lcp`, the lines in common with its neighbour."""
    final, levels = ranks or suffix_ranks(docs)
    if final is None:
        empty = docs.sparkSession.createDataFrame([], "o bigint, k bigint, n int, lcp bigint")
        return empty
    array = stage(number_rows(final, ["r", "o", "k", "n"], "place"), "suffix-array")
    before = array.select((F.col("place") + 1).alias("place"), *[F.col(c).alias(f"{c}2") for c in (*_DOC, "n")])
    after = array.select("place", *[F.col(c).alias(f"{c}1") for c in (*_DOC, "n")])
    common = _common_prefix(after.join(before, "place", "left"), levels)
    marked = common.select("place", F.col("o1").alias("o"), F.col("k1").alias("k"), F.col("n1").alias("n"), "lcp")
    cut = F.when(F.col("lcp") < min_lines, 1).otherwise(0)
    blocked = marked.withColumn("one", F.lit(1)).withColumn("block", F.floor(F.col("place") / (1 << _PLACES)))
    intervals = running_total(blocked, ["one"], "block", ["place"], cut, "interval").select("o", "k", "n", "lcp", "interval")
    earliest = intervals.groupBy("interval").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("o", "k", "n")).alias("first")).where("copies > 1").select("interval", "first")
    return intervals.join(earliest, "interval").where(F.struct("o", "k", "n") != F.col("first")).select("o", "k", "n", "lcp")


def _later_lines(first: DataFrame) -> DataFrame:
    """(o, k, n): positions (o, k, n, r) whose line, told by its first rank r, occurs earlier."""
    earliest = first.groupBy("r").agg(F.min(F.struct("o", "k", "n")).alias("first"))
    return first.join(earliest, "r").where(F.struct("o", "k", "n") != F.col("first")).select(*_DOC, "n")


def _long_lines(min_words: int) -> Column:
    """Numbers of the lines with `min_words` words or more."""
    long = F.transform(_lines(), lambda line, i: F.when(F.size(F.array_remove(F.split(line, r"[\x20\x09-\x0D]+"), "")) >= min_words, i))
    return F.array_compact(long)


def marks(docs: DataFrame, min_lines: int = 2, min_words: int | None = None) -> DataFrame:
    """A row for each row of docs: doc_id, n_lines, removed (numbers of the lines that go, from 0), text_key.

    min_words: a repeated line of so many words is a run whatever its neighbours; without it runs count by their lines alone.
    """
    ranks = suffix_ranks(docs)
    copies = repeated_runs(docs, min_lines, ranks)
    gone = copies.select(*_DOC, F.explode(F.sequence(F.col("n"), F.col("n") + min_lines - 1)).alias("line"), F.lit(True).alias("run"))
    singles = min_words is not None and bool(ranks[1])
    if singles:
        gone = gone.unionByName(_later_lines(ranks[1][0]).select(*_DOC, F.col("n").alias("line"), F.lit(False).alias("run")))
    of_run = F.sort_array(F.collect_set(F.when(F.col("run"), F.col("line"))))
    listed = gone.groupBy(*_DOC).agg(of_run.alias("removed"), F.collect_set(F.when(~F.col("run"), F.col("line"))).alias("alone"))  # of one document
    nothing = F.array().cast("array<int>")
    long = F.when(F.col("text").isNotNull(), _long_lines(min_words)) if singles else nothing
    every = _keyed(docs).select("doc_id", *_DOC, F.when(F.col("text").isNull(), 0).otherwise(F.size(_lines())).cast("bigint").alias("n_lines"), long.alias("long"))
    removed = F.array_sort(F.array_union("removed", F.array_intersect("alone", "long"))) if singles else F.col("removed")
    return every.join(listed, _DOC, "left").select("doc_id", "n_lines", F.coalesce(removed, nothing).alias("removed"), F.col("k").alias("text_key"))


def dedup(docs: DataFrame, min_lines: int = 2, min_words: int | None = None) -> DataFrame:
    """docs without the lines of later copies; a null text stays null, and all columns stay."""
    changed = marks(docs, min_lines, min_words).where(F.size("removed") > 0).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("removed").alias("_gone")).distinct()
    same = docs["doc_id"].eqNullSafe(changed["_id"]) & (F.xxhash64(F.lit(1), docs["text"]) == changed["_key"])
    joined = docs.join(changed, same, "left")
    lines = F.split(docs["text"], "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), changed["_gone"])  # by hashing, so linear in the lines
    text = F.when(changed["_gone"].isNull(), docs["text"]).otherwise(F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))
    return joined.select(*[text.alias("text") if c == "text" else docs[c] for c in docs.columns])
