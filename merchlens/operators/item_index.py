"""Retrieval index: inverted lists of clustered item vectors with norm bounds; results are exact.

Items are dealt to the nearest of some centres; a list keeps its centre and the largest distance r from it. By Cauchy-Schwarz no item of a
list scores more than u.c + |u| r for a user u, nor less than u.c - |u| r. A search first reads the lists of highest bound until they
hold enough items, which gives each user a k-th score; then only those others whose bound reaches that score, or that may hold a
lower score than any so far (retrieval scales by the lowest). What remains unread cannot change the result.

Centres are fitted on a bounded sample; all items are indexed. A list longer than ITEM_BLOCK is cut into several, and users meet
lists in blocks, so no task gets an unbounded list or all users of one, and a user's scores of a block are cut to the best there and,
in the second reading, to those that reach the k-th score. Only centres and radii, at most LISTS of them per ITEM_BLOCK items
of a list, go to all tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stage
from . import block_top_k, item_lists, retrieval
from .sampling import uniform_sample

cloudpickle.register_pickle_by_value(item_lists)

LISTS, PER_LIST = 1024, 64  # most centres, and items of the sample for each that the centres are fitted on
_SCORED = "user_id bigint, product_id bigint, raw_score double, lo double, hi double"


@dataclass
class ItemIndex:
    items: DataFrame  # (product_id, vector, list)
    lists: pd.DataFrame  # list, centre, radius, n, ib (the block of lists)


def build(items: DataFrame, lists: int | None = None, seed: int = 42) -> ItemIndex:
    """lists: about the square root of the number of items if not given."""
    items = stage(items.select("product_id", "vector"), "index-items")
    total = items.count()
    wanted = max(1, min(LISTS, total, lists or int(np.ceil(total**0.5))))
    odd = F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    sample = uniform_sample(items.where(~odd), wanted * PER_LIST, ["product_id"]).select(array_to_vector("vector").alias("features"))
    sample = stage(sample, "index-sample")
    if sample.isEmpty():
        width = items.agg(F.max(F.size("vector")).alias("n")).first()["n"] or 1
        centres = np.zeros((1, width))
    else:
        centres = np.stack(KMeans(k=wanted, seed=seed, maxIter=10).fit(sample).clusterCenters())
    near = stage(items.mapInPandas(item_lists.assign(centres), "product_id bigint, vector array<double>, centre int, far double"), "index-near")
    sizes = near.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / retrieval.ITEM_BLOCK).alias("parts"))
    part = F.pmod(F.xxhash64("product_id"), F.col("parts"))
    dealt = near.join(sizes, "centre").withColumn("list", F.concat_ws(".", "centre", part))
    dealt = stage(dealt.select("product_id", "vector", "list", "centre", "far"), "index-lists")
    table = dealt.groupBy("list", "centre").agg(F.max("far").alias("radius"), F.count(F.lit(1)).alias("n")).orderBy("centre", "list").toPandas()
    # Lists side by side make up blocks of about ITEM_BLOCK items.
    block = (table["n"].cumsum() - table["n"]) // retrieval.block_rows(dealt)
    return ItemIndex(dealt.select("product_id", "vector", "list"), table.assign(centre=[centres[c] for c in table["centre"]], ib=block.astype("int32")))


def _met(asked: DataFrame, users: DataFrame, index: ItemIndex, k: int, user_blocks: int) -> DataFrame:
    """Scores of the users' lists: a block of users meets a block of lists, each user only their own lists there, and a user's best k + seen of
    the block come out. A user's vector travels once for each block of lists, not for each list."""
    block = F.pmod(F.xxhash64("user_id"), F.lit(user_blocks)).cast("int")
    left = asked.join(users.select("user_id", "vector", "n_seen"), "user_id").withColumn("ub", block)
    numbers = index.items.sparkSession.createDataFrame(
        [(name, n, int(ib)) for n, (name, ib) in enumerate(zip(index.lists["list"], index.lists["ib"]))], "list string, number int, ib int")
    right = index.items.join(F.broadcast(numbers), "list").select(
        "product_id", "vector", F.col("number").alias("list"), "ib", F.explode(F.sequence(F.lit(0), F.lit(user_blocks - 1))).alias("ub"))
    return left.groupBy("ib", "ub").cogroup(right.groupBy("ib", "ub")).applyInPandas(block_top_k.listed(k), _SCORED)


def pairs_and_scores(users: DataFrame, index: ItemIndex, k: int) -> tuple[DataFrame, DataFrame]:
    """The (user, list) pairs that were read, and the scores as retrieval expects them: all that can be among a user's best k + seen."""
    users = stage(users.select("user_id", "vector", "n_seen"), "index-users")
    if not len(index.lists):
        return users.select("user_id", F.lit("").alias("list")).where("false"), users.sparkSession.createDataFrame([], _SCORED)
    kind = "user_id bigint, ib int, floor double, lists array<int>"
    blocks = retrieval.user_blocks(users, k)
    first = stage(users.mapInPandas(item_lists.wanted(index.lists, k, False), kind), "index-first")
    found = stage(_met(first, users, index, k, blocks), "index-found")
    scores = found.where(F.col("raw_score").isNotNull())
    place = Window.partitionBy("user_id").orderBy(F.desc("raw_score"))
    kth = scores.join(users.select("user_id", "n_seen"), "user_id").withColumn("at", F.row_number().over(place)).where(F.col("at") <= F.col("n_seen") + k)
    known = kth.groupBy("user_id").agg(F.count(F.lit(1)).alias("held"), F.min("raw_score").alias("low"))
    lowest = found.groupBy("user_id").agg(F.min("lo").alias("least"))
    # With fewer than k + seen items found nothing can be ruled out.
    enough = F.when(F.col("held") >= F.col("n_seen") + k, F.col("low")).otherwise(float("-inf"))
    asked = users.join(known, "user_id", "left").join(lowest, "user_id", "left").withColumn("kth", F.coalesce(enough, F.lit(float("-inf")))).withColumn("least", F.coalesce("least", F.lit(float("inf"))))
    more = stage(asked.select("user_id", "vector", "n_seen", "kth", "least").mapInPandas(item_lists.wanted(index.lists, k, True), kind), "index-more")
    names = F.lit([str(n) for n in index.lists["list"]])
    pairs = first.unionByName(more).select("user_id", F.explode("lists").alias("n")).select("user_id", F.get(names, F.col("n")).alias("list"))
    return pairs, found.unionByName(_met(more, users, index, k, blocks))


def retrieve(users: DataFrame, index: ItemIndex, seen: DataFrame | None, k: int = 100) -> DataFrame:
    """As retrieval.retrieve, through the index."""
    return retrieval.retrieve(users, index.items, seen, k, score=lambda u: pairs_and_scores(u, index, k)[1])
