"""Candidate retrieval: item attributes, factor models, exact top-k scoring in blocks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark import cloudpickle
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scalars as S
from ..session import stage
from . import block_top_k
from .ordering import number_rows

# Ship the task-side code with the job: executors need numpy and pandas only, not this package.
cloudpickle.register_pickle_by_value(block_top_k)

BROADCAST_BYTES = 64 << 20
USER_BLOCK, ITEM_BLOCK = 8_192, 65_536  # most rows of a block; a task holds one of each
ITEM_BLOCK_BYTES, RESULT_ROWS = 32 << 20, 1 << 20  # most bytes of a block's item vectors, and rows that a block of users gets from a block of items


def item_attributes(catalog: DataFrame) -> DataFrame:
    """Z-scored numeric attributes per product; a constant attribute scores 0."""
    raw = {
        "log_price": F.log1p(F.coalesce("price", F.lit(0.0))),
        "margin_rate": F.coalesce("margin", F.lit(0.0)),
        "rating_share": F.coalesce("rating", F.lit(0.0)) / 5,
        "log_reviews": F.log1p(F.coalesce(F.col("review_count").cast("double"), F.lit(0.0))) / 10,
        "log_stock": F.log1p(F.coalesce(F.col("inventory").cast("double"), F.lit(0.0))) / 10,
    }
    base = catalog.select("product_id", "category", "brand", *[e.alias(n) for n, e in raw.items()])
    stats = base.agg(F.struct(*[
        F.struct(F.avg(n).alias("mean"), F.stddev_pop(n).alias("std")).alias(n) for n in raw
    ]).alias("s")).scalar()

    def z(n: str):
        std = stats[n]["std"]
        return (F.col(n) - stats[n]["mean"]) / F.when(std == 0, 1.0).otherwise(std)

    return base.withColumns({n: z(n) for n in raw})


NUMERIC_ATTRIBUTES = ["log_price", "margin_rate", "rating_share", "log_reviews", "log_stock"]


def item_content_vectors(attributes: DataFrame, vectors: DataFrame) -> DataFrame:
    """Content vector: numeric attributes, one indicator for each category and each brand, the whole stored vector.

    The values are numbered by a sort, so no list of brands passes through the driver; only their number does. A vector is as wide as
    there are categories and brands.
    """
    def indicator(slot, width: int):
        return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.when(i == slot, 1.0).otherwise(0.0))

    joined, parts = attributes, [F.array(*NUMERIC_ATTRIBUTES)]
    for c in ("category", "brand"):
        numbered = number_rows(attributes.where(F.col(c).isNotNull()).select(c).distinct(), [c], f"_{c}")
        width = max(1, numbered.count())
        joined = joined.join(numbered, c, "left")
        parts.append(indicator(F.col(f"_{c}"), width))
    wide = vectors.agg(F.max(F.size("vector")).alias("n")).first().n or 0
    parts.append(S.pad_vector("vector", wide))
    return joined.join(vectors, "product_id", "left").select("product_id", F.concat(*parts).alias("vector"))


def user_vectors(interactions: DataFrame, items: DataFrame) -> DataFrame:
    """Unit-length mean of the vectors a user interacted with, weighted by interaction score.

    The vector mean is an aggregate with map-side combine: a heavy user never gathers in one place.
    """
    weighted = interactions.where("score > 0").join(items.select("product_id", "vector"), "product_id")
    mean = Summarizer.mean(array_to_vector("vector"), F.col("score"))
    return weighted.groupBy("user_id").agg(mean.alias("m")).select(
        "user_id", S.l2_normalised(vector_to_array("m")).alias("vector")
    )


def mean_vector(items: DataFrame) -> DataFrame:
    return items.agg(Summarizer.mean(array_to_vector("vector")).alias("m")).select(vector_to_array("m").alias("vector"))


def requested_vectors(requests: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """A vector per requested user; an unknown user takes the mean item vector."""
    return requests.join(users, "user_id", "left").withColumn("vector", F.coalesce("vector", mean_vector(items).scalar()))


_SCORED = "user_id bigint, product_id bigint, raw_score double, lo double, hi double"


def _rows_of(width: int) -> int:
    return max(1, min(ITEM_BLOCK, ITEM_BLOCK_BYTES // (8 * (width + 1))))


def block_rows(items: DataFrame) -> int:
    """Items of a block, fewer where vectors are wide."""
    return _rows_of(items.agg(F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width")).first().width)


def user_blocks(users: DataFrame, k: int) -> int:
    """Blocks of users (with n_seen): more of them where users have seen much, as a task returns k + seen rows a user."""
    size = users.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("n_seen") + k), F.lit(0)).alias("wanted")).first()
    return max(1, -(-size.n // USER_BLOCK), -(-size.wanted // RESULT_ROWS))


def _score(users: DataFrame, items: DataFrame, k: int, broadcast_bytes: int) -> DataFrame:
    spark = users.sparkSession
    size = items.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width")).first()
    n_items = size.n
    if n_items * (size.width + 1) * 8 <= broadcast_bytes:
        # Size checked above: the item matrix fits every executor.
        packed = items.orderBy("product_id").toPandas()
        ids = spark.sparkContext.broadcast(packed["product_id"].to_numpy())
        matrix = spark.sparkContext.broadcast(np.stack(packed["vector"].to_numpy()) if len(packed) else np.zeros((0, 1)))

        return users.mapInPandas(block_top_k.scan(ids, matrix, k), _SCORED)

    # Larger catalogs: blocks of users meet blocks of items. Hash blocks keep every group near the
    # block size, whatever the keys look like.
    n_users = user_blocks(users, k)
    item_blocks = max(1, -(-n_items // _rows_of(size.width)))

    def blocks(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = users.withColumn("ub", F.pmod(F.xxhash64("user_id"), F.lit(n_users)).cast("int")).withColumn("ib", blocks(item_blocks))
    right = items.select("product_id", "vector").withColumn(
        "ib", F.pmod(F.xxhash64("product_id"), F.lit(item_blocks)).cast("int")
    ).withColumn("ub", blocks(n_users))

    return left.groupBy("ub", "ib").cogroup(right.groupBy("ub", "ib")).applyInPandas(block_top_k.pair(k), _SCORED)


def retrieve(
    users: DataFrame, items: DataFrame, seen: DataFrame | None, k: int = 100, broadcast_bytes: int = BROADCAST_BYTES,
    score: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Exact top-k unseen items per user by dot product, scores min-max scaled over all items.

    score: another way to score users (with n_seen) than to scan all items, such as that of item_index.

    Seen items are removed, not demoted. Output: user_id, product_id, raw_score, retrieval_score, rank.
    """
    if seen is not None:
        listed = seen.select("user_id", "product_id").distinct()
        known = listed.join(items.select("product_id"), "product_id", "left_semi")
        users = users.join(known.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_seen")), "user_id", "left")
        users = users.withColumn("n_seen", F.coalesce("n_seen", F.lit(0)))
    else:
        users = users.withColumn("n_seen", F.lit(0))
    asked = users.select("user_id", "vector", "n_seen")
    scored = _score(asked, items, k, broadcast_bytes) if score is None else score(asked)
    limits = scored.groupBy("user_id").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    unseen = scored.where(F.col("raw_score").isNotNull()).drop("lo", "hi")
    if seen is not None:
        unseen = unseen.join(listed, ["user_id", "product_id"], "left_anti")
    best = Window.partitionBy("user_id").orderBy(F.desc("raw_score"), "product_id")
    top = unseen.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    span = F.col("hi") - F.col("lo")
    scaled = F.when(span == 0, 0.0).otherwise((F.col("raw_score") - F.col("lo")) / span)
    return top.join(limits, "user_id").select(
        "user_id", "product_id", "raw_score", F.round(scaled, 5).alias("retrieval_score"), "rank"
    )


def min_max(df: DataFrame, key: str, score: str, out: str) -> DataFrame:
    """Scale scores to [0, 1] per key; a constant vector becomes 0, missing and infinite scores count as 0."""
    clean = S.number_or_zero(score, "double")
    limits = df.groupBy(key).agg(F.min(clean).alias("_lo"), F.max(clean).alias("_hi"))
    span = F.col("_hi") - F.col("_lo")
    return df.join(limits, key).withColumn(out, F.when(span == 0, 0.0).otherwise((clean - F.col("_lo")) / span)).drop("_lo", "_hi")


def pair_scores(pairs: DataFrame, users: DataFrame, items: DataFrame, out: str = "retrieval_score") -> DataFrame:
    """Raw dot product of given pairs; 0 when either side is unknown."""
    u = users.select("user_id", F.col("vector").alias("_u"))
    i = items.select("product_id", F.col("vector").alias("_i"))
    return (
        pairs.join(u, "user_id", "left").join(i, "product_id", "left")
        .withColumn(out, F.coalesce(S.dot("_u", "_i"), F.lit(0.0))).drop("_u", "_i")
    )


def fit_factors(interactions: DataFrame, rank: int = 48, iterations: int = 8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Implicit-feedback factorisation; unit-length user and item vectors.

    The solver takes 32-bit numbers, so users and items are numbered first; ids may be any bigint.
    """
    positive = stage(interactions.where("score > 0").select("user_id", "product_id", "score"), "interactions")
    numbers = {c: number_rows(positive.select(c).distinct(), [c], f"_{c}") for c in ("user_id", "product_id")}
    numbered = positive
    for c, n in numbers.items():
        numbered = numbered.join(n.withColumn(f"_{c}", F.col(f"_{c}").cast("int")), c)
    model = ALS(
        userCol="_user_id", itemCol="_product_id", ratingCol="score", implicitPrefs=True, rank=rank, maxIter=iterations,
        seed=seed, coldStartStrategy="drop",
    ).fit(stage(numbered.select("_user_id", "_product_id", "score"), "interactions-numbered"))

    def unit(factors: DataFrame, key: str) -> DataFrame:
        own = factors.join(numbers[key], F.col("id") == F.col(f"_{key}"))
        return own.select(key, S.l2_normalised(F.col("features").cast("array<double>")).alias("vector"))

    return unit(model.userFactors, "user_id"), unit(model.itemFactors, "product_id")


class TwoTower:
    """Two towers over identity and content: a user and an item vector whose dot product is the score.

    Identity comes from the factorisation, content from item attributes (a user's content is the mean
    of theirs). A logistic regression on positives and sampled negatives weighs the two parts.
    """

    def __init__(self, users: DataFrame, items: DataFrame, model: LogisticRegressionModel) -> None:
        self.users, self.items, self.model = users, items, model


def fit_two_tower(
    interactions: DataFrame, content: DataFrame, positives: DataFrame, negatives: DataFrame, rank: int = 16, seed: int = 42
) -> TwoTower:
    id_users, id_items = fit_factors(interactions, rank=rank, seed=seed)
    # Written once each: both are read by the training pairs and by the towers.
    content = stage(content.select("product_id", S.l2_normalised("vector").alias("vector")), "content")
    taste = stage(user_vectors(interactions, content), "taste")
    labelled = positives.select("user_id", "product_id", F.lit(1).alias("label"), "weight").unionByName(
        negatives.select("user_id", "product_id", F.lit(0).alias("label"), F.lit(1.0).alias("weight"))
    )
    scored = pair_scores(pair_scores(labelled, id_users, id_items, "id_score"), taste, content, "content_score")
    pairs = stage(scored.select("id_score", "content_score", "label", "weight"), "tower-train")
    data = VectorAssembler(inputCols=["id_score", "content_score"], outputCol="features").transform(pairs)
    model = LogisticRegression(weightCol="weight", maxIter=20).fit(data)
    a, b = (float(x) for x in model.coefficients)
    dims = content.select(F.size("vector").alias("d")).first().d

    def tower(ids: DataFrame, other: DataFrame, key: str, wa: float, wb: float) -> DataFrame:
        left = ids.withColumnRenamed("vector", "_id")
        both = left.join(other.withColumnRenamed("vector", "_content"), key, "full")

        def part(c: str, size: int, w: float):
            return F.transform(F.coalesce(c, F.array_repeat(F.lit(0.0), size)), lambda x: x * w)

        return both.select(key, F.concat(part("_id", rank, wa), part("_content", dims, wb)).alias("vector"))

    # The learned weights ride on the user side only, so the dot product is the model's margin.
    users = stage(tower(id_users, taste, "user_id", a, b), "tower-users")
    return TwoTower(users, stage(tower(id_items, content, "product_id", 1.0, 1.0), "tower-items"), model)
