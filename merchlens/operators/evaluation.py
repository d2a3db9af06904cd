"""Ranking metrics over recommendation lists (user_id, product_id, rank) and relevant pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def relevant_pairs(test_events: DataFrame) -> DataFrame:
    return test_events.where("purchase_label = 1").select("user_id", "product_id").distinct()


def per_user(recommended: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """precision, recall, ndcg and average precision at k for every user with a relevant item.

    All four come from one join of lists and relevant pairs; a user has at most k list rows.
    """
    top = recommended.where(F.col("rank") <= k).select("user_id", "product_id", "rank")
    marked = top.join(relevant.withColumn("_hit", F.lit(1)), ["user_id", "product_id"], "left").withColumn(
        "hit", F.coalesce("_hit", F.lit(0))
    )
    upto = Window.partitionBy("user_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    counted = marked.withColumn("hits_so_far", F.sum("hit").over(upto))
    lists = counted.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("returned"),
        F.count_distinct(F.when(F.col("hit") == 1, F.col("product_id"))).alias("hits"),
        F.sum(F.col("hit") / F.log2(F.col("rank") + 1)).alias("dcg"),
        F.sum(F.col("hit") * F.col("hits_so_far") / F.col("rank")).alias("ap_sum"),
    )
    wanted = relevant.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_relevant"))
    joined = wanted.join(lists, "user_id", "left").fillna(0, ["returned", "hits"]).fillna(0.0, ["dcg", "ap_sum"])
    # The ideal list cannot be longer than what was returned.
    ideal_n = F.least(F.col("n_relevant"), F.lit(k), F.col("returned")).cast("int")
    ideal = F.aggregate(
        F.slice(F.sequence(F.lit(1), F.lit(k)), F.lit(1), ideal_n), F.lit(0.0), lambda acc, i: acc + 1 / F.log2(i + 1)
    )
    return joined.withColumn("_ideal", ideal).select(
        "user_id",
        "n_relevant",
        (F.col("hits") / F.lit(k)).alias("precision_at_k"),
        (F.col("hits") / F.col("n_relevant")).alias("recall_at_k"),
        F.when(F.col("_ideal") > 0, F.col("dcg") / F.col("_ideal")).otherwise(0.0).alias("ndcg_at_k"),
        (F.col("ap_sum") / F.least(F.col("n_relevant"), F.lit(k))).alias("map_at_k"),
    )


def list_ndcg(scored: DataFrame, k: int = 10, group: str = "user_id", label: str = "purchase_label", score: str = "ranking_score", tie: str = "event_id") -> DataFrame:
    """(group, ndcg) of every user's rows by falling score; users whose rows have one label only say nothing and are left out."""
    best = Window.partitionBy(group).orderBy(F.desc(F.round(score, 12)), tie)
    top = scored.select(group, label, score, tie).withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= k)
    gained = top.groupBy(group).agg(F.sum(F.col(label) / F.log2(F.col("_place") + 1)).alias("_dcg"))
    kinds = scored.groupBy(group).agg(F.sum(label).cast("bigint").alias("_ones"), F.count(label).alias("_rows")).where("_ones > 0 and _ones < _rows")
    ideal = F.aggregate(F.sequence(F.lit(1).cast("bigint"), F.least(F.col("_ones"), F.lit(k))), F.lit(0.0), lambda a, i: a + 1 / F.log2(i + 1))
    return kinds.join(gained, group).select(group, (F.col("_dcg") / ideal).alias("ndcg"))


def recall(recommended: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    hits = recommended.where(F.col("rank") <= k).select("user_id", "product_id").distinct().join(
        relevant, ["user_id", "product_id"], "left_semi"
    )
    found = hits.groupBy("user_id").agg(F.count(F.lit(1)).alias("_hits"))
    wanted = relevant.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_relevant"))
    return wanted.join(found, "user_id", "left").select(
        "user_id", (F.coalesce("_hits", F.lit(0)) / F.col("n_relevant")).alias("recall")
    )


def catalog_coverage(recommended: DataFrame, catalog: DataFrame) -> DataFrame:
    size = catalog.agg(F.count(F.lit(1)).alias("n")).scalar()
    return recommended.agg((F.count_distinct("product_id") / F.greatest(size, F.lit(1))).alias("catalog_coverage"))


def category_diversity(recommended: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return recommended.agg(
        F.when(n > 0, F.count_distinct("product_category") / F.nullif(n, F.lit(0))).otherwise(0.0).alias("diversity")
    )


def per_user_diversity(recommended: DataFrame) -> DataFrame:
    """Mean over users of distinct categories per list; unlike the total it does not shrink with users."""
    mine = recommended.groupBy("user_id").agg((F.count_distinct("product_category") / F.count(F.lit(1))).alias("d"))
    return mine.agg(F.avg("d").alias("user_diversity"))


def evaluate(
    recommended: DataFrame, retrieved: DataFrame, train: DataFrame, test: DataFrame, catalog: DataFrame, k: int = 10,
    retrieval_k: int = 100,
) -> DataFrame:
    """One row with every offline metric, over the users with at least one test purchase."""
    relevant = relevant_pairs(test)
    asked = relevant.select("user_id").distinct()
    recommended = recommended.join(asked, "user_id", "left_semi")
    history = train.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_train"))
    users = (
        per_user(recommended, relevant, k)
        .join(recall(retrieved, relevant, retrieval_k).withColumnRenamed("recall", "retrieval_recall"), "user_id", "left")
        .join(history, "user_id", "left")
        .withColumn("cold", F.coalesce("n_train", F.lit(0)) <= 3)
    )

    def mean(c) -> Column:
        return F.coalesce(F.round(F.avg(c), 4), F.lit(0.0))

    row = users.agg(
        mean("retrieval_recall").alias("retrieval_recall_at_100"),
        mean("precision_at_k").alias("precision_at_k"),
        mean("recall_at_k").alias("recall_at_k"),
        mean("ndcg_at_k").alias("ndcg_at_k"),
        mean("map_at_k").alias("map_at_k"),
        mean(F.when(F.col("cold"), F.col("recall_at_k"))).alias("cold_start_performance"),
    )
    shares = recommended.agg(
        F.count_distinct("product_id").alias("items"), F.count_distinct("product_category").alias("categories"),
        F.count(F.lit(1)).alias("n"),
    )
    size = catalog.agg(F.count(F.lit(1)).alias("n")).scalar()
    shares = shares.select(F.struct(
        F.round(F.col("items") / F.greatest(size, F.lit(1)), 4).alias("coverage"),
        F.round(F.col("categories") / F.greatest(F.col("n"), F.lit(1)), 4).alias("diversity"),
    ).alias("s")).scalar()
    return row.withColumn("catalog_coverage", shares["coverage"]).withColumn("diversity", shares["diversity"]).withColumn(
        "simulated_ctr_lift", F.round(F.col("precision_at_k") * 0.42 + F.col("diversity") * 0.08, 4)
    )
