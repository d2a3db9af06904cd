"""Re-ranking of candidates and the final recommendations."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import constants as K
from ..functions import scalars as S
from ..session import stage
from . import lambda_rank, retrieval
from .features import normalise_ranker_columns

CATEGORICAL = ["category", "brand"]
LABELLED_ROWS = 25_000  # labelled rows that a ranker is fitted on at most; their features come from all events
FEATURE_COLUMNS = [
    "price", "margin", "rating", "review_count", "inventory_level", "demand_score", "conversion_rate", "ctr",
    "category", "brand", "price_elasticity_score", "competitor_price",
]


def training_set(
    events: DataFrame, features: DataFrame, dominant: DataFrame, users: DataFrame, items: DataFrame
) -> DataFrame:
    """Events with product features, category match and raw retrieval score; label = purchase."""
    wanted = [c for c in FEATURE_COLUMNS if c in features.columns]
    base = events.select("event_id", "user_id", "product_id", "product_category", "purchase_label")
    joined = (
        base.join(features.select("product_id", *wanted), "product_id", "left")
        .join(dominant.select("user_id", "dominant_category"), "user_id", "left")
        .withColumn("category_match", F.coalesce(F.col("dominant_category") == F.col("product_category"), F.lit(False)).cast("int"))
    )
    scored = retrieval.pair_scores(joined, users, items)
    return normalise_ranker_columns(scored, K.RANKER_NUMERIC, CATEGORICAL).dropna(
        subset=[*K.RANKER_NUMERIC, *CATEGORICAL, "purchase_label"]
    )


def fit_ranker(training: DataFrame, rounds: int = 20, seed: int = 42) -> PipelineModel:
    """Pointwise gradient-boosted ranker."""
    training = stage(training.select(*K.RANKER_NUMERIC, *CATEGORICAL, "purchase_label"), "ranker-train")
    seen = training.agg(F.min("purchase_label").alias("lo"), F.max("purchase_label").alias("hi")).first()
    if seen.lo == seen.hi:
        raise ValueError("the ranking frame holds one class only; a ranker needs both")
    return Pipeline(stages=[
        StringIndexer(inputCols=CATEGORICAL, outputCols=["_cat", "_brand"], handleInvalid="keep"),
        OneHotEncoder(inputCols=["_cat", "_brand"], outputCols=["_cat_vec", "_brand_vec"], dropLast=False),
        VectorAssembler(inputCols=[*K.RANKER_NUMERIC, "_cat_vec", "_brand_vec"], outputCol="features"),
        GBTClassifier(labelCol="purchase_label", maxIter=rounds, maxDepth=4, stepSize=0.1, seed=seed),
    ]).fit(training)


def centred_per_user(training: DataFrame) -> DataFrame:
    """Ranker features minus the user's own mean: what is left only orders items within a user.

    This stands for the within-user comparisons of a pairwise loss without building any pair; the
    means are aggregates, so a user with very many events is no special case.
    """
    x = {c: F.col(c).cast("double") for c in K.RANKER_NUMERIC}
    means = training.groupBy("user_id").agg(*[F.avg(e).alias(f"_m_{c}") for c, e in x.items()])
    joined = training.join(means, "user_id")
    vector = array_to_vector(F.array(*[e - F.col(f"_m_{c}") for c, e in x.items()]))
    return joined.select(vector.alias("features"), F.col("purchase_label").cast("double").alias("label"))


def fit_within_user(training: DataFrame):
    """Linear ranker on within-user differences; its margin orders candidates."""
    return LogisticRegression(maxIter=20, standardization=True).fit(stage(centred_per_user(training), "ranker-train"))


def _model_inputs(candidates: DataFrame) -> DataFrame:
    """Ranker inputs: the model sees the raw dot product it was trained on, kept apart from the scaled one."""
    frame = candidates.withColumn("_scaled", F.col("retrieval_score"))
    if "raw_score" in candidates.columns:
        frame = frame.withColumn("retrieval_score", F.col("raw_score"))
    return normalise_ranker_columns(frame, K.RANKER_NUMERIC, CATEGORICAL)


def _restored(scored: DataFrame) -> DataFrame:
    return scored.withColumn("retrieval_score", F.col("_scaled")).drop("_scaled")


def score_with_model(candidates: DataFrame, model: PipelineModel) -> DataFrame:
    frame = _model_inputs(candidates)
    raw = ["rawPrediction", "probability", "prediction", "features", "_cat", "_brand", "_cat_vec", "_brand_vec"]
    return _restored(model.transform(frame).withColumn("ranking_score", vector_to_array("probability")[1]).drop(*raw))


def score_within_user(candidates: DataFrame, model) -> DataFrame:
    """Margins against the mean of the user's own candidates, as the model was fitted on differences to the user's mean."""
    frame = _model_inputs(candidates)
    weights = [float(w) for w in model.coefficients]
    margin = sum((F.col(c).cast("double") * w for c, w in zip(K.RANKER_NUMERIC, weights)), F.lit(0.0))
    scored = frame.withColumn("_margin", margin)
    means = scored.groupBy("user_id").agg(F.avg("_margin").alias("_mean"))
    centred = scored.join(means, "user_id").withColumn("ranking_score", S.sigmoid(F.col("_margin") - F.col("_mean")))
    return _restored(centred.drop("_margin", "_mean"))


def fit_lambda(training: DataFrame, rounds: int = 20) -> lambda_rank.LambdaModel:
    """Boosted trees on NDCG-weighted pairs of a user's rows."""
    return lambda_rank.fit_lambda(training, K.RANKER_NUMERIC, rounds=rounds)


def score_lambda(candidates: DataFrame, model: lambda_rank.LambdaModel) -> DataFrame:
    return _restored(_model_inputs(candidates).withColumn("ranking_score", S.sigmoid(lambda_rank.margin(model))))


def score_closed_form(candidates: DataFrame) -> DataFrame:
    """Deterministic ranking score in [0, 1]: the purchase propensity, a cart's when the category fits."""
    step = F.when(F.col("category_match") == 1, "add_to_cart").otherwise("click")
    return candidates.withColumn("ranking_score", S.purchase_propensity(
        step, F.lit(0.0), "price_elasticity_score", "price", "competitor_price", "inventory_level", "rating",
        F.lit(1.0), F.lit(0),
    ))


def enrich(candidates: DataFrame, features: DataFrame, dominant: DataFrame) -> DataFrame:
    wanted = [c for c in FEATURE_COLUMNS if c in features.columns]
    joined = candidates.join(features.select("product_id", *wanted), "product_id", "left").join(
        dominant.select("user_id", "dominant_category"), "user_id", "left"
    )
    match = F.coalesce(F.col("category") == F.col("dominant_category"), F.lit(False)).cast("int")
    return joined.withColumn("category_match", match)


def sellable() -> Column:
    stock, margin = F.coalesce("inventory_level", F.lit(0.0)), F.coalesce("margin", F.lit(0.0))
    return (stock > 0) & (margin >= K.MINIMUM_MARGIN)


def business_filter(enriched: DataFrame, k: int) -> DataFrame:
    """In stock with enough margin; a user left with nothing keeps their first k candidates.

    A user has at most the retrieval top-k candidates, which bounds the window.
    """
    mine = Window.partitionBy("user_id")
    marked = enriched.withColumn("_ok", sellable()).withColumn("_any", F.max("_ok").over(mine))
    return marked.where(F.col("_ok") | (~F.col("_any") & (F.col("rank") <= k))).drop("_ok", "_any")


def blend() -> Column:
    return (
        K.BLEND["ranking"] * F.col("ranking_score")
        + K.BLEND["retrieval"] * F.coalesce("retrieval_score", F.lit(0.0))
        + K.BLEND["margin"] * F.coalesce("margin", F.lit(0.0))
        + K.BLEND["in_stock"] * (F.coalesce("inventory_level", F.lit(0.0)) > 0).cast("double")
    )


def reason() -> Column:
    return (
        F.when(F.col("category_match") == 1, K.REASON_CATEGORY)
        .when(F.col("ranking_score") > F.col("retrieval_score"), K.REASON_RANKING)
        .otherwise(K.REASON_RETRIEVAL)
    )


def final_top_k(scored: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("user_id").orderBy(F.desc("_order"), "product_id")
    blended = scored.drop("rank").withColumn("_score", blend()).withColumn("_order", F.round("_score", 9))
    top = blended.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return top.select(
        "user_id",
        "rank",
        "product_id",
        F.col("category").alias("product_category"),
        "brand",
        F.round("retrieval_score", 4).alias("retrieval_score"),
        F.round("ranking_score", 4).alias("ranking_score"),
        F.round("_score", 4).alias("product_score"),
        reason().alias("recommendation_reason"),
        (F.col("category_match") == 1).alias("category_match"),
        F.round("ranking_score", 4).alias("predicted_purchase_probability"),
    )


def recommend(
    candidates: DataFrame, features: DataFrame, dominant: DataFrame, k: int = 10, score=score_closed_form
) -> DataFrame:
    """Recommendations for every user in `candidates` (user_id, product_id, retrieval_score, rank)."""
    return final_top_k(score(business_filter(enrich(candidates, features, dominant), k)), k)


def top_users(users: DataFrame, n: int) -> DataFrame:
    return users.orderBy(F.desc(F.round("ltv_estimate", 6)), "user_id").limit(n).select("user_id")


def batch_recommendations(candidates, features, users, max_users: int, k: int = 10, score=score_closed_form) -> DataFrame:
    """Recommendations of the `max_users` users with the highest lifetime value; candidates(chosen) is asked for these only."""
    return recommend(candidates(top_users(users, max_users)), features, users, k, score)


def popular_candidates(requests: DataFrame, catalog: DataFrame, seen: DataFrame, k: int = 100) -> DataFrame:
    """Non-personal fallback: the most popular unseen products of every user.

    A user's list needs at most k + (number seen) head items of one shared popularity order, so each
    user meets that prefix only.
    """
    from .ordering import number_rows

    head = number_rows(
        catalog.select("product_id", F.round(S.popularity("rating", "review_count", "inventory"), 6).alias("popularity")),
        [F.desc("popularity"), "product_id"], "_at",
    )
    counts = seen.groupBy("user_id").agg(F.count(F.lit(1)).alias("_seen"))
    size = head.agg(F.count(F.lit(1))).scalar()
    want = F.least(F.coalesce("_seen", F.lit(0)) + k, size)
    slots = requests.join(counts, "user_id", "left").select(
        "user_id", F.explode(F.sequence(F.lit(0).cast("bigint"), want - 1)).alias("_at")
    )
    mine = slots.join(head, "_at").join(seen, ["user_id", "product_id"], "left_anti")
    best = Window.partitionBy("user_id").orderBy("_at")
    top = mine.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return top.select("user_id", "product_id", "popularity", "rank")
