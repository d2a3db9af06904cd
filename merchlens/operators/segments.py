"""Customer segmentation."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import scalars as S
from ..session import stage


def _numbers(users: DataFrame, features: list[str]) -> DataFrame:
    types = dict(users.dtypes)
    return users.withColumns({f"z_{c}": S.number_or_zero(c, types[c]) for c in features})


def standardised(users: DataFrame, features: list[str] = K.SEGMENT_FEATURES) -> DataFrame:
    """Zero mean, unit population deviation; missing and infinite values count as 0."""
    clean = _numbers(users, features)
    stats = clean.agg(*[
        F.struct(F.avg(f"z_{c}").alias("mean"), F.stddev_pop(f"z_{c}").alias("std")).alias(c) for c in features
    ]).select(F.struct(*features).alias("s")).scalar()

    def scaled(c):
        std = stats[c]["std"]
        return (F.col(f"z_{c}") - stats[c]["mean"]) / F.when(std == 0, 1.0).otherwise(std)

    return clean.withColumns({f"z_{c}": scaled(c) for c in features})


def _vectors(scaled: DataFrame) -> DataFrame:
    return scaled.withColumn("features", array_to_vector(F.array(*[f"z_{c}" for c in K.SEGMENT_FEATURES])))


def fit_clusters(users: DataFrame, k: int = 5, seed: int = 42) -> PipelineModel:
    """Scaler and clusters in one model, which `save` and `PipelineModel.load` keep; users scored later are scaled as the fitted ones were."""
    # Written once: every iteration reads these vectors again.
    points = stage(_vectors(_numbers(users, K.SEGMENT_FEATURES)).select("features"), "segment-vectors")
    scaler = StandardScaler(withMean=True, withStd=True, inputCol="features", outputCol="_scaled")
    return Pipeline(stages=[scaler, KMeans(k=k, seed=seed, featuresCol="_scaled", predictionCol="behavior_cluster")]).fit(points)


def with_clusters(users: DataFrame, model: PipelineModel) -> DataFrame:
    drop = ["features", "_scaled"] + [f"z_{c}" for c in K.SEGMENT_FEATURES]
    return model.transform(_vectors(_numbers(users, K.SEGMENT_FEATURES))).drop(*drop)


def segment_rule():
    """The first rule that holds names the segment."""
    c = F.col
    return (
        F.when(c("total_events") <= 3, "new users")
        .when((c("purchases") >= 5) & (c("churn_risk") < 0.28), "loyal buyers")
        .when((c("ltv_estimate") >= 300) & (c("purchases") >= 3), "high-value customers")
        .when((c("avg_discount_seen") >= 0.18) & (c("conversion_rate") >= 0.05), "discount-sensitive customers")
        .when((c("views") >= 12) & (c("purchases") <= 1), "frequent browsers")
        .when(c("churn_risk") >= 0.62, "likely-to-churn customers")
        .otherwise("growth customers")
    )


def retention_rule():
    return (
        F.when(F.col("churn_risk") < 0.35, "healthy").when(F.col("purchases") > 0, "save_offer").otherwise("nurture")
    )


def segments(users: DataFrame) -> DataFrame:
    return users.withColumns({"customer_segment": segment_rule(), "retention_signal": retention_rule()})


def lookup_segments(requests: DataFrame, table: DataFrame) -> DataFrame:
    """Segment per requested user; unknown users get the defaults."""
    hit = table.select(
        "user_id", "customer_segment", F.round("churn_risk", 4).alias("churn_risk"),
        F.round("ltv_estimate", 2).alias("ltv_estimate"), F.round("conversion_rate", 4).alias("conversion_rate"),
        "retention_signal",
    )
    defaults = {
        "customer_segment": "unknown", "churn_risk": 0.0, "ltv_estimate": 0.0, "retention_signal": "insufficient_history",
    }
    out = requests.join(hit, "user_id", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in defaults.items()})


def summary(table: DataFrame) -> DataFrame:
    return table.groupBy("customer_segment").agg(
        F.count_distinct("user_id").alias("users"),
        F.avg("conversion_rate").alias("conversion_rate"),
        F.avg("aov").alias("aov"),
        F.avg("ltv_estimate").alias("ltv_estimate"),
        F.avg("churn_risk").alias("churn_risk"),
    )


def fallback_segments(requests: DataFrame, table: DataFrame) -> DataFrame:
    """Users without a segment take the largest one (ties: alphabetically first) and its means."""
    largest = summary(table).agg(
        F.min_by(
            F.struct("customer_segment", "churn_risk", "ltv_estimate", "conversion_rate"),
            F.struct(-F.col("users"), F.col("customer_segment")),
        ).alias("s")
    ).scalar()
    unknown = requests.join(table.select("user_id"), "user_id", "left_anti")
    return unknown.withColumn("_s", largest).select(
        "user_id",
        F.col("_s.customer_segment").alias("customer_segment"),
        F.round("_s.churn_risk", 4).alias("churn_risk"),
        F.round("_s.ltv_estimate", 2).alias("ltv_estimate"),
        F.round("_s.conversion_rate", 4).alias("conversion_rate"),
        F.when(F.col("_s.churn_risk") < 0.35, "healthy").otherwise("save_offer").alias("retention_signal"),
    )
