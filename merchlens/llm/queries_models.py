"""Registered queries of the fitted models. SQL cannot express them; the tests hold them against brute force and held-out labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import interpolation, toxicity
from .queries_dedup import documents


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    model = toxicity.train(docs, labels(spark, folder))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op8_interpolation(spark: SparkSession, folder: str) -> DataFrame:
    scored = interpolation.score(documents(spark, folder))
    return scored.select("doc_id", (F.col("part") == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
