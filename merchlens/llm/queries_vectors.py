"""Registered query of embedding whitening. SQL cannot express it; the tests compare it with a dense eigensolver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import whitening


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{folder}/embeddings.parquet"), components=32)
