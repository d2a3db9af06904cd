"""Registered queries of the rule-and-model scans. SQL cannot express their methods; the tests hold the base part against brute force."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import licenses
from . import secret_scan as secrets
from .queries_dedup import documents


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    found = secrets.scan(docs, secrets.learn(docs))

    def number(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["kind"] != "format")
    return found.select("doc_id", *[number(k) for k in secrets.KINDS], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))


def op6_licenses(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    found = licenses.scan(docs, licenses.build(*licenses.count(docs)))

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").alias("first_word"),
        F.array_max("base.start").alias("last_word"),
        joined(F.col("base.label")).alias("base_labels"),
        joined(F.concat("base.label", "notices.label")).alias("labels"),
        # A phrase without its notice counts half.
        F.greatest(F.coalesce(F.array_max("notices.coverage"), F.lit(0.0)), F.when(F.size("base") > 0, 0.5).otherwise(0.0)).alias("score"),
    )
