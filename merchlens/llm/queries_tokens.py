"""Registered queries of the tokenizers. SQL cannot express them; the tests compare them with the libraries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .queries_dedup import documents

PIECES, RANKS = "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"


def vocabulary(name: str) -> str:
    """Path of an installed vocabulary file; the folder of vocabularies is needed only when a tokenizer runs."""
    import public_tokenizers

    return public_tokenizers.path(name)


def digests(coded: DataFrame, model: str | None = None) -> DataFrame:
    """n_tokens and the digests of ids and decoded text."""
    from . import sentence_pieces

    return sentence_pieces.decode(coded, model or vocabulary(PIECES)).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op3_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    from . import sentence_pieces

    return digests(sentence_pieces.encode(documents(spark, folder), vocabulary(PIECES)))


def op12_byte_pairs(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from . import byte_pairs

    path, pattern = vocabulary(RANKS), public_tokenizers.PATTERN
    return byte_pairs.decode(byte_pairs.encode(documents(spark, folder), path, pattern), path, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
