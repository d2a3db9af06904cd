"""Corpus pipeline: stages over documents, each written as Parquet and read again by the next.

1. toxicity: documents that the classifier rejects go (fitted on the labelled rows that reach the stage);
2. exact dedup: of equal texts the smallest doc_id stays;
3. near-duplicates: of each component (five-word shingles, similarity 0.8 or more) the smallest doc_id stays;
4. decontamination: documents with a benchmark passage go;
5. SentencePiece: the ids of the documents that are left, and the text decoded from them.

All but the last return the columns of documents. Rows without a doc_id pass like others: equal texts among them become one row,
near-duplicates among them all stay, and each with a benchmark passage goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.llm import decontaminate, exact_dedup, minhash, toxicity
from merchlens.llm.queries_tokens import PIECES, vocabulary
from merchlens.llm.text import fresh, text_key
from merchlens.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    likely, toxic = fresh(docs, "likely"), fresh(docs, "toxic")
    return toxicity.score(docs, model, (likely, toxic)).where(F.col(toxic) == 0).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    near = minhash.judged(docs, words=5, threshold=80).where(~F.col("kept"))
    gone = near.select(F.col("doc_id").alias("_gone"), F.col("text_key").alias("_gone_text")).distinct()
    return docs.join(gone, (docs["doc_id"] == gone["_gone"]) & (text_key() == gone["_gone_text"]), "left_anti")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from merchlens.llm import sentence_pieces  # needs the tokenizer's library, which the other stages don't

    model = vocabulary(PIECES)
    return sentence_pieces.decode(sentence_pieces.encode(docs, model), model).select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), "text")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near-duplicates", drop_near_copies),
    ("decontamination", drop_leaks),
    ("sentence pieces", tokenize),
]
# A fitted classifier and a tokenizer cannot be stated in SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
