"""Registered query of conversation repair. SQL cannot express the alignment; the tests compare it with brute force."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from . import turn_repair


def damaged(conversations: DataFrame) -> tuple[DataFrame, Column]:
    """The rows with planted faults, and how often each stands there; nulls are one space."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    rows = conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )
    return rows, F.col("copies")


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of turns that lie in order, a conversation in one partition."""
    kind = repaired.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest, out = None, None, ([], [])
        for b in batches:
            of = b.column(0)
            for conv, role, text in zip(of.to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if digest is None or conv != last:
                    if digest is not None:
                        out[0].append(last)
                        out[1].append(digest.hexdigest())
                    last, digest = conv, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], of.type), pa.array(out[1], pa.string())], ["conv_id", "repaired_sha256"])
            out = ([], [])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], of.type), pa.array([digest.hexdigest()])], ["conv_id", "repaired_sha256"])

    return repaired.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def op11_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns, copies = damaged(spark.read.parquet(f"{folder}/conversations.parquet"))
    found = stage(turn_repair.audits(turns, copies), "turns-audits")
    hashed = digests(turn_repair.repaired(turns, found, copies)).withColumnRenamed("conv_id", "_conv")
    both = found.join(hashed, found["conv_id"].eqNullSafe(hashed["_conv"]), "left").drop("_conv")
    return both.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)))
