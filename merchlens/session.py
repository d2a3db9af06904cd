"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A join key holding a third of the rows is split even if that costs a later shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Stored rows are many times as large in memory as in their files, and the sizes of broadcast sides are guessed from the files.
    "spark.sql.sources.fileCompressionFactor": "8.0",
}
#: A broadcast is built on the driver, several at once in one query: no side beyond this is broadcast unless a hint asks for it.
BROADCAST_BYTES = 2 << 20


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        allowed = spark.conf.get(key, None)  # below 0: no broadcast at all
        if allowed is not None and not allowed.startswith("-") and spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(allowed) > BROADCAST_BYTES:
            spark.conf.set(key, str(BROADCAST_BYTES))
    return spark


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="merchlens-")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only for a local session."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_dir()


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/merchlens/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write once and read back: cuts lineage, survives executor loss, keeps column pruning."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
