"""Batch ingestion: numbered micro-batches over the time-ordered events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from .ordering import number_rows


def microbatches(events: DataFrame, size: int = K.MICROBATCH_ROWS, order_by: tuple[str, ...] = ("timestamp", "event_id")) -> DataFrame:
    """Global 0-based offset in time order and the 1-based micro-batch it falls in."""
    numbered = number_rows(events, list(order_by), "stream_offset")
    return numbered.withColumn("microbatch_id", (F.floor(F.col("stream_offset") / size) + 1).cast("bigint")).withColumn(
        "ingestion_timestamp", F.current_timestamp()
    )


def collect_batches(batches: list[DataFrame]) -> DataFrame:
    """Concatenation by column name; the schema survives when every batch is empty."""
    return reduce(DataFrame.unionByName, batches)
