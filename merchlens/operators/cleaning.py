"""Event cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import scalars as S


def parse_timestamp(text: Column | str) -> Column:
    """Unreadable timestamps become NULL instead of failing the job."""
    return S.col(text).try_cast("timestamp_ntz")


def repair(events: DataFrame) -> DataFrame:
    """Fill and clip; narrow, so it also runs on a stream."""
    return events.withColumns({
        "discount_percentage": S.clip(F.coalesce("discount_percentage", F.lit(0.0)), 0.0, 0.9),
        "competitor_price": F.coalesce("competitor_price", "product_price"),
        "dwell_time_seconds": S.clip(F.coalesce("dwell_time_seconds", F.lit(0.0)), 0.0, 900.0),
        "page_position": S.clip(F.coalesce("page_position", F.lit(1)), 1, 200),
        "purchase_label": F.col("purchase_label").cast("int"),
    })


def drop_incomplete(events: DataFrame) -> DataFrame:
    return events.dropna(subset=K.EVENT_KEY)


def first_delivery(events: DataFrame, order: str = "event_id") -> DataFrame:
    """One row per event key: the delivery with the smallest id.

    An aggregate, not a window: copies collapse before the shuffle, so a heavily re-sent event costs
    one row per map task.
    """
    rest = [c for c in events.columns if c not in K.EVENT_KEY]
    kept = events.groupBy(*K.EVENT_KEY).agg(F.min_by(F.struct(*rest), order).alias("r"))
    return kept.select(*[c if c in K.EVENT_KEY else F.col(f"r.{c}").alias(c) for c in events.columns])


def clean_events(events: DataFrame) -> DataFrame:
    return repair(first_delivery(drop_incomplete(events)))
