"""Gap sessionization and session features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import constants as K
from ..functions import scalars as S


def micros(ts: Column | str) -> Column:
    """Event time as whole microseconds; differences of these are exact."""
    return F.unix_micros(S.col(ts).cast("timestamp"))


def pauses(events: DataFrame, block: str = "hour") -> DataFrame:
    """Seconds since the user's previous event; the first event of a user has none.

    Same cut as `sessionize`: rows meet by (user, block), one summary row per block carries over.
    """
    cut = events.withColumn("_block", F.date_trunc(block, "timestamp").cast("timestamp_ntz"))
    inside = Window.partitionBy("user_id", "_block").orderBy("timestamp", "event_id")
    by_user = Window.partitionBy("user_id").orderBy("_block")
    before = cut.groupBy("user_id", "_block").agg(F.max("timestamp").alias("_last")).select(
        "user_id", "_block", F.lag("_last").over(by_user).alias("_before")
    )
    own = cut.withColumn("_prev", F.lag("timestamp").over(inside)).join(before, ["user_id", "_block"])
    pause = micros("timestamp") - micros(F.coalesce("_prev", "_before"))
    return own.withColumn("pause_seconds", pause / 1e6).drop("_block", "_prev", "_before")


def sessionize(events: DataFrame, gap_minutes: int = K.SESSION_GAP_MINUTES, block: str = "hour") -> DataFrame:
    """Number each user's sessions; a session ends when the pause is longer than the gap.

    Rows shuffle by (user, time block) so that one very active user is spread over their blocks.
    A block summary (one row per user and block) carries the last event time and the session count
    from block to block; the events themselves shuffle once.
    """
    gap = gap_minutes * 60_000_000
    inside = Window.partitionBy("user_id", "_block").orderBy("timestamp", "event_id")
    upto_here = inside.rowsBetween(Window.unboundedPreceding, 0)
    cut = events.withColumn("_block", F.date_trunc(block, "timestamp").cast("timestamp_ntz"))
    paused = cut.withColumn(
        "_pause", micros("timestamp") - F.lag(micros("timestamp")).over(inside)
    ).withColumn("_starts", (F.coalesce("_pause", F.lit(0)) > gap).cast("int"))

    blocks = paused.groupBy("user_id", "_block").agg(
        F.min("timestamp").alias("_first"), F.max("timestamp").alias("_last"), F.sum("_starts").alias("_inner")
    )
    by_user = Window.partitionBy("user_id").orderBy("_block")
    opening = blocks.withColumn("_prev_last", F.lag("_last").over(by_user)).withColumn(
        "_open",
        (F.col("_prev_last").isNull() | (micros("_first") - micros("_prev_last") > gap)).cast("int"),
    )
    carry = opening.select(
        "user_id",
        "_block",
        (
            F.coalesce(
                F.sum(F.col("_inner") + F.col("_open")).over(by_user.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            )
            + F.col("_open")
        ).alias("_base"),
    )
    # The running sum is computed before the join, on the partitioning the lag already paid for.
    numbered = paused.withColumn("_run", F.sum("_starts").over(upto_here)).join(carry, ["user_id", "_block"])
    number = (F.col("_base") + F.col("_run")).cast("bigint")
    text = number.cast("string")
    session = F.concat(
        F.lit("DS-"), F.col("user_id").cast("string"), F.lit("-"),
        # Pads to four digits and never cuts longer numbers.
        F.lpad(text, F.greatest(F.lit(4), F.length(text)), F.lit("0")),
    )
    return numbered.withColumn("derived_session_number", number).withColumn("derived_session_id", session).drop(
        "_block", "_pause", "_starts", "_run", "_base"
    )


def session_features(events: DataFrame, session_key: str = "derived_session_id") -> DataFrame:
    kind = F.col("event_type")
    out = events.groupBy(F.col(session_key).alias("session_id")).agg(
        F.min_by("user_id", "timestamp").alias("user_id"),
        F.min("timestamp").alias("session_start"),
        F.max("timestamp").alias("session_end"),
        F.count(F.lit(1)).alias("events"),
        F.count_if(kind == "search").alias("searches"),
        F.count_if(kind == "view").alias("views"),
        F.count_if(kind == "click").alias("clicks"),
        F.count_if(kind == "add_to_cart").alias("cart_additions"),
        F.sum(F.col("purchase_label").cast("bigint")).alias("purchases"),
        F.avg("dwell_time_seconds").alias("avg_dwell_time"),
        F.max(S.event_score()).alias("max_event_score"),
        F.count_distinct("product_id").alias("unique_products"),
    )
    return out.withColumn(
        "duration_seconds", F.greatest(micros("session_end") - micros("session_start"), F.lit(0)) / 1e6
    ).withColumn("session_conversion_rate", S.safe_ratio("purchases", "views"))
