"""Structured Streaming twins: micro-batch ingest, cleaning, sessions, feature refresh, feedback."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions import scalars as S
from ..operators.cleaning import drop_incomplete, repair
from ..session import fresh_path
from ..sources.bindings import clickstream_from
from ..sources.tables import SCHEMAS

WATERMARK = "1 hour"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
GIVEN = "given"  # complete deliveries that reach first_deliveries()
FEEDBACK_HOURS = 72  # how long after serving an action counts for the served list


def event_stream(spark: SparkSession, folder: str, name: str = "events.parquet", files_per_batch: int = 1) -> DataFrame:
    return (
        spark.readStream.schema(SCHEMAS["events"])
        .option("pathGlobFilter", name)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def product_events(stream: DataFrame, catalog: DataFrame) -> DataFrame:
    """The watermarked clickstream. Watermarks need TIMESTAMP, so the UTC time is cast."""
    return clickstream_from(stream, catalog, ts=F.col("ts").cast("timestamp")).withWatermark("timestamp", WATERMARK)


def clean_stream(events: DataFrame) -> DataFrame:
    """Drop incomplete rows, one delivery per event key within the watermark, repair values."""
    return repair(drop_incomplete(events).dropDuplicatesWithinWatermark(K.EVENT_KEY))


def first_deliveries(events: DataFrame, order: str = "event_id") -> DataFrame:
    """Of each event key the delivery with the smallest `order` (text), once the watermark has passed the event, with the number of `copies`.

    What `clean_stream` leaves to arrival is decided here as in the batch: every copy that is not behind the watermark is compared. A copy
    behind it is dropped and counted (see `drain_counted`). A delivery without `order` stands behind the others. The result carries no
    watermark; values are repaired. Copies of one event in a micro-batch are combined before they are shuffled.
    """
    rest = [f for f in events.schema.fields if f.name not in K.EVENT_KEY]
    given = drop_incomplete(events).observe(GIVEN, F.count(F.lit(1)).alias("rows"))
    copy = F.struct(F.coalesce(F.col(order).cast("string"), F.lit("\U0010ffff")).alias("copy_order"), F.to_json(F.struct(*[f.name for f in rest])).alias("copy_row"))
    # The event time is part of the key, so an event is closed when the watermark has passed it.
    kept = given.groupBy(*K.EVENT_KEY).agg(F.min(copy).alias("first"), F.count(F.lit(1)).alias("copies"))
    back = kept.withColumns({"copy_row": F.from_json("first.copy_row", T.StructType(rest)), "timestamp": F.timestamp_micros(F.unix_micros("timestamp"))})
    return repair(back.select(*[F.col(c) if c in K.EVENT_KEY else F.col(f"copy_row.{c}").alias(c) for c in events.columns], "copies"))


def session_stream(events: DataFrame, gap_minutes: int = K.SESSION_GAP_MINUTES) -> DataFrame:
    """Sessions per user, emitted once the watermark has closed them."""
    window = F.session_window("timestamp", f"{gap_minutes} minutes")
    return events.groupBy(window, "user_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.col("purchase_label").cast("bigint")).alias("purchases"),
        F.min("timestamp").alias("session_start"),
        F.max("timestamp").alias("session_end"),
    ).drop("session_window")


def still_open(results: DataFrame, end: Column, events: DataFrame) -> DataFrame:
    """Rows of a batch result whose window a drained stream over the same events has not closed."""
    newest = events.agg(F.max("timestamp")).scalar()
    return results.where(end > newest - F.expr(f"INTERVAL {WATERMARK}"))


def daily_features(events: DataFrame, key: str) -> DataFrame:
    """Event counts and revenue per key and day, emitted when the day is closed."""
    return events.groupBy(F.window("timestamp", "1 day"), key).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("event_type") == "view").alias("views"),
        F.sum(F.col("purchase_label").cast("bigint")).alias("purchases"),
        F.sum(S.net_price() * F.col("purchase_label")).alias("revenue"),
    ).select(F.col("window.start").cast("date").alias("date"), key, "events", "views", "purchases", "revenue")


def feedback(events: DataFrame, served: DataFrame) -> DataFrame:
    """Clicks and purchases that fall on a recommendation served to the same user."""
    acted = events.where(F.col("event_type").isin("click", "purchase"))
    return acted.join(served.select("user_id", "product_id", "rank"), ["user_id", "product_id"]).select(
        "event_id", "user_id", "product_id", "rank", "event_type", "timestamp"
    )


def served_log(served: DataFrame, label: str = "served-log") -> DataFrame:
    """Append served lists (with `served_at`) to a table and read it as a watermarked stream."""
    spark = served.sparkSession
    path = fresh_path(spark, label)
    served.withColumn("served_at", F.col("served_at").cast("timestamp")).write.parquet(path)
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(path).withWatermark("served_at", WATERMARK)


def feedback_within(events: DataFrame, served: DataFrame, hours: int = FEEDBACK_HOURS) -> DataFrame:
    """Clicks and purchases on a product served to the same user at most `hours` before; the moment of serving and the last one count.

    With two streams this is an interval join: both sides carry a watermark and the time condition bounds how long a row can still
    find a partner, so a served list leaves the state `hours` after it fell behind the watermark, and an action as soon as it does.
    A product served again within the time gives a row for each serving. Nulls match nothing. The same call joins batches.
    """
    acted = events.where(F.col("event_type").isin("click", "purchase")).select("event_id", "user_id", "product_id", "event_type", "timestamp")
    lists = served.select(F.col("user_id").alias("_user"), F.col("product_id").alias("_product"), "rank", "served_at")
    window = F.expr(f"timestamp >= served_at AND timestamp <= served_at + INTERVAL {hours} HOURS")
    return acted.join(lists, (F.col("user_id") == F.col("_user")) & (F.col("product_id") == F.col("_product")) & window).select(
        "event_id", "user_id", "product_id", "rank", "event_type", "served_at", "timestamp"
    )


def drain(stream: DataFrame, label: str) -> DataFrame:
    """Run everything available through an exactly-once Parquet sink and read the result back."""
    spark = stream.sparkSession
    out, state = fresh_path(spark, label), fresh_path(spark, f"{label}-state")
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", state)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def drain_counted(stream: DataFrame, label: str) -> tuple[DataFrame, int]:
    """`drain` of `first_deliveries` with the RocksDB state store, and the number of deliveries that came too late.

    These are the given ones without the copies that went out and those still in the state; the query's own progress counts events, not copies.
    """
    spark = stream.sparkSession
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        out, state = fresh_path(spark, label), fresh_path(spark, f"{label}-state")
        query = (
            stream.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", state)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)
    drained = spark.read.schema(stream.schema).parquet(out)
    given = sum(p.observedMetrics[GIVEN].rows for p in query.recentProgress if GIVEN in p.observedMetrics)
    if not given:
        return drained, 0
    gone = drained.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n")).first().n
    open_ = spark.read.format("statestore").load(state).agg(F.coalesce(F.sum("value.count"), F.lit(0)).alias("n")).first().n
    return drained, given - gone - open_


def each_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], label: str) -> None:
    """Hand every micro-batch with its id to `handle`; replays keep the id, so writes can be idempotent."""
    state = fresh_path(stream.sparkSession, f"{label}-state")
    stream.writeStream.foreachBatch(handle).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()


def ingest_microbatches(stream: DataFrame, label: str = "ingest") -> DataFrame:
    """Append every micro-batch with its id and arrival time to a table partitioned by batch."""
    spark = stream.sparkSession
    out = fresh_path(spark, label)

    def write(batch: DataFrame, batch_id: int) -> None:
        # Overwriting the batch's own folder makes a replayed batch harmless.
        batch.withColumn("ingestion_timestamp", F.current_timestamp()).write.mode("overwrite").parquet(
            f"{out}/microbatch_id={batch_id + 1}"
        )

    each_batch(stream, write, label)
    extra = [T.StructField("ingestion_timestamp", T.TimestampType()), T.StructField("microbatch_id", T.LongType())]
    schema = T.StructType([*stream.schema.fields, *extra])
    return spark.read.schema(schema).option("basePath", out).parquet(out)
