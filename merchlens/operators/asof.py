"""Point-in-time join: each event meets the newest version of its key that was valid at its time.

Events and versions are one table, sorted by (key, time, kind, tie) over range partitions. A version is carried forward inside its slice
of the sort; each slice hands its last version to the slices behind it, one row a slice. No row is compared with all versions of its key,
and there is no window over a key's whole time: a key that holds a third of the rows is cut by time and tie like any other range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .ordering import _ordered


def as_of_join(
    events: DataFrame, versions: DataFrame, key: str, event_time: str, version_time: str, columns: list[str], event_id: str,
    version_tie: str | None = None, strict: bool = False,
) -> DataFrame:
    """All events with `columns` and `version_time` of the newest version of their key at or before (`strict`: before) their time.

    Of versions of one key and time the one with the largest `version_tie` counts, then the one with the largest values. Events without
    such a version, without key or without time keep nulls; versions without key or time are no versions. Repeated events stay. `event_id`
    only cuts events of one key and time into slices. Columns of `versions` must not clash with those of `events`: an error.
    """
    taken = set(columns + [version_time]) & set(events.columns)
    if taken:
        raise ValueError(f"columns of both sides: {sorted(taken)}")
    tie = F.col(version_tie) if version_tie else F.lit(0)
    carried = F.struct(F.col(key).alias("_k"), F.col(version_time).alias("_v"), tie.alias("_t"), *[F.col(c).alias(c) for c in columns])
    # At one time a version stands before the events that may see it.
    version_kind, event_kind = (1, 0) if strict else (0, 1)
    known = versions.where(F.col(key).isNotNull() & F.col(version_time).isNotNull()).select(
        F.col(key).alias("_key"), F.col(version_time).alias("_time"), F.lit(version_kind).alias("_kind"), carried.alias("_version"))
    asked = events.select(
        F.col(key).alias("_key"), F.col(event_time).alias("_time"), F.lit(event_kind).alias("_kind"), F.col(event_id).alias("_id"),
        F.struct(*events.columns).alias("_event"))
    placed = _ordered(known.unionByName(asked, allowMissingColumns=True), ["_key", "_time", "_kind", "_version", "_id"])

    inside = Window.partitionBy("_slice").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    last = placed.where("_version IS NOT NULL").groupBy("_slice").agg(F.max_by("_version", "_place").alias("_last"))
    # One row for each slice of the sort that has a version: as few as the sort has partitions.
    slices = placed.select("_slice").distinct().join(last, "_slice", "left")
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    handed = slices.select("_slice", F.last("_last", ignorenulls=True).over(earlier).alias("_handed"))
    joined = placed.withColumn("_own", F.last("_version", ignorenulls=True).over(inside)).where("_event IS NOT NULL").join(F.broadcast(handed), "_slice")

    newest = F.coalesce("_own", "_handed")
    mine = F.when((newest["_k"] == F.col("_key")) & F.col("_time").isNotNull(), newest)
    found = joined.select("_event", mine.alias("_found"))
    return found.select("_event.*", F.col("_found._v").alias(version_time), *[F.col(f"_found.{c}").alias(c) for c in columns])
