"""Drift from small daily summaries: quantile and distinct-count sketches, stored per day and merged for any window of days.

A number's sketch counts values in buckets whose bounds grow by a fixed ratio, so a bucket knows its values to a relative error of
ACCURACY. Two days merge by adding counts, which is exact: the sketch of a window does not depend on how it was cut into days. Values
nearer to zero than SMALLEST count as zero; missing, NaN and infinite ones are left out. Distinct counts are HyperLogLog sketches.

The table is partitioned by date. An update reads only events of days that are not stored yet (the time bound reaches the scan); events
that arrive for a stored day are not added, and `update` is called with closed days only.
"""

from __future__ import annotations

import datetime as dt
from math import ceil, log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .monitor import index, shares_of

ACCURACY = 0.01
SMALLEST = 1e-9
RATIO = log((1 + ACCURACY) / (1 - ACCURACY))
OFFSET = 1 - ceil(log(SMALLEST) / RATIO)  # the least positive number has bucket 1


def bucket(x: Column) -> Column:
    """Whole number that grows with x: 0 for zero, negative for negative numbers."""
    size = F.ceil(F.log(F.abs(x)) / F.lit(RATIO)) + OFFSET
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.when(finite, F.when(F.abs(x) < SMALLEST, 0).otherwise(F.signum(x) * size)).cast("bigint")


class DailySketches:
    """The sketches of `numbers` (columns) and of the distinct values of `things` (columns), under `root`."""

    def __init__(self, spark: SparkSession, root: str, numbers: list[str], things: list[str], stored_until: dt.date | None = None) -> None:
        self.spark, self.root, self.numbers, self.things = spark, root.rstrip("/"), numbers, things
        self.stored_until = stored_until  # what an earlier run has stored; an update that failed half-way is repeated and replaces its days

    def update(self, events: DataFrame, until: dt.date) -> None:
        """Add the days before `until` that are not stored; `timestamp` tells an event's day."""
        since = self.stored_until
        new = events.where(F.col("timestamp") < F.lit(until).cast("timestamp_ntz"))
        if since is not None:
            if until <= since:
                return
            new = new.where(F.col("timestamp") >= F.lit(since).cast("timestamp_ntz"))
        day = F.col("timestamp").cast("date").alias("date")
        # One pass for all numbers: a row becomes one (name, bucket) each, counted on the map side.
        cells = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), bucket(F.col(n).cast("double")).alias("bucket")) for n in self.numbers]))
        counted = new.select(day, cells.alias("c")).where("c.bucket IS NOT NULL").groupBy("date", "c.name", "c.bucket").agg(F.count(F.lit(1)).alias("n"))
        counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(f"{self.root}/numbers")
        sketches = new.groupBy(day).agg(*[F.hll_sketch_agg(F.col(t).cast("string")).alias(t) for t in self.things])
        sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(f"{self.root}/things")
        self.stored_until = until

    def _days(self, table: str, first: dt.date | None, end: dt.date | None) -> DataFrame:
        kinds = "name string, bucket bigint, n bigint" if table == "numbers" else ", ".join(f"{t} binary" for t in self.things)
        days = self.spark.read.schema(f"{kinds}, date date").parquet(f"{self.root}/{table}")
        if first is not None:
            days = days.where(F.col("date") >= F.lit(first))
        return days if end is None else days.where(F.col("date") < F.lit(end))

    def counts(self, name: str, first: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        """(bucket, n) of a window of days [first, end)."""
        return self._days("numbers", first, end).where(F.col("name") == name).groupBy("bucket").agg(F.sum("n").alias("n"))

    def distinct(self, name: str, first: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        """One row (distinct): the estimated number of distinct values in a window of days; 0 without days."""
        merged = self._days("things", first, end).agg(F.hll_union_agg(name).alias("s"))
        return merged.select(F.coalesce(F.hll_sketch_estimate("s"), F.lit(0)).cast("bigint").alias("distinct"))

    def psi(self, name: str, cut: dt.date, bins: int = 10) -> DataFrame:
        """Stability index of the days from `cut` on against those before it, over quantile bins of the latter."""
        return counted_psi(self.counts(name, None, cut), self.counts(name, cut, None), bins)


def counted_psi(reference: DataFrame, current: DataFrame, bins: int = 10) -> DataFrame:
    """Stability index of two (bucket, n) tables. A bin ends at the bucket that holds the reference's quantile.

    The edges lie within ACCURACY of the quantiles; a whole bucket falls to one side of an edge. Null without any value.
    """
    total = reference.agg(F.sum("n").alias("n")).scalar()
    # A sketch has some thousand buckets at most, whatever the number of events; so the order needs no partitions.
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = reference.select("bucket", F.sum("n").over(upto).alias("_upto"), F.lit(bins).cast("bigint").alias("_bins")).withColumn("_n", total)
    edges = ranked.agg(F.array(*[F.min(F.when(F.col("_upto") > F.expr(f"({i} * (_n - 1)) div _bins"), F.col("bucket"))) for i in range(1, bins)]).alias("e")).scalar()
    both = reference.withColumn("is_current", F.lit(False)).unionByName(current.withColumn("is_current", F.lit(True)))
    binned = both.withColumn("_edges", edges).withColumn("bin", F.size(F.filter("_edges", lambda e: F.col("bucket") > e)))
    counts = binned.groupBy("bin").agg(F.sum(F.when(~F.col("is_current"), F.col("n"))).alias("r"), F.sum(F.when(F.col("is_current"), F.col("n"))).alias("c"))
    return shares_of(counts.fillna(0, ["r", "c"]), "bin").agg(index().alias("psi"))
