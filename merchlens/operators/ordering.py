"""Running totals, global row numbers and exact quantiles that no hot key can pile into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stage

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in the low 33 bits


def running_total(
    df: DataFrame, keys: list[str], block: str, order_by: list[str], value: Column, out: str
) -> DataFrame:
    """Inclusive running total per key, where `block` cuts each key's rows into consecutive pieces.

    Rows shuffle by (key, block), so a hot key is spread over its blocks; only one summary row per
    block meets in the per-key window that carries totals from block to block.
    """
    inside = Window.partitionBy(*keys, block).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_step", value)
    carry = (
        df.groupBy(*keys, block)
        .agg(F.sum("_step").alias("_block_total"))
        .select(*keys, block, F.coalesce(F.sum("_block_total").over(earlier), F.lit(0)).alias("_carry"))
    )
    return (
        df.withColumn("_running", F.sum("_step").over(inside))
        .join(carry, [*keys, block])
        .withColumn(out, F.col("_running") + F.col("_carry"))
        .drop("_step", "_running", "_carry")
    )


def _ordered(df: DataFrame, order_by: list) -> DataFrame:
    """Range-sort once and keep the result: slice number and position survive recomputation."""
    placed = stage(df.orderBy(*order_by).withColumn("_place", F.monotonically_increasing_id()), "ordered")
    return placed.withColumn("_slice", F.shiftright("_place", _LOCAL_BITS))


def _slice_starts(slices: DataFrame) -> DataFrame:
    """Exclusive prefix over slice totals; as many rows as the sort has partitions, so broadcastable."""
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.select("_slice", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_start"))
    return F.broadcast(starts)


def number_rows(df: DataFrame, order_by: list, out: str) -> DataFrame:
    """0-based position in the total order. `order_by` must be a total order over the rows."""
    placed = _ordered(df, order_by)
    starts = _slice_starts(placed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_total")))
    local = F.col("_place").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return placed.join(starts, "_slice").withColumn(out, F.col("_start") + local).drop("_slice", "_place", "_start")


def quantiles(df: DataFrame, column: str, qs: list[float]) -> DataFrame:
    """Exact interpolated quantiles as rows (q, value).

    Equal values are counted before the sort, so a value that holds a third of the rows is one row;
    the sort is a range sort and no task sees more than its slice.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    placed = _ordered(counted, ["v"])
    starts = _slice_starts(placed.groupBy("_slice").agg(F.sum("n").alias("_total")))
    inside = Window.partitionBy("_slice").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumn("_local", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(starts, "_slice")
    first = F.col("_start") + F.col("_local")
    total = placed.agg(F.sum("n").alias("n")).scalar()

    def wanted(q: Column) -> Column:
        at = q * (F.col("_total_n") - 1)
        return F.struct(q.alias("q"), at.alias("at"))

    targets = F.transform(F.array(*[F.lit(float(q)) for q in qs]), wanted)

    def covers(t: Column) -> Column:
        low, high = F.floor(t["at"]), F.ceil(t["at"])
        return (low.between(F.col("_first"), F.col("_last"))) | (high.between(F.col("_first"), F.col("_last")))

    hits = (
        ranked.withColumn("_total_n", total)
        .withColumn("_first", first)
        .withColumn("_last", first + F.col("n") - 1)
        .withColumn("t", F.explode(F.filter(targets, covers)))
    )
    span = F.max("v") - F.min("v")
    part = F.first("t.at") - F.floor(F.first("t.at"))
    return hits.groupBy(F.col("t.q").alias("q")).agg((F.min("v") + span * part).alias("value"))
