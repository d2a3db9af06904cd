"""Point-in-time join against brute force, on ties, nulls and a hot key."""

import datetime as dt
import random

import pytest
from merchlens.operators import asof
from pyspark.sql import functions as F

EVENTS = "event_id string, product_id bigint, ts timestamp_ntz"
VERSIONS = "product_id bigint, since timestamp_ntz, number int, value string"


def at(minute):
    return None if minute is None else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def brute(events, versions, strict):
    out = []
    for e, k, t in events:
        known = [v for v in versions if None not in (k, t, v[0], v[1]) and v[0] == k and (v[1] < t if strict else v[1] <= t)]
        best = max(known, key=lambda v: (v[1], v[2])) if known else (None,) * 4
        out.append((e, k, t, *best[1:]))
    return sorted(out, key=str)


@pytest.mark.parametrize("strict", [False, True])
def test_equals_brute_force_with_a_hot_key_and_nulls(spark, strict):
    rng = random.Random(3)
    events = [(f"e{i}", rng.choice([1, 1, 1, 2, 3, 4, None]), at(rng.choice([None, *range(40)]))) for i in range(600)]
    events += events[:20]  # repeated rows stay
    # 10 and 9 as numbers of versions of one time: order is that of numbers, not of texts; product 4 has no versions.
    versions = [(k, at(m), n, f"{k}-{m}-{n}") for k in (1, 2, 3, None) for m in (None, 5, 6, 20, 39) for n in (9, 10)]
    versions += [(9, at(0), 1, "other product")]
    left = spark.createDataFrame(events, EVENTS).repartition(5)
    right = spark.createDataFrame(versions, VERSIONS).repartition(3)
    got = asof.as_of_join(left, right, "product_id", "ts", "since", ["number", "value"], "event_id", "number", strict)
    assert got.columns == ["event_id", "product_id", "ts", "since", "number", "value"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(events, versions, strict)


def test_a_hot_product_is_cut_into_slices(spark):
    """One version at the start, one product, one moment: slices behind the first take it from there."""
    events = spark.range(200_000).select(
        F.concat(F.lit("e"), F.col("id")).alias("event_id"), F.lit(1).cast("bigint").alias("product_id"), F.lit(at(5)).cast("timestamp_ntz").alias("ts"))
    versions = spark.createDataFrame([(1, at(0), 1, "first"), (0, at(9), 1, "another product's")], VERSIONS)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = asof.as_of_join(events, versions, "product_id", "ts", "since", ["value"], "event_id")
        assert {tuple(r) for r in got.groupBy("value").count().collect()} == {("first", 200_000)}
        loads = asof._ordered(events, ["product_id", "ts", "event_id"]).groupBy("_slice").count().collect()
        assert len(loads) > 4 and max(r["count"] for r in loads) < 60_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty_sides_and_clashing_columns(spark):
    events = spark.createDataFrame([("a", 1, at(1))], EVENTS)
    none = spark.createDataFrame([], VERSIONS)
    assert [tuple(r) for r in asof.as_of_join(events, none, "product_id", "ts", "since", ["value"], "event_id").collect()] == [("a", 1, at(1), None, None)]
    assert asof.as_of_join(events.limit(0), none, "product_id", "ts", "since", ["value"], "event_id").count() == 0
    with pytest.raises(ValueError):
        asof.as_of_join(events.withColumn("value", F.lit(1)), none, "product_id", "ts", "since", ["value"], "event_id")
