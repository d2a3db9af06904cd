"""Daily sketches: buckets, merging, distance from the exact drift, and that stored days are not read again."""

import datetime as dt
import math
import random

import pytest
from merchlens.operators import daily_sketch as ds
from merchlens.operators import monitor
from pyspark.sql import functions as F

CUT = dt.date(2024, 1, 16)


def test_buckets_keep_order_and_accuracy(spark):
    rng = random.Random(1)
    values = sorted({0.0, -0.0, 1e-9, -1e-9, 1.0, -1.0, 900.0, 1e300, -1e300, *[rng.choice([-1, 1]) * 10 ** rng.uniform(-8, 12) for _ in range(2000)]})
    rows = spark.createDataFrame([(v,) for v in [*values, 1e-12, float("nan"), float("inf"), -float("inf"), None]], "x double")
    got = rows.select("x", ds.bucket(F.col("x")).alias("b")).collect()
    known = {r.x: r.b for r in got if r.b is not None}
    ordered = [known[v] for v in values]
    assert ordered == sorted(ordered) and known[0.0] == 0 == known[1e-12] and known[1.0] == -known[-1.0] > 0
    assert sum(r.b is None for r in got) == 4  # nan, two infinities, null
    for v in values:
        if abs(v) >= 1e-9:
            middle = math.copysign(math.exp((abs(known[v]) - ds.OFFSET - 0.5) * ds.RATIO), v)
            assert abs(middle / v - 1) <= ds.ACCURACY * 1.01


def events(spark):
    rng = random.Random(2)
    rows = [(dt.datetime(2024, 1, rng.randint(1, 30), rng.randint(0, 23)), None if rng.random() < 0.05 else rng.lognormvariate(3, 1), rng.randint(1, 400)) for _ in range(6000)]
    rows = [(t, None if x is None else x * (1.6 if t.date() >= CUT else 1.0), u) for t, x, u in rows]
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, x double, user_id bigint"), rows


def test_drift_and_distinct_counts_near_the_exact_ones_however_cut(spark, tmp_path):
    frame, rows = events(spark)
    end = dt.date(2024, 2, 1)
    once = ds.DailySketches(spark, str(tmp_path / "a"), ["x"], ["user_id"])
    once.update(frame, end)
    often = ds.DailySketches(spark, str(tmp_path / "b"), ["x"], ["user_id"])
    for day in (dt.date(2024, 1, 9), CUT, CUT, end):
        often.update(frame, day)
    assert once.counts("x").exceptAll(often.counts("x")).count() == 0 == often.counts("x").exceptAll(once.counts("x")).count()
    exact = monitor.numeric_psi(monitor.split_windows(frame, F.lit("2024-01-16").cast("timestamp_ntz")), "x").first().psi
    assert exact > 0.1 and often.psi("x", CUT).first().psi == pytest.approx(once.psi("x", CUT).first().psi)
    assert often.psi("x", CUT).first().psi == pytest.approx(exact, rel=0.1)
    late = len({u for t, _, u in rows if t.date() >= CUT})
    assert often.distinct("user_id", CUT).first()["distinct"] == pytest.approx(late, rel=0.05)
    assert sum(r.n for r in often.counts("x", CUT, end).collect()) == sum(x is not None and t.date() >= CUT for t, x, _ in rows)


def test_stored_days_are_not_read_again(spark, tmp_path):
    frame, _ = events(spark)
    sketches = ds.DailySketches(spark, str(tmp_path / "s"), ["x"], ["user_id"])
    sketches.update(frame, CUT)
    before = sketches.counts("x", None, CUT).collect()
    # Events of stored days that would change the counts, or fail the update, if they were read.
    poisoned = frame.withColumn("x", F.when(F.col("timestamp") < F.lit(CUT).cast("timestamp_ntz"), F.raise_error(F.lit("read again")).cast("double")).otherwise(F.col("x")))
    sketches.update(poisoned, dt.date(2024, 2, 1))
    assert sorted(sketches.counts("x", None, CUT).collect()) == sorted(before)
    table = str(tmp_path / "events")
    frame.write.parquet(table)
    read = spark.read.parquet(table).where(F.col("timestamp") >= F.lit(CUT).cast("timestamp_ntz"))
    assert "GreaterThanOrEqual(timestamp" in read._jdf.queryExecution().executedPlan().toString()  # the bound reaches the scan


def test_windows_without_values(spark, tmp_path):
    frame, _ = events(spark)
    sketches = ds.DailySketches(spark, str(tmp_path / "e"), ["x"], ["user_id"])
    sketches.update(frame.where("x < 0"), dt.date(2024, 2, 1))
    empty = sketches.spark.createDataFrame([], "bucket bigint, n bigint")
    assert ds.counted_psi(empty, empty).first().psi is None
    some = spark.createDataFrame([(5, 10)], "bucket bigint, n bigint")
    assert ds.counted_psi(some, some).first().psi == 0 and ds.counted_psi(some, empty).first().psi > 1
