"""The sampled cells of a demand calendar against brute force."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from merchlens.functions import scalars as S
from merchlens.operators.forecast import Demand

FIRST = dt.date(2024, 2, 20)


def _hash(key, day) -> int:
    text = "|".join(([] if key is None else [str(key)]) + [str(day), "42"])
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


@pytest.mark.parametrize("kind,n,last", [
    ("bigint", 40, FIRST + dt.timedelta(29)), ("string", 40, FIRST + dt.timedelta(9)), ("bigint", 10_000, FIRST + dt.timedelta(2)),
    ("bigint", 5, FIRST - dt.timedelta(1)),
])
def test_the_smallest_hashes_without_counting_the_cells(spark, monkeypatch, kind, n, last):
    keys = [None, *range(1, 60)]
    entities = spark.createDataFrame([(k, "A") for k in keys], "series_id bigint, category string").withColumn("series_id", F.col("series_id").cast(kind))
    days = [FIRST + dt.timedelta(k) for k in range((last - FIRST).days + 1)]
    want = sorted((_hash(k, d), str(k), d) for k in keys for d in days)[:n]
    asked = []
    count = type(entities).count
    monkeypatch.setattr(type(entities), "count", lambda df: asked.append(df.columns) or count(df))
    found = Demand(entities, entities, "series_id", FIRST, last).sample(n, last)
    assert found.columns == ["series_id", "category", "date"]
    assert sorted((_hash(r.series_id, r.date), str(r.series_id), r.date) for r in found.collect()) == want
    assert last < FIRST or asked[0] == entities.columns  # the series are counted, not their cells


def test_a_hash_is_compared_as_its_number(spark):
    rows = spark.range(500).select(S.hashed_text("id", seed="7").alias("t"), S.hash32("id", seed="7").alias("h"))
    some = rows.first().h
    for cut in (0, some - 1, some, some + 1, (1 << 32) - 2, (1 << 32) - 1, 1 << 40):
        assert rows.where(S.hash_at_most("t", cut) != (F.col("h") <= cut)).count() == 0
