"""The item index against scanning all items."""

import numpy as np
import pytest
from merchlens.operators import item_index, retrieval


def vectors(spark, name, matrix):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(matrix)], f"{name} bigint, vector array<double>")


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 8)) * 4
    items = centres[rng.integers(0, 12, 600)] + rng.standard_normal((600, 8)) * 0.1
    return items, centres[rng.integers(0, 12, 40)] + rng.standard_normal((40, 8))


def rows(df):
    return sorted((r.user_id, r.rank, r.product_id, round(r.raw_score, 9), r.retrieval_score) for r in df.collect())


def test_index_equals_scan_and_reads_fewer_lists(spark, clustered, monkeypatch):
    monkeypatch.setattr(retrieval, "USER_BLOCK", 15)
    items, users = (vectors(spark, n, m) for n, m in zip(("product_id", "user_id"), clustered))
    seen = spark.createDataFrame([(u, p) for u in range(40) for p in range(u * 7, u * 7 + u)] + [(3, 100_000)], "user_id bigint, product_id bigint")
    index = item_index.build(items, 24)
    assert index.lists["n"].sum() == 600
    assert rows(item_index.retrieve(users, index, seen, 10)) == rows(retrieval.retrieve(users, items, seen, 10))
    from pyspark.sql import functions as F

    pairs, _ = item_index.pairs_and_scores(users.withColumn("n_seen", F.lit(0).cast("bigint")), index, 10)
    read = pairs.count()
    assert pairs.distinct().count() == read and read < 40 * len(index.lists) / 2


def test_long_lists_are_cut_and_odd_vectors_are_read(spark, clustered, monkeypatch):
    monkeypatch.setattr(retrieval, "ITEM_BLOCK", 50)
    matrix = np.array(clustered[0])
    matrix[5, 0], matrix[6, 1], matrix[7] = np.nan, np.inf, matrix[8]
    items, users = vectors(spark, "product_id", matrix), vectors(spark, "user_id", np.vstack([clustered[1][:6], np.zeros((1, 8))]))
    index = item_index.build(items, 4)
    assert index.lists["n"].max() < 120 and len(index.lists) > 4
    for k in (5, 700):
        assert rows(item_index.retrieve(users, index, None, k)) == rows(retrieval.retrieve(users, items, None, k))


def test_empty_catalog(spark, clustered):
    items, users = vectors(spark, "product_id", clustered[0]).limit(0), vectors(spark, "user_id", clustered[1][:3])
    assert item_index.retrieve(users, item_index.build(items), None, 5).count() == 0
