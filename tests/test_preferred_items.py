"""A user's preferred products against brute force, and where their rows are made."""

import hashlib

import pytest

from merchlens.operators import sampling

SCHEMA = "user_id bigint, product_category string, score double"


def wanted(affinity, catalog):
    """The two best categories of a user, and of each a tenth of its products, three at least, from a hashed start on."""
    out = []
    for user in {u for u, _, _ in affinity}:
        best = sorted(((-s, c) for u, c, s in affinity if u == user))[:2]
        for _, category in best:
            items = sorted((p for c, p in catalog if c == category), key=lambda p: (p is not None, p))
            n = len(items)
            start = int(hashlib.md5(f"{user}|{category}|42".encode()).hexdigest()[:8], 16) % n if n else 0
            out += [(user, category, items[(start + k) % n]) for k in range(min(max(3, n // 10), n))]
    return sorted(out, key=str)


@pytest.mark.parametrize("places", [4, 1024])
def test_equals_brute_force_over_borders_of_blocks_and_categories(spark, monkeypatch, places):
    monkeypatch.setattr(sampling, "PLACES", places)
    catalog = [("A", p) for p in range(67)] + [("B", p) for p in (100, 101)] + [("C", p) for p in range(200, 290)] + [(None, 7), ("A", None), ("C", 250)]
    affinity = [(u, c, float((u * k) % 7)) for u in range(40) for k, c in enumerate("ABCD", 1)]
    got = sampling.preferred_items(spark.createDataFrame(affinity, SCHEMA), spark.createDataFrame(catalog, "category string, product_id bigint"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == wanted(affinity, catalog)


def test_result_rows_are_made_after_the_last_shuffle(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")  # as with a catalog that is too large to be broadcast
    try:
        catalog = spark.range(3000).selectExpr("'A' AS category", "id AS product_id")
        affinity = spark.range(50).selectExpr("id AS user_id", "'A' AS product_category", "1.0D AS score")
        got = sampling.preferred_items(affinity, catalog)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert got.count() == 50 * 300
        assert "Generate" in plan and plan.index("Generate") < plan.index("Exchange")
    finally:
        spark.conf.set(key, before)
