"""Pricing, forecasting, retrieval, ranking metrics, segments, store, monitoring."""

import datetime as dt

import numpy as np
import pytest
from merchlens.functions import constants as K
from merchlens.operators import evaluation, features, forecast, monitor, pricing, ranking, retrieval, segments
from merchlens.operators.store import FeatureStore, FeatureTable
from merchlens.plans.tables import Retail
from merchlens.session import fresh_path
from pyspark.sql import functions as F


def offers(spark, rows):
    return spark.createDataFrame(rows, "product_id int, price double, margin double, competitor_price double, inventory_level double, demand_score double")


def test_price_bounds_per_branch(spark):
    rows = [
        (1, 100.0, 0.35, 104.0, 700.0, 1.0), (2, 100.0, 0.35, 104.0, 25.0, 1.8), (3, 100.0, 0.35, 104.0, 300.0, 1.0),
        (4, 100.0, 0.02, 104.0, 300.0, 1.0), (5, 100.0, 0.05, 104.0, 700.0, 1.0),
    ]
    got = {r.product_id: r for r in pricing.bounds(pricing.contexts(offers(spark, rows))).collect()}
    floor = 65 * 1.08
    assert (got[1].lower_bound, got[1].upper_bound) == pytest.approx((max(floor, 70), 102))
    assert (got[2].lower_bound, got[2].upper_bound) == pytest.approx((103, 135))
    assert (got[3].lower_bound, got[3].upper_bound) == pytest.approx((78, 128))
    assert got[4].decision_rule == K.RULE_FLOOR and got[4].lower_bound == pytest.approx(98 * 1.08)
    # The floor lies above the clearance ceiling: the range collapses instead of running backwards.
    assert got[5].lower_bound == got[5].upper_bound == pytest.approx(95 * 1.08)


def test_decision_respects_floor_and_flags(spark):
    got = pricing.optimise(offers(spark, [(1, 100.0, 0.35, 104.0, 25.0, 1.8), (2, 100.0, 0.35, 50.0, 300.0, 1.0)])).collect()
    assert all(r.optimal_price >= 70.2 and r.expected_margin >= 0 for r in got)
    flags = {r.product_id: r.guardrail_flags for r in got}
    assert K.FLAG_RAISE in flags[1] and flags[2] == [K.FLAG_COMPETITOR]


def test_equal_margins_take_the_lower_price(spark):
    # Price below cost everywhere is impossible, so force a tie with a scorer of zero.
    ctx = pricing.bounds(pricing.contexts(offers(spark, [(1, 100.0, 0.35, 104.0, 300.0, 1.0)])))
    row = pricing.choose(ctx, lambda p: F.lit(0.0)).first()
    assert row.optimal_price == pytest.approx(row.lower_bound)


def test_conversion_model_prices_within_bounds(spark, folder):
    r = Retail(spark, folder)
    model = pricing.fit_conversion_model(r.frame, rounds=3)
    bounded = pricing.bounds(pricing.contexts(r.offers))
    chosen = pricing.choose_with_model(bounded, model)
    bad = chosen.where(
        (F.col("optimal_price") < F.col("lower_bound") - 1e-9) | (F.col("optimal_price") > F.col("upper_bound") + 1e-9)
        | ~F.col("demand_probability").between(0, 1))
    assert chosen.count() == r.catalog.count() and bad.count() == 0


def test_single_class_is_refused(spark, folder):
    with pytest.raises(ValueError):
        pricing.fit_conversion_model(Retail(spark, folder).frame.where("purchase_label = 0"))


def panel(spark, values):
    rows = [("s", "c", dt.date(2024, 1, 1) + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    return forecast.with_calendar(spark.createDataFrame(rows, "series_id string, category string, date date, daily_sales bigint"))


def test_lags_and_short_history(spark):
    got = forecast.lags(panel(spark, range(10))).orderBy("date").collect()
    assert got[0].lag_7 == 4.5 and got[0].rolling_7 == 4.5  # no past: the series mean
    assert got[9].lag_7 == 2 and got[9].rolling_7 == np.mean(range(2, 9))
    past = forecast.lags(panel(spark, range(10)), fill="past").orderBy("date").collect()
    assert past[0].lag_7 == 0 and past[3].lag_7 == 1.0
    short = forecast.forecast_naive(panel(spark, [4, 8]), 3).orderBy("date").collect()
    assert short[0].predicted_demand == 6.0


@pytest.mark.parametrize("fill", ["series", "past"])
def test_rows_of_cells_equal_those_of_the_whole_panel(spark, fill):
    day = [dt.date(2024, 1, 1) + dt.timedelta(k) for k in range(40)]
    sold = [("a", day[k], k % 5 + 1) for k in range(0, 40, 3)] + [("b", day[k], 7) for k in (0, 1, 2, 9, 38)]
    series = forecast.demand(
        spark.createDataFrame(sold, "series_id string, date date, daily_sales bigint"), spark.createDataFrame([("a", "c"), ("b", "c"), ("z", "d")], "series_id string, category string"))
    whole = forecast.supervised(forecast.dense_panel(series.sold, series.entities), fill=fill)
    columns = sorted(whole.columns)
    want = sorted(tuple(r) for r in whole.select(columns).collect())
    cells = series.cells(series.first, series.last)
    assert len(want) == 3 * 40 and sorted(tuple(r) for r in series.rows_at(cells, fill).select(columns).collect()) == want
    last = sorted(tuple(r) for r in series.tail(14).select("series_id", "date", "daily_sales").collect())
    assert last == sorted(tuple(r) for r in whole.where(F.col("date") > day[25]).select("series_id", "date", "daily_sales").collect())


def test_holdout_score_reads_28_days_of_no_panel(spark):
    sold = spark.createDataFrame([("a", dt.date(2020, 1, 1), 5), ("a", dt.date(2024, 1, 1), 3), ("b", dt.date(2023, 12, 20), 1)], "series_id string, date date, daily_sales bigint")
    series = forecast.demand(sold, spark.createDataFrame([("a", "c"), ("b", "c")], "series_id string, category string"))
    cells = series.cells(series.since(21), series.last)
    assert cells.count() == 2 * 21 and cells.agg(F.min("date")).first()[0] == dt.date(2023, 12, 12)
    assert "Window" not in series.rows_at(cells)._jdf.queryExecution().optimizedPlan().toString()


def test_dense_panel_fills_gaps(spark):
    sold = spark.createDataFrame([("a", dt.date(2024, 1, 1), 2), ("a", dt.date(2024, 1, 4), 1)], "series_id string, date date, daily_sales bigint")
    who = spark.createDataFrame([("a", "c"), ("b", "c")], "series_id string, category string")
    got = forecast.dense_panel(sold, who).groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.sum("daily_sales").alias("s")).collect()
    assert {(r.series_id, r.n, r.s) for r in got} == {("a", 4, 3), ("b", 4, 0)}


def test_model_forecast_is_recursive_and_not_negative(spark):
    week = [5, 6, 7, 8, 9, 20, 1]
    p = panel(spark, week * 8)
    model = forecast.fit_demand_model(forecast.supervised(p), trees=5)
    got = forecast.forecast_model(p, model, 9, dt.date(2024, 1, 1), cut_every=4).orderBy("date").collect()
    assert len(got) == 9 and all(r.predicted_demand >= 0 for r in got)
    assert got[0].date == dt.date(2024, 1, 1) + dt.timedelta(days=56)
    series = forecast.demand(p.select("series_id", "date", "daily_sales"), p.select("series_id", "category").distinct())
    scores = forecast.evaluate_model(series, trees=5).first()
    assert scores.mae >= 0 and scores.rmse >= scores.mae


def test_ranking_metrics(spark):
    recs = spark.createDataFrame(
        [(1, f"P{i}", i, "c") for i in range(1, 5)] + [(2, "P1", 1, "c")], "user_id int, product_id string, rank int, product_category string")
    relevant = spark.createDataFrame([(1, "P2"), (1, "P4"), (1, "P9"), (2, "P7")], "user_id int, product_id string")
    got = {r.user_id: r for r in evaluation.per_user(recs, relevant, 4).collect()}
    assert got[1].precision_at_k == 0.5 and got[1].recall_at_k == pytest.approx(2 / 3)
    ideal = sum(1 / np.log2(i + 1) for i in (1, 2, 3))
    assert got[1].ndcg_at_k == pytest.approx((1 / np.log2(3) + 1 / np.log2(5)) / ideal)
    assert got[1].map_at_k == pytest.approx((1 / 2 + 2 / 4) / 3)
    assert (got[2].precision_at_k, got[2].recall_at_k, got[2].ndcg_at_k, got[2].map_at_k) == (0, 0, 0, 0)


def vectors(spark, rows, key):
    return spark.createDataFrame(rows, f"{key} bigint, vector array<double>")


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_retrieval_matches_brute_force(spark, broadcast_bytes, monkeypatch):
    monkeypatch.setattr(retrieval, "USER_BLOCK", 7)
    monkeypatch.setattr(retrieval, "ITEM_BLOCK", 11)
    rng = np.random.default_rng(3)
    items, users = rng.normal(size=(60, 4)).round(1), rng.normal(size=(20, 4)).round(1)
    items[5] = items[6]  # equal scores: the lower id wins
    seen = {(u, int(p)) for u in range(20) for p in rng.choice(60, size=u * 3, replace=False)}
    got = retrieval.retrieve(
        vectors(spark, [(i, v.tolist()) for i, v in enumerate(users)], "user_id"),
        vectors(spark, [(i, v.tolist()) for i, v in enumerate(items)], "product_id"),
        spark.createDataFrame(sorted(seen), "user_id bigint, product_id bigint"), 10, broadcast_bytes).collect()
    for u in range(20):
        s = np.round(items @ users[u], 12)
        want = sorted((i for i in range(60) if (u, i) not in seen), key=lambda i: (-s[i], i))[:10]
        mine = sorted((r for r in got if r.user_id == u), key=lambda r: r["rank"])
        assert [r.product_id for r in mine] == want
        scaled = (s - s.min()) / (s.max() - s.min())
        assert [r.retrieval_score for r in mine] == pytest.approx([scaled[i] for i in want], abs=1e-5)


def test_constant_scores_and_unknown_users(spark):
    items = vectors(spark, [(1, [1.0, 0.0]), (2, [1.0, 0.0])], "product_id")
    asked = spark.createDataFrame([(9,)], "user_id bigint")
    users = retrieval.requested_vectors(asked, vectors(spark, [], "user_id"), items)
    got = retrieval.retrieve(users, items, None, 5).orderBy("rank").collect()
    assert [(r.product_id, r.retrieval_score) for r in got] == [(1, 0.0), (2, 0.0)]


def test_business_filter_falls_back_to_first_candidates(spark):
    rows = [(1, 10, 1, 5.0, 0.3), (1, 11, 2, 0.0, 0.3), (2, 10, 1, 0.0, 0.3), (2, 11, 2, 5.0, 0.05), (2, 12, 3, 0.0, 0.3)]
    df = spark.createDataFrame(rows, "user_id int, product_id int, rank int, inventory_level double, margin double")
    got = {(r.user_id, r.product_id) for r in ranking.business_filter(df, 2).collect()}
    assert got == {(1, 10), (2, 10), (2, 11)}


def test_popular_candidates_skip_seen(spark):
    catalog = spark.createDataFrame([(i, 4.0, i * 10, 100) for i in range(1, 9)], "product_id bigint, rating double, review_count int, inventory int")
    seen = spark.createDataFrame([(1, 8), (1, 7)], "user_id bigint, product_id bigint")
    asked = spark.createDataFrame([(1,), (2,)], "user_id bigint")
    got = ranking.popular_candidates(asked, catalog, seen, 3).orderBy("user_id", "rank").collect()
    assert [(r.user_id, r.product_id) for r in got] == [(1, 6), (1, 5), (1, 4), (2, 8), (2, 7), (2, 6)]


def test_fitted_rankers_score_in_unit_interval(spark, folder):
    r = Retail(spark, folder)
    events = r.clean_table
    users = retrieval.user_vectors(features.interactions(events), r.items)
    training = ranking.training_set(events, r.products, r.users, users, r.items)
    for scored in (
        ranking.score_with_model(training, ranking.fit_ranker(training, rounds=3)),
        ranking.score_within_user(training, ranking.fit_within_user(training)),
    ):
        assert scored.where(~F.col("ranking_score").between(0, 1)).count() == 0


def test_user_features_edge_cases(spark):
    schema = ("user_id string, product_id string, product_category string, event_type string, timestamp timestamp_ntz, product_price double, "
              "discount_percentage double, purchase_label int")
    t = dt.datetime(2024, 1, 1, 23, 0)
    rows = [("a", "p", "Z", "click", t, 10.0, 0.1, 0), ("a", "q", "A", "click", t, 10.0, 0.1, 0),
            ("b", "p", "Z", "purchase", t + dt.timedelta(hours=3), 10.0, 0.5, 1)]
    got = {r.user_id: r for r in features.user_features(spark.createDataFrame(rows, schema)).collect()}
    a, b = got["a"], got["b"]
    assert a.ctr == 2.0 and a.aov == 0 and a.dominant_category == "A" and a.category_affinity == {"A": 0.5, "Z": 0.5}
    assert a.days_since_last_event == 0  # three hours, although the date differs
    assert b.total_revenue == 5.0 and b.ltv_estimate == pytest.approx(9.0) and b.purchases == 1


def test_product_without_events_keeps_its_stock(spark, folder):
    r = Retail(spark, folder)
    rows = r.products.where("views + clicks + purchases = 0 AND product_id >= 100").select("inventory", "inventory_level").collect()
    assert rows and all(x.inventory == x.inventory_level for x in rows)


def test_segment_rules_in_order(spark):
    cols = "total_events int, purchases int, churn_risk double, ltv_estimate double, avg_discount_seen double, conversion_rate double, views int"
    rows = [(3, 9, 0.1, 999.0, 0.5, 1.0, 50), (9, 5, 0.2, 999.0, 0.5, 1.0, 50), (9, 3, 0.5, 300.0, 0.5, 1.0, 50), (9, 2, 0.5, 10.0, 0.18, 0.05, 50),
            (20, 1, 0.5, 10.0, 0.0, 0.0, 12), (9, 1, 0.62, 10.0, 0.0, 0.0, 2), (9, 1, 0.5, 10.0, 0.0, 0.0, 2)]
    got = [r.s for r in spark.createDataFrame(rows, cols).select(segments.segment_rule().alias("s")).collect()]
    assert got == ["new users", "loyal buyers", "high-value customers", "discount-sensitive customers", "frequent browsers",
                   "likely-to-churn customers", "growth customers"]


def test_clusters_cover_all_users(spark, folder):
    r = Retail(spark, folder)
    got = segments.with_clusters(r.users, segments.fit_clusters(r.users, k=3))
    assert got.count() == r.users.count() and got.where(~F.col("behavior_cluster").between(0, 2)).count() == 0


def test_saved_clusters_score_a_part_as_the_whole(spark, folder):
    from pyspark.ml import PipelineModel

    r = Retail(spark, folder)
    model, path = segments.fit_clusters(r.users, k=3), fresh_path(spark, "clusters")
    model.write().overwrite().save(path)
    whole = {x.user_id: x.behavior_cluster for x in segments.with_clusters(r.users, model).collect()}
    some = segments.with_clusters(r.users.where("user_id % 3 = 0"), PipelineModel.load(path)).collect()
    assert some and all(whole[x.user_id] == x.behavior_cluster for x in some)


def test_within_user_scores_are_not_saturated(spark, folder):
    r = Retail(spark, folder)
    events = r.clean_table
    users = retrieval.user_vectors(features.interactions(events), r.items)
    training = ranking.training_set(events, r.products, r.users, users, r.items)
    scored = ranking.score_within_user(training, ranking.fit_within_user(training))
    got = scored.agg(F.stddev("ranking_score").alias("s"), F.avg("ranking_score").alias("m")).first()
    assert got.s > 0.01 and abs(got.m - 0.5) < 0.1
    auc = scored.crossJoin(F.broadcast(scored.select(F.avg("ranking_score").alias("mean")).limit(1)))
    above = auc.groupBy("purchase_label").agg(F.avg((F.col("ranking_score") > F.col("mean")).cast("double")).alias("share")).collect()
    share = {x.purchase_label: x.share for x in above}
    assert share[1] > share[0]


def test_content_vectors_tell_every_brand_apart(spark):
    rows = [(i, f"c{i % 3}", None if i == 7 else f"b{i}", 0.0, 0.0, 0.0, 0.0, 0.0) for i in range(40)]
    cols = "product_id bigint, category string, brand string, " + ", ".join(f"{c} double" for c in retrieval.NUMERIC_ATTRIBUTES)
    vectors = spark.createDataFrame([(i, [float(i)] * 12) for i in range(0, 40, 2)], "product_id bigint, vector array<double>")
    got = {r.product_id: r.vector for r in retrieval.item_content_vectors(spark.createDataFrame(rows, cols), vectors).collect()}
    assert {len(v) for v in got.values()} == {5 + 3 + 39 + 12}
    assert all(sum(v[5:8]) == 1 and sum(v[8:47]) == (i != 7) and v[47:] == [float(i) * (i % 2 == 0)] * 12 for i, v in got.items())
    assert len({tuple(v[8:47]) for v in got.values()}) == 40


def test_feature_store_versions_and_registry(spark):
    root = fresh_path(spark, "store-test")
    frame = spark.createDataFrame([("U1", 0.2, 120.0), ("U1", 0.3, 130.0)], "user_id string, ctr double, ltv double")
    for version in ("v1", "v2"):
        FeatureStore(spark, root, version).materialize([FeatureTable("user_features", frame, "user_id", "ctr")])
    store = FeatureStore(spark, root, "v2")
    assert store.read("user_features").count() == 2
    assert {(r.name, r.version, r.row_count, r.feature_count) for r in store.registry().collect()} == {
        ("user_features", "v1", 2, 3), ("user_features", "v2", 2, 3)}
    assert spark.read.json(store.online_path("user_features")).collect()[0].ctr == 0.3


def test_drift_of_equal_and_shifted_windows(spark):
    df = spark.range(2000).select((F.col("id") % 1000).cast("double").alias("x"), (F.col("id") >= 1000).alias("is_current"))
    assert monitor.numeric_psi(df, "x").first().psi == pytest.approx(0.0, abs=1e-6)
    moved = df.withColumn("x", F.when(F.col("is_current"), F.col("x") + 500).otherwise(F.col("x")))
    assert monitor.numeric_psi(moved, "x").first().psi > K.DRIFT_WATCH


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_product_or_unpartitioned_window(spark, folder):
    r = Retail(spark, folder)
    for df in (r.users, r.products, r.sessions, r.frame, r.decisions, r.series(), forecast.lags(r.series())):
        plan = plan_of(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SinglePartition" not in plan_of(r.sessions)


def test_scan_reads_only_needed_columns(spark, folder):
    from merchlens.operators import kpis

    r = Retail(spark, folder)
    plan = plan_of(kpis.category_sales(r.table("lineitem"), r.catalog))
    assert "l_tax" not in plan and "l_shipdate" not in plan


@pytest.mark.parametrize("name", ["fct_3", "fct_4_model"])
def test_fitted_forecasts_cover_every_product(spark, name):
    from merchlens.plans import all_queries

    folder = "/root/testdata/sf0.001"
    parts = {str(r.p_partkey) for r in spark.read.parquet(f"{folder}/part.parquet").select("p_partkey").collect()}
    got = all_queries()[name].run(spark, folder)
    assert {str(r.series_id) for r in got.select("series_id").distinct().collect()} == parts
    assert name == "fct_3" or got.count() == 30 * len(parts)
