"""Queries over recommendation, pricing, forecasting, segmentation, feature store and monitoring."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import scalars as S
from ..operators import asof, daily_sketch, evaluation, features, forecast, item_index, kpis, monitor, pricing, ranking, retrieval, sampling, segments, svd, towers
from ..operators.store import FeatureStore, FeatureTable, freshness, latest_per_entity
from ..session import fresh_path, stage
from . import summary
from .oracle_tables import RANK_SCORE, bounded, chosen, decided, lagged_of, propensity
from .queries_tables import _KPI_COLUMNS, _KPI_SQL, _LATEST, group_volumes, naive_sql
from .registry import register
from .tables import Retail, with_price_context

# --- retrieval and ranking -----------------------------------------------------------------------

_Z = {
    "log_price": "ln(1 + price)", "margin_rate": "margin", "rating_share": "rating / 5", "log_reviews": "ln(1 + review_count) / 10",
    "log_stock": "ln(1 + inventory) / 10",
}


@register("rec_1", "product_id category brand " + " ".join(f"{n}:6" for n in _Z), "SELECT product_id, category, brand, " + ", ".join(
    f"({e} - (SELECT avg({e}) FROM t_catalog)) / (SELECT CASE WHEN stddev_pop({e}) = 0 THEN 1 ELSE stddev_pop({e}) END FROM t_catalog) AS {n}"
    for n, e in _Z.items()) + " FROM t_catalog")
def _(r: Retail):
    return retrieval.item_attributes(r.catalog)


def _side(df: DataFrame, key: str, side: str) -> DataFrame:
    return df.select(
        F.lit(side).alias("side"), F.col(key).alias("id"), F.size("vector").alias("dims"), F.sqrt(S.dot("vector", "vector")).alias("norm"))


@register("rec_2", "side id dims:i norm:4")
def _(r: Retail):
    """Unit vectors of the truncated SVD of users and products."""
    users, items = svd.unit_factors(svd.truncated_svd(features.interactions(r.clean_table), tolerance=1e-4))
    return _side(users, "user_id", "user").unionByName(_side(items, "product_id", "item"))


@register("rec_2_values", "component:i singular_value:3")
def _(r: Retail):
    found = svd.truncated_svd(features.interactions(r.clean_table), rank=8, spare=24, tolerance=1e-7)
    return r.spark.createDataFrame([(k + 1, float(v)) for k, v in enumerate(found.values)], "component int, singular_value double")


def two_tower(r: Retail, events: DataFrame) -> retrieval.TwoTower:
    content = retrieval.item_content_vectors(retrieval.item_attributes(r.catalog), r.items.select("product_id", "vector"))
    positives = events.select("event_id", "user_id", "product_id", S.training_weight().alias("weight"))
    negatives = sampling.negatives(positives, features.seen_items(events), r.catalog)
    return retrieval.fit_two_tower(features.interactions(events), content, positives, negatives)


@register("rec_3", "user_id product_id retrieval_score:5 rank:i")
def _(r: Retail):
    model = two_tower(r, r.clean_table)
    return retrieval.retrieve(model.users, model.items, features.seen_items(r.clean_table))


def _trained_towers(r: Retail, events: DataFrame) -> towers.Towers:
    content = retrieval.item_content_vectors(retrieval.item_attributes(r.catalog), r.items.select("product_id", "vector"))
    unit = content.select("product_id", S.l2_normalised("vector").alias("vector"))
    positives = events.select("event_id", "user_id", "product_id", S.training_weight().alias("weight"))
    negatives = sampling.negatives(positives, features.seen_items(events), r.catalog)
    return towers.fit(towers.labelled_pairs(positives, negatives), unit)


@register("rec_3_trained", "user_id product_id retrieval_score:5 rank:i")
def _(r: Retail):
    """Candidates of the towers trained by gradient descent over rotating blocks."""
    model = _trained_towers(r, r.clean_table)
    return retrieval.retrieve(model.users, model.items, features.seen_items(r.clean_table))


@register("rec_3_recall", "model users:i recall_20:4 recall_100:4")
def _(r: Retail):
    """Mean recall of held-out purchases among 20 and 100 retrieved products, of each factor model fitted on the training window."""
    train, test = r.split
    train = stage(train, "recall-train")
    seen = stage(features.seen_items(train), "recall-seen")
    wanted = stage(evaluation.relevant_pairs(test).join(seen, ["user_id", "product_id"], "left_anti").join(
        train.select("user_id").distinct(), "user_id", "left_semi"), "recall-wanted")
    weighed, trained = two_tower(r, train), _trained_towers(r, train)
    models = {
        "svd": svd.unit_factors(svd.truncated_svd(features.interactions(train), tolerance=1e-4)),
        "weighed_towers": (weighed.users, weighed.items), "trained_towers": (trained.users, trained.items),
    }

    def measured(name: str, users: DataFrame, items: DataFrame) -> DataFrame:
        asked = users.join(wanted.select("user_id").distinct(), "user_id", "left_semi")
        found = stage(retrieval.retrieve(asked, items, seen), f"recall-{name}")
        both = evaluation.recall(found, wanted, 20).withColumnRenamed("recall", "_20").join(evaluation.recall(found, wanted, 100), "user_id")
        return both.agg(F.count(F.lit(1)).alias("users"), F.coalesce(F.avg("_20"), F.lit(0.0)).alias("recall_20"), F.coalesce(F.avg("recall"), F.lit(0.0)).alias("recall_100")).select(
            F.lit(name).alias("model"), "users", "recall_20", "recall_100")

    return reduce(DataFrame.unionByName, [measured(n, *sides) for n, sides in models.items()])


@register("rec_4", "user_id product_id retrieval_score:5 rank:i", "SELECT * FROM t_candidates")
def _(r: Retail):
    return r.candidates(r.clean_table)


@register("rec_5", "user_id product_id retrieval_score:5 rank:i", "SELECT * FROM t_candidates")
def _(r: Retail):
    """The candidates of rec_4, through an index of clustered items."""
    events = r.clean_table
    users = retrieval.user_vectors(features.interactions(events), r.items)
    return item_index.retrieve(users, item_index.build(r.items), features.seen_items(events))


def _training(r: Retail, rows: DataFrame, history: DataFrame) -> DataFrame:
    """Labelled rows with features and vectors of all events in `history`."""
    users = retrieval.user_vectors(features.interactions(history), r.items)
    return ranking.training_set(
        rows, features.product_features(history, r.catalog), features.user_features(history), users, r.items)


@register("rec_6", "event_id user_id product_id category brand price:4 demand_score:6 ctr:6 category_match:i purchase_label:i", """
  SELECT event_id, c.user_id, c.product_id, p.category, p.brand, p.price, demand_score, p.ctr,
    CAST(coalesce(c.product_category = dominant_category, false) AS INTEGER) AS category_match, purchase_label
  FROM t_clean c LEFT JOIN t_products p ON p.product_id = c.product_id LEFT JOIN t_users u ON u.user_id = c.user_id""")
def _(r: Retail):
    return _training(r, r.clean_table, r.clean_table)


def _rankers(r: Retail) -> dict[str, DataFrame]:
    """The held-out events scored by every fitted ranker; features come from the training window, labelled rows are bounded."""
    train, test = r.split
    sample = sampling.uniform_sample(train, ranking.LABELLED_ROWS, ["event_id"])
    training, held = stage(_training(r, sample, train), "ranker-rows"), stage(_training(r, test, train), "ranker-held")
    return {
        "pointwise": ranking.score_with_model(held, ranking.fit_ranker(training)),
        "within_user": ranking.score_within_user(held, ranking.fit_within_user(training)),
        "lambda": ranking.score_lambda(held, ranking.fit_lambda(training)),
    }


@register("rec_7", "ranker rows:i in_range:i", "SELECT unnest(['pointwise', 'within_user', 'lambda']) AS ranker, count(*) AS rows, count(*) AS in_range FROM t_test")
def _(r: Retail):
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("ranking_score").between(0, 1)).alias("in_range"))
        .select(F.lit(n).alias("ranker"), "rows", "in_range") for n, df in _rankers(r).items()
    ])


@register("rec_7_ndcg", "ranker users:i ndcg_10:4")
def _(r: Retail):
    """Mean NDCG@10 of each ranker over the held-out rows of users that have both labels there."""
    return reduce(DataFrame.unionByName, [
        evaluation.list_ndcg(df).agg(F.count(F.lit(1)).alias("users"), F.coalesce(F.avg("ndcg"), F.lit(0.0)).alias("ndcg_10"))
        .select(F.lit(n).alias("ranker"), "users", "ndcg_10") for n, df in _rankers(r).items()
    ])


@register("rec_8", "user_id product_id ranking_score:6", f"SELECT user_id, product_id, {RANK_SCORE} AS ranking_score FROM t_filtered")
def _(r: Retail):
    enriched = ranking.enrich(r.candidates(r.clean_table), with_price_context(r.products), r.users)
    return ranking.score_closed_form(ranking.business_filter(enriched, 10))


@register("rec_9", "user_id product_id rank:i inventory_level:4 margin:4", "SELECT * FROM t_filtered")
def _(r: Retail):
    return ranking.business_filter(ranking.enrich(r.candidates(r.clean_table), r.products, r.users), 10)


_RECOMMENDED = ("user_id rank:i product_id product_category brand retrieval_score:5 ranking_score:4 product_score:4 category_match "
                "recommendation_reason")


@register("rec_10", "user_id product_id product_score:4", "SELECT * FROM t_recommended")
def _(r: Retail):
    return r.recommendations(r.clean_table)


@register("rec_11", "user_id product_id category_match recommendation_reason", "SELECT * FROM t_recommended")
def _(r: Retail):
    return r.recommendations(r.clean_table)


@register("rec_12", _RECOMMENDED, "SELECT * FROM t_recommended")
def _(r: Retail):
    return r.recommendations(r.clean_table)


@register("rec_12_model", _RECOMMENDED)
def _(r: Retail):
    """The fitted system: factor retrieval, boosted ranker, business rules, for all users at once."""
    events = r.clean_table
    users, items = retrieval.fit_factors(features.interactions(events))
    found = retrieval.retrieve(users, items, features.seen_items(events))
    products, profiles = features.product_features(events, r.catalog), features.user_features(events)
    sample = sampling.uniform_sample(events, ranking.LABELLED_ROWS, ["event_id"])
    model = ranking.fit_ranker(ranking.training_set(sample, products, profiles, users, items))
    return ranking.recommend(found, with_price_context(products), profiles, 10, lambda c: ranking.score_with_model(c, model))


@register("rec_13", _RECOMMENDED, """
  SELECT * FROM t_recommended WHERE user_id IN (SELECT user_id FROM t_users ORDER BY round(ltv_estimate, 6) DESC, user_id LIMIT 500)""")
def _(r: Retail):
    events = r.clean_table
    users, products = features.user_features(events), features.product_features(events, r.catalog)
    vectors = retrieval.user_vectors(features.interactions(events), r.items)

    def candidates(chosen: DataFrame) -> DataFrame:
        return retrieval.retrieve(vectors.join(chosen, "user_id", "left_semi"), r.items, features.seen_items(events))

    return ranking.batch_recommendations(candidates, with_price_context(products), users, max_users=500)


# --- offline metrics -----------------------------------------------------------------------------

def _metrics(r: Retail) -> DataFrame:
    train, test = r.split
    return evaluation.per_user(r.recommendations(train), evaluation.relevant_pairs(test), 10)


for _name, _metric in {"evl_1": "precision_at_k", "evl_2": "recall_at_k", "evl_3": "ndcg_at_k", "evl_4": "map_at_k"}.items():
    register(_name, f"user_id n_relevant:i {_metric}:6", "SELECT * FROM t_user_metrics")(_metrics)


@register("evl_5", "catalog_coverage:6", "SELECT count(DISTINCT product_id) / (SELECT count(*) FROM t_catalog) AS catalog_coverage FROM t_recommended")
def _(r: Retail):
    return evaluation.catalog_coverage(r.recommendations(r.clean_table), r.catalog)


@register("evl_6", "diversity:6 user_diversity:6", """
  SELECT count(DISTINCT product_category) / count(*) AS diversity, (SELECT avg(d) FROM (
    SELECT count(DISTINCT product_category) / count(*) AS d FROM t_recommended GROUP BY user_id)) AS user_diversity FROM t_recommended""")
def _(r: Retail):
    recs = r.recommendations(r.clean_table)
    return evaluation.category_diversity(recs).withColumn("user_diversity", evaluation.per_user_diversity(recs).scalar())


_EVALUATION = ("retrieval_recall_at_100:4 precision_at_k:4 recall_at_k:4 ndcg_at_k:4 map_at_k:4 catalog_coverage:4 diversity:4 "
               "cold_start_performance:4 simulated_ctr_lift:4")


@register("evl_7", _EVALUATION, """
  SELECT *, precision_at_k * 0.42 + diversity * 0.08 AS simulated_ctr_lift FROM (
    SELECT (SELECT round(avg(coalesce(h, 0) / n), 4) FROM (SELECT user_id, count(*) AS n FROM t_relevant GROUP BY user_id) LEFT JOIN (
        SELECT user_id, count(*) AS h FROM t_relevant JOIN t_train_candidates USING (user_id, product_id) GROUP BY user_id) USING (user_id)) AS retrieval_recall_at_100,
      round(avg(precision_at_k), 4) AS precision_at_k, round(avg(recall_at_k), 4) AS recall_at_k, round(avg(ndcg_at_k), 4) AS ndcg_at_k,
      round(avg(map_at_k), 4) AS map_at_k,
      coalesce(round(avg(recall_at_k) FILTER (coalesce(n_train, 0) <= 3), 4), 0) AS cold_start_performance,
      (SELECT round(count(DISTINCT product_id) / (SELECT count(*) FROM t_catalog), 4) FROM t_train_recommended
        WHERE user_id IN (SELECT user_id FROM t_relevant)) AS catalog_coverage,
      (SELECT round(count(DISTINCT product_category) / count(*), 4) FROM t_train_recommended WHERE user_id IN (SELECT user_id FROM t_relevant)) AS diversity
    FROM t_user_metrics LEFT JOIN (SELECT user_id, count(*) AS n_train FROM t_train GROUP BY user_id) USING (user_id))""")
def _(r: Retail):
    train, test = r.split
    return evaluation.evaluate(r.recommendations(train), r.candidates(train), train, test, r.catalog)


# --- pricing -------------------------------------------------------------------------------------

@register("prc_1", "event_id product_id product_category competitor_price:4 inventory_level:4 demand_score:6 seasonality_factor:6 discount_percentage:6 "
          "historical_conversion_rate:6 margin:4 price_elasticity_score:4 net_price:4 purchase_label:i daily_sales:i holiday_flag:i promotion_flag:i",
          "SELECT * FROM t_frame")
def _(r: Retail):
    return r.frame


@register("prc_2", "product_id rows:i in_range:i", "SELECT product_id, count(*) AS rows, count(*) AS in_range FROM t_frame GROUP BY product_id")
def _(r: Retail):
    """The conversion model scores every row; it is fitted on rates without the row's own label."""
    model = pricing.fit_conversion_model(r.training_frame)
    return pricing.model_score(model)(r.frame).groupBy("product_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("probability").between(0, 1)).alias("in_range"))


@register("prc_3", "product_id cost:4 price_floor:4 lower_bound:4 upper_bound:4 decision_rule rule_flag", "SELECT * FROM t_bounded")
def _(r: Retail):
    return pricing.bounds(pricing.contexts(r.offers))


@register("prc_4", "product_id step:i candidate:4",
          "SELECT product_id, i AS step, lower_bound + ((upper_bound - lower_bound) / 30) * i AS candidate FROM t_bounded, range(31) g(i)")
def _(r: Retail):
    return pricing.bounds(pricing.contexts(r.offers)).select("product_id", F.posexplode(pricing.price_grid()).alias("step", "candidate"))


@register("prc_5", "product_id competitor_price:4 inventory_level:4 demand_score:6 seasonality_factor:4 historical_conversion_rate:6 margin:4 "
          "price_elasticity_score:4 product_category discount:6", """
  SELECT *, greatest(0.0, 1 - lower_bound / greatest(price, 1)) AS discount FROM t_bounded""")
def _(r: Retail):
    ctx = pricing.bounds(pricing.contexts(r.offers))
    return ctx.withColumn("discount", pricing.candidate_discount(F.col("lower_bound")))


@register("prc_6", "product_id optimal_price:4 demand_probability:6 expected_margin:4", "SELECT * FROM t_chosen")
def _(r: Retail):
    return pricing.choose(pricing.bounds(pricing.contexts(r.offers)))


@register("prc_6_model", "product_id optimal_price:2 demand_probability:4 expected_margin:2 decision_rule")
def _(r: Retail):
    return pricing.optimise(r.offers, pricing.fit_conversion_model(r.training_frame))


def _flat(decisions: DataFrame) -> DataFrame:
    return decisions.withColumn("flags", F.array_join("guardrail_flags", ","))


@register("prc_7", "product_id flags", "SELECT * FROM t_decisions")
def _(r: Retail):
    return _flat(r.decisions)


@register("prc_8", "product_id revenue_uplift_estimate:4", "SELECT * FROM t_decisions")
def _(r: Retail):
    return r.decisions


_DECISION = ("product_id current_price:2 optimal_price:2 demand_probability:4 expected_margin:2 decision_rule competitor_price:2 "
             "competitor_price_delta:2 revenue_uplift_estimate:4 flags")


@register("prc_9", _DECISION, "SELECT * FROM t_decisions")
def _(r: Retail):
    return _flat(r.decisions)


@register("prc_10", "estimated_revenue_uplift:4 estimated_margin_improvement:4 estimated_conversion_improvement:4", """
  SELECT (r1 - r0) / greatest(r0, 1) AS estimated_revenue_uplift, (m1 - m0) / greatest(m0, 1) AS estimated_margin_improvement,
    (c1 - c0) / greatest(c0, 1e-6) AS estimated_conversion_improvement
  FROM (SELECT sum(price * u * h) AS r0, sum(o * u * p) AS r1, sum((price - cost) * u * h) AS m0, sum((o - cost) * u * p) AS m1, sum(h) AS c0, sum(p) AS c1
    FROM (SELECT *, greatest(observed_units, 1) AS u, historical_conversion_rate AS h, round(optimal_price, 2) AS o, round(demand_probability, 4) AS p FROM t_impact))""")
def _(r: Retail):
    ctx = pricing.contexts(pricing.impact_contexts(r.frame, r.catalog))
    return pricing.business_impact(pricing.choose(pricing.bounds(ctx)))


@register("prc_11", _DECISION, """
  SELECT * FROM t_decisions WHERE product_id IN (SELECT product_id FROM t_products ORDER BY round(demand_score, 6) DESC, product_id LIMIT 8)""")
def _(r: Retail):
    return _flat(pricing.optimise(r.offers.orderBy(F.desc(F.round("demand_score", 6)), "product_id").limit(8)))


_WHAT_IF = """
  SELECT vec_id AS product_id, coalesce(price, 100.0) AS price, coalesce(margin, 0.35) AS margin, competitor_price_base AS competitor_price,
    CAST(10 + label * 100 AS DOUBLE) AS inventory_level, coalesce(demand_score, 1.0) AS demand_score, 1.0 AS seasonality_factor,
    historical_conversion_rate, coalesce(price_elasticity_score, 1.0) AS price_elasticity_score, coalesce(rating, 4.0) AS rating
  FROM embeddings LEFT JOIN (SELECT * EXCLUDE (competitor_price), competitor_price AS competitor_price_base FROM t_offers) o ON o.product_id = vec_id"""


@register("prc_12", _DECISION, decided(chosen(bounded(
    f"SELECT * REPLACE (coalesce(competitor_price, price) AS competitor_price) FROM ({_WHAT_IF})"))))
def _(r: Retail):
    # The requests override the stock level of the stored features.
    overrides = r.table("embeddings").select(
        F.col("vec_id").alias("product_id"), (10 + F.col("label") * 100).cast("double").alias("inventory_level"))
    return _flat(pricing.optimise(pricing.with_overrides(r.offers, overrides)))


_PROB = propensity("'click'", "discount_percentage", "price_elasticity_score", "product_price", "competitor_price", "inventory_level", "rating",
                   "seasonality_factor", "0")
_IMPORTANT = ["competitor_price", "inventory_level", "seasonality_factor", "discount_percentage", "price_elasticity_score"]


def _importance_sql() -> str:
    from .oracle_tables import hash32
    loss = "avg(-(purchase_label * ln(p) + (1 - purchase_label) * ln(1 - p)))"
    parts = []
    for f in ["none", *_IMPORTANT]:
        swap = "*" if f == "none" else f"* REPLACE (d_{f} AS {f})"
        parts.append(f"SELECT '{f}' AS feature, {loss} AS loss FROM (SELECT purchase_label, {_PROB} AS p FROM (SELECT {swap} FROM paired))")
    donor = ", ".join(f"d.{f} AS d_{f}" for f in _IMPORTANT)
    return f"""
    WITH numbered AS (SELECT *, row_number() OVER (ORDER BY {hash32('event_id', seed='perm')}, event_id) - 1 AS pos, count(*) OVER () AS n FROM t_frame),
    paired AS (SELECT a.*, {donor} FROM numbered a JOIN numbered d ON a.pos = (d.pos + d.n // 2) % d.n),
    losses AS ({' UNION ALL '.join(parts)})
    SELECT feature, loss - (SELECT loss FROM losses WHERE feature = 'none') AS importance FROM losses WHERE feature <> 'none'"""


@register("prc_13", "feature importance:6", _importance_sql())
def _(r: Retail):
    return pricing.permutation_importance(r.frame, pricing.closed_form_score, _IMPORTANT, ["event_id"])


# --- forecasting ---------------------------------------------------------------------------------

_PANEL = "series_id date daily_sales:i seasonality_factor:3 holiday_flag:i promotion_flag:i"


@register("fct_1", _PANEL, "SELECT * FROM t_product_panel")
def _(r: Retail):
    return r.series("product")


@register("fct_2", "series_id date daily_sales:i day_index:i day_of_week:i month:i lag_7:4 rolling_7:4", f"""
  SELECT *, date - (SELECT min(date) FROM t_product_panel) AS day_index, date_part('isodow', date) - 1 AS day_of_week, month(date) AS month
  FROM ({lagged_of('t_product_panel', 'series_id')})""")
def _(r: Retail):
    series = r.sold_series("product")
    return forecast.supervised(forecast.dense_series(series.sold, series.entities), start=series.first)


@register("fct_3", "series_id rows:i mean_actual:4 mean_prediction:4 mae:4")
def _(r: Retail):
    """A forest of 180 trees, judged for each product on the days held out."""
    scored = forecast.scored_holdout(r.sold_series("product"), kind="forest", trees=180)
    return scored.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("daily_sales").alias("mean_actual"), F.avg("prediction").alias("mean_prediction"),
        F.avg(F.abs(F.col("daily_sales") - F.col("prediction"))).alias("mae"))


_FORECAST = "series_id category date predicted_demand:2"


@register("fct_4", _FORECAST, "SELECT * FROM t_series_forecast")
def _(r: Retail):
    return forecast.forecast_naive(r.sold_series("product").tail(14), 30)


@register("fct_4_model", _FORECAST)
def _(r: Retail):
    series = r.sold_series("product")
    return forecast.forecast_model(series.tail(14), forecast.fit_series(series), 30, series.first)


@register("fct_5", "category date predicted_demand:2", """
  SELECT category, date, sum(predicted_demand) AS predicted_demand FROM t_product_forecast GROUP BY ALL""")
def _(r: Retail):
    return forecast.forecast_by_category(forecast.forecast_naive(r.recent_demand, 30, "product_id"), key="product_id")


@register("fct_6", "baseline_mae:3 baseline_rmse:3 baseline_wape:4", naive_sql("t_product_panel", "series_id"))
def _(r: Retail):
    return forecast.seasonal_naive(r.sold_series("product"))


@register("fct_7", "mae:3 rmse:3 mape:4 wape:4")
def _(r: Retail):
    return forecast.evaluate_model(r.sold_series("product"))


@register("fct_8", "mae:3 rmse:3 mape:4 wape:4", f"""
  SELECT avg(abs(daily_sales - rolling_7)) AS mae, sqrt(avg((daily_sales - rolling_7) ** 2)) AS rmse,
    avg(abs(daily_sales - rolling_7) / greatest(abs(daily_sales), 1)) AS mape, sum(abs(daily_sales - rolling_7)) / greatest(sum(abs(daily_sales)), 1) AS wape
  FROM ({lagged_of('t_product_panel', 'series_id')})""")
def _(r: Retail):
    return forecast.errors(forecast.supervised(r.dense_series("product")), predicted="rolling_7")


@register("fct_9", "horizon:i series_id date predicted_demand:2", """
  SELECT 7 AS horizon, * FROM t_series_forecast WHERE date <= (SELECT max(date) + 7 FROM t_product_panel) UNION ALL SELECT 30 AS horizon, * FROM t_series_forecast""")
def _(r: Retail):
    panel = r.sold_series("product").tail(14)
    return reduce(DataFrame.unionByName, [forecast.forecast_naive(panel, h).withColumn("horizon", F.lit(h)) for h in (7, 30)])


# --- segments ------------------------------------------------------------------------------------

@register("seg_1", "user_id " + " ".join(f"z_{c}:6" for c in K.SEGMENT_FEATURES), "SELECT user_id, " + ", ".join(
    f"({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 ELSE stddev_pop({c}) OVER () END AS z_{c}"
    for c in K.SEGMENT_FEATURES) + " FROM t_users")
def _(r: Retail):
    return segments.standardised(r.users)


@register("seg_2", "behavior_cluster:i users:i")
def _(r: Retail):
    users = features.user_features(r.clean_table)
    model = segments.fit_clusters(users)
    return segments.with_clusters(users, model).groupBy("behavior_cluster").agg(F.count(F.lit(1)).alias("users"))


@register("seg_3", "user_id customer_segment", "SELECT * FROM t_segments")
def _(r: Retail):
    return r.segments


@register("seg_4", "user_id retention_signal", "SELECT * FROM t_segments")
def _(r: Retail):
    return r.segments


_SEGMENT = "user_id customer_segment churn_risk:4 ltv_estimate:2 conversion_rate:4 retention_signal"


@register("seg_5", _SEGMENT, """
  SELECT c_custkey AS user_id, coalesce(customer_segment, 'unknown') AS customer_segment, coalesce(churn_risk, 0) AS churn_risk,
    coalesce(ltv_estimate, 0) AS ltv_estimate, conversion_rate, coalesce(retention_signal, 'insufficient_history') AS retention_signal
  FROM customer LEFT JOIN t_segments ON user_id = c_custkey""")
def _(r: Retail):
    requests = r.table("customer").select(F.col("c_custkey").alias("user_id"))
    return segments.lookup_segments(requests, r.segments)


@register("seg_6", "customer_segment users:i conversion_rate:6 aov:4 ltv_estimate:4 churn_risk:6", "SELECT * FROM t_segment_summary")
def _(r: Retail):
    return segments.summary(r.segments)


@register("seg_7", _SEGMENT, """
  SELECT c_custkey AS user_id, customer_segment, churn_risk, ltv_estimate, conversion_rate,
    CASE WHEN churn_risk < 0.35 THEN 'healthy' ELSE 'save_offer' END AS retention_signal
  FROM customer, (SELECT * FROM t_segment_summary ORDER BY users DESC, customer_segment LIMIT 1)
  WHERE c_custkey NOT IN (SELECT user_id FROM t_segments)""")
def _(r: Retail):
    requests = r.table("customer").select(F.col("c_custkey").alias("user_id"))
    return segments.fallback_segments(requests, r.segments)


# --- feature store -------------------------------------------------------------------------------

def _store(r: Retail) -> FeatureStore:
    return FeatureStore(r.spark, fresh_path(r.spark, "feature-store"))


@register("fst_1", "user_id total_events:i total_revenue:4 churn_risk:6", "SELECT * FROM t_users")
def _(r: Retail):
    store = _store(r)
    store.materialize([FeatureTable("user_features", r.users, "user_id")])
    return store.read("user_features")


_HISTORY = "valid_from views_before:i clicks_before:i purchases_before:i revenue_before:4 ctr_before:6 conversion_before:6"


@register("fst_1_history", f"product_id {_HISTORY}", "SELECT * FROM t_history")
def _(r: Retail):
    """The versions of the product counts, through the store."""
    store = _store(r)
    store.materialize([FeatureTable("product_history", features.product_history(r.clean_table), "product_id", "valid_from")])
    return store.read("product_history")


@register("jn_9_as_of", f"event_id product_id purchase_label:i {_HISTORY}", """
  SELECT event_id, c.product_id, purchase_label, h.* EXCLUDE (product_id)
  FROM t_clean c ASOF LEFT JOIN t_history h ON c.product_id = h.product_id AND c.timestamp >= h.valid_from""")
def _(r: Retail):
    """Labelled events with the product counts as they stood at the event: nothing from its own day or later."""
    history = features.product_history(r.clean_table)
    rows = r.clean_table.select("event_id", "product_id", "timestamp", "purchase_label")
    values = [c for c in history.columns if c not in ("product_id", "valid_from")]
    return asof.as_of_join(rows, history, "product_id", "timestamp", "valid_from", values, "event_id")


@register("fst_2", "product_id event_id discount_percentage:6 demand_score:6", """
  SELECT f.product_id, event_id, f.discount_percentage, demand_score FROM t_frame f JOIN (SELECT event_id, timestamp FROM t_clean) USING (event_id)
  QUALIFY row_number() OVER (PARTITION BY f.product_id ORDER BY timestamp DESC, event_id DESC) = 1""")
def _(r: Retail):
    frame = r.frame.join(r.clean.select("event_id", "timestamp"), "event_id")
    return latest_per_entity(frame, "product_id", ["timestamp", "event_id"])


@register("fst_2_bucketed", "product_id category views:i current_price:4 margin_pricing:4 inventory_level_inventory:4 reorder_point:i", """
  SELECT p.product_id, category, views, current_price, q.margin AS margin_pricing, i.inventory_level AS inventory_level_inventory, reorder_point
  FROM t_products p LEFT JOIN t_pricing q ON q.product_id = p.product_id LEFT JOIN t_inventory i ON i.product_id = p.product_id""")
def _(r: Retail):
    """Three feature tables of the products, bucketed alike, joined where they lie."""
    store = _store(r)
    products, pricing_table, stock = (
        store.materialize_bucketed(FeatureTable(n, df, "product_id"), 8) for n, df in (("products", r.products), ("pricing", r.pricing), ("inventory", r.inventory)))
    return features.with_inventory(features.with_pricing(products, pricing_table), stock)


@register("fst_3", "name version entity row_count:i feature_count:i", """
  SELECT 'user_features' AS name, 'v1' AS version, 'user_id' AS entity, (SELECT count(*) FROM t_users) AS row_count, 20 AS feature_count
  UNION ALL SELECT 'product_features', 'v1', 'product_id', (SELECT count(*) FROM t_products), 22
  UNION ALL SELECT 'inventory_features', 'v1', 'product_id', (SELECT count(*) FROM t_inventory), 12""")
def _(r: Retail):
    return _store(r).materialize([
        FeatureTable("user_features", r.users, "user_id"),
        FeatureTable("product_features", r.products, "product_id"),
        FeatureTable("inventory_features", features.inventory_features(r.inventory, r.products), "product_id"),
    ])


@register("fst_4", "name age_minutes:4 status", """
  SELECT name, (epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(t)) / 6e7 AS age_minutes,
    CASE WHEN (epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(t)) / 6e7 <= 2880 THEN 'fresh' ELSE 'stale' END AS status
  FROM (SELECT 'user_features' AS name, max(timestamp) AS t FROM t_clean UNION ALL SELECT 'inventory_features', max(l_shipdate) FROM lineitem)""")
def _(r: Retail):
    newest = {
        "user_features": r.clean.agg(F.max("timestamp").alias("newest_event")),
        "inventory_features": r.table("lineitem").agg(F.max("l_shipdate").alias("newest_event")),
    }
    rows = reduce(DataFrame.unionByName, [df.select(F.lit(n).alias("name"), "newest_event") for n, df in newest.items()])
    return freshness(rows, F.lit("2024-02-01 00:00:00"), 2880)


# --- monitoring ----------------------------------------------------------------------------------

@register("mon_1", "date clickstream_volume:i browsing_volume:i", """
  SELECT CAST(timestamp AS DATE) AS date, count(*) AS clickstream_volume, count(*) FILTER (event_type IN ('view', 'click')) AS browsing_volume
  FROM t_clean GROUP BY ALL""")
def _(r: Retail):
    return monitor.daily_volumes(r.clean)


def _windows(r: Retail, events: DataFrame) -> DataFrame:
    """Second half of the month against the first."""
    return monitor.split_windows(events, F.lit("2024-01-16").cast("timestamp_ntz"))


_EDGES = "(SELECT quantile_cont(dwell_time_seconds, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) FROM t_clean WHERE timestamp < TIMESTAMP '2024-01-16')"


def _psi_sql(bucket: str, source: str) -> str:
    return f"""
    SELECT sum((c - r) * ln(c / r)) AS psi FROM (
      SELECT greatest(count(*) FILTER (cur) / greatest(sum(count(*) FILTER (cur)) OVER (), 1), 1e-4) AS c,
        greatest(count(*) FILTER (NOT cur) / greatest(sum(count(*) FILTER (NOT cur)) OVER (), 1), 1e-4) AS r
      FROM (SELECT {bucket} AS bucket, cur FROM {source}) GROUP BY bucket)"""


_NUMERIC_PSI = _psi_sql(f"len(list_filter({_EDGES}, lambda e: dwell_time_seconds > e))", "(SELECT *, timestamp >= TIMESTAMP '2024-01-16' AS cur FROM t_clean)")
_RECOMMENDED_PSI = _psi_sql("product_category", """(
  SELECT product_category, false AS cur FROM t_train_recommended UNION ALL SELECT product_category, true FROM t_recommended)""")


@register("mon_2", "psi:6", _NUMERIC_PSI)
def _(r: Retail):
    return monitor.numeric_psi(_windows(r, r.clean_table), "dwell_time_seconds")


_SKETCH_CUT = dt.date(2024, 1, 16)
_BUCKET = f"""CASE WHEN dwell_time_seconds < {daily_sketch.SMALLEST} THEN 0
  ELSE CAST(ceil(ln(dwell_time_seconds) / CAST({daily_sketch.RATIO!r} AS DOUBLE)) AS BIGINT) + {daily_sketch.OFFSET} END"""
_SKETCHED = f"(SELECT {_BUCKET} AS b, timestamp >= TIMESTAMP '{_SKETCH_CUT}' AS cur FROM t_clean)"
_SKETCH_EDGES = "list_value(" + ", ".join(
    f"(SELECT min(b) FROM (SELECT b, sum(count(*)) OVER (ORDER BY b) AS upto, sum(count(*)) OVER () AS n FROM {_SKETCHED} WHERE NOT cur GROUP BY b) WHERE upto > ({i} * (n - 1)) // 10)"
    for i in range(1, 10)) + ")"


def _daily_sketches(r: Retail) -> daily_sketch.DailySketches:
    """Two updates, as on two days: the second reads only what the first has not."""
    sketches = daily_sketch.DailySketches(r.spark, fresh_path(r.spark, "sketches"), ["dwell_time_seconds", "product_price"], ["user_id", "product_id"])
    sketches.update(r.clean_table, _SKETCH_CUT)
    newest = r.clean_table.agg(F.max(F.col("timestamp").cast("date")).alias("d")).first().d
    sketches.update(r.clean_table, max(_SKETCH_CUT, newest or _SKETCH_CUT) + dt.timedelta(days=1))
    return sketches


@register("mon_2_daily", "psi:6", f"""
  WITH e AS (SELECT {_SKETCH_EDGES} AS edges)
  {_psi_sql("len(list_filter(edges, lambda e: b > e))", f"{_SKETCHED}, e")}""")
def _(r: Retail):
    """The drift of mon_2 from sketches of days, within their accuracy; stored days are not read again."""
    return _daily_sketches(r).psi("dwell_time_seconds", _SKETCH_CUT)


@register("mon_3", "feature psi:6 drift_status overall", f"""
  SELECT *, CASE WHEN psi > 0.28 THEN 'watch' ELSE 'stable' END AS drift_status,
    CASE WHEN bool_or(psi > 0.28) OVER () THEN 'watch' ELSE 'stable' END AS overall
  FROM (SELECT 'dwell_time_seconds' AS feature, psi FROM ({_NUMERIC_PSI}) UNION ALL SELECT 'event_type', psi FROM (
    {_psi_sql('event_type', "(SELECT *, timestamp >= TIMESTAMP '2024-01-16' AS cur FROM t_clean)")}))""")
def _(r: Retail):
    marked = _windows(r, r.clean_table)
    drift = monitor.numeric_psi(marked, "dwell_time_seconds").withColumn("feature", F.lit("dwell_time_seconds")).unionByName(
        monitor.category_psi(marked, "event_type").withColumn("feature", F.lit("event_type")))
    drift = drift.withColumn("drift_status", monitor.drift_status("psi"))
    return drift.withColumn("overall", monitor.overall_status(drift).scalar())


@register("mon_4", "psi:6", _RECOMMENDED_PSI)
def _(r: Retail):
    before = r.recommendations(r.split[0]).select("product_category", F.lit(False).alias("is_current"))
    now = r.recommendations(r.clean_table).select("product_category", F.lit(True).alias("is_current"))
    return monitor.category_psi(before.unionByName(now), "product_category")


@register("mon_5", "date rate:6 conversion_trend:6", """
  SELECT date, rate, avg(rate) OVER (ORDER BY date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS conversion_trend
  FROM (SELECT CAST(timestamp AS DATE) AS date, avg(purchase_label) AS rate FROM t_clean GROUP BY ALL)""")
def _(r: Retail):
    return monitor.conversion_trend(r.clean)


@register("mon_6", "date data_quality_issues:i", """
  SELECT CAST(timestamp AS DATE) AS date, sum(CAST(event_type NOT IN ('view', 'click', 'add_to_cart', 'purchase', 'search') AS INTEGER)
    + CAST(coalesce(product_price < 0, false) AS INTEGER) + CAST(coalesce(discount_percentage < 0 OR discount_percentage > 0.9, false) AS INTEGER)
    + CAST(coalesce(rating < 1 OR rating > 5, false) AS INTEGER)) AS data_quality_issues FROM t_raw GROUP BY ALL""")
def _(r: Retail):
    return monitor.quality_issues(r.raw)


@register("mon_7", "date flag violations:i", """
  SELECT date, flag, count(*) AS violations FROM (SELECT date, unnest(string_split(flags, ',')) AS flag FROM t_day_decisions)
  WHERE flag <> 'passed' GROUP BY ALL""")
def _(r: Retail):
    offers = r.demand.withColumn("season", F.col("seasonality_factor")).select(
        "product_id", "date", S.event_demand_score("daily_sales", "season").alias("demand_score"), "seasonality_factor",
    )
    # A product's days of equal demand and season are one offer: its price is chosen once and counts on each of them.
    offers = offers.groupBy("product_id", "demand_score", "seasonality_factor").agg(F.collect_list(F.struct("date")).alias("days")).join(r.catalog, "product_id")
    chosen_days = pricing.choose(pricing.bounds(pricing.contexts(offers))).select("days", pricing.guardrails().alias("guardrail_flags"))
    return monitor.guardrail_violations(chosen_days.select(F.inline("days"), "guardrail_flags"))


@register("mon_8", "event_group date event_volume:i average_value:4 mean_value:2 total_volume:i", f"""
  SELECT *, (SELECT avg(average_value) FROM t_group_volumes) AS mean_value, (SELECT sum(event_volume) FROM t_group_volumes) AS total_volume FROM ({_LATEST})""")
def _(r: Retail):
    totals = monitor.volume_totals(group_volumes(r)).select(F.struct("mean_value", "total_volume").alias("t")).scalar()
    return monitor.latest_per_group(group_volumes(r)).withColumns({
        "mean_value": totals["mean_value"], "total_volume": totals["total_volume"]})


# --- the whole summary ---------------------------------------------------------------------------

@register("dsh_1", "section rows:i document_bytes:i")
def _(r: Retail):
    return summary.executive_summary(r).select("section", "rows", F.length("document").alias("document_bytes"))


@register("dsh_1_kpis", _KPI_COLUMNS, _KPI_SQL)
def _(r: Retail):
    document = summary.executive_summary(r, ["kpis"])
    fields = ", ".join(f"{c.partition(':')[0]} double" for c in _KPI_COLUMNS.split())
    parsed = F.from_json("document", f"array<struct<{fields}>>")
    return document.select(F.explode(parsed).alias("k")).select("k.*")
