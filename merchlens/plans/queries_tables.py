"""Queries over joins, aggregates, windows, top-k, set operations, samples and splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import constants as K
from ..functions import scalars as S
from ..operators import evaluation, features, forecast, kpis, monitor, ordering, pricing, ranking, retrieval, sampling, segments
from ..sources import bindings
from .oracle_tables import SCORE, WEIGHT, case, hash32
from .registry import QUERIES, register
from .tables import Retail

# --- joins ---------------------------------------------------------------------------------------

_PRODUCT = ("product_id category brand price:4 views:i clicks:i cart_additions:i purchases:i revenue:4 avg_discount:6 inventory_level:4 "
            "ctr:6 conversion_rate:6 demand_score:6 competitor_price_index:6")


@register("jn_1", "product_id category views:i purchases:i revenue:4 inventory_level:4", "SELECT * FROM t_products")
def _(r: Retail):
    return r.products


@register("jn_2", "product_id category current_price:4 competitor_price:4 competitor_price_pricing:4 margin:4 margin_pricing:4 minimum_margin_threshold:4", """
  SELECT p.product_id, category, current_price, p.competitor_price, q.competitor_price AS competitor_price_pricing, p.margin,
    q.margin AS margin_pricing, minimum_margin_threshold FROM t_products p LEFT JOIN t_pricing q ON q.product_id = p.product_id""")
def _(r: Retail):
    return features.with_pricing(r.products, r.pricing)


@register("jn_3", "product_id inventory_level:4 inventory_level_inventory:4 reorder_point:i stockout_flag:i inventory_risk", """
  SELECT p.product_id, p.inventory_level, q.inventory_level AS inventory_level_inventory, reorder_point, stockout_flag, inventory_risk
  FROM t_products p LEFT JOIN t_inventory q ON q.product_id = p.product_id""")
def _(r: Retail):
    return features.with_inventory(r.products, r.inventory)


@register("jn_4", "product_id category inventory_level:4 demand_score:6 conversion_rate:6 purchases:i", "SELECT * FROM t_inventory_features")
def _(r: Retail):
    return features.inventory_features(r.inventory, r.products)


@register("jn_5", "event_id product_id daily_sales:i purchase_label:i", "SELECT * FROM t_frame")
def _(r: Retail):
    return r.frame


@register("jn_6", "event_id product_id margin:4 price_elasticity_score:4", "SELECT * FROM t_frame")
def _(r: Retail):
    return r.frame


@register("jn_7", "event_id margin:4 margin_amount:4", """
  SELECT event_id, coalesce(margin, 0.35) AS margin, product_price * (1 - discount_percentage) * purchase_label * coalesce(margin, 0.35) AS margin_amount
  FROM t_clean c LEFT JOIN (SELECT product_id, margin FROM t_catalog) m ON m.product_id = c.product_id""")
def _(r: Retail):
    return kpis.with_margin(r.clean, r.catalog).withColumn("margin_amount", kpis.net_revenue() * F.col("margin"))


@register("jn_8", "product_id price:4 competitor_price:4 demand_score:6 historical_conversion_rate:6 observed_units:i", """
  SELECT * FROM (SELECT product_id, price FROM t_catalog) JOIN t_stats USING (product_id)""")
def _(r: Retail):
    return pricing.impact_contexts(r.frame, r.catalog)


@register("jn_9", "event_id product_id brand price:4 demand_score:6 category_match:i", """
  SELECT event_id, c.product_id, p.brand, p.price, demand_score, CAST(coalesce(c.product_category = dominant_category, false) AS INTEGER) AS category_match
  FROM t_clean c LEFT JOIN t_products p ON p.product_id = c.product_id LEFT JOIN t_users u ON u.user_id = c.user_id""")
def _(r: Retail):
    return ranking.enrich(r.clean.select("event_id", "user_id", "product_id"), r.products, r.users)


@register("jn_10", "user_id product_id rank:i retrieval_score:5 category brand price:4 inventory_level:4", "SELECT * FROM t_enriched")
def _(r: Retail):
    return ranking.enrich(r.candidates(r.clean_table), r.products, r.users)


@register("jn_11", "user_id total_events:i views:i clicks:i cart_additions:i purchases:i search:i total_revenue:4", "SELECT * FROM t_users")
def _(r: Retail):
    return features.user_totals(features.user_product_cells(r.clean))


@register("jn_12", "event_id user_id dominant_category", """
  SELECT event_id, c.user_id, dominant_category FROM t_clean c LEFT JOIN t_users u ON u.user_id = c.user_id""")
def _(r: Retail):
    dominant = features.dominant_category(features.category_affinity(features.user_product_cells(r.clean)))
    return r.clean.join(dominant, "user_id", "left")


@register("jn_13", "event_id user_id product_id", """
  SELECT event_id, user_id, product_id FROM t_raw WHERE user_id IN (SELECT c_custkey FROM customer) AND product_id IN (SELECT vec_id FROM embeddings)""")
def _(r: Retail):
    return sampling.known_pairs(r.raw, bindings.user_profiles(r.spark, r.folder), r.items)


@register("jn_14", "user_id product_id rank:i", "SELECT * FROM t_candidates")
def _(r: Retail):
    return r.candidates(r.clean_table)


def _unseen_draws() -> str:
    h = hash32("user_id", "event_id", seed="42")
    return f"""
    WITH ids AS (SELECT product_id, row_number() OVER (ORDER BY product_id) - 1 AS idx FROM t_catalog),
    seen AS (SELECT DISTINCT user_id, product_id FROM t_clean),
    pool AS (SELECT user_id, list(idx ORDER BY idx) AS free FROM (SELECT DISTINCT user_id FROM t_clean) u, ids
      WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = u.user_id AND s.product_id = ids.product_id) GROUP BY user_id)
    SELECT user_id, event_id, draw, product_id FROM (
      SELECT user_id, event_id, g.j AS draw, free[1 + ({h} % len(free) + g.j * greatest(len(free) // 2, 1)) % len(free)] AS idx
      FROM t_clean JOIN pool USING (user_id), range(2) g(j)) JOIN ids USING (idx)"""


@register("jn_15", "user_id event_id draw:i product_id", _unseen_draws())
def _(r: Retail):
    return sampling.negatives(r.clean_table, features.seen_items(r.clean_table), r.catalog)


@register("jn_16", "user_id product_id retrieval_score:5 rank:i", "SELECT * FROM t_candidates")
def _(r: Retail):
    # A bound of zero bytes takes the blocked path: user blocks meet item blocks.
    users = retrieval.user_vectors(features.interactions(r.clean_table), r.items)
    return retrieval.retrieve(users, r.items, features.seen_items(r.clean_table), broadcast_bytes=0)


@register("jn_17", "product_id date daily_sales:i", "SELECT * FROM t_demand")
def _(r: Retail):
    return r.demand


@register("jn_18", "product_id category price:4 optimal_price:2 decision_rule times_recommended:i best_rank:i", """
  SELECT product_id, category, price, optimal_price, decision_rule, coalesce(n, 0) AS times_recommended, best_rank FROM t_products
  LEFT JOIN t_decisions USING (product_id)
  LEFT JOIN (SELECT product_id, count(*) AS n, min(rank) AS best_rank FROM t_recommended GROUP BY product_id) USING (product_id)""")
def _(r: Retail):
    return kpis.product_insights(r.products, r.decisions, r.recommendations(r.clean_table))


# --- aggregates ----------------------------------------------------------------------------------

@register("agg_1", "user_id views:i clicks:i cart_additions:i purchases:i search:i", "SELECT * FROM t_users")
def _(r: Retail):
    return features.event_type_counts(r.clean)


@register("agg_2", "user_id total_events:i total_revenue:4 avg_discount_seen:6 avg_price_seen:4 unique_products:i last_event_ts", "SELECT * FROM t_users")
def _(r: Retail):
    return features.user_totals(features.user_product_cells(r.clean))


@register("agg_3", "user_id product_category score:4 affinity:4", "SELECT * FROM t_affinity")
def _(r: Retail):
    return features.category_affinity(features.user_product_cells(r.clean))


@register("agg_4", "user_id dominant_category", "SELECT * FROM t_users")
def _(r: Retail):
    return features.dominant_category(features.category_affinity(features.user_product_cells(r.clean)))


@register("agg_5", "user_id days_since_last_event:i", "SELECT * FROM t_users")
def _(r: Retail):
    return features.days_since_last(features.user_totals(features.user_product_cells(r.clean)), r.clean)


@register("agg_6", "user_id total_events:i total_revenue:4 avg_discount_seen:6 avg_price_seen:4 unique_products:i last_event_ts views:i clicks:i "
          "cart_additions:i purchases:i search:i ctr:6 conversion_rate:6 aov:4 ltv_estimate:4 affinity_text dominant_category "
          "days_since_last_event:i churn_risk:6", "SELECT * FROM t_users")
def _(r: Retail):
    # The map is compared as text: category=share in ten-thousandths.
    text = F.transform(F.map_entries("category_affinity"), lambda e: F.concat(
        e["key"], F.lit("="), F.round(e["value"] * 10000).cast("bigint").cast("string")))
    return r.users.withColumn("affinity_text", F.array_join(F.array_sort(text), ","))


@register("agg_7", "product_id views:i clicks:i cart_additions:i purchases:i revenue:4 avg_discount:6 event_competitor_price:4 event_inventory:4", """
  SELECT product_id, views, clicks, cart_additions, purchases, revenue, avg_discount, competitor_price AS event_competitor_price,
    inventory_level AS event_inventory FROM t_products WHERE product_id IN (SELECT product_id FROM t_clean)""")
def _(r: Retail):
    return features.product_aggregates(r.clean)


@register("agg_8", _PRODUCT, "SELECT * FROM t_products")
def _(r: Retail):
    return r.products


@register("agg_9", "user_id product_id score:4",
          f"SELECT user_id, product_id, sum({case(SCORE, 'event_type', 0.0)}) AS score FROM t_clean GROUP BY ALL")
def _(r: Retail):
    return features.interactions(r.clean)


@register("agg_10", "user_id product_id", "SELECT DISTINCT user_id, product_id FROM t_clean")
def _(r: Retail):
    return features.seen_items(r.clean)


@register("agg_11", "product_id product_category competitor_price:4 inventory_level:4 demand_score:6 seasonality_factor:6 discount_percentage:6 "
          "historical_conversion_rate:6 observed_units:i", "SELECT * FROM t_stats")
def _(r: Retail):
    return pricing.product_stats(r.frame)


_REPEAT = "(SELECT coalesce(avg(CAST(n > 1 AS INTEGER)), 0) FROM (SELECT count(*) AS n FROM t_clean WHERE purchase_label = 1 GROUP BY user_id))"
_KPI_COLUMNS = ("total_users:i total_products:i total_sessions:i total_revenue:2 total_margin:2 ctr:4 conversion_rate:4 average_order_value:2 "
                "stockout_rate:4 return_rate:4 repeat_purchase_rate:4 customer_lifetime_value_estimate:2")
_KPI_SQL = f"""
  SELECT (SELECT count(DISTINCT user_id) FROM t_clean) AS total_users, (SELECT count(DISTINCT product_id) FROM t_catalog) AS total_products,
    (SELECT count(DISTINCT derived_session_id) FROM t_sess) AS total_sessions, revenue AS total_revenue,
    (SELECT sum(product_price * (1 - discount_percentage) * purchase_label * coalesce(margin, 0.35)) FROM t_clean c
      LEFT JOIN (SELECT product_id, margin FROM t_catalog) m ON m.product_id = c.product_id) AS total_margin,
    clicks / greatest(views, 1) AS ctr, purchases / greatest(views, 1) AS conversion_rate, revenue / greatest(purchases, 1) AS average_order_value,
    (SELECT avg(stockout_flag) FROM t_inventory) AS stockout_rate, returns / greatest(purchases, 1) AS return_rate, {_REPEAT} AS repeat_purchase_rate,
    (SELECT avg(ltv_estimate) FROM t_users) AS customer_lifetime_value_estimate
  FROM (SELECT sum(product_price * (1 - discount_percentage) * purchase_label) AS revenue, sum(purchase_label) AS purchases,
    sum(return_label) AS returns, count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'click') AS clicks FROM t_clean)"""


@register("agg_12", _KPI_COLUMNS, _KPI_SQL)
def _(r: Retail):
    users = features.user_features(r.clean_table)
    return kpis.executive_kpis(r.session_table, r.catalog, users, r.inventory, "derived_session_id")


@register("agg_13", "repeat_purchase_rate:6", f"SELECT {_REPEAT} AS repeat_purchase_rate")
def _(r: Retail):
    return kpis.repeat_purchase_rate(r.clean)


@register("agg_14", "date revenue:4 margin:4 purchases:i ctr:6 purchase_rate:6", """
  SELECT CAST(timestamp AS DATE) AS date, sum(product_price * (1 - discount_percentage) * purchase_label) AS revenue,
    sum(product_price * (1 - discount_percentage) * purchase_label * coalesce(margin, 0.35)) AS margin, sum(purchase_label) AS purchases,
    count(*) FILTER (event_type = 'click') / greatest(count(*) FILTER (event_type = 'view'), 1) AS ctr, avg(purchase_label) AS purchase_rate
  FROM t_clean c LEFT JOIN (SELECT product_id, margin FROM t_catalog) m ON m.product_id = c.product_id GROUP BY ALL ORDER BY 1 DESC LIMIT 45""")
def _(r: Retail):
    return kpis.revenue_trend(r.clean, r.catalog)


@register("agg_15", "product_category revenue:4 purchases:i views:i purchase_rate:6", """
  SELECT product_category, sum(product_price * (1 - discount_percentage) * purchase_label) AS revenue, sum(purchase_label) AS purchases,
    count(*) FILTER (event_type = 'view') AS views, avg(purchase_label) AS purchase_rate FROM t_clean GROUP BY product_category ORDER BY revenue DESC""")
def _(r: Retail):
    return kpis.category_performance(r.clean).orderBy(F.desc("revenue"))


@register("agg_14_15", "level date product_category revenue:4 margin:4 purchases:i views:i ctr:6 purchase_rate:6", """
  SELECT CASE grouping_id(date, product_category) WHEN 1 THEN 'day' WHEN 2 THEN 'category' ELSE 'total' END AS level, date, product_category,
    sum(net) AS revenue, sum(net * coalesce(margin, 0.35)) AS margin, sum(purchase_label) AS purchases, count(*) FILTER (event_type = 'view') AS views,
    count(*) FILTER (event_type = 'click') / greatest(count(*) FILTER (event_type = 'view'), 1) AS ctr, avg(purchase_label) AS purchase_rate
  FROM (SELECT CAST(timestamp AS DATE) AS date, product_category, product_price * (1 - discount_percentage) * purchase_label AS net, m.margin, purchase_label, event_type
    FROM t_clean c LEFT JOIN (SELECT product_id, margin FROM t_catalog) m ON m.product_id = c.product_id)
  GROUP BY GROUPING SETS ((date), (product_category), ())""")
def _(r: Retail):
    return kpis.day_and_category(r.clean, r.catalog)


@register("agg_15_sales", "product_category revenue:4 margin:4 units:2 purchases:i return_rate:6", """
  SELECT product_category, sum(product_price * (1 - discount_percentage)) AS revenue, sum(product_price * (1 - discount_percentage) * margin) AS margin,
    sum(quantity) AS units, count(*) AS purchases, count(*) FILTER (l_returnflag = 'R') / count(*) AS return_rate
  FROM t_sales GROUP BY product_category ORDER BY revenue DESC""")
def _(r: Retail):
    return kpis.category_sales(r.table("lineitem"), r.catalog).orderBy(F.desc("revenue"))


@register("agg_16", "stockout_risk_bucket products:i", "SELECT stockout_risk_bucket, count(*) AS products FROM t_inventory_features GROUP BY ALL")
def _(r: Retail):
    return kpis.inventory_risk(features.inventory_features(r.inventory, r.products))


@register("agg_17", "category daily_sales:i promo_days:i",
          "SELECT category, sum(daily_sales) AS daily_sales, sum(promotion_flag) AS promo_days FROM t_demand GROUP BY category")
def _(r: Retail):
    return kpis.demand_summary(r.demand)


_SUMMARY = "customer_segment users:i conversion_rate:6 aov:4 ltv_estimate:4 churn_risk:6"


@register("agg_18", _SUMMARY, "SELECT * FROM t_segment_summary ORDER BY users DESC")
def _(r: Retail):
    return segments.summary(r.segments).orderBy(F.desc("users"))


@register("agg_19", "product_id inventory_level:i reorder_point:i demand_forecast:4 stockout_flag:i inventory_risk", "SELECT * FROM t_inventory")
def _(r: Retail):
    return r.inventory


_NAIVE = """
  SELECT avg(abs(daily_sales - lag_7)) AS baseline_mae, sqrt(avg((daily_sales - lag_7) ** 2)) AS baseline_rmse,
    sum(abs(daily_sales - lag_7)) / greatest(sum(abs(daily_sales)), 1) AS baseline_wape
  FROM ({lagged}) WHERE date > (SELECT max(date) - 21 FROM {panel})"""


def naive_sql(panel: str, key: str) -> str:
    from .oracle_tables import lagged_of
    return _NAIVE.format(lagged=lagged_of(panel, key), panel=panel)


@register("agg_20", "model catalog_coverage:4 diversity:4 estimated_revenue_uplift:4 baseline_wape:4", f"""
  SELECT 'two_stage_recommender' AS model, (SELECT count(DISTINCT product_id) FROM t_recommended) / (SELECT count(*) FROM t_catalog) AS catalog_coverage,
    (SELECT count(DISTINCT product_category) / count(*) FROM t_recommended) AS diversity, NULL AS estimated_revenue_uplift, NULL AS baseline_wape
  UNION ALL SELECT 'dynamic_pricing', NULL, NULL, (SELECT estimated_revenue_uplift FROM ({'{impact}'})), NULL
  UNION ALL SELECT 'demand_forecaster', NULL, NULL, NULL, (SELECT baseline_wape FROM ({naive_sql('t_cat_panel', 'series_id')}))""".replace("{impact}", """
    SELECT (sum(round(optimal_price, 2) * greatest(observed_units, 1) * round(demand_probability, 4)) - sum(price * greatest(observed_units, 1) * historical_conversion_rate))
      / greatest(sum(price * greatest(observed_units, 1) * historical_conversion_rate), 1) AS estimated_revenue_uplift FROM t_impact"""))
def _(r: Retail):
    recs = r.recommendations(r.clean_table)
    shares = recs.agg((F.count_distinct("product_category") / F.count(F.lit(1))).alias("diversity")).withColumn(
        "catalog_coverage", evaluation.catalog_coverage(recs, r.catalog).scalar())
    impact = pricing.business_impact(pricing.choose(pricing.bounds(pricing.contexts(pricing.impact_contexts(r.frame, r.catalog)))))
    return kpis.model_metrics({
        "two_stage_recommender": shares, "dynamic_pricing": impact, "demand_forecaster": forecast.seasonal_naive(r.sold_series()),
    })


# --- windows -------------------------------------------------------------------------------------

@register("win_1", "event_id pause_seconds:6", """
  SELECT event_id, (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER (PARTITION BY user_id ORDER BY timestamp, event_id))) / 1e6 AS pause_seconds FROM t_clean""")
def _(r: Retail):
    from ..operators import sessions
    return sessions.pauses(r.clean)


@register("win_2", "event_id events_so_far:i score_so_far:4", f"""
  SELECT event_id, row_number() OVER w AS events_so_far, sum({case(SCORE, 'event_type', 0.0)}) OVER w AS score_so_far FROM t_clean
  WINDOW w AS (PARTITION BY user_id ORDER BY timestamp, event_id ROWS UNBOUNDED PRECEDING)""")
def _(r: Retail):
    blocked = r.clean.withColumn("hour", F.date_trunc("hour", "timestamp"))
    counted = ordering.running_total(blocked, ["user_id"], "hour", ["timestamp", "event_id"], F.lit(1), "events_so_far")
    return ordering.running_total(counted, ["user_id"], "hour", ["timestamp", "event_id"], S.event_score(), "score_so_far")


@register("win_3", "user_id product_category affinity:4", "SELECT * FROM t_affinity")
def _(r: Retail):
    return features.category_affinity(features.user_product_cells(r.clean))


@register("win_4", "event_id historical_conversion_rate:6", "SELECT * FROM t_frame")
def _(r: Retail):
    return r.frame


def lagged_sql(panel: str, key: str) -> str:
    from .oracle_tables import lagged_of
    return lagged_of(panel, key)


@register("win_5", "series_id date lag_7:4", lagged_sql("t_product_panel", "series_id"))
def _(r: Retail):
    return forecast.lags(r.dense_series("product"))


@register("win_6", "series_id date rolling_7:4", lagged_sql("t_product_panel", "series_id"))
def _(r: Retail):
    return forecast.lags(r.dense_series("product"))


@register("win_7", "user_id product_category score:4",
          "SELECT * FROM t_affinity QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_category) = 1")
def _(r: Retail):
    scores = features.category_affinity(features.user_product_cells(r.clean))
    first = Window.partitionBy("user_id").orderBy(F.desc("score"), "product_category")
    return scores.withColumn("_rn", F.row_number().over(first)).where("_rn = 1")


def group_volumes(r: Retail) -> DataFrame:
    """Daily number of events and mean event value of browsing, purchases and the rest."""
    group = F.when(F.col("event_type").isin("view", "click"), "browsing").when(
        F.col("event_type") == "purchase", "purchase").otherwise("other")
    return r.table("events").groupBy(F.col("ts").cast("date").alias("date"), group.alias("event_group")).agg(
        F.count(F.lit(1)).alias("event_volume"), F.avg("value").alias("average_value"))


_LATEST = "SELECT * FROM t_group_volumes QUALIFY row_number() OVER (PARTITION BY event_group ORDER BY date DESC) = 1"


@register("win_8", "event_group date event_volume:i average_value:4", _LATEST)
def _(r: Retail):
    return monitor.latest_per_group(group_volumes(r))


@register("win_9", "user_id rank:i product_id", "SELECT * FROM t_recommended")
def _(r: Retail):
    return r.recommendations(r.clean_table)


@register("win_10", "product_id optimal_price:4 expected_margin:4", "SELECT * FROM t_chosen")
def _(r: Retail):
    return pricing.choose(pricing.bounds(pricing.contexts(r.offers)))


# --- top-k, sets, samples, splits ----------------------------------------------------------------

@register("top_1", "user_id product_id retrieval_score:5", "SELECT * FROM t_candidates")
def _(r: Retail):
    return r.candidates(r.clean_table)


@register("top_2", "user_id product_id product_score:4", "SELECT * FROM t_recommended")
def _(r: Retail):
    return r.recommendations(r.clean_table)


_TOP_USERS = "SELECT user_id, ltv_estimate FROM t_users ORDER BY round(ltv_estimate, 6) DESC, user_id LIMIT 500"


@register("top_3", "user_id", _TOP_USERS)
def _(r: Retail):
    return ranking.top_users(r.users, 500)


@register("top_4", "product_id category demand_score:6", "SELECT * FROM t_products ORDER BY round(demand_score, 6) DESC, product_id LIMIT 8")
def _(r: Retail):
    return r.products.orderBy(F.desc(F.round("demand_score", 6)), "product_id").limit(8)


@register("top_5", "feature importance:4")
def _(r: Retail):
    model = pricing.fit_conversion_model(r.frame)
    rows = pricing.permutation_importance(
        r.frame, pricing.model_score(model), [*K.PRICING_NUMERIC, "product_category"], ["event_id"])
    return rows.orderBy(F.desc("importance"), "feature").limit(10)


@register("top_6", "category date predicted_demand:2", """
  SELECT category, date, sum(predicted_demand) AS predicted_demand FROM ({recursive}) GROUP BY ALL""".format(
    recursive="SELECT * FROM t_product_forecast"))
def _(r: Retail):
    return forecast.forecast_by_category(forecast.forecast_naive(r.recent_demand, 30, "product_id"), key="product_id")


@register("top_7", "user_id product_category product_id", f"""
  WITH ids AS (SELECT category, product_id, row_number() OVER (PARTITION BY category ORDER BY product_id) - 1 AS pos,
      count(*) OVER (PARTITION BY category) AS n FROM t_catalog),
  best AS (SELECT * FROM t_affinity QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_category) <= 2)
  SELECT user_id, product_category, product_id FROM best JOIN ids ON category = product_category
  WHERE (pos - ({hash32('user_id', 'product_category', seed='42')} % n) + n) % n < least(greatest(3, n // 10), n)""")
def _(r: Retail):
    return sampling.preferred_items(features.category_affinity(features.user_product_cells(r.clean)), r.catalog)


@register("set_1", "event_id event_type", "SELECT event_id, event_type FROM t_train UNION ALL SELECT event_id, event_type FROM t_test")
def _(r: Retail):
    train, test = r.split
    return reduce(DataFrame.unionByName, [train, test])


@register("set_2", "user_id hits:i", """
  SELECT user_id, count(*) AS hits FROM t_train_recommended JOIN t_relevant USING (user_id, product_id) GROUP BY user_id""")
def _(r: Retail):
    train, test = r.split
    hits = r.recommendations(train).select("user_id", "product_id").join(evaluation.relevant_pairs(test), ["user_id", "product_id"])
    return hits.groupBy("user_id").agg(F.count(F.lit(1)).alias("hits"))


@register("set_3", "items:i", "SELECT count(DISTINCT product_id) AS items FROM t_recommended")
def _(r: Retail):
    return r.recommendations(r.clean_table).agg(F.count_distinct("product_id").alias("items"))


_U = f"({hash32('event_id', seed='42')} / 4294967296.0)"


@register("smp_1", "event_id event_type", f"""
  SELECT event_id, event_type FROM t_clean ORDER BY pow({_U}, 1 / {case(WEIGHT, 'event_type', 0.5)}) DESC, event_id LIMIT 5000""")
def _(r: Retail):
    return sampling.weighted_sample(r.clean, 5000, S.training_weight(), ["event_id"])


@register("smp_2", "event_id event_type", f"SELECT event_id, event_type FROM t_clean ORDER BY {hash32('event_id', seed='42')}, event_id LIMIT 25000")
def _(r: Retail):
    return sampling.uniform_sample(r.clean_table, 25000, ["event_id"])


@register("spl_1", "event_id is_test", """
  SELECT event_id, epoch_us(timestamp) > (SELECT cutoff_us FROM t_cut) AS is_test FROM t_clean""")
def _(r: Retail):
    train, test = r.split
    return train.select("event_id", F.lit(False).alias("is_test")).unionByName(test.select("event_id", F.lit(True).alias("is_test")))


@register("spl_2", "series_id date is_test", """
  SELECT series_id, date, date > (SELECT max(date) - 21 FROM t_product_panel) AS is_test FROM t_product_panel""")
def _(r: Retail):
    train, test = forecast.holdout(r.dense_series("product"))
    return train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))


@register("unp_1_metrics", "model variable value:4", f"""
  SELECT model, variable, value FROM (
    SELECT model, unnest(['catalog_coverage', 'diversity', 'estimated_revenue_uplift', 'baseline_wape']) AS variable,
      unnest([CAST(catalog_coverage AS DOUBLE), CAST(diversity AS DOUBLE), CAST(estimated_revenue_uplift AS DOUBLE), CAST(baseline_wape AS DOUBLE)]) AS value
    FROM ({QUERIES['agg_20'].sql})) WHERE value IS NOT NULL""")
def _(r: Retail):
    metrics = QUERIES["agg_20"].build(r).select("model", "catalog_coverage", "diversity", "estimated_revenue_uplift", "baseline_wape")
    return kpis.long_metrics(metrics)


@register("unp_1", "product_id variable value:2", """
  SELECT product_id, 'current_price' AS variable, current_price AS value FROM t_decisions
  UNION ALL SELECT product_id, 'optimal_price', optimal_price FROM t_decisions""")
def _(r: Retail):
    return r.decisions.unpivot("product_id", ["current_price", "optimal_price"], "variable", "value")
