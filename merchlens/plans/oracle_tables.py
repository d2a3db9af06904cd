"""Shared SQL tables (CTEs) of the oracles, in DuckDB SQL over the stored Parquet tables."""

from __future__ import annotations

import re


def clip(x: str, low: str, high: str) -> str:
    return f"CASE WHEN ({x}) IS NOT NULL THEN least(greatest({x}, {low}), {high}) END"


def case(table: dict[str, float], x: str, other: float) -> str:
    arms = " ".join(f"WHEN '{k}' THEN CAST({v} AS DOUBLE)" for k, v in table.items())
    return f"CASE {x} {arms} ELSE CAST({other} AS DOUBLE) END"


SCORE = {"view": 1.0, "search": 1.5, "click": 2.0, "add_to_cart": 4.0, "purchase": 8.0}
WEIGHT = {"view": 0.35, "search": 0.45, "click": 0.65, "add_to_cart": 0.9, "purchase": 1.0}
FUNNEL = {"view": 0.01, "click": 0.045, "add_to_cart": 0.18, "purchase": 0.65, "search": 0.025}


def season(d: str) -> str:
    return (
        f"((1.0 + 0.18 * sin(2 * pi() * date_part('week', {d}) / 52)) * (CASE WHEN date_part('isodow', {d}) >= 6 "
        f"THEN 1.08 ELSE 0.97 END) * (CASE WHEN month({d}) IN (11, 12) THEN 1.18 ELSE 1.0 END))"
    )


def holiday(d: str) -> str:
    return f"CAST(month({d}) = 12 OR strftime({d}, '%m-%d') IN ('11-28', '11-29') AS INTEGER)"


def promo_day(d: str) -> str:
    return f"CAST(date_part('isodow', {d}) - 1 IN (4, 5) AS INTEGER)"


def hash32(*parts: str, seed: str) -> str:
    text = " || '|' || ".join([f"CAST({p} AS VARCHAR)" for p in parts] + [f"'{seed}'"])
    return f"CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT)"


def propensity(kind, discount, sens, price, comp, stock, rating, seasonality, promo) -> str:
    relative = clip(f"({comp} - {price} * (1 - {discount})) / greatest({comp}, 1.0)", "-0.4", "0.5")
    score = (
        f"{case(FUNNEL, kind, 0.0)} + 0.19 * {discount} * {sens} + 0.11 * {relative} + 0.035 * ({rating} - 4.0) "
        f"+ 0.025 * ({seasonality} - 1.0) + 0.035 * {promo} + CASE WHEN {stock} < 30 THEN 0.04 ELSE 0.0 END"
    )
    return clip(score, "0.002", "0.82")


def bounded(source: str) -> str:
    """Cost, floor, bounds and rule for a source of price contexts."""
    return f"""
    SELECT *, greatest(hi0, lower_bound) AS upper_bound FROM (
      SELECT *,
        CASE WHEN is_clear THEN greatest(price_floor, price * 0.70)
             WHEN is_lift THEN greatest(price_floor, price * 0.78, price * 1.03)
             WHEN price < price_floor THEN price_floor ELSE greatest(price_floor, price * 0.78) END AS lower_bound,
        CASE WHEN is_clear THEN least(price * 1.28, price * 1.02) WHEN is_lift THEN greatest(price * 1.28, price * 1.35)
             ELSE price * 1.28 END AS hi0,
        CASE WHEN is_clear THEN 'increase discount for high inventory and low demand'
             WHEN is_lift THEN 'increase price for low inventory and high demand'
             WHEN price < price_floor THEN 'avoid price below margin threshold' ELSE 'balanced optimization' END AS decision_rule,
        CASE WHEN is_clear THEN 'high_inventory_low_demand_discount'
             WHEN is_lift THEN 'low_inventory_high_demand_margin_protection'
             WHEN price < price_floor THEN 'minimum_margin_floor' END AS rule_flag
      FROM (SELECT *, price * (1 - margin) AS cost, price * (1 - margin) * 1.08 AS price_floor,
                   inventory_level > 600 AND demand_score < 1.2 AS is_clear,
                   NOT (inventory_level > 600 AND demand_score < 1.2) AND inventory_level < 75 AND demand_score > 1.5 AS is_lift
            FROM ({source})))"""


def chosen(source: str, key: str = "product_id") -> str:
    """Best candidate of the 31-step grid for every bounded context."""
    p = propensity("'click'", "disc", "price_elasticity_score", "price", "competitor_price", "inventory_level", "rating",
                   "seasonality_factor", "0")
    return f"""
    SELECT * FROM (
      SELECT *, greatest(optimal_price - cost, 0) * demand_probability AS expected_margin FROM (
        SELECT *, {p} AS demand_probability FROM (
          SELECT *, greatest(0.0, 1 - optimal_price / greatest(price, 1.0)) AS disc FROM (
            SELECT b.*, lower_bound + ((upper_bound - lower_bound) / 30) * i AS optimal_price
            FROM ({source}) b, range(31) g(i)))))
    QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY expected_margin DESC, optimal_price) = 1"""


def decided(source: str, extra: str = "") -> str:
    return f"""
    SELECT {extra} product_id, round(price, 2) AS current_price, round(optimal_price, 2) AS optimal_price,
      round(demand_probability, 4) AS demand_probability, round(expected_margin, 2) AS expected_margin, decision_rule,
      round(competitor_price, 2) AS competitor_price, round(optimal_price - competitor_price, 2) AS competitor_price_delta,
      round((optimal_price * demand_probability - price * coalesce(historical_conversion_rate, demand_probability))
        / greatest(price * greatest(coalesce(historical_conversion_rate, demand_probability), 1e-6), 1e-6), 4) AS revenue_uplift_estimate,
      coalesce(nullif(concat_ws(',', rule_flag, CASE WHEN optimal_price < price_floor THEN 'margin_floor_violation' END,
        CASE WHEN competitor_price <> 0 AND optimal_price > competitor_price * 1.2 THEN 'competitor_gap_watch' END), ''), 'passed') AS flags
    FROM ({source})"""


def products_of(events: str) -> str:
    return f"""
    SELECT *, 0.45 * ln(1 + purchases) + 0.2 * ctr + 0.2 * conversion_rate + 0.15 * rating / 5 AS demand_score,
      competitor_price / greatest(price, 1.0) AS competitor_price_index
    FROM (SELECT *, clicks / greatest(views, 1) AS ctr, purchases / greatest(views, 1) AS conversion_rate
      FROM (SELECT c.* EXCLUDE (competitor_price), coalesce(views, 0) AS views, coalesce(clicks, 0) AS clicks,
          coalesce(cart_additions, 0) AS cart_additions, coalesce(purchases, 0) AS purchases, coalesce(revenue, 0) AS revenue,
          coalesce(avg_discount, 0) AS avg_discount, coalesce(a.competitor_price, 0) AS competitor_price,
          coalesce(a.inventory_level, c.inventory) AS inventory_level
        FROM t_catalog c LEFT JOIN (
          SELECT product_id, count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'click') AS clicks,
            count(*) FILTER (event_type = 'add_to_cart') AS cart_additions, CAST(sum(purchase_label) AS BIGINT) AS purchases,
            sum(CASE WHEN purchase_label = 1 THEN product_price * (1 - discount_percentage) ELSE 0 END) AS revenue,
            avg(discount_percentage) AS avg_discount, avg(competitor_price) AS competitor_price, avg(inventory_level) AS inventory_level
          FROM {events} GROUP BY product_id) a USING (product_id)))"""


def users_of(events: str, affinity: str) -> str:
    churn = clip("0.15 + 0.018 * days_since_last_event - 0.08 * ln(1 + purchases) - 0.05 * ctr", "0", "0.98")
    return f"""
    SELECT *, {churn} AS churn_risk FROM (
      SELECT *, clicks / greatest(views, 1) AS ctr, purchases / greatest(views, 1) AS conversion_rate,
        total_revenue / greatest(purchases, 1) AS aov,
        total_revenue / greatest(purchases, 1) * greatest(purchases, 1) * 1.8 AS ltv_estimate,
        CAST(greatest(floor((epoch_us((SELECT max(timestamp) FROM {events})) - epoch_us(last_event_ts)) / 1e6 / 86400), 0) AS BIGINT) AS days_since_last_event
      FROM (
        SELECT user_id, count(*) AS total_events, sum(product_price * (1 - discount_percentage) * purchase_label) AS total_revenue,
          avg(discount_percentage) AS avg_discount_seen, avg(product_price) AS avg_price_seen,
          count(DISTINCT product_id) AS unique_products, max(timestamp) AS last_event_ts,
          count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'click') AS clicks,
          count(*) FILTER (event_type = 'add_to_cart') AS cart_additions,
          count(*) FILTER (event_type = 'purchase') AS purchases, count(*) FILTER (event_type = 'search') AS search
        FROM {events} GROUP BY user_id)
      LEFT JOIN (SELECT user_id, arg_min(product_category, (-score, product_category)) AS dominant_category,
          string_agg(product_category || '=' || CAST(CAST(round(affinity * 10000) AS BIGINT) AS VARCHAR), ',' ORDER BY product_category) AS affinity_text
        FROM {affinity} GROUP BY user_id) USING (user_id))"""


def affinity_of(events: str) -> str:
    return f"""
    SELECT *, CASE WHEN total <> 0 THEN round(score / total, 4) END AS affinity FROM (
      SELECT *, sum(score) OVER (PARTITION BY user_id) AS total FROM (
        SELECT user_id, product_category, sum({case(SCORE, 'event_type', 0.0)}) AS score
        FROM {events} WHERE product_category IS NOT NULL GROUP BY ALL))"""


def candidates_of(events: str, k: int = 100) -> str:
    return f"""
    SELECT user_id, product_id, rank, CASE WHEN hi = lo THEN 0.0 ELSE round((s - lo) / (hi - lo), 5) END AS retrieval_score FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s DESC, product_id) AS rank FROM (
        SELECT user_id, product_id, s, min(s) OVER (PARTITION BY user_id) AS lo, max(s) OVER (PARTITION BY user_id) AS hi FROM (
          SELECT user_id, product_id, list_dot_product(u.vector, i.vector) AS s FROM (
            SELECT user_id, list(x / n ORDER BY d) AS vector FROM (
              SELECT user_id, d, x, sqrt(sum(x * x) OVER (PARTITION BY user_id)) AS n FROM (
                SELECT user_id, d, sum(score * vector[d]) / sum(score) AS x
                FROM (SELECT user_id, product_id, sum({case(SCORE, 'event_type', 0.0)}) AS score FROM {events} GROUP BY ALL HAVING score > 0)
                JOIN t_items USING (product_id), range(1, 65) r(d) GROUP BY user_id, d))
            GROUP BY user_id) u, t_items i))
      ANTI JOIN (SELECT DISTINCT user_id, product_id FROM {events}) z USING (user_id, product_id))
    WHERE rank <= {k}"""


RANK_SCORE = propensity("CASE WHEN category_match = 1 THEN 'add_to_cart' ELSE 'click' END", "0.0", "price_elasticity_score", "price",
                        "competitor_price", "inventory_level", "rating", "1.0", "0")


def enriched_of(candidates: str, products: str, users: str) -> str:
    return f"""
    SELECT c.*, p.* EXCLUDE (product_id, competitor_price), CASE WHEN competitor_price > 0 THEN competitor_price ELSE price END AS competitor_price,
      CAST(coalesce(category = dominant_category, false) AS INTEGER) AS category_match
    FROM {candidates} c LEFT JOIN {products} p USING (product_id) LEFT JOIN (SELECT user_id, dominant_category FROM {users}) USING (user_id)"""


def filtered_of(enriched: str, k: int = 10) -> str:
    return f"""
    SELECT * FROM (SELECT *, bool_or(ok) OVER (PARTITION BY user_id) AS any_ok FROM (
      SELECT *, coalesce(inventory_level, 0) > 0 AND coalesce(margin, 0) >= 0.12 AS ok FROM {enriched}))
    WHERE ok OR (NOT any_ok AND rank <= {k})"""


def recommended_of(filtered: str, k: int = 10) -> str:
    return f"""
    SELECT * FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, product_id) AS rank, product_id,
      category AS product_category, brand, CAST(round(CAST(retrieval_score AS DECIMAL(18, 5)), 4) AS DOUBLE) AS retrieval_score, round(ranking_score, 4) AS ranking_score,
      round(score, 4) AS product_score, category_match = 1 AS category_match,
      CASE WHEN category_match = 1 THEN 'Recommended because it matches the user''s category affinity'
           WHEN ranking_score > retrieval_score THEN 'Recommended because ranking features predict purchase intent'
           ELSE 'Recommended because the two-tower retrieval model found similar behavior' END AS recommendation_reason
    FROM (SELECT *, 0.52 * ranking_score + 0.28 * coalesce(retrieval_score, 0) + 0.12 * coalesce(margin, 0)
              + 0.08 * CAST(coalesce(inventory_level, 0) > 0 AS INTEGER) AS score
          FROM (SELECT *, {RANK_SCORE} AS ranking_score FROM {filtered}))
) WHERE rank <= {k}"""


def panel_of(sold: str, entities: str, key: str) -> str:
    return f"""
    SELECT {key}, category, date, CAST(coalesce(daily_sales, 0) AS BIGINT) AS daily_sales,
      round({season('date')}, 3) AS seasonality_factor, {holiday('date')} AS holiday_flag, {promo_day('date')} AS promotion_flag
    FROM (SELECT *, CAST(d AS DATE) AS date FROM {entities},
      (SELECT unnest(generate_series((SELECT min(date) FROM {sold}), (SELECT max(date) FROM {sold}), INTERVAL 1 DAY)) AS d))
    LEFT JOIN {sold} USING ({key}, date)"""


def lagged_of(panel: str, key: str, fill: str = "avg(daily_sales) OVER (PARTITION BY {key})") -> str:
    w = f"(PARTITION BY {key} ORDER BY date"
    return f"""
    SELECT *, coalesce(avg(daily_sales) OVER {w} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), lag_7) AS rolling_7 FROM (
      SELECT *, CAST(coalesce(lag(daily_sales, 7) OVER {w}), {fill.format(key=key)}) AS DOUBLE) AS lag_7 FROM {panel})"""


def recursive_of(panel: str, key: str, horizon: int) -> str:
    """The seven-day lag fed back repeats the last week."""
    return f"""
    SELECT {key}, category, CAST(last_date + CAST(h AS INTEGER) AS DATE) AS date, round(CAST(daily_sales AS DOUBLE), 2) AS predicted_demand
    FROM (SELECT *, max(date) OVER (PARTITION BY {key}) AS last_date,
        row_number() OVER (PARTITION BY {key} ORDER BY date DESC) AS rn FROM {panel}), range(1, {horizon + 1}) g(h)
    WHERE rn <= 7 AND (h - 1) % 7 = 7 - rn"""


_PAIR = "('' || user_id || '-' || strftime(ts, '%Y%m%d'))"

TABLES = {
    "t_catalog": """
      SELECT p_partkey AS product_id, p_type AS category, p_brand AS brand, p_retailprice AS price,
        0.05 + (p_partkey % 49) / 100.0 AS margin, (p_partkey * 37) % 888 AS inventory, 2.7 + (p_partkey % 24) / 10.0 AS rating,
        (p_partkey * 13) % 600 AS review_count, 0.25 + (p_partkey % 200) / 100.0 AS price_elasticity_score,
        p_retailprice * (0.8 + p_size / 125.0) AS competitor_price, p_name AS text_description FROM part""",
    "t_raw": f"""
      SELECT event_id, user_id, {_PAIR} AS session_id, ts AS timestamp, event_type, k AS product_id, category AS product_category, brand,
        price AS product_price, CASE WHEN event_type <> 'signup' THEN value / 400.0 END AS discount_percentage,
        CASE WHEN event_type <> 'error' THEN price * (0.95 + value / 500.0) END AS competitor_price, inventory AS inventory_level,
        rating, review_count, CASE WHEN event_type = 'view' THEN text_description END AS search_query,
        CASE WHEN event_type <> 'signup' THEN value * 4 END AS dwell_time_seconds, k AS page_position,
        CAST(event_type = 'purchase' AS INTEGER) AS purchase_label, CAST(event_type = 'purchase' AND value >= 150 AS INTEGER) AS return_label,
        CAST(coalesce(event_type <> 'signup' AND value / 400.0 >= 0.2, false) AS INTEGER) AS promotion_flag,
        {holiday('CAST(ts AS DATE)')} AS holiday_flag, {season('CAST(ts AS DATE)')} AS seasonality_factor
      FROM (SELECT unnest(CASE WHEN event_type = 'error' THEN [CAST(event_id AS VARCHAR), CAST(event_id AS VARCHAR) || '-DUP']
              ELSE [CAST(event_id AS VARCHAR)] END) AS event_id, ts, user_id, event_type, value,
              CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
      LEFT JOIN t_catalog ON product_id = k""",
    "t_clean": f"""
      SELECT * REPLACE (
        {clip('coalesce(discount_percentage, 0)', '0', '0.9')} AS discount_percentage,
        coalesce(competitor_price, product_price) AS competitor_price,
        {clip('coalesce(dwell_time_seconds, 0)', '0', '900')} AS dwell_time_seconds,
        {clip('coalesce(page_position, 1)', '1', '200')} AS page_position)
      FROM t_raw
      WHERE user_id IS NOT NULL AND session_id IS NOT NULL AND timestamp IS NOT NULL AND event_type IS NOT NULL AND product_id IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY user_id, session_id, timestamp, event_type, product_id ORDER BY event_id) = 1""",
    "t_history": """
      SELECT *, clicks_before / greatest(views_before, 1) AS ctr_before, purchases_before / greatest(views_before, 1) AS conversion_before
      FROM (SELECT product_id, CAST(day + 1 AS TIMESTAMP) AS valid_from, sum(views) OVER w AS views_before, sum(clicks) OVER w AS clicks_before,
          sum(purchases) OVER w AS purchases_before, sum(revenue) OVER w AS revenue_before
        FROM (SELECT product_id, CAST(timestamp AS DATE) AS day, count(*) FILTER (event_type = 'view') AS views,
            count(*) FILTER (event_type = 'click') AS clicks, sum(purchase_label) AS purchases,
            sum(product_price * (1 - discount_percentage) * purchase_label) AS revenue
          FROM t_clean GROUP BY ALL)
        WINDOW w AS (PARTITION BY product_id ORDER BY day ROWS UNBOUNDED PRECEDING))""",
    "t_sess": """
      SELECT *, 'DS-' || user_id || '-' || CASE WHEN num < 1000 THEN lpad(CAST(num AS VARCHAR), 4, '0') ELSE CAST(num AS VARCHAR) END AS derived_session_id
      FROM (SELECT *, CAST(sum(starts) OVER (PARTITION BY user_id ORDER BY timestamp, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS num
        FROM (SELECT *, CASE WHEN prev IS NULL OR epoch_us(timestamp) - epoch_us(prev) > 30 * 60 * 1000000 THEN 1 ELSE 0 END AS starts
          FROM (SELECT *, lag(timestamp) OVER (PARTITION BY user_id ORDER BY timestamp, event_id) AS prev FROM t_clean)))""",
    "t_session_features": f"""
      SELECT derived_session_id AS session_id, min(user_id) AS user_id, min(timestamp) AS session_start, max(timestamp) AS session_end,
        count(*) AS events, count(*) FILTER (event_type = 'search') AS searches, count(*) FILTER (event_type = 'view') AS views,
        count(*) FILTER (event_type = 'click') AS clicks, count(*) FILTER (event_type = 'add_to_cart') AS cart_additions,
        CAST(sum(purchase_label) AS BIGINT) AS purchases, avg(dwell_time_seconds) AS avg_dwell_time,
        max({case(SCORE, 'event_type', 0.0)}) AS max_event_score, count(DISTINCT product_id) AS unique_products,
        (epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 1e6 AS duration_seconds,
        sum(purchase_label) / greatest(count(*) FILTER (event_type = 'view'), 1) AS session_conversion_rate
      FROM t_sess GROUP BY derived_session_id""",
    "t_sales": """
      SELECT o_custkey AS user_id, product_id, category AS product_category, brand, margin, l_shipdate AS timestamp, l_quantity AS quantity,
        l_extendedprice AS product_price, l_discount AS discount_percentage, l_returnflag
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN t_catalog ON l_partkey = product_id""",
    "t_product_days": """
      SELECT l_partkey AS product_id, CAST(l_shipdate AS DATE) AS date, count(*) AS daily_sales, sum(l_quantity) AS units,
        sum(l_discount) AS discount_sum FROM lineitem GROUP BY ALL""",
    "t_pricing": """
      SELECT product_id, price AS current_price, competitor_price, discount_percentage, margin, price_elasticity_score,
        greatest(0.12, margin - 0.08) AS minimum_margin_threshold
      FROM t_catalog LEFT JOIN (SELECT l_partkey AS product_id, avg(l_discount) AS discount_percentage FROM lineitem GROUP BY ALL) USING (product_id)""",
    "t_inventory": """
      SELECT *, CAST(inventory_level <= reorder_point * 0.35 AS INTEGER) AS stockout_flag,
        CASE WHEN inventory_level <= reorder_point THEN 'high' ELSE 'normal' END AS inventory_risk
      FROM (SELECT product_id, inventory AS inventory_level, CAST(greatest(10, floor(coalesce(mean_daily, 1.0) * 60)) AS BIGINT) AS reorder_point,
          coalesce(mean_daily, 1.0) * 60 AS demand_forecast
        FROM t_catalog LEFT JOIN (SELECT product_id, sum(units) / (SELECT max(date) - min(date) + 1 FROM t_product_days) AS mean_daily
          FROM t_product_days GROUP BY product_id) USING (product_id))""",
    "t_affinity": affinity_of("t_clean"),
    "t_users": users_of("t_clean", "t_affinity"),
    "t_products": products_of("t_clean"),
    "t_inventory_features": f"""
      SELECT *, CASE WHEN stockout_risk_score > -0.1 AND stockout_risk_score <= 0.8 THEN 'low'
          WHEN stockout_risk_score > 0.8 AND stockout_risk_score <= 1.5 THEN 'medium'
          WHEN stockout_risk_score > 1.5 AND stockout_risk_score <= 10 THEN 'high' ELSE 'nan' END AS stockout_risk_bucket
      FROM (SELECT i.*, category, demand_score, conversion_rate, purchases,
          {clip('reorder_point / greatest(i.inventory_level, 1) * (1 + coalesce(demand_score, 0))', '0', '10')} AS stockout_risk_score
        FROM t_inventory i LEFT JOIN t_products USING (product_id))""",
    "t_sold": """
      SELECT product_id, CAST(timestamp AS DATE) AS date, count(*) AS daily_sales FROM t_clean WHERE purchase_label = 1 GROUP BY ALL""",
    "t_active": "SELECT product_id, category FROM t_catalog",
    "t_demand": panel_of("t_sold", "t_active", "product_id"),
    "t_frame": """
      SELECT c.product_id, product_category, competitor_price, inventory_level,
        ln(1 + coalesce(daily_sales, 0)) * coalesce(c.seasonality_factor, 1) AS demand_score, c.seasonality_factor, discount_percentage,
        avg(purchase_label) OVER (PARTITION BY c.product_id) AS historical_conversion_rate, coalesce(margin, 0.35) AS margin,
        coalesce(price_elasticity_score, 1.0) AS price_elasticity_score, product_price * (1 - discount_percentage) AS net_price,
        purchase_label, daily_sales, c.holiday_flag, c.promotion_flag, event_id, product_price, rating
      FROM t_clean c LEFT JOIN t_demand d ON d.product_id = c.product_id AND d.date = CAST(c.timestamp AS DATE)
      LEFT JOIN (SELECT product_id, margin, price_elasticity_score FROM t_pricing) p ON p.product_id = c.product_id""",
    "t_segments": """
      SELECT *, CASE WHEN total_events <= 3 THEN 'new users' WHEN purchases >= 5 AND churn_risk < 0.28 THEN 'loyal buyers'
          WHEN ltv_estimate >= 300 AND purchases >= 3 THEN 'high-value customers'
          WHEN avg_discount_seen >= 0.18 AND conversion_rate >= 0.05 THEN 'discount-sensitive customers'
          WHEN views >= 12 AND purchases <= 1 THEN 'frequent browsers' WHEN churn_risk >= 0.62 THEN 'likely-to-churn customers'
          ELSE 'growth customers' END AS customer_segment,
        CASE WHEN churn_risk < 0.35 THEN 'healthy' WHEN purchases > 0 THEN 'save_offer' ELSE 'nurture' END AS retention_signal
      FROM t_users""",
    "t_segment_summary": """
      SELECT customer_segment, count(DISTINCT user_id) AS users, avg(conversion_rate) AS conversion_rate, avg(aov) AS aov,
        avg(ltv_estimate) AS ltv_estimate, avg(churn_risk) AS churn_risk FROM t_segments GROUP BY customer_segment""",
    "t_cat_sold": """
      SELECT category AS series_id, date, sum(daily_sales) AS daily_sales FROM t_product_days JOIN t_catalog USING (product_id) GROUP BY ALL""",
    "t_cat_ids": "SELECT DISTINCT category AS series_id, category FROM t_catalog",
    "t_cat_panel": panel_of("t_cat_sold", "t_cat_ids", "series_id"),
    "t_series_sold": """
      SELECT product_id AS series_id, date, sum(daily_sales) AS daily_sales FROM t_product_days JOIN t_catalog USING (product_id) GROUP BY ALL""",
    "t_series_ids": "SELECT DISTINCT product_id AS series_id, category FROM t_catalog",
    "t_product_panel": panel_of("t_series_sold", "t_series_ids", "series_id"),
    "t_product_forecast": recursive_of("t_demand", "product_id", 30),
    "t_series_forecast": recursive_of("t_product_panel", "series_id", 30),
    "t_items": "SELECT vec_id AS product_id, CAST(embedding AS DOUBLE[]) AS vector, label FROM embeddings",
    "t_cut": "SELECT quantile_cont(epoch_us(timestamp), 0.82) AS cutoff_us FROM t_clean",
    "t_train": "SELECT * FROM t_clean WHERE epoch_us(timestamp) <= (SELECT cutoff_us FROM t_cut)",
    "t_test": "SELECT * FROM t_clean WHERE epoch_us(timestamp) > (SELECT cutoff_us FROM t_cut)",
    "t_candidates": candidates_of("t_clean"),
    "t_enriched": enriched_of("t_candidates", "t_products", "t_users"),
    "t_filtered": filtered_of("t_enriched"),
    "t_recommended": recommended_of("t_filtered"),
    "t_train_affinity": affinity_of("t_train"),
    "t_train_users": users_of("t_train", "t_train_affinity"),
    "t_train_products": products_of("t_train"),
    "t_train_candidates": candidates_of("t_train"),
    "t_train_enriched": enriched_of("t_train_candidates", "t_train_products", "t_train_users"),
    "t_train_filtered": filtered_of("t_train_enriched"),
    "t_train_recommended": recommended_of("t_train_filtered"),
    "t_relevant": "SELECT DISTINCT user_id, product_id FROM t_test WHERE purchase_label = 1",
    "t_user_metrics": """
      SELECT user_id, n_relevant, coalesce(hits, 0) / 10 AS precision_at_k, coalesce(hits, 0) / n_relevant AS recall_at_k,
        CASE WHEN coalesce(returned, 0) > 0 THEN dcg / list_sum(list_transform(range(1, least(n_relevant, 10, returned) + 1), lambda i: 1 / log2(i + 1)))
          ELSE 0 END AS ndcg_at_k, coalesce(ap_sum, 0) / least(n_relevant, 10) AS map_at_k
      FROM (SELECT user_id, count(*) AS n_relevant FROM t_relevant GROUP BY user_id)
      LEFT JOIN (SELECT user_id, count(*) AS returned, sum(hit) AS hits, sum(hit / log2(rank + 1)) AS dcg, sum(hit * so_far / rank) AS ap_sum
        FROM (SELECT *, sum(hit) OVER (PARTITION BY user_id ORDER BY rank) AS so_far FROM (
          SELECT a.user_id, a.rank, CAST(b.user_id IS NOT NULL AS INTEGER) AS hit FROM t_train_recommended a
          LEFT JOIN t_relevant b ON a.user_id = b.user_id AND a.product_id = b.product_id)) GROUP BY user_id) USING (user_id)""",
    "t_offers": """
      SELECT * REPLACE (CASE WHEN competitor_price > 0 THEN competitor_price ELSE price END AS competitor_price), 1.0 AS seasonality_factor,
        purchases / greatest(views, 1) AS historical_conversion_rate, category AS product_category FROM t_products""",
    "t_bounded": bounded("SELECT * FROM t_offers"),
    "t_chosen": chosen("SELECT * FROM t_bounded"),
    "t_decisions": decided("SELECT * FROM t_chosen"),
    "t_day_offers": """
      SELECT d.product_id, d.date, d.category AS product_category, price, margin, inventory AS inventory_level, rating, price_elasticity_score,
        competitor_price, d.seasonality_factor, ln(1 + daily_sales) * d.seasonality_factor AS demand_score, NULL AS historical_conversion_rate,
        CAST(d.product_id AS VARCHAR) || ' ' || CAST(d.date AS VARCHAR) AS offer_id
      FROM t_demand d JOIN t_catalog USING (product_id)""",
    "t_day_decisions": decided(chosen(bounded("SELECT * FROM t_day_offers"), "offer_id"), "date,"),
    "t_stats": """
      SELECT product_id, min(product_category) AS product_category, avg(competitor_price) AS competitor_price, avg(inventory_level) AS inventory_level,
        avg(demand_score) AS demand_score, avg(seasonality_factor) AS seasonality_factor, avg(discount_percentage) AS discount_percentage,
        avg(historical_conversion_rate) AS historical_conversion_rate, CAST(sum(purchase_label) AS BIGINT) AS observed_units
      FROM t_frame GROUP BY product_id""",
    "t_impact": chosen(bounded("""
      SELECT product_id, price, margin, price_elasticity_score, rating, t_stats.* EXCLUDE (product_id) FROM t_catalog JOIN t_stats USING (product_id)""")),
    "t_group_volumes": """
      SELECT CAST(ts AS DATE) AS date, CASE event_type WHEN 'view' THEN 'browsing' WHEN 'click' THEN 'browsing'
          WHEN 'purchase' THEN 'purchase' ELSE 'other' END AS event_group,
        count(*) AS event_volume, avg(value) AS average_value FROM events GROUP BY ALL""",
}


def with_tables(sql: str) -> str:
    """Prefix the statement with the shared tables it needs, in order."""
    need: set[str] = set()

    def visit(text: str) -> None:
        for name in set(re.findall(r"\bt_\w+", text)) & TABLES.keys():
            if name not in need:
                need.add(name)
                visit(TABLES[name])

    visit(sql)
    ordered: list[str] = []

    def place(name: str) -> None:
        for other in sorted(set(re.findall(r"\bt_\w+", TABLES[name])) & TABLES.keys() - {name}):
            if other not in ordered:
                place(other)
        if name not in ordered:
            ordered.append(name)

    for name in sorted(need):
        place(name)
    parts = ", ".join(f"{n} AS MATERIALIZED ({TABLES[n]})" for n in ordered)
    return f"WITH {parts} {sql}" if ordered else sql
