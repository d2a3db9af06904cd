"""Queries over sources, streams, validation, cleaning, sessions and scalar functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import scalars as S
from ..operators import cleaning, features, ingest, kpis, quality, ranking, retrieval, sessions
from ..session import fresh_path
from ..sources import sinks
from ..sources.tables import read_csv
from ..streaming import clickstream as stream
from .oracle_tables import FUNNEL, SCORE, WEIGHT, case, clip, holiday, promo_day, propensity, season
from .registry import register
from .tables import Retail


def _sizes(named: dict[str, DataFrame], label: str = "table_name") -> DataFrame:
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias(label), "rows") for n, df in named.items()
    ])


def _size_sql(named: dict[str, str], label: str = "table_name") -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS {label}, count(*) AS rows FROM {t}" for n, t in named.items())


# --- sources and sinks -----------------------------------------------------------------------

@register("src_1", "table_name rows:i", _size_sql({
    "user_profiles": "customer", "product_catalog": "t_catalog", "pricing": "t_pricing", "inventory": "t_inventory",
    "demand": "t_demand", "events": "t_raw", "sales": "t_sales"}))
def _(r: Retail):
    from ..sources.bindings import user_profiles
    return _sizes({
        "user_profiles": user_profiles(r.spark, r.folder), "product_catalog": r.catalog, "pricing": r.pricing,
        "inventory": r.inventory, "demand": r.demand, "events": r.raw, "sales": r.sales,
    })


_CATALOG_COLUMNS = "product_id category brand price:4 margin:4 inventory:i rating:4 review_count:i text_description"


@register("src_2", _CATALOG_COLUMNS, "SELECT * FROM t_catalog")
def _(r: Retail):
    path = fresh_path(r.spark, "catalog-csv")
    sinks.write_table(r.catalog, path, "csv")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in r.catalog.schema.fields)
    return read_csv(r.spark, path, schema)


@register("src_3", "product_category revenue:4 purchases:i views:i", """
  SELECT product_category, sum(product_price * (1 - discount_percentage) * purchase_label) AS revenue, sum(purchase_label) AS purchases,
    count(*) FILTER (event_type = 'view') AS views FROM t_clean GROUP BY product_category""")
def _(r: Retail):
    documents = sinks.as_json_rows(kpis.category_performance(r.clean))
    path = fresh_path(r.spark, "summary-json")
    documents.write.text(path)
    parsed = F.from_json("value", "product_category string, revenue double, purchases bigint, views bigint")
    return r.spark.read.text(path).select(parsed.alias("d")).select("d.*")


@register("src_4", "product_id found price:4 text_number:4 purchases:i demand_score:6", """
  SELECT vec_id AS product_id, p.product_id IS NOT NULL AS found, price, TRY_CAST(text_description AS DOUBLE) AS text_number, purchases, demand_score
  FROM embeddings LEFT JOIN t_products p ON p.product_id = vec_id""")
def _(r: Retail):
    requests = r.table("embeddings").select(F.col("vec_id").alias("product_id"))
    return sinks.lookup(requests, r.products, "product_id").withColumn("text_number", sinks.coerce_numeric("text_description"))


@register("src_5", "product_id size:i first:4 last:4 total:4", """
  SELECT vec_id AS product_id, 8 AS size, v[1] AS first, coalesce(v[8], 0) AS last, list_sum(v) AS total FROM (
    SELECT vec_id, list_slice(CAST(embedding AS DOUBLE[]), 1, least(label + 4, 8)) AS v FROM embeddings)""")
def _(r: Retail):
    # Vectors travel as JSON text of 4 to 13 numbers: shorter ones are padded, longer ones cut.
    text = F.to_json(F.slice(F.col("embedding").cast("array<double>"), F.lit(1), F.col("label") + 4))
    v = S.parse_vector(text, 8)
    return r.table("embeddings").select(
        F.col("vec_id").alias("product_id"), F.size(v).alias("size"), v[0].alias("first"), v[7].alias("last"),
        F.aggregate(v, F.lit(0.0), lambda a, x: a + x).alias("total"),
    )


# --- ingestion and streams ---------------------------------------------------------------------

@register("ing_1", "event_id stream_offset:i microbatch_id:i", """
  SELECT event_id, o AS stream_offset, o // 1000 + 1 AS microbatch_id
  FROM (SELECT event_id, row_number() OVER (ORDER BY timestamp, event_id) - 1 AS o FROM t_raw)""")
def _(r: Retail):
    return ingest.microbatches(r.raw, 1000)


@register("ing_2", "event_type rows:i users:i",
          "SELECT event_type, count(*) AS rows, count(DISTINCT user_id) AS users FROM t_raw GROUP BY event_type")
def _(r: Retail):
    arrived = stream.ingest_microbatches(stream.product_events(stream.event_stream(r.spark, r.folder), r.catalog))
    empty = arrived.limit(0)
    collected = ingest.collect_batches([arrived, empty])
    return collected.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("user_id").alias("users"))


@register("ing_3", "source kind rows:i", """
  SELECT 'product_catalog' AS source, 'batch' AS kind, count(*) AS rows FROM t_catalog UNION ALL
  SELECT 'pricing', 'batch', count(*) FROM t_pricing UNION ALL SELECT 'inventory', 'batch', count(*) FROM t_inventory UNION ALL
  SELECT 'events', 'stream', count(*) FROM t_raw""")
def _(r: Retail):
    batch = _sizes({"product_catalog": r.catalog, "pricing": r.pricing, "inventory": r.inventory}, "source")
    events = stream.drain(stream.product_events(stream.event_stream(r.spark, r.folder), r.catalog), "events")
    return batch.withColumn("kind", F.lit("batch")).unionByName(_sizes({"events": events}, "source").withColumn("kind", F.lit("stream")))


def _clean_stream(r: Retail) -> DataFrame:
    return stream.clean_stream(stream.product_events(stream.event_stream(r.spark, r.folder), r.catalog))


@register("str_1", "user_id session_id event_type product_id discount_percentage:6 competitor_price:4 dwell_time_seconds:4 page_position:i",
          "SELECT * FROM t_clean")
def _(r: Retail):
    return stream.drain(_clean_stream(r), "clean-stream")


@register("str_1_first", "event_id user_id session_id event_type product_id discount_percentage:6 competitor_price:4 dwell_time_seconds:4 page_position:i copies:i", """
  SELECT c.*, n AS copies FROM t_clean c
  JOIN (SELECT user_id, session_id, timestamp, event_type, product_id, count(*) AS n FROM t_raw GROUP BY ALL) USING (user_id, session_id, timestamp, event_type, product_id)""")
def _(r: Retail):
    """First deliveries that the stream has let go, and those still open at its end from a batch pass."""
    events = stream.product_events(stream.event_stream(r.spark, r.folder), r.catalog)
    out, _late = stream.drain_counted(stream.first_deliveries(events), "first-deliveries")
    closed = out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    counted = r.raw.groupBy(*K.EVENT_KEY).agg(F.count(F.lit(1)).alias("copies"))
    batch = stream.still_open(r.clean_table.join(counted, K.EVENT_KEY), F.col("timestamp"), r.clean_table)
    return closed.unionByName(batch)


@register("str_2", "user_id session_start session_end events:i purchases:i", """
  SELECT user_id, session_start, session_end, events, purchases FROM t_session_features""")
def _(r: Retail):
    """Closed sessions from the stream, those still open at its end from a batch pass."""
    out = stream.drain(stream.session_stream(_clean_stream(r)), "session-stream")
    closed = out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})
    batch = stream.session_stream(r.clean_table)
    return closed.unionByName(stream.still_open(batch, F.col("session_end") + F.expr(f"INTERVAL {K.SESSION_GAP_MINUTES} MINUTES"), r.clean_table))


@register("str_3", "date product_id events:i views:i purchases:i revenue:4", """
  SELECT CAST(timestamp AS DATE) AS date, product_id, count(*) AS events, count(*) FILTER (event_type = 'view') AS views,
    sum(purchase_label) AS purchases, sum(product_price * (1 - discount_percentage) * purchase_label) AS revenue
  FROM t_clean GROUP BY ALL""")
def _(r: Retail):
    """Closed days from the stream, the days still open at its end from a batch pass."""
    closed = stream.drain(stream.daily_features(_clean_stream(r), "product_id"), "daily-stream")
    batch = stream.daily_features(r.clean_table, "product_id")
    return closed.unionByName(stream.still_open(batch, F.col("date").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY"), r.clean_table))


@register("str_4", "event_id user_id product_id rank:i event_type", """
  SELECT event_id, user_id, product_id, rank, t_raw.event_type FROM t_raw JOIN t_train_recommended USING (user_id, product_id)
  WHERE event_type IN ('click', 'purchase')""")
def _(r: Retail):
    served = r.recommendations(r.split[0])
    return stream.drain(stream.feedback(_clean_stream(r), served), "feedback-stream")


@register("str_4_interval", "event_id user_id product_id rank:i event_type seconds_after:3", f"""
  SELECT event_id, user_id, product_id, rank, t_clean.event_type, (epoch_us(timestamp) - epoch_us(served_at)) / 1e6 AS seconds_after
  FROM t_clean JOIN t_train_recommended USING (user_id, product_id)
    JOIN (SELECT user_id, max(timestamp) AS served_at FROM t_train GROUP BY user_id) USING (user_id)
  WHERE t_clean.event_type IN ('click', 'purchase') AND timestamp >= served_at AND timestamp <= served_at + INTERVAL {stream.FEEDBACK_HOURS} HOUR""")
def _(r: Retail):
    """Lists served after each user's last training event, as a stream, joined with the stream of actions."""
    train = r.split[0]
    served_at = train.groupBy("user_id").agg(F.max("timestamp").alias("served_at"))
    served = r.recommendations(train).select("user_id", "product_id", "rank").join(served_at, "user_id")
    found = stream.drain(stream.feedback_within(_clean_stream(r), stream.served_log(served)), "feedback-interval")
    return found.withColumn("seconds_after", (F.unix_micros("timestamp") - F.unix_micros("served_at")) / 1e6)


# --- validation and quality ----------------------------------------------------------------------

@register("val_1", "table_name column_name present row_count:i", f"""
  SELECT 'events' AS table_name, unnest({K.REQUIRED_COLUMNS['events']}) AS column_name, (SELECT count(*) FROM t_raw) AS row_count,
    column_name NOT IN ('user_location', 'device_type') AS present""")
def _(r: Retail):
    return quality.required_columns(r.raw, "events")


_RAW_COLUMNS = [
    "event_id", "user_id", "session_id", "timestamp", "event_type", "product_id", "product_category", "brand", "product_price",
    "discount_percentage", "competitor_price", "inventory_level", "rating", "review_count", "search_query", "dwell_time_seconds",
    "page_position", "purchase_label", "return_label", "promotion_flag", "holiday_flag", "seasonality_factor",
]
_NULL_RATES = " UNION ALL ".join(f"SELECT '{c}' AS column_name, avg(CAST({c} IS NULL AS INTEGER)) AS null_rate FROM t_raw" for c in _RAW_COLUMNS)


@register("val_2", "column_name null_rate:4 warning", f"SELECT *, null_rate > 0.05 AS warning FROM ({_NULL_RATES})")
def _(r: Retail):
    return quality.null_rates(r.raw, "events")


@register("val_3", "l_orderkey rows:i", "SELECT l_orderkey, count(*) AS rows FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def _(r: Retail):
    return quality.duplicate_keys(r.table("lineitem"), "l_orderkey")


_UNEXPECTED = f"""
  SELECT 'event_type' AS column_name, event_type AS value, count(*) AS rows FROM t_raw
  WHERE event_type NOT IN ('view', 'click', 'add_to_cart', 'purchase', 'search') GROUP BY event_type"""


@register("val_4", "column_name value rows:i", _UNEXPECTED)
def _(r: Retail):
    return quality.unexpected_values(r.raw, "event_type", K.EVENT_TYPES)


def _range_sql(table: str, source: str) -> str:
    rows = []
    for c, low, high in K.RANGES[table]:
        below = f"count(*) FILTER ({c} < {low})" if low is not None else "0"
        above = f"count(*) FILTER ({c} > {high})" if high is not None else "0"
        bounds = [f"CAST({'NULL' if b is None else b} AS DOUBLE)" for b in (low, high)]
        rows.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, {bounds[0]} AS lower_bound, {bounds[1]} AS upper_bound, "
                    f"{below} AS below, {above} AS above FROM {source}")
    return " UNION ALL ".join(rows)


_RANGE_COLUMNS = "table_name column_name lower_bound:4 upper_bound:4 below:i above:i"


@register("val_5", _RANGE_COLUMNS, _range_sql("events", "t_raw"))
def _(r: Retail):
    return quality.range_violations(r.raw, "events")


_ALL_RANGES = " UNION ALL ".join([
    _range_sql("events", "t_raw"), _range_sql("product_catalog", "t_catalog"), _range_sql("demand", "t_demand")])


@register("val_6", _RANGE_COLUMNS, _ALL_RANGES)
def _(r: Retail):
    tables = {"events": r.raw, "product_catalog": r.catalog, "demand": r.demand}
    return reduce(DataFrame.unionByName, [quality.range_violations(df, n) for n, df in tables.items()])


@register("val_7", "table_name row_count:i warnings:i errors:i passed", f"""
  SELECT *, errors = 0 AS passed FROM (
    SELECT 'events' AS table_name, (SELECT count(*) FROM t_raw) AS row_count,
      (SELECT count(*) FROM ({_NULL_RATES}) WHERE null_rate > 0.05) AS warnings,
      1 + (SELECT count(*) FROM ({_UNEXPECTED})) + (SELECT sum(CAST(below > 0 AS INTEGER) + CAST(above > 0 AS INTEGER))
        FROM ({_range_sql('events', 't_raw')})) AS errors
    UNION ALL SELECT 'product_catalog', (SELECT count(*) FROM t_catalog), 0,
      (SELECT sum(CAST(below > 0 AS INTEGER) + CAST(above > 0 AS INTEGER)) FROM ({_range_sql('product_catalog', 't_catalog')}))
    UNION ALL SELECT 'demand', (SELECT count(*) FROM t_demand), 0,
      (SELECT sum(CAST(below > 0 AS INTEGER) + CAST(above > 0 AS INTEGER)) FROM ({_range_sql('demand', 't_demand')})))""")
def _(r: Retail):
    tables = {"events": r.raw, "product_catalog": r.catalog, "demand": r.demand}
    return reduce(DataFrame.unionByName, [quality.report(df, n) for n, df in tables.items()])


@register("dq_1", "raw_events:i clean_events:i duplicate_event_rate:4 tracked_missing_value_rate:4 records_removed:i", """
  SELECT n AS raw_events, m AS clean_events, 1 - d / n AS duplicate_event_rate, miss AS tracked_missing_value_rate,
    greatest(n - m, 0) AS records_removed
  FROM (SELECT count(*) AS n, (avg(CAST(search_query IS NULL AS INTEGER)) + avg(CAST(competitor_price IS NULL AS INTEGER))) / 2 AS miss FROM t_raw),
    (SELECT count(*) AS m FROM t_clean),
    (SELECT count(*) AS d FROM (SELECT DISTINCT user_id, session_id, timestamp, event_type, product_id FROM t_raw))""")
def _(r: Retail):
    return quality.quality_summary(r.raw, r.clean)


# --- cleaning and sessions -----------------------------------------------------------------------

@register("cln_1", "event_id parsed", """
  SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS parsed FROM events""")
def _(r: Retail):
    # Error events carry a broken timestamp text.
    text = F.when(F.col("event_type") != "error", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format("ts", "'at' HH"))
    return r.table("events").select("event_id", cleaning.parse_timestamp(text).alias("parsed"))


@register("cln_2", "event_id user_id event_type product_id", "SELECT * FROM t_raw WHERE product_id <> 0")
def _(r: Retail):
    # Product 0 is a placeholder of the source and stands for a missing product.
    return cleaning.drop_incomplete(r.raw.withColumn("product_id", F.nullif("product_id", F.lit(0))))


_CLEAN = "event_id user_id session_id timestamp event_type product_id"


@register("cln_3", _CLEAN, "SELECT * FROM t_clean")
def _(r: Retail):
    return cleaning.first_delivery(r.raw)


@register("cln_4", "event_id discount_percentage:6",
          f"SELECT event_id, {clip('coalesce(discount_percentage, 0)', '0', '0.9')} AS discount_percentage FROM t_raw")
def _(r: Retail):
    return cleaning.repair(r.raw)


@register("cln_5", "event_id competitor_price:4",
          "SELECT event_id, coalesce(competitor_price, product_price) AS competitor_price FROM t_raw")
def _(r: Retail):
    return cleaning.repair(r.raw)


@register("cln_6", "event_id dwell_time_seconds:4 page_position:i purchase_label:i", f"""
  SELECT event_id, {clip('coalesce(dwell_time_seconds, 0)', '0', '900')} AS dwell_time_seconds,
    {clip('coalesce(page_position, 1)', '1', '200')} AS page_position, purchase_label FROM t_raw""")
def _(r: Retail):
    return cleaning.repair(r.raw)


@register("cln_7", _CLEAN + " discount_percentage:6 dwell_time_seconds:4", "SELECT * FROM t_clean")
def _(r: Retail):
    return r.clean.orderBy("user_id", "timestamp", "event_id")


@register("ses_1", "event_id user_id derived_session_number:i derived_session_id",
          "SELECT event_id, user_id, num AS derived_session_number, derived_session_id FROM t_sess")
def _(r: Retail):
    return r.sessions


@register("ses_2", "session_id user_id session_start session_end events:i searches:i views:i clicks:i cart_additions:i purchases:i "
          "avg_dwell_time:4 max_event_score:4 unique_products:i duration_seconds:4 session_conversion_rate:4",
          "SELECT * FROM t_session_features")
def _(r: Retail):
    return sessions.session_features(r.sessions)


# --- scalar functions ----------------------------------------------------------------------------

def _scalar(name: str, columns: str, sql: str, **expressions):
    """A query that adds scalar expressions to clean events."""
    @register(name, columns, sql)
    def _(r: Retail):
        return r.clean.withColumns({n: e() for n, e in expressions.items()})


_scalar("scl_1", "event_id event_score:4", f"SELECT event_id, {case(SCORE, 'event_type', 0.0)} AS event_score FROM t_clean",
        event_score=S.event_score)
_scalar("scl_2", "event_id weight:4", f"SELECT event_id, {case(WEIGHT, 'event_type', 0.5)} AS weight FROM t_clean",
        weight=S.training_weight)
_scalar("scl_3", "event_id net_price:4 net_revenue:4", """
  SELECT event_id, product_price * (1 - discount_percentage) AS net_price,
    product_price * (1 - discount_percentage) * purchase_label AS net_revenue FROM t_clean""",
        net_price=S.net_price, net_revenue=kpis.net_revenue)


@register("scl_4", "user_id ctr:6 conversion_rate:6 aov:4", "SELECT * FROM t_users")
def _(r: Retail):
    return r.users


@register("scl_5", "user_id ltv_estimate:4", "SELECT * FROM t_users")
def _(r: Retail):
    return r.users


@register("scl_6", "user_id churn_risk:6", "SELECT * FROM t_users")
def _(r: Retail):
    return r.users


@register("scl_7", "product_id demand_score:6", "SELECT * FROM t_products")
def _(r: Retail):
    return r.products


@register("scl_8", "event_id demand_score:6", "SELECT * FROM t_frame")
def _(r: Retail):
    return r.frame


@register("scl_9", "product_id competitor_price_index:6", "SELECT * FROM t_products")
def _(r: Retail):
    return r.products


@register("scl_10", "product_id stockout_risk_score:6", "SELECT * FROM t_inventory_features")
def _(r: Retail):
    return features.inventory_features(r.inventory, r.products)


@register("scl_11", "product_id stockout_risk_bucket", "SELECT * FROM t_inventory_features")
def _(r: Retail):
    return features.inventory_features(r.inventory, r.products)


def _on_days(name: str, columns: str, sql: str, **expressions):
    """A query over every ship date of the order lines."""
    @register(name, columns, f"SELECT date, {sql} FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem)")
    def _(r: Retail):
        days = r.table("lineitem").select(F.col("l_shipdate").cast("date").alias("date")).distinct()
        return days.withColumns({n: e("date") for n, e in expressions.items()})


_on_days("scl_12", "date holiday_flag:i", f"{holiday('date')} AS holiday_flag", holiday_flag=S.holiday_flag)
_on_days("scl_13", "date seasonality_factor:6", f"{season('date')} AS seasonality_factor", seasonality_factor=S.seasonality)
_on_days("scl_14", "date promotion_flag:i", f"{promo_day('date')} AS promotion_flag", promotion_flag=S.promotion_day)


@register("scl_15", "date day_index:i day_of_week:i month:i", """
  SELECT date, date - (SELECT CAST(min(l_shipdate) AS DATE) FROM lineitem) AS day_index, date_part('isodow', date) - 1 AS day_of_week,
    month(date) AS month FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem)""")
def _(r: Retail):
    lines = r.table("lineitem")
    start = lines.agg(F.min("l_shipdate").cast("date")).scalar()
    return lines.select(F.col("l_shipdate").cast("date").alias("date")).distinct().withColumns({
        "day_index": F.datediff("date", start), "day_of_week": F.weekday("date"), "month": F.month("date")})


@register("scl_16", "user_id product_id scaled:6", f"""
  SELECT user_id, product_id, CASE WHEN hi = lo THEN 0 ELSE (score - lo) / (hi - lo) END AS scaled FROM (
    SELECT *, min(score) OVER (PARTITION BY user_id) AS lo, max(score) OVER (PARTITION BY user_id) AS hi FROM (
      SELECT user_id, product_id, sum({case(SCORE, 'event_type', 0.0)}) AS score FROM t_clean GROUP BY ALL))""")
def _(r: Retail):
    return retrieval.min_max(features.interactions(r.clean), "user_id", "score", "scaled")


_scalar("scl_17", "event_id p:6", "SELECT event_id, 1 / (1 + exp(-(dwell_time_seconds / 100 - 2))) AS p FROM t_clean",
        p=lambda: S.sigmoid(F.col("dwell_time_seconds") / 100 - 2))


@register("scl_18", "product_id norm:6 first:6 cosine:6", """
  SELECT vec_id AS product_id, n AS norm, v[1] / n AS first, list_dot_product(v, w) / (n * sqrt(list_dot_product(w, w))) AS cosine
  FROM (SELECT *, sqrt(list_dot_product(v, v)) AS n, list_reverse(v) AS w FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings))""")
def _(r: Retail):
    unit = S.l2_normalised("vector")
    return r.items.select(
        "product_id", F.sqrt(S.dot("vector", "vector")).alias("norm"), unit[0].alias("first"),
        S.dot(unit, S.l2_normalised(F.reverse("vector"))).alias("cosine"),
    )


@register("scl_19", "event_id discount:6 ratio:6 text:4", """
  SELECT event_id, coalesce(discount_percentage, 0) AS discount, CASE WHEN page_position = 0 OR dwell_time_seconds IS NULL THEN 0 ELSE dwell_time_seconds / page_position END AS ratio,
    0.0 AS text FROM t_raw""")
def _(r: Retail):
    # A zero position gives an infinite ratio, which counts as 0, as do missing values and unreadable text.
    ratio = F.when(F.col("page_position") == 0, F.lit(float("inf"))).otherwise(
        F.col("dwell_time_seconds") / F.greatest("page_position", F.lit(1)))
    return r.raw.select(
        "event_id", S.number_or_zero("discount_percentage", "double").alias("discount"),
        S.number_or_zero(ratio, "double").alias("ratio"), S.number_or_zero("session_id").alias("text"),
    )


@register("scl_20", "event_id category price:4 margin:4 inventory_level:4 brand", """
  SELECT event_id, product_category AS category, product_price AS price, 0.0 AS margin, inventory_level, brand FROM t_clean""")
def _(r: Retail):
    return features.normalise_ranker_columns(r.clean, K.RANKER_NUMERIC, ranking.CATEGORICAL)


@register("scl_21", "product_id popularity:4",
          "SELECT product_id, rating * ln(1 + review_count) * sqrt(inventory) AS popularity FROM t_catalog")
def _(r: Retail):
    return r.catalog.withColumn("popularity", S.popularity("rating", "review_count", "inventory"))


_scalar("scl_22", "event_id propensity:6", "SELECT event_id, " + propensity(
    "event_type", "discount_percentage", "0.5", "product_price", "competitor_price", "inventory_level", "rating", "seasonality_factor",
    "promotion_flag") + " AS propensity FROM t_clean",
    propensity=lambda: S.purchase_propensity(
        "event_type", "discount_percentage", F.lit(0.5), "product_price", "competitor_price", "inventory_level", "rating",
        "seasonality_factor", "promotion_flag"))


@register("scl_23", "product_id minimum_margin_threshold:4", "SELECT * FROM t_pricing")
def _(r: Retail):
    return r.pricing


@register("scl_24", "product_id r2:4 r4:6 r5:7",
          "SELECT product_id, round(sqrt(price) * margin, 2) AS r2, round(margin * sqrt(rating), 4) AS r4, round(sqrt(price), 5) AS r5 FROM t_catalog")
def _(r: Retail):
    return r.catalog.withColumns({
        "r2": F.round(F.sqrt("price") * F.col("margin"), 2), "r4": F.round(F.col("margin") * F.sqrt("rating"), 4),
        "r5": F.round(F.sqrt("price"), 5)})


@register("scl_25", "user_id n_train:i cold new_user", """
  SELECT user_id, n_train, coalesce(n_train, 0) <= 3 AS cold, total_events <= 3 AS new_user
  FROM t_users LEFT JOIN (SELECT user_id, count(*) AS n_train FROM t_train GROUP BY user_id) USING (user_id)""")
def _(r: Retail):
    history = r.split[0].groupBy("user_id").agg(F.count(F.lit(1)).alias("n_train"))
    return r.users.join(history, "user_id", "left").withColumns({
        "cold": F.coalesce("n_train", F.lit(0)) <= 3, "new_user": F.col("total_events") <= 3})
