"""Bind the stored tables to the retail model: catalog, clickstream, sales, pricing, stock, demand.

Attributes the stored tables lack (stock, margin, rating, ...) are derived from stored columns by
plain arithmetic, so any SQL engine derives the same values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from .tables import read_table


def product_catalog(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    return read_table(spark, folder, "part").select(
        key.alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"),
        (0.05 + key % 49 / 100.0).alias("margin"),
        (key * 37 % 888).alias("inventory"),
        (2.7 + key % 24 / 10.0).alias("rating"),
        (key * 13 % 600).alias("review_count"),
        (0.25 + key % 200 / 100.0).alias("price_elasticity_score"),
        (F.col("p_retailprice") * (0.8 + F.col("p_size") / 125.0)).alias("competitor_price"),
        F.col("p_name").alias("text_description"),
    )


def raw_clickstream(spark: SparkSession, folder: str) -> DataFrame:
    return clickstream_from(read_table(spark, folder, "events"), product_catalog(spark, folder))


def clickstream_from(events: DataFrame, catalog: DataFrame, ts: Column | None = None) -> DataFrame:
    """Uncleaned product events; works on a batch or a streaming `events`.

    Error events are delivered twice (at-least-once delivery), the copy under another id.
    """
    ts = F.col("ts") if ts is None else ts
    product = F.get_json_object("props", "$.k").cast("bigint")
    ids = F.when(
        F.col("event_type") == "error",
        F.array(F.col("event_id").cast("string"), F.concat(F.col("event_id").cast("string"), F.lit("-DUP"))),
    ).otherwise(F.array(F.col("event_id").cast("string")))
    discount = F.when(F.col("event_type") != "signup", F.col("value") / 400.0)
    joined = events.select(
        F.explode(ids).alias("event_id"), "user_id", ts.alias("timestamp"), "event_type", "value",
        product.alias("product_id"),
    ).join(catalog, "product_id", "left")
    is_purchase = F.col("event_type") == "purchase"
    day = F.col("timestamp").cast("date")
    day_number = F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
    return joined.select(
        "event_id",
        "user_id",
        F.concat(F.col("user_id").cast("string"), F.lit("-"), day_number.cast("string")).alias("session_id"),
        "timestamp",
        "event_type",
        "product_id",
        F.col("category").alias("product_category"),
        "brand",
        F.col("price").alias("product_price"),
        discount.alias("discount_percentage"),
        F.when(F.col("event_type") != "error", F.col("price") * (0.95 + F.col("value") / 500.0)).alias("competitor_price"),
        F.col("inventory").alias("inventory_level"),
        "rating",
        "review_count",
        F.when(F.col("event_type") == "view", F.col("text_description")).alias("search_query"),
        F.when(F.col("event_type") != "signup", F.col("value") * 4).alias("dwell_time_seconds"),
        F.col("product_id").alias("page_position"),
        is_purchase.cast("int").alias("purchase_label"),
        (is_purchase & (F.col("value") >= 150)).cast("int").alias("return_label"),
        F.coalesce(discount >= 0.2, F.lit(False)).cast("int").alias("promotion_flag"),
        S.holiday_flag(day).alias("holiday_flag"),
        S.seasonality(day).alias("seasonality_factor"),
    )


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with buyer and product: the purchase history over all years."""
    lines = read_table(spark, folder, "lineitem")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    catalog = product_catalog(spark, folder).select("product_id", "category", "brand", "margin")
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(catalog, lines.l_partkey == catalog.product_id)
        .select(
            F.col("o_custkey").alias("user_id"),
            "product_id",
            F.col("category").alias("product_category"),
            "brand",
            "margin",
            F.col("l_shipdate").alias("timestamp"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("product_price"),
            F.col("l_discount").alias("discount_percentage"),
            F.lit(1).alias("purchase_label"),
            (F.col("l_returnflag") == "R").cast("int").alias("return_label"),
        )
    )


def product_days(spark: SparkSession, folder: str) -> DataFrame:
    """Units and lines sold per (product, day): the pre-aggregate every sales series starts from."""
    return (
        read_table(spark, folder, "lineitem")
        .groupBy(F.col("l_partkey").alias("product_id"), F.col("l_shipdate").cast("date").alias("date"))
        .agg(
            F.count(F.lit(1)).alias("daily_sales"),
            F.sum("l_quantity").alias("units"),
            F.sum("l_discount").alias("discount_sum"),
        )
    )


def pricing(spark: SparkSession, folder: str) -> DataFrame:
    discount = (
        product_days(spark, folder)
        .groupBy("product_id")
        .agg((F.sum("discount_sum") / F.sum("daily_sales")).alias("discount_percentage"))
    )
    return (
        product_catalog(spark, folder)
        .join(discount, "product_id", "left")
        .select(
            "product_id",
            F.col("price").alias("current_price"),
            "competitor_price",
            "discount_percentage",
            "margin",
            "price_elasticity_score",
            S.minimum_margin_threshold("margin").alias("minimum_margin_threshold"),
        )
    )


def inventory(spark: SparkSession, folder: str, cover_days: int = 60) -> DataFrame:
    """Stock position with the reorder policy driven by mean daily units over the sales calendar."""
    days = product_days(spark, folder)
    span = days.agg((F.datediff(F.max("date"), F.min("date")) + 1).alias("days")).scalar()
    mean = days.groupBy("product_id").agg(F.sum("units").alias("units")).withColumn("mean_daily", F.col("units") / span)
    return reorder_policy(product_catalog(spark, folder), mean, cover_days)


def reorder_policy(catalog: DataFrame, mean_daily: DataFrame, cover_days: int) -> DataFrame:
    forecast = F.coalesce(F.col("mean_daily"), F.lit(1.0)) * cover_days
    out = catalog.join(mean_daily.select("product_id", "mean_daily"), "product_id", "left").select(
        "product_id",
        F.col("inventory").alias("inventory_level"),
        F.greatest(F.lit(10), F.floor(forecast)).cast("bigint").alias("reorder_point"),
        forecast.alias("demand_forecast"),
    )
    level, point = F.col("inventory_level"), F.col("reorder_point")
    return out.withColumn("stockout_flag", (level <= point * 0.35).cast("int")).withColumn(
        "inventory_risk", F.when(level <= point, "high").otherwise("normal")
    )


def sales_series(spark: SparkSession, folder: str, level: str) -> DataFrame:
    """Daily sales per category, brand or product; pre-aggregated per product before the catalog join."""
    level = "product_id" if level == "product" else level
    catalog = product_catalog(spark, folder).select("product_id", "category", "brand")
    return (
        product_days(spark, folder)
        .join(catalog, "product_id")
        .groupBy(F.col(level).alias("series_id"), "date")
        .agg(F.sum("daily_sales").alias("daily_sales"))
    )


def user_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("user_segment"),
        F.col("c_nationkey").alias("home_location"),
        F.col("c_acctbal").alias("account_balance"),
    )


def item_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("product_id"), F.col("embedding").cast("array<double>").alias("vector"), "label"
    )
