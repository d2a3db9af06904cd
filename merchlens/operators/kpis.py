"""Business KPIs and summary tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S


def net_revenue():
    return S.net_price() * F.col("purchase_label")


def with_margin(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """Events with the catalog margin of their product (0.35 when unknown)."""
    return events.join(catalog.select("product_id", "margin"), "product_id", "left").withColumn(
        "margin", F.coalesce("margin", F.lit(0.35))
    )


def product_margin_totals(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """Revenue and margin per product: the margin joins one row per product, not the events."""
    per_product = events.groupBy("product_id").agg(F.sum(net_revenue()).alias("revenue"))
    return with_margin(per_product, catalog).withColumn("margin_amount", F.col("revenue") * F.col("margin"))


def executive_kpis(
    events: DataFrame, catalog: DataFrame, users: DataFrame, inventory: DataFrame, session_key: str
) -> DataFrame:
    kind = F.col("event_type")
    base = events.agg(
        F.sum(net_revenue()).alias("revenue"),
        F.sum(F.col("purchase_label").cast("bigint")).alias("purchases"),
        F.sum(F.col("return_label").cast("bigint")).alias("returns"),
        F.count_if(kind == "view").alias("views"),
        F.count_if(kind == "click").alias("clicks"),
    )
    margin = product_margin_totals(events, catalog).agg(F.sum("margin_amount")).scalar()
    return base.select(
        events.agg(F.count_distinct("user_id")).scalar().alias("total_users"),
        catalog.agg(F.count_distinct("product_id")).scalar().alias("total_products"),
        events.agg(F.count_distinct(session_key)).scalar().alias("total_sessions"),
        F.round("revenue", 2).alias("total_revenue"),
        F.round(margin, 2).alias("total_margin"),
        F.round(S.safe_ratio("clicks", "views"), 4).alias("ctr"),
        F.round(S.safe_ratio("purchases", "views"), 4).alias("conversion_rate"),
        F.round(S.safe_ratio("revenue", "purchases"), 2).alias("average_order_value"),
        F.round(inventory.agg(F.avg("stockout_flag")).scalar(), 4).alias("stockout_rate"),
        F.round(S.safe_ratio("returns", "purchases"), 4).alias("return_rate"),
        F.round(repeat_purchase_rate(events).scalar(), 4).alias("repeat_purchase_rate"),
        F.round(users.agg(F.avg("ltv_estimate")).scalar(), 2).alias("customer_lifetime_value_estimate"),
    )


def repeat_purchase_rate(events: DataFrame) -> DataFrame:
    buyers = events.where("purchase_label = 1").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return buyers.agg(F.coalesce(F.avg((F.col("n") > 1).cast("double")), F.lit(0.0)).alias("repeat_purchase_rate"))


def revenue_trend(events: DataFrame, catalog: DataFrame, days: int = 45) -> DataFrame:
    """Daily revenue, margin, purchases, ctr and mean label for the newest `days` dates.

    Events collapse to (date, product) before they meet the catalog.
    """
    kind = F.col("event_type")
    cells = events.groupBy(F.col("timestamp").cast("date").alias("date"), "product_id").agg(
        F.sum(net_revenue()).alias("revenue"),
        F.sum(F.col("purchase_label").cast("bigint")).alias("purchases"),
        F.count("purchase_label").alias("n"),
        F.count_if(kind == "view").alias("views"),
        F.count_if(kind == "click").alias("clicks"),
    )
    daily = with_margin(cells, catalog).groupBy("date").agg(
        F.sum("revenue").alias("revenue"),
        F.sum(F.col("revenue") * F.col("margin")).alias("margin"),
        F.sum("purchases").alias("purchases"),
        S.safe_ratio(F.sum("clicks"), F.sum("views")).alias("ctr"),
        (F.sum("purchases") / F.sum("n")).alias("purchase_rate"),
    )
    return daily.orderBy(F.desc("date")).limit(days)


def category_performance(events: DataFrame) -> DataFrame:
    return events.groupBy("product_category").agg(
        F.sum(net_revenue()).alias("revenue"),
        F.sum(F.col("purchase_label").cast("bigint")).alias("purchases"),
        F.count_if(F.col("event_type") == "view").alias("views"),
        F.avg("purchase_label").alias("purchase_rate"),
    )


def day_and_category(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """The numbers of `revenue_trend` and `category_performance`, and of all events, in one pass: a row per day, per category and in total.

    level says which; a missing category is a category. Grouping sets are counted on the map side, so each task sends one row for each
    day, category and total it has seen, and there is one exchange of those.
    """
    kind = F.col("event_type")
    rows = with_margin(events, catalog).select(
        F.col("timestamp").cast("date").alias("date"), "product_category", "purchase_label", net_revenue().alias("_net"), (net_revenue() * F.col("margin")).alias("_margin"),
        (kind == "view").cast("bigint").alias("_view"), (kind == "click").cast("bigint").alias("_click"))
    sets = rows.groupingSets([["date"], ["product_category"], []], "date", "product_category").agg(
        F.grouping_id().alias("_level"), F.sum("_net").alias("revenue"), F.sum("_margin").alias("margin"),
        F.sum(F.col("purchase_label").cast("bigint")).alias("purchases"), F.sum("_view").alias("views"),
        S.safe_ratio(F.sum("_click"), F.sum("_view")).alias("ctr"), F.avg("purchase_label").alias("purchase_rate"))
    level = F.element_at(F.create_map(F.lit(1), F.lit("day"), F.lit(2), F.lit("category"), F.lit(3), F.lit("total")), F.col("_level").cast("int"))
    return sets.withColumn("level", level).drop("_level")


def category_sales(lines: DataFrame, catalog: DataFrame) -> DataFrame:
    """Category revenue over all order lines, pre-aggregated per product before the catalog join."""
    per_product = lines.groupBy(F.col("l_partkey").alias("product_id")).agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
        F.sum("l_quantity").alias("units"),
        F.count(F.lit(1)).alias("purchases"),
        F.count_if(F.col("l_returnflag") == "R").alias("returns"),
    )
    return (
        per_product.join(catalog.select("product_id", "category", "margin"), "product_id")
        .groupBy(F.col("category").alias("product_category"))
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum(F.col("revenue") * F.col("margin")).alias("margin"),
            F.sum("units").alias("units"),
            F.sum("purchases").alias("purchases"),
            S.safe_ratio(F.sum("returns"), F.sum("purchases")).alias("return_rate"),
        )
    )


def inventory_risk(features: DataFrame) -> DataFrame:
    return features.groupBy("stockout_risk_bucket").agg(F.count("product_id").alias("products"))


def demand_summary(demand: DataFrame) -> DataFrame:
    return demand.groupBy("category").agg(
        F.sum("daily_sales").alias("daily_sales"), F.sum("promotion_flag").cast("bigint").alias("promo_days")
    )


def model_metrics(rows: dict[str, DataFrame]) -> DataFrame:
    """One row per model; a metric another model does not have is NULL."""
    named = [df.select(F.lit(name).alias("model"), *df.columns) for name, df in rows.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def long_metrics(metrics: DataFrame) -> DataFrame:
    values = [c for c in metrics.columns if c != "model"]
    return metrics.select("model", *[F.col(c).cast("double") for c in values]).unpivot(
        ["model"], values, "variable", "value"
    ).where(F.col("value").isNotNull())


def product_insights(features: DataFrame, decisions: DataFrame, recommendations: DataFrame) -> DataFrame:
    """Every product with its price decision and how often it is recommended."""
    presence = recommendations.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("times_recommended"), F.min("rank").alias("best_rank")
    )
    return (
        features.join(decisions.select("product_id", "optimal_price", "decision_rule"), "product_id", "left")
        .join(presence, "product_id", "left")
        .withColumn("times_recommended", F.coalesce("times_recommended", F.lit(0)))
    )
