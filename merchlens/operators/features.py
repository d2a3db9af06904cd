"""User, product, inventory, interaction and pricing features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scalars as S
from .sessions import micros


def _count_type(name: str):
    return F.count_if((F.col("event_type") == name) & F.col("product_id").isNotNull())


def user_product_cells(events: DataFrame) -> DataFrame:
    """Partials per (user, category, product): the one shuffle of the events for user features.

    A hot user is spread over their products here, and everything later works on cells.
    """
    bought = S.net_price() * F.col("purchase_label")
    return events.groupBy("user_id", "product_category", "product_id").agg(
        F.count(F.lit(1)).alias("events"),
        _count_type("view").alias("views"),
        _count_type("click").alias("clicks"),
        _count_type("add_to_cart").alias("carts"),
        _count_type("purchase").alias("purchases"),
        _count_type("search").alias("searches"),
        F.sum(bought).alias("revenue"),
        F.sum("discount_percentage").alias("discount_sum"),
        F.count("discount_percentage").alias("discount_n"),
        F.sum("product_price").alias("price_sum"),
        F.count("product_price").alias("price_n"),
        F.max("timestamp").alias("last_ts"),
        F.sum(S.event_score()).alias("score"),
    )


def event_type_counts(events: DataFrame) -> DataFrame:
    """Pivot of event types per user; absent types are 0."""
    return events.groupBy("user_id").agg(
        _count_type("view").alias("views"),
        _count_type("click").alias("clicks"),
        _count_type("add_to_cart").alias("cart_additions"),
        _count_type("purchase").alias("purchases"),
        _count_type("search").alias("search"),
    )


def user_totals(cells: DataFrame) -> DataFrame:
    return cells.groupBy("user_id").agg(
        F.sum("events").alias("total_events"),
        F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("total_revenue"),
        (F.sum("discount_sum") / F.nullif(F.sum("discount_n"), F.lit(0))).alias("avg_discount_seen"),
        (F.sum("price_sum") / F.nullif(F.sum("price_n"), F.lit(0))).alias("avg_price_seen"),
        F.count_distinct("product_id").alias("unique_products"),
        F.max("last_ts").alias("last_event_ts"),
        F.sum("views").alias("views"),
        F.sum("clicks").alias("clicks"),
        F.sum("carts").alias("cart_additions"),
        F.sum("purchases").alias("purchases"),
        F.sum("searches").alias("search"),
    )


def category_affinity(cells: DataFrame) -> DataFrame:
    """Score and share of the user's total per (user, category)."""
    scores = cells.where(F.col("product_category").isNotNull()).groupBy("user_id", "product_category").agg(
        F.sum("score").alias("score")
    )
    total = F.sum("score").over(Window.partitionBy("user_id"))
    return scores.withColumn("affinity", F.when(total != 0, F.round(F.col("score") / total, 4)))


def dominant_category(affinity: DataFrame) -> DataFrame:
    """Highest score per user; equal scores go to the alphabetically first category."""
    best = F.struct((-F.col("score")).alias("s"), F.col("product_category").alias("c"))
    return affinity.groupBy("user_id").agg(F.min(best)["c"].alias("dominant_category"))


def affinity_maps(affinity: DataFrame) -> DataFrame:
    """One map per user; a user has at most as many entries as there are categories."""
    entries = F.sort_array(F.collect_list(F.struct("product_category", "affinity")))
    best = F.struct((-F.col("score")).alias("s"), F.col("product_category").alias("c"))
    return affinity.groupBy("user_id").agg(
        F.map_from_entries(entries).alias("category_affinity"), F.min(best)["c"].alias("dominant_category")
    )


def days_since_last(users: DataFrame, as_of: DataFrame) -> DataFrame:
    """Whole days between the user's last event and the newest event of `as_of`."""
    newest = as_of.agg(F.max("timestamp").alias("t")).select(micros("t").alias("t")).scalar()
    days = F.floor((newest - micros("last_event_ts")) / 86_400_000_000)
    return users.withColumn("days_since_last_event", F.greatest(days, F.lit(0)))


def user_features(events: DataFrame, as_of: DataFrame | None = None) -> DataFrame:
    """The user feature table. Recency counts from the newest event of `as_of` (default: of `events`);
    pass a cheaper source of the same maximum when `events` is costly to compute.
    """
    cells = user_product_cells(events)
    users = user_totals(cells).join(affinity_maps(category_affinity(cells)), "user_id", "left")
    users = users.withColumns({
        "ctr": S.safe_ratio("clicks", "views"),
        "conversion_rate": S.safe_ratio("purchases", "views"),
        "aov": S.safe_ratio("total_revenue", "purchases"),
    }).withColumn("ltv_estimate", S.lifetime_value("aov", "purchases"))
    return days_since_last(users, events if as_of is None else as_of).withColumn(
        "churn_risk", S.churn_risk("days_since_last_event", "purchases", "ctr")
    )


def product_aggregates(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return events.groupBy("product_id").agg(
        F.count_if(kind == "view").alias("views"),
        F.count_if(kind == "click").alias("clicks"),
        F.count_if(kind == "add_to_cart").alias("cart_additions"),
        F.sum(F.col("purchase_label").cast("bigint")).alias("purchases"),
        F.sum(F.when(F.col("purchase_label") == 1, S.net_price()).otherwise(0.0)).alias("revenue"),
        F.avg("discount_percentage").alias("avg_discount"),
        F.avg("competitor_price").alias("event_competitor_price"),
        F.avg("inventory_level").alias("event_inventory"),
    )


def product_features(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """Catalog with event aggregates. Products without events keep their catalog stock."""
    joined = catalog.drop("competitor_price").join(product_aggregates(events), "product_id", "left")
    counts = ["views", "clicks", "cart_additions", "purchases"]
    filled = joined.fillna(0, counts).fillna(0.0, ["revenue", "avg_discount", "event_competitor_price"])
    out = filled.withColumns({
        "inventory_level": F.coalesce("event_inventory", F.col("inventory").cast("double")),
        "competitor_price": F.col("event_competitor_price"),
        "ctr": S.safe_ratio("clicks", "views"),
        "conversion_rate": S.safe_ratio("purchases", "views"),
    })
    return out.withColumns({
        "demand_score": S.product_demand_score("purchases", "ctr", "conversion_rate", "rating"),
        "competitor_price_index": S.competitor_index("competitor_price", "price"),
    }).drop("event_inventory", "event_competitor_price")


def product_history(events: DataFrame) -> DataFrame:
    """Versions of a product's counts: after each day with events, all up to that day, valid from the next midnight.

    Events collapse to one row per product and day before the running sums, so those see days, not events.
    """
    day = F.col("timestamp").cast("date")
    daily = events.where("product_id IS NOT NULL AND timestamp IS NOT NULL").groupBy("product_id", day.alias("_day")).agg(
        F.count_if(F.col("event_type") == "view").alias("views"), F.count_if(F.col("event_type") == "click").alias("clicks"),
        F.sum(F.col("purchase_label").cast("bigint")).alias("purchases"), F.sum(S.net_price() * F.col("purchase_label")).alias("revenue"))
    upto = Window.partitionBy("product_id").orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    counts = ["views", "clicks", "purchases", "revenue"]
    out = daily.select("product_id", F.date_add("_day", 1).cast("timestamp_ntz").alias("valid_from"), *[F.sum(c).over(upto).alias(f"{c}_before") for c in counts])
    return out.withColumn("ctr_before", S.safe_ratio("clicks_before", "views_before")).withColumn("conversion_before", S.safe_ratio("purchases_before", "views_before"))


def with_suffix(df: DataFrame, taken: list[str], key: str, suffix: str) -> DataFrame:
    """Rename the columns that the other side already has, so a join keeps both."""
    return df.select(*[F.col(c).alias(c + suffix if c in taken and c != key else c) for c in df.columns])


def with_pricing(features: DataFrame, pricing: DataFrame) -> DataFrame:
    return features.join(with_suffix(pricing, features.columns, "product_id", "_pricing"), "product_id", "left")


def with_inventory(features: DataFrame, inventory: DataFrame) -> DataFrame:
    return features.join(with_suffix(inventory, features.columns, "product_id", "_inventory"), "product_id", "left")


def inventory_features(inventory: DataFrame, features: DataFrame) -> DataFrame:
    wanted = features.select("product_id", "category", "demand_score", "conversion_rate", "purchases")
    out = inventory.join(wanted, "product_id", "left").withColumn(
        "stockout_risk_score", S.stockout_risk("reorder_point", "inventory_level", "demand_score")
    )
    return out.withColumn("stockout_risk_bucket", S.stockout_bucket("stockout_risk_score"))


def interactions(events: DataFrame) -> DataFrame:
    """User x product scores in long form; never pivoted."""
    return events.groupBy("user_id", "product_id").agg(F.sum(S.event_score()).alias("score"))


def seen_items(events: DataFrame) -> DataFrame:
    return events.select("user_id", "product_id").distinct()


def purchase_days(events: DataFrame) -> DataFrame:
    """Purchases per (product, day) of the clickstream."""
    return (
        events.where("purchase_label = 1")
        .groupBy("product_id", F.col("timestamp").cast("date").alias("date"))
        .agg(F.count(F.lit(1)).alias("daily_sales"))
    )


def pricing_frame(
    events: DataFrame, demand: DataFrame, pricing: DataFrame | None = None, leave_one_out: bool = False
) -> DataFrame:
    """Event-grain pricing features.

    Everything an event needs from its product and day is gathered per (product, day) first, from
    aggregates that combine before the shuffle. The events then join once, on product and day, so a
    hot product is spread over its days.
    With `leave_one_out` an event's own label is left out of its product's rate.
    """
    per_product = events.groupBy("product_id").agg(
        F.sum(F.col("purchase_label").cast("double")).alias("_bought"), F.count("purchase_label").alias("_n")
    )
    if pricing is not None:
        per_product = per_product.join(
            pricing.select("product_id", "margin", "price_elasticity_score"), "product_id", "left"
        )
    else:
        per_product = per_product.withColumns({
            "margin": F.lit(None).cast("double"), "price_elasticity_score": F.lit(None).cast("double")
        })
    dated = events.withColumn("date", F.col("timestamp").cast("date"))
    known = (
        dated.groupBy("product_id", "date").agg(F.count(F.lit(1)).alias("_events")).drop("_events")
        .join(demand.select("product_id", "date", "daily_sales"), ["product_id", "date"], "left")
        .join(per_product, "product_id", "left")
    )
    own = F.col("purchase_label") if leave_one_out else F.lit(0)
    others = F.col("_n") - 1 if leave_one_out else F.col("_n")
    return dated.join(known, ["product_id", "date"], "left").select(
        "product_id",
        "product_category",
        "competitor_price",
        "inventory_level",
        S.event_demand_score("daily_sales", "seasonality_factor").alias("demand_score"),
        "seasonality_factor",
        "discount_percentage",
        F.coalesce((F.col("_bought") - own) / F.nullif(others, F.lit(0)), F.lit(0.0)).alias("historical_conversion_rate"),
        F.coalesce("margin", F.lit(0.35)).alias("margin"),
        F.coalesce("price_elasticity_score", F.lit(1.0)).alias("price_elasticity_score"),
        S.net_price().alias("net_price"),
        "purchase_label",
        "daily_sales",
        "holiday_flag",
        "promotion_flag",
        # Carried for row identity and tie-breaks.
        "event_id",
        "product_price",
        "rating",
    )


def normalise_ranker_columns(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Fill model columns from their alternative names, coerce numbers, and default what is absent."""
    fallback = {
        "category": "product_category", "price": "product_price", "margin": "product_margin",
        "inventory_level": "inventory",
    }
    added = {}
    for name, other in fallback.items():
        if name not in df.columns and other in df.columns:
            added[name] = F.col(other)
    df = df.withColumns(added) if added else df
    types = dict(df.dtypes)
    columns = {
        c: S.number_or_zero(c, types[c]) if c in df.columns else F.lit(0.0) for c in numeric
    } | {c: F.lit("unknown") for c in categorical if c not in df.columns}
    return df.withColumns(columns)
