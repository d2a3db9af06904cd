"""The retail tables of one data folder, each built lazily on first use."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning, features, forecast, pricing, ranking, retrieval, sampling, segments, sessions
from ..session import stage, tune
from ..sources import bindings
from ..sources.tables import read_table


class Retail:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = tune(spark), folder.rstrip("/")
        self._candidates: dict[tuple[int, int], tuple[DataFrame, DataFrame]] = {}

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)

    @cached_property
    def catalog(self) -> DataFrame:
        return bindings.product_catalog(self.spark, self.folder)

    @cached_property
    def raw(self) -> DataFrame:
        return bindings.raw_clickstream(self.spark, self.folder)

    @cached_property
    def clean(self) -> DataFrame:
        return cleaning.clean_events(self.raw)

    @cached_property
    def clean_table(self) -> DataFrame:
        """Clean events written once, for jobs that read them many times."""
        return stage(self.clean, "clean")

    @cached_property
    def sessions(self) -> DataFrame:
        return sessions.sessionize(self.clean)

    @cached_property
    def session_table(self) -> DataFrame:
        return stage(sessions.sessionize(self.clean_table), "sessions")

    @cached_property
    def sales(self) -> DataFrame:
        return bindings.sales(self.spark, self.folder)

    @cached_property
    def pricing(self) -> DataFrame:
        return bindings.pricing(self.spark, self.folder)

    @cached_property
    def inventory(self) -> DataFrame:
        return bindings.inventory(self.spark, self.folder)

    @cached_property
    def users(self) -> DataFrame:
        # Dropping copies cannot change the newest time, so that scan skips the deduplication.
        return features.user_features(self.clean, as_of=cleaning.drop_incomplete(self.raw))

    @cached_property
    def products(self) -> DataFrame:
        return features.product_features(self.clean, self.catalog)

    @cached_property
    def demand(self) -> DataFrame:
        """Product x day panel of the clickstream, over the whole catalog."""
        sold = features.purchase_days(self.clean_table)
        entities = self.catalog.select("product_id", "category")
        return forecast.dense_panel(sold, entities, "product_id")

    @cached_property
    def event_demand(self) -> DataFrame:
        """The rows of `demand` whose product has events: an event asks for its own product's days, so others are not laid out."""
        entities = self.catalog.select("product_id", "category").join(self.clean_table.select("product_id").distinct(), "product_id", "left_semi")
        return forecast.dense_panel(features.purchase_days(self.clean_table), entities, "product_id")

    @cached_property
    def frame(self) -> DataFrame:
        return features.pricing_frame(self.clean_table, self.event_demand, self.pricing)

    @cached_property
    def training_frame(self) -> DataFrame:
        """The pricing frame to fit on: an event's own label is left out of its product's rate."""
        return features.pricing_frame(self.clean_table, self.event_demand, self.pricing, leave_one_out=True)

    @cached_property
    def segments(self) -> DataFrame:
        return segments.segments(self.users)

    def sold_series(self, level: str = "category") -> forecast.Demand:
        """Sold days per category or product, and the series they belong to."""
        sold = bindings.sales_series(self.spark, self.folder, level)
        key = "product_id" if level == "product" else level
        return forecast.demand(sold, self.catalog.select(F.col(key).alias("series_id"), "category").distinct())

    def dense_series(self, level: str = "category") -> forecast.DenseSeries:
        """Daily sales per category or product over the whole calendar, one array per series."""
        sold = bindings.sales_series(self.spark, self.folder, level)
        key = "product_id" if level == "product" else level
        entities = self.catalog.select(F.col(key).alias("series_id"), "category").distinct()
        return forecast.dense_series(sold, entities)

    def series(self, level: str = "category") -> DataFrame:
        """Dense daily sales panel per category or product."""
        return self.dense_series(level).rows()

    @cached_property
    def recent_demand(self) -> DataFrame:
        """The last 14 days of `demand`, built from the sold days."""
        entities = self.catalog.select("product_id", "category")
        return forecast.demand(features.purchase_days(self.clean_table), entities, "product_id").tail(14)

    @cached_property
    def items(self) -> DataFrame:
        return bindings.item_vectors(self.spark, self.folder)

    @cached_property
    def split(self) -> tuple[DataFrame, DataFrame]:
        return sampling.temporal_split(self.clean_table)

    def candidates(self, events: DataFrame, k: int = 100) -> DataFrame:
        """Scored once per event set and written: lists, metrics and presence all read it."""
        known = self._candidates.get((id(events), k))
        if known is None:
            users = retrieval.user_vectors(features.interactions(events), self.items)
            found = stage(retrieval.retrieve(users, self.items, features.seen_items(events), k), "candidates")
            known = self._candidates[id(events), k] = (events, found)
        return known[1]

    def recommendations(self, events: DataFrame, k: int = 10) -> DataFrame:
        users = features.user_features(events)
        products = features.product_features(events, self.catalog)
        return ranking.recommend(self.candidates(events), with_price_context(products), users, k)

    @cached_property
    def offers(self) -> DataFrame:
        """Price contexts of all products: features with competitor price, season and history."""
        return with_price_context(self.products).withColumn(
            "historical_conversion_rate", F.col("purchases") / F.greatest(F.col("views"), F.lit(1))
        )

    @cached_property
    def decisions(self) -> DataFrame:
        return pricing.optimise(self.offers)


def with_price_context(products: DataFrame) -> DataFrame:
    """Products without events have no observed competitor price; their own price stands in."""
    return products.withColumn(
        "competitor_price", F.when(F.col("competitor_price") > 0, F.col("competitor_price")).otherwise(F.col("price"))
    )
