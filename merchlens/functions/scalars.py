"""Scalar expressions. Each takes columns (or names) and returns a Column; all stay in codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def by_type(table: dict[str, float], event_type: Column | str, other: float) -> Column:
    """CASE over a small fixed table of event types."""
    out = F.when(F.lit(False), F.lit(0.0))
    for name, value in table.items():
        out = out.when(col(event_type) == name, F.lit(value))
    return out.otherwise(F.lit(other))


def event_score(event_type: Column | str = "event_type") -> Column:
    return by_type(K.EVENT_SCORE, event_type, 0.0)


def training_weight(event_type: Column | str = "event_type") -> Column:
    return by_type(K.TRAINING_WEIGHT, event_type, K.OTHER_TRAINING_WEIGHT)


def clip(x: Column | str, low: float, high: float) -> Column:
    """Clip that keeps NULL as NULL (greatest/least would skip it)."""
    x = col(x)
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def net_price(price: Column | str = "product_price", discount: Column | str = "discount_percentage") -> Column:
    return col(price) * (1 - col(discount))


def safe_ratio(x: Column | str, y: Column | str) -> Column:
    return col(x) / F.greatest(col(y).cast("double"), F.lit(1.0))


def lifetime_value(aov: Column | str, purchases: Column | str) -> Column:
    return col(aov) * F.greatest(col(purchases).cast("double"), F.lit(1.0)) * 1.8


def churn_risk(days: Column | str, purchases: Column | str, ctr: Column | str) -> Column:
    raw = 0.15 + 0.018 * col(days) - 0.08 * F.log1p(col(purchases)) - 0.05 * col(ctr)
    return clip(raw, 0.0, 0.98)


def product_demand_score(purchases, ctr, conversion, rating) -> Column:
    return (
        0.45 * F.log1p(col(purchases)) + 0.2 * col(ctr) + 0.2 * col(conversion) + 0.15 * col(rating) / 5
    )


def event_demand_score(daily_sales, seasonality) -> Column:
    sold = F.coalesce(col(daily_sales), F.lit(0)).cast("double")
    return F.log1p(sold) * F.coalesce(col(seasonality), F.lit(1.0))


def competitor_index(competitor, price) -> Column:
    return safe_ratio(competitor, price)


def stockout_risk(reorder_point, inventory, demand_score) -> Column:
    raw = safe_ratio(reorder_point, inventory) * (1 + F.coalesce(col(demand_score), F.lit(0.0)))
    return clip(raw, 0.0, 10.0)


def stockout_bucket(score: Column | str) -> Column:
    """Right-closed buckets; anything outside (missing included) is the text 'nan'."""
    s = col(score)
    return (
        F.when((s > -0.1) & (s <= 0.8), "low")
        .when((s > 0.8) & (s <= 1.5), "medium")
        .when((s > 1.5) & (s <= 10), "high")
        .otherwise("nan")
    )


def holiday_flag(day: Column | str) -> Column:
    d = col(day)
    return ((F.month(d) == 12) | ((F.month(d) == 11) & F.dayofmonth(d).isin(28, 29))).cast("int")


def seasonality(day: Column | str) -> Column:
    d = col(day)
    yearly = 1.0 + 0.18 * F.sin(2 * math.pi * F.weekofyear(d) / 52)
    weekly = F.when(F.weekday(d) >= 5, 1.08).otherwise(0.97)
    quarter = F.when(F.month(d).isin(11, 12), 1.18).otherwise(1.0)
    return yearly * weekly * quarter


def promotion_day(day: Column | str) -> Column:
    return F.weekday(col(day)).isin(4, 5).cast("int")


def sigmoid(x: Column | str) -> Column:
    return 1 / (1 + F.exp(-col(x)))


def number_or_zero(c: Column | str, source_type: str = "string") -> Column:
    """Coerce to double; unreadable, NULL, NaN and infinite values become 0."""
    c = col(c)
    x = c.try_cast("double") if source_type == "string" else c.cast("double")
    bad = x.isNull() | F.isnan(x) | x.isin(float("inf"), float("-inf"))
    return F.when(bad, 0.0).otherwise(x)


def popularity(rating, reviews, inventory) -> Column:
    return col(rating) * F.log1p(col(reviews)) * F.sqrt(col(inventory).cast("double"))


def propensity_offset(event_type, inventory, rating, season, promotion) -> Column:
    """The part of the purchase propensity that does not depend on the price."""
    return (
        by_type(K.FUNNEL_BASE, event_type, 0.0)
        + 0.035 * (col(rating) - 4.0)
        + 0.025 * (col(season) - 1.0)
        + 0.035 * col(promotion)
        + F.when(col(inventory) < 30, 0.04).otherwise(0.0)
    )


def propensity_at(offset, discount, sensitivity, price, competitor) -> Column:
    """Closed-form purchase probability at a discount, given the price-free offset."""
    c = col(competitor)
    relative = (c - col(price) * (1 - col(discount))) / F.greatest(c, F.lit(1.0))
    bounded = F.least(F.greatest(relative, F.lit(-0.4)), F.lit(0.5))
    score = col(offset) + 0.19 * col(discount) * col(sensitivity) + 0.11 * bounded
    return F.least(F.greatest(score, F.lit(0.002)), F.lit(0.82))


def purchase_propensity(
    event_type, discount, sensitivity, price, competitor, inventory, rating, season, promotion
) -> Column:
    """Closed-form purchase probability; the deterministic scorer for prices and rankings."""
    offset = propensity_offset(event_type, inventory, rating, season, promotion)
    return propensity_at(offset, discount, sensitivity, price, competitor)


def minimum_margin_threshold(margin) -> Column:
    return F.greatest(F.lit(0.12), col(margin) - 0.08)


def dot(a: Column | str, b: Column | str) -> Column:
    pairs = F.zip_with(col(a), col(b), lambda x, y: x * y)
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)


def l2_normalised(v: Column | str) -> Column:
    norm = F.sqrt(dot(v, v))
    return F.when(norm == 0, col(v)).otherwise(F.transform(col(v), lambda x: x / norm))


def unit_hash(*parts: Column | str, seed: str = "") -> Column:
    """Uniform number in [0, 1) from md5, reproducible in any SQL engine."""
    return hash32(*parts, seed=seed) / F.lit(float(2**32))


def hash32(*parts: Column | str, seed: str = "") -> Column:
    return F.conv(F.substring(F.md5(hashed_text(*parts, seed=seed)), 1, 8), 16, 10).cast("bigint")


def hashed_text(*parts: Column | str, seed: str = "") -> Column:
    """The text whose md5 hash32 reads."""
    return F.concat_ws("|", *[col(p).cast("string") for p in parts], F.lit(seed))


def hash_at_most(text: Column, cut: int) -> Column:
    """Whether hash32 of a hashed text is at most `cut`. Digits compare as numbers do, so a row costs its md5 and no conversion."""
    return F.md5(text) < (f"{cut + 1:08x}" if cut + 1 < 1 << 32 else "g")


def pad_vector(v: Column | str, size: int) -> Column:
    """Missing vectors become zeros; short ones are padded and long ones cut."""
    filled = F.coalesce(col(v), F.array().cast("array<double>"))
    return F.slice(F.concat(filled, F.array_repeat(F.lit(0.0), size)), 1, size)


def parse_vector(text: Column | str, size: int) -> Column:
    return pad_vector(F.from_json(col(text), "array<double>"), size)
