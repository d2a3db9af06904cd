"""Constrained price optimization: bounds, candidate grid, scoring, guardrails, impact."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import scalars as S
from ..session import stage
from .ordering import number_rows

Scorer = Callable[[Column], Column]


def contexts(df: DataFrame) -> DataFrame:
    """Fill the inputs of a price decision with their defaults. Needs product_id and price."""
    def get(name: str, *others: Column) -> Column:
        own = [F.col(name)] if name in df.columns else []
        return F.coalesce(*own, *others)

    stock = [F.col("inventory").cast("double")] if "inventory" in df.columns else []
    category = [F.col("category")] if "category" in df.columns else []
    return df.withColumns({
        "price": F.col("price").cast("double"),
        "competitor_price": get("competitor_price", F.col("price").cast("double")),
        "inventory_level": get("inventory_level", *stock, F.lit(100.0)).cast("double"),
        "demand_score": get("demand_score", F.lit(1.0)),
        "seasonality_factor": get("seasonality_factor", F.lit(1.0)),
        "margin": get("margin", F.lit(0.35)),
        "price_elasticity_score": get("price_elasticity_score", F.lit(1.0)),
        "product_category": get("product_category", *category, F.lit("Unknown")),
        "historical_conversion_rate": get("historical_conversion_rate", F.lit(None).cast("double")),
        "rating": get("rating", F.lit(4.0)),
    })


def bounds(ctx: DataFrame, enforce_minimum_margin: bool = False) -> DataFrame:
    """Cost, floor, allowed price range, the rule that set it and its flag.

    A tiny margin can push the floor over the ceiling; the range then collapses to the floor.
    """
    p, stock, demand = F.col("price"), F.col("inventory_level"), F.col("demand_score")
    floor = F.col("cost") * K.MARGIN_FLOOR
    if enforce_minimum_margin:
        floor = F.greatest(floor, F.col("cost") / (1 - F.col("minimum_margin_threshold")))
    clear = (stock > 600) & (demand < 1.2)
    lift = (stock < 75) & (demand > 1.5)
    low = (
        F.when(F.col("_clear"), F.greatest(F.col("price_floor"), p * 0.70))
        .when(F.col("_lift"), F.greatest(F.col("price_floor"), p * 0.78, p * 1.03))
        .when(F.col("_under"), F.col("price_floor"))
        .otherwise(F.greatest(F.col("price_floor"), p * 0.78))
    )
    high = F.when(F.col("_clear"), F.least(p * 1.28, p * 1.02)).when(F.col("_lift"), F.greatest(p * 1.28, p * 1.35)).otherwise(p * 1.28)
    rule = (
        F.when(F.col("_clear"), K.RULE_CLEAR).when(F.col("_lift"), K.RULE_RAISE)
        .when(F.col("_under"), K.RULE_FLOOR).otherwise(K.RULE_BALANCED)
    )
    flag = F.when(F.col("_clear"), K.FLAG_CLEAR).when(F.col("_lift"), K.FLAG_RAISE).when(F.col("_under"), K.FLAG_FLOOR)
    return (
        ctx.withColumn("cost", p * (1 - F.col("margin")))
        .withColumn("price_floor", floor)
        .withColumns({"_clear": clear, "_lift": lift, "_under": p < F.col("price_floor")})
        .withColumn("lower_bound", low)
        .withColumn("upper_bound", F.greatest(high, F.col("lower_bound")))
        .withColumns({"decision_rule": rule, "rule_flag": flag})
        .drop("_clear", "_lift", "_under")
    )


def price_grid() -> Column:
    """Evenly spaced prices from the lower to the upper bound, both included."""
    step = (F.col("upper_bound") - F.col("lower_bound")) / K.PRICE_STEPS
    return F.transform(F.sequence(F.lit(0), F.lit(K.PRICE_STEPS)), lambda i: F.col("lower_bound") + step * i)


def candidate_discount(candidate: Column) -> Column:
    return F.greatest(F.lit(0.0), 1 - candidate / F.greatest(F.col("price"), F.lit(1.0)))


def closed_form(candidate: Column) -> Column:
    """Deterministic purchase probability of a context at a candidate price."""
    return S.propensity_at("_offset", candidate_discount(candidate), "price_elasticity_score", "price", "competitor_price")


def choose(bounded: DataFrame, scorer: Scorer = closed_form) -> DataFrame:
    """Best expected margin over the grid, the lower price on ties.

    The grid stays an array inside its row: nothing is multiplied or shuffled. What does not depend on
    the price is computed before the array, once per row.
    """
    offset = S.propensity_offset(F.lit("click"), "inventory_level", "rating", "seasonality_factor", F.lit(0))

    def scored(p: Column) -> Column:
        prob = scorer(p)
        unit = F.greatest(p - F.col("cost"), F.lit(0.0))
        return F.struct((unit * prob).alias("expected_margin"), (-p).alias("neg_price"), prob.alias("probability"))

    ready = bounded.withColumn("_offset", offset).withColumn("_grid", price_grid())
    return ready.withColumn("_best", F.array_max(F.transform("_grid", scored))).withColumns({
        "optimal_price": -F.col("_best.neg_price"),
        "demand_probability": F.col("_best.probability"),
        "expected_margin": F.col("_best.expected_margin"),
    }).drop("_best", "_grid", "_offset")


def choose_with_model(bounded: DataFrame, model: PipelineModel, keys: tuple[str, ...] = ("product_id",)) -> DataFrame:
    """The same argmax with a fitted model: one set-wise transform of all candidates.

    `keys` identify a context row. Its candidates come from that one row, so the map side folds them
    to one before the shuffle, and the context joins back on its key.
    """
    grid = bounded.withColumn("_candidate", F.explode(price_grid())).withColumns({
        "discount_percentage": candidate_discount(F.col("_candidate")),
        "historical_conversion_rate": F.coalesce("historical_conversion_rate", F.lit(0.04)),
    })
    prob = vector_to_array("probability")[1]
    unit = F.greatest(F.col("_candidate") - F.col("cost"), F.lit(0.0))
    best = model.transform(grid).select(
        *keys, F.struct((unit * prob).alias("expected_margin"), (-F.col("_candidate")).alias("neg_price"), prob.alias("probability")).alias("_c")
    ).groupBy(*keys).agg(F.max("_c").alias("_best"))
    return bounded.join(best, list(keys)).withColumns({
        "optimal_price": -F.col("_best.neg_price"),
        "demand_probability": F.col("_best.probability"),
        "expected_margin": F.col("_best.expected_margin"),
    }).drop("_best")


def guardrails() -> Column:
    """Flags of a decision; ['passed'] when there is none."""
    checks = F.array(
        F.col("rule_flag"),
        F.when(F.col("optimal_price") < F.col("price_floor"), K.FLAG_BELOW_FLOOR),
        F.when((F.col("competitor_price") != 0) & (F.col("optimal_price") > F.col("competitor_price") * 1.2), K.FLAG_COMPETITOR),
    )
    raised = F.filter(checks, lambda f: f.isNotNull())
    return F.when(F.size(raised) == 0, F.array(F.lit(K.FLAG_PASSED))).otherwise(raised)


def revenue_uplift() -> Column:
    hist = F.coalesce("historical_conversion_rate", "demand_probability")
    base = F.col("price") * F.greatest(hist, F.lit(1e-6))
    gained = F.col("optimal_price") * F.col("demand_probability") - F.col("price") * hist
    return gained / F.greatest(base, F.lit(1e-6))


def decisions(chosen: DataFrame) -> DataFrame:
    """The ten-field decision record."""
    return chosen.select(
        "product_id",
        F.round("price", 2).alias("current_price"),
        F.round("optimal_price", 2).alias("optimal_price"),
        F.round("demand_probability", 4).alias("demand_probability"),
        F.round("expected_margin", 2).alias("expected_margin"),
        "decision_rule",
        F.round("competitor_price", 2).alias("competitor_price"),
        F.round(F.col("optimal_price") - F.col("competitor_price"), 2).alias("competitor_price_delta"),
        F.round(revenue_uplift(), 4).alias("revenue_uplift_estimate"),
        guardrails().alias("guardrail_flags"),
    )


def optimise(df: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    bounded = bounds(contexts(df))
    if model is None:
        return decisions(choose(bounded))
    return decisions(choose_with_model(stage(bounded, "price-contexts"), model))


def with_overrides(features: DataFrame, overrides: DataFrame, key: str = "product_id") -> DataFrame:
    """What-if contexts: each override row laid over the stored features of its product."""
    changed = [c for c in overrides.columns if c != key]
    base = features.select([F.col(c).alias(f"_base_{c}" if c in changed else c) for c in features.columns])
    out = overrides.join(base, key, "left")
    out = out.withColumns({
        c: F.coalesce(c, f"_base_{c}") for c in changed if c in features.columns
    }).drop(*[f"_base_{c}" for c in changed])
    spare = [F.col("current_price")] if "current_price" in out.columns else []
    return out.withColumn("price", F.coalesce("price", *spare, F.lit(100.0)))


def product_stats(frame: DataFrame) -> DataFrame:
    return frame.groupBy("product_id").agg(
        F.min("product_category").alias("product_category"),
        F.avg("competitor_price").alias("competitor_price"),
        F.avg("inventory_level").alias("inventory_level"),
        F.avg("demand_score").alias("demand_score"),
        F.avg("seasonality_factor").alias("seasonality_factor"),
        F.avg("discount_percentage").alias("discount_percentage"),
        F.avg("historical_conversion_rate").alias("historical_conversion_rate"),
        F.sum(F.col("purchase_label").cast("bigint")).alias("observed_units"),
    )


def impact_contexts(frame: DataFrame, catalog: DataFrame) -> DataFrame:
    """All catalog products that have pricing statistics."""
    base = catalog.select("product_id", "price", "margin", "price_elasticity_score", "rating")
    return base.join(product_stats(frame), "product_id")


def business_impact(chosen: DataFrame) -> DataFrame:
    units = F.greatest(F.coalesce(F.col("observed_units"), F.lit(1)).cast("double"), F.lit(1.0))
    hist = F.coalesce("historical_conversion_rate", F.lit(0.03))
    opt, prob = F.round("optimal_price", 2), F.round("demand_probability", 4)
    sums = chosen.agg(
        F.sum(F.col("price") * units * hist).alias("r0"),
        F.sum(opt * units * prob).alias("r1"),
        F.sum((F.col("price") - F.col("cost")) * units * hist).alias("m0"),
        F.sum((opt - F.col("cost")) * units * prob).alias("m1"),
        F.sum(hist).alias("c0"),
        F.sum(prob).alias("c1"),
    )

    def gain(after: str, before: str, least: float) -> Column:
        return F.round((F.col(after) - F.col(before)) / F.greatest(F.col(before), F.lit(least)), 4)

    return sums.select(
        gain("r1", "r0", 1.0).alias("estimated_revenue_uplift"),
        gain("m1", "m0", 1.0).alias("estimated_margin_improvement"),
        gain("c1", "c0", 1e-6).alias("estimated_conversion_improvement"),
    )


def _model_inputs(frame: DataFrame) -> DataFrame:
    """A missing number counts as 0 and a missing category as its own, in training and in scoring; no row is dropped."""
    types = dict(frame.dtypes)
    filled = frame.withColumns({c: S.number_or_zero(c, types[c]) for c in K.PRICING_NUMERIC})
    return filled.withColumn("product_category", F.coalesce("product_category", F.lit("")))


def fit_conversion_model(frame: DataFrame, rounds: int = 20, seed: int = 42) -> PipelineModel:
    """Gradient-boosted purchase probability. Tree splits need no scaling of the inputs."""
    needed = [*K.PRICING_NUMERIC, "product_category", "purchase_label"]
    labelled = _model_inputs(frame).where(F.col("purchase_label").isNotNull())
    usable = stage(labelled.select(*needed), "pricing-train")
    seen = usable.agg(F.min("purchase_label").alias("lo"), F.max("purchase_label").alias("hi")).first()
    if seen.lo == seen.hi:
        raise ValueError("the pricing frame holds one class only; a conversion model needs both")
    return Pipeline(stages=[
        StringIndexer(inputCol="product_category", outputCol="_cat", handleInvalid="keep"),
        OneHotEncoder(inputCol="_cat", outputCol="_cat_vec", dropLast=False),
        VectorAssembler(inputCols=[*K.PRICING_NUMERIC, "_cat_vec"], outputCol="features", handleInvalid="error"),
        GBTClassifier(labelCol="purchase_label", maxIter=rounds, maxDepth=4, stepSize=0.1, seed=seed),
    ]).fit(usable)


def permutation_importance(
    frame: DataFrame, score: Callable[[DataFrame], DataFrame], features: list[str], order_by: list[str], seed: str = "perm"
) -> DataFrame:
    """Rise of the log loss when one feature takes another row's value.

    Rows are numbered once in hash order; each row's donor is the one half a table further. One
    self-join serves every feature. `score` adds a column `probability` to a frame.
    """
    numbered = number_rows(frame.withColumn("_h", S.hash32(*order_by, seed=seed)), ["_h", *order_by], "_at")
    n = numbered.agg(F.count(F.lit(1))).scalar()
    donor = numbered.select(
        ((F.col("_at") + F.floor(n / 2)) % n).alias("_at"), *[F.col(f).alias(f"_donor_{f}") for f in features]
    )
    variants = F.explode(F.array(F.lit("none"), *[F.lit(f) for f in features]))
    spread = numbered.join(donor, "_at").withColumn("feature", variants)
    swapped = spread.withColumns({
        f: F.when(F.col("feature") == f, F.col(f"_donor_{f}")).otherwise(F.col(f)) for f in features
    })
    p = S.clip("probability", 1e-9, 1 - 1e-9)
    y = F.col("purchase_label")
    loss = score(swapped).groupBy("feature").agg(F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("loss"))
    base = loss.where("feature = 'none'").agg(F.max("loss")).scalar()
    return loss.where("feature <> 'none'").select("feature", (F.col("loss") - base).alias("importance"))


def model_score(model: PipelineModel) -> Callable[[DataFrame], DataFrame]:
    def score(df: DataFrame) -> DataFrame:
        return model.transform(_model_inputs(df)).withColumn("probability", vector_to_array("probability")[1])

    return score


def closed_form_score(df: DataFrame) -> DataFrame:
    return df.withColumn("probability", S.purchase_propensity(
        F.lit("click"), "discount_percentage", "price_elasticity_score", "product_price", "competitor_price",
        "inventory_level", "rating", "seasonality_factor", F.lit(0),
    ))
