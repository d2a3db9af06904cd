"""Tables, thresholds and formats whose exact value decides the result."""

# Interaction score per event type; any other type scores 0.
EVENT_SCORE = {
    "view": 1.0,
    "search": 1.5,
    "click": 2.0,
    "add_to_cart": 4.0,
    "purchase": 8.0,
}

# Training weight of an interaction; any other type weighs 0.5.
TRAINING_WEIGHT = {
    "view": 0.35,
    "search": 0.45,
    "click": 0.65,
    "add_to_cart": 0.9,
    "purchase": 1.0,
}
OTHER_TRAINING_WEIGHT = 0.5

# Purchase propensity contributed by the funnel stage.
FUNNEL_BASE = {
    "view": 0.01,
    "click": 0.045,
    "add_to_cart": 0.18,
    "purchase": 0.65,
    "search": 0.025,
}

EVENT_TYPES = ["view", "click", "add_to_cart", "purchase", "search"]

# The key that makes two deliveries of an event the same event.
EVENT_KEY = ["user_id", "session_id", "timestamp", "event_type", "product_id"]

# Validation contract per table.
REQUIRED_COLUMNS = {
    "events": [
        "user_id", "session_id", "timestamp", "event_type", "product_id", "product_category",
        "product_price", "discount_percentage", "competitor_price", "inventory_level", "rating",
        "review_count", "user_location", "device_type", "search_query", "purchase_label",
    ],
    "product_catalog": [
        "product_id", "category", "brand", "price", "margin", "inventory", "text_description",
    ],
    "demand": [
        "date", "product_id", "daily_sales", "seasonality_factor", "holiday_flag", "promotion_flag",
    ],
}
# (column, lower bound, upper bound); None leaves that side open.
RANGES = {
    "events": [
        ("product_price", 0, None),
        ("discount_percentage", 0, 0.9),
        ("rating", 1, 5),
        ("purchase_label", 0, 1),
    ],
    "product_catalog": [
        ("price", 0, None),
        ("margin", 0.05, 0.8),
        ("inventory", 0, None),
    ],
    "demand": [
        ("daily_sales", 0, None),
        ("seasonality_factor", 0.1, 3),
    ],
}
NULL_WARNING_RATE = 0.05

SESSION_GAP_MINUTES = 30
MICROBATCH_ROWS = 5000
TRAIN_QUANTILE = 0.82
HOLDOUT_DAYS = 21

# Pricing guardrails.
PRICE_STEPS = 30
MARGIN_FLOOR = 1.08
RULE_BALANCED = "balanced optimization"
RULE_CLEAR = "increase discount for high inventory and low demand"
RULE_RAISE = "increase price for low inventory and high demand"
RULE_FLOOR = "avoid price below margin threshold"
FLAG_CLEAR = "high_inventory_low_demand_discount"
FLAG_RAISE = "low_inventory_high_demand_margin_protection"
FLAG_FLOOR = "minimum_margin_floor"
FLAG_BELOW_FLOOR = "margin_floor_violation"
FLAG_COMPETITOR = "competitor_gap_watch"
FLAG_PASSED = "passed"

# Recommendation blend and texts.
BLEND = {"ranking": 0.52, "retrieval": 0.28, "margin": 0.12, "in_stock": 0.08}
MINIMUM_MARGIN = 0.12
REASON_CATEGORY = "Recommended because it matches the user's category affinity"
REASON_RANKING = "Recommended because ranking features predict purchase intent"
REASON_RETRIEVAL = "Recommended because the two-tower retrieval model found similar behavior"

# Model feature contracts.
PRICING_NUMERIC = [
    "competitor_price", "inventory_level", "demand_score", "seasonality_factor",
    "discount_percentage", "historical_conversion_rate", "margin", "price_elasticity_score",
]
FORECAST_NUMERIC = [
    "day_index", "day_of_week", "month", "seasonality_factor", "holiday_flag", "promotion_flag",
    "lag_7", "rolling_7",
]
RANKER_NUMERIC = [
    "retrieval_score", "price", "margin", "rating", "review_count", "inventory_level",
    "demand_score", "conversion_rate", "ctr", "category_match",
]
SEGMENT_FEATURES = [
    "views", "clicks", "cart_additions", "purchases", "total_revenue", "ctr", "conversion_rate",
    "aov", "ltv_estimate", "avg_discount_seen", "days_since_last_event", "churn_risk",
]

# Drift above this is a "watch".
DRIFT_WATCH = 0.28
