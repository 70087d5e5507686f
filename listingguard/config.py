"""Thresholds and column roles of the pipeline."""

from __future__ import annotations

from dataclasses import dataclass

# Column roles of the listing table.
NUMERIC = ("price", "bed", "bath", "acre_lot", "house_size")
CATEGORICAL = ("status", "state")
HIGH_CARDINALITY = ("city", "zip_code")
TEMPORAL = ("prev_sold_date",)
DROPPED = ("street", "brokered_by")
STATELESS = (
    "price_per_sqft",
    "bath_per_bed",
    "price_log",
    "house_size_log",
    "acre_lot_log",
    "is_large_property",
    "days_since_last_sale",
    "sold_year",
    "sold_month",
)
FOLD_DEPENDENT = (
    "price_vs_city_median",
    "zip_listing_count",
    "city_median_price",
    "state_median_price",
    "city_fraud_rate",
)
RULES = (
    "rule_price_low",
    "rule_price_high",
    "rule_price_per_sqft",
    "rule_impossible_dims",
    "rule_size_disconnect",
    "rule_duplicate",
    "rule_state_anomaly",
)
BASE_COLUMNS = NUMERIC + CATEGORICAL + HIGH_CARDINALITY + TEMPORAL
DEDUP_KEY = NUMERIC + CATEGORICAL + HIGH_CARDINALITY

# Listing schema, in declared order.
LISTING_TYPES = {
    "listing_id": "string",
    "brokered_by": "double",
    "status": "string",
    "price": "double",
    "bed": "double",
    "bath": "double",
    "acre_lot": "double",
    "street": "double",
    "city": "string",
    "state": "string",
    "zip_code": "string",
    "house_size": "double",
    "prev_sold_date": "string",
    "description": "string",
}


@dataclass(frozen=True)
class LabelRules:
    """Cut points of the seven labelling rules (fixed values)."""

    price_low_multiplier: float = 0.30
    price_high_multiplier: float = 4.00
    price_per_sqft_quantile: float = 0.03
    impossible_bed: float = 20.0
    impossible_bath: float = 15.0
    impossible_acre: float = 1000.0
    disconnect_sqft: float = 5000.0
    disconnect_price: float = 50000.0
    state_low_multiplier: float = 0.15
    state_high_multiplier: float = 8.00
    duplicate_min_zip_listings: int = 5
    clip_quantile: float = 0.99
    min_fraud_score: int = 2
    target_rate_min: float = 0.03
    target_rate_max: float = 0.08
    min_city_listings: int = 30
    min_state_listings: int = 10


@dataclass(frozen=True)
class Settings:
    """Everything else the jobs read (fixed values unless tuned by the caller)."""

    rules: LabelRules = LabelRules()
    null_warn_pct: float = 30.0
    null_critical_pct: float = 80.0
    min_rows: int = 1000
    skew_log_threshold: float = 1.0
    reference_date: str = "2024-01-01"
    missing_days: int = 9999
    large_property_sqft: float = 3000.0
    cv_folds: int = 5
    test_share: float = 0.20
    seed: int = 42
    suspicious_score: float = 0.70
    review_score: float = 0.40
    latency_target_ms: float = 500.0
    max_price: float = 100_000_000.0
    text_enabled: bool = False
    text_max_features: int = 5000
    text_min_df: int = 5
    text_components: int = 50
    drift_threshold: float = 0.20
    drift_min_count: int = 10
    drift_retrain_above: int = 5
    model_version: str = "1.1.0"


SETTINGS = Settings()
