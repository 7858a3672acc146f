"""Parameters and fixed vocabularies.

The thresholds, cut-offs and class vocabulary below are fixed values that the
results depend on; they are stated here once, in natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values -----------------------------------------------------------
# Risk classes as text.
STOCKOUT = "Stockout Risk"
OVERSTOCK = "Overstock Risk"
SAFE = "Safe Zone"
# Encoded class order is alphabetical: 0 Overstock, 1 Safe, 2 Stockout.
CLASS_NAMES = [OVERSTOCK, SAFE, STOCKOUT]
LABELS = CLASS_NAMES
# Default rule thresholds: theta_low 1.2, theta_high 4.5, sales velocity 0.8.
# Threshold scenarios compared side by side (name, theta_low, theta_high, sales_vel).
SCENARIOS = [
    ("Scenario 1", 1.2, 4.5, 0.8),
    ("Scenario 2", 1.0, 1.5, 0.5),
    ("Scenario 3", 1.6, 2.4, 0.7),
]
# Series key and time column of the daily panel.
SERIES_KEYS = ["store_id", "product_id"]
TIME_COL = "dt"
# Columns removed before modelling (leakage list).
DROP_COLS = [
    "risk_label", "risk_label_current", "store_id", "product_id", "dt",
    "demand_forecast", "demand_forecast_clean",
]
# Model inputs, in this order.
NUMERICAL_FEATURES = [
    "inventory_reconstructed", "units_sold", "units_ordered", "price", "discount",
    "units_sold_lag1", "inventory_change_pct", "days_of_stock", "sales_velocity",
    "coverage_ratio", "forecast_error", "order_to_inventory",
]
CATEGORICAL_FEATURES = ["category", "region", "weather_condition", "seasonality"]
FEATURE_COLUMNS = NUMERICAL_FEATURES + CATEGORICAL_FEATURES
# Columns filled with the train-split median.
MEDIAN_FILL_COLS = ["days_of_stock", "sales_velocity"]
# Numeric columns reported by the monitoring summary (those present are used).
MONITOR_NUMERIC = [
    "inventory_reconstructed", "units_sold", "units_ordered", "price", "discount",
    "units_sold_lag1", "inventory_change_pct", "days_of_stock", "sales_velocity",
    "coverage_ratio", "forecast_error", "order_to_inventory",
]
# Scoring contract: API field name -> model column name, with its type.
REQUEST_FIELDS = [
    ("Inventory_Reconstructed", "inventory_reconstructed", "double"),
    ("Units_Sold", "units_sold", "bigint"),
    ("Units_Ordered", "units_ordered", "bigint"),
    ("Price", "price", "double"),
    ("Discount", "discount", "bigint"),
    ("Units_Sold_Lag1", "units_sold_lag1", "double"),
    ("Inventory_Change_Pct", "inventory_change_pct", "double"),
    ("Days_of_Stock", "days_of_stock", "double"),
    ("Sales_Velocity", "sales_velocity", "double"),
    ("Coverage_Ratio", "coverage_ratio", "double"),
    ("Forecast_Error", "forecast_error", "double"),
    ("Order_to_Inventory", "order_to_inventory", "double"),
    ("Category", "category", "string"),
    ("Region", "region", "string"),
    ("Weather_Condition", "weather_condition", "string"),
    ("Seasonality", "seasonality", "string"),
]
# Raw CSV header -> our column name.
RAW_COLUMNS = [
    ("Date", "dt"),
    ("Store ID", "store_id"),
    ("Product ID", "product_id"),
    ("Category", "category"),
    ("Region", "region"),
    ("Inventory Level", "inventory_level"),
    ("Units Sold", "units_sold"),
    ("Units Ordered", "units_ordered"),
    ("Demand Forecast", "demand_forecast"),
    ("Price", "price"),
    ("Discount", "discount"),
    ("Weather Condition", "weather_condition"),
    ("Holiday/Promotion", "holiday_promotion"),
    ("Competitor Pricing", "competitor_pricing"),
    ("Seasonality", "seasonality"),
]


@dataclass(frozen=True)
class RiskParams:
    """Tunable parameters of the labelling and split steps."""

    theta_low: float = 1.2
    theta_high: float = 4.5
    sales_vel: float = 0.8
    # Which label wins when both rule conditions hold: "overstock" (code order
    # of the feature pipeline) or "stockout" (stated intent, stage-1 code).
    precedence: str = "overstock"
    # Rows dropped at the end of every series by the next-day shift (1, or 2 to
    # reproduce the doubled shift of the stage-2 notebook).
    drop_tail: int = 1
    # Temporal split cut-offs for the driver tables (train < val < test).
    cutoff_val: str = "2000-02-01"
    cutoff_test: str = "2001-02-01"
    sample_frac: float = 1.0
    seed: int = 42
    extra: dict = field(default_factory=dict, compare=False, hash=False)
