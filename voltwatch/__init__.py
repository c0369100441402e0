"""voltwatch: fleet-health analytics for field sensors on Spark DataFrames."""

from .config import FEATURE_HEALTH_OUTPUT_COLUMNS
from .operators.health import build_health_features, get_top_risk_devices

__all__ = ["build_health_features", "get_top_risk_devices", "FEATURE_HEALTH_OUTPUT_COLUMNS"]
